"""Near copies among vectors, by randomised rotations, binary codes and exact cosines.

A unit vector is rotated at random and kept as the signs of its coordinates, one bit each.
Stored with the code is its correction factor f, the inner product of the vector and the
unit vector its signs stand for: the inner product of code and another vector, divided by
f, estimates the cosine without bias, and its error is below CONFIDENCE *
sqrt((1 - f * f) / (f * f * (dimensions - 1))) but for a known, small probability. The
other vector takes part rotated and in 8-bit steps, the error of which is added to the
bound. Only pairs whose upper bound reaches the threshold are computed exactly, in double
precision from the original vectors, and only exact cosines make links.

Which pairs are estimated follows from the same codes. Bits of the codes form the keys of
tables; two vectors at an angle a differ in each bit with probability a / pi, so `plan`
takes as many tables as bring a pair at the threshold together in one of them with
probability 1 - MISS. A bit more a key for twice as many vectors keeps tables of about
OCCUPANCY rows a key, at every size. A pair counts in the first table that has it.

Groups of near copies do not become pairs. Equal vectors are one row with a count. Rows
that share a longer key look for the smallest of them, and those within half the threshold
angle of the same centre form a ball: by the triangle inequality of angles all of them are
linked, so their links are counted and not compared. Rows of a key are dealt into blocks of
BLOCK rows, large balls into blocks of their own, and a task compares two blocks, never two
of the same ball.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relay.llm.components import components
from relay.llm.permutation_index import usable
from relay.operators.positions import join_per_key
from relay.session import ship, stage

LINK = 0.9
MISS = 0.005
CONFIDENCE = 3.0
OCCUPANCY = 1024
LEAST_BITS = 4
CENTRE_TABLES = 4
CENTRE_BITS = 10  # more than a table's key has
BLOCK = 2048
SALTS = 8


def plan(rows: int, link: float = LINK) -> tuple[int, int]:
    """(bits of a key, number of tables) for so many different vectors."""
    bits = max(LEAST_BITS, round(math.log2(max(rows, 1) / OCCUPANCY)))
    same = (1 - math.acos(link) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - same))


@functools.lru_cache(maxsize=64)
def rotation(size: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([size, number]).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that no square is lost or overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def encode(units: np.ndarray, rotations: int) -> tuple[np.ndarray, np.ndarray]:
    """(signs as booleans, rotations side by side; correction factor of each rotation)."""
    size = units.shape[1]
    turned = [units @ rotation(size, w).T for w in range(rotations)]
    factors = np.stack([np.abs(t).sum(axis=1) / math.sqrt(size) for t in turned], axis=1)
    return np.concatenate([t >= 0 for t in turned], axis=1), factors


def steps(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(8-bit steps, length of a step, length of the error) of unit vectors."""
    scale = np.abs(units).max(axis=1) / 127
    q = np.rint(units / scale[:, None]).astype(np.int8)
    return q, scale, np.sqrt(((units - q * scale[:, None]) ** 2).sum(axis=1))


def estimate(code: tuple, other: tuple, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(estimated cosines, error bounds) of all rows of one block with all of another.
    A block is (signs, factors, steps, step lengths, step errors)."""
    def one_way(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
        signs, factors, count = a[0], a[1], a[1].shape[1]
        near = (b[2] * b[3][:, None]).astype(np.float32)
        total = np.zeros((len(signs), len(near)), np.float32)
        for w in range(count):
            ones = np.where(signs[:, w * size:(w + 1) * size], 1, -1).astype(np.float32)
            total += (ones / (factors[:, w:w + 1] * math.sqrt(size)).astype(np.float32)) @ (
                near @ rotation(size, w).T.astype(np.float32)).T
        f2 = factors * factors
        spread = np.sqrt(np.maximum(1 - f2, 0) / f2 / max(size - 1, 1)).mean(axis=1) / math.sqrt(count)
        return total / count, CONFIDENCE * spread[:, None] + b[4][None, :]

    there, bound = one_way(code, other)
    back, bound_back = one_way(other, code)
    return (there + back.T) / 2, (bound + bound_back.T) / 2


def keys_of(signs: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The key of every row in every table, from consecutive bits of the codes."""
    weights = 1 << np.arange(bits, dtype=np.int64)
    return signs[:, :bits * tables].reshape(len(signs), tables, bits) @ weights


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of vectors in a list column without nulls."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, values[(ends[at] - size)[:, None] + np.arange(size)]


def _name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a digest of their vector, equal for equal vectors."""
    for batch in batches:
        names = [b""] * batch.num_rows
        for at, matrix in _matrices(batch.column(1)):
            for i, row in zip(at, matrix + 0.0):
                names[i] = hashlib.sha256(row.tobytes()).digest()[:16]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary()), batch.column(1)],
                                         names=["id", "k", "v"])


CODES = ("k binary, id long, n long, size int, code binary, factors array<double>, q binary, scale double, "
         "error double, keys array<long>, centres array<long>")
CODE_TYPES = pa.schema([
    ("k", pa.binary()), ("id", pa.int64()), ("n", pa.int64()), ("size", pa.int32()), ("code", pa.binary()),
    ("factors", pa.list_(pa.float64())), ("q", pa.binary()), ("scale", pa.float64()), ("error", pa.float64()),
    ("keys", pa.list_(pa.int64())), ("centres", pa.list_(pa.int64()))])


def _rotations(size: int, bits: int, tables: int) -> int:
    return -(-max(bits * tables, (bits + CENTRE_BITS) * CENTRE_TABLES) // size)


def _coder(bits: int, tables: int):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in _matrices(batch.column(3)):
                units, size = unit(matrix), matrix.shape[1]
                signs, factors = encode(units, _rotations(size, bits, tables))
                q, scale, error = steps(units)
                packed = np.packbits(signs, axis=1)
                some = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([
                    some.column(0), some.column(1), some.column(2), pa.array(np.full(len(at), size, np.int32)),
                    pa.array([r.tobytes() for r in packed], pa.binary()), pa.array(list(factors), CODE_TYPES.types[5]),
                    pa.array([r.tobytes() for r in q], pa.binary()), pa.array(scale), pa.array(error),
                    pa.array(list(keys_of(signs, bits, tables)), CODE_TYPES.types[9]),
                    pa.array(list(keys_of(signs, bits + CENTRE_BITS, CENTRE_TABLES)), CODE_TYPES.types[10]),
                ], schema=CODE_TYPES)

    return code


def _cosine(a: str, top_a: str, b: str, top_b: str) -> Column:
    """The cosine of two array columns, given their largest magnitudes, in double precision."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    x, y = F.transform(a, lambda v: v / F.col(top_a)), F.transform(b, lambda v: v / F.col(top_b))
    return dot(x, y) / F.sqrt(dot(x, x)) / F.sqrt(dot(y, y))


def balls(codes: DataFrame, classes: DataFrame, link: float) -> DataFrame:
    """(k, ball, centre_id): for rows within half the threshold angle of a centre the
    centre's k. Other rows are not in the result.

    A row's first centre is the smallest row that shares one of its CENTRE_TABLES longer
    keys, its second that one's first centre; the second is taken if it is near enough.
    """
    half = math.cos(math.acos(link) / 2) + 1e-12
    me = F.struct("id", "k")
    shared = codes.select("k", "id", "size", F.posexplode("centres").alias("t", "key"))
    least = shared.groupBy("size", "t", "key").agg(F.min(me).alias("first"), F.count("*").alias("rows")).filter(
        "rows > 1").drop("rows")
    lead = join_per_key(shared, least, ["size", "t", "key"], "id", salts=SALTS).groupBy("k", "id").agg(
        F.min("first").alias("first")).filter(F.col("first") < me)
    vectors = classes.select("k", "v", "top")

    def near(pairs: DataFrame, least_cosine: float) -> DataFrame:
        centres = pairs.select(F.col("centre").alias("k")).distinct().join(vectors, "k").select(
            F.col("k").alias("centre"), F.col("v").alias("centre_v"), F.col("top").alias("centre_top"))
        both = join_per_key(pairs, centres, ["centre"], "id", salts=SALTS).join(vectors, "k")
        return both.filter(_cosine("v", "top", "centre_v", "centre_top") >= least_cosine).select(*pairs.columns)

    lead = stage(lead.select("k", "id", F.col("first.k").alias("centre"), F.col("first.id").alias("centre_id")), "leads")
    first = stage(near(lead, link), "centres")
    second = first.select(F.col("k").alias("centre"), F.col("centre").alias("c2"), F.col("centre_id").alias("c2_id"))
    hops = stage(join_per_key(first, second, ["centre"], "id", "left", salts=SALTS).select(
        "k", "id", F.coalesce("c2", "centre").alias("centre"), F.coalesce("c2_id", "centre_id").alias("centre_id")), "hops")
    return near(hops, half).select("k", F.col("centre").alias("ball"), "centre_id")


def _unpack(side: pd.DataFrame, bits: int, tables: int) -> tuple:
    """(signs, factors, steps, step lengths, step errors, keys) of a block."""
    factors = np.stack(side["factors"].to_numpy())
    size = int(side["size"].iloc[0])
    packed = np.frombuffer(b"".join(side["code"]), np.uint8).reshape(len(side), -1)
    signs = np.unpackbits(packed, axis=1, count=size * factors.shape[1]).astype(bool)
    q = np.frombuffer(b"".join(side["q"]), np.int8).reshape(len(side), size)
    return (signs, factors, q, side["scale"].to_numpy(), side["error"].to_numpy()), keys_of(signs, bits, tables), size


def possible(left: pd.DataFrame, right: pd.DataFrame | None, table: int, bits: int, tables: int,
             link: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of two blocks (or of one with itself) whose upper bound
    reaches the threshold, that no earlier table has and that are not in one ball."""
    code, keys, size = _unpack(left, bits, tables)
    other, other_keys, _ = (code, keys, size) if right is None else _unpack(right, bits, tables)
    cosines, bounds = estimate(code, other, size)
    a, b = np.nonzero(cosines + bounds >= link)
    if right is None:
        a, b = a[a < b], b[a < b]
    fresh = ~(keys[a, :table] == other_keys[b, :table]).any(axis=1)
    balls_a, balls_b = left["ball"].to_numpy(), (left if right is None else right)["ball"].to_numpy()
    apart = fresh & (balls_a[a] != balls_b[b]) if len(a) else fresh
    return a[apart], b[apart]


def _sides(frame: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame | None]:
    frame = frame.sort_values(["side", "k"], kind="stable")
    left, right = frame[frame["side"] == 0], frame[frame["side"] == 1]
    return left, right if len(right) or not frame["two"].iloc[0] else right.iloc[:0]


def _asks(bits: int, tables: int, link: float):
    """Rows of a pair of blocks that have to be computed exactly."""
    def ask(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        left, right = _sides(frame)
        two = bool(frame["two"].iloc[0])
        if not len(left) or (two and not len(right)):
            return frame.iloc[:0][["pair", "side", "k"]]
        a, b = possible(left, right if two else None, int(frame["t"].iloc[0]), bits, tables, link)
        rows = [left.iloc[np.unique(a)], right.iloc[np.unique(b)]] if two else [left.iloc[np.unique(np.r_[a, b])]]
        return pd.concat(rows)[["pair", "side", "k"]]

    return ask


def _counts(bits: int, tables: int, link: float):
    """Links of the rows asked for: how many each row has, and the least (id, k) it reaches."""
    def count(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        left, right = _sides(frame)
        two = bool(frame["two"].iloc[0])
        if not len(left) or (two and not len(right)):
            return pd.DataFrame({"k": [], "id": [], "links": [], "to_id": [], "to_k": []})
        a, b = possible(left, right if two else None, int(frame["t"].iloc[0]), bits, tables, link)
        side = right if two else left
        units, other = unit(np.stack(left["v"].to_numpy())), unit(np.stack(side["v"].to_numpy()))
        exact = np.concatenate([(units[a[i:i + BLOCK]] * other[b[i:i + BLOCK]]).sum(axis=1)
                                for i in range(0, len(a), BLOCK)] or [np.zeros(0)])
        a, b = a[exact >= link], b[exact >= link]
        rows = pd.concat([left, right]) if two else left
        b = b + (len(left) if two else 0)
        n, ids, names = rows["n"].to_numpy(), rows["id"].to_numpy(), rows["k"].to_numpy()
        links = np.bincount(a, n[b], len(rows)) + np.bincount(b, n[a], len(rows))
        order = np.array(sorted(range(len(rows)), key=lambda i: (ids[i], names[i])), dtype=int)
        least = np.argsort(order)
        while len(a):  # labels spread over the links of these two blocks
            low = least.copy()
            np.minimum.at(low, a, least[b])
            np.minimum.at(low, b, least[a])
            if (low == least).all():
                break
            least = low
        own = np.unique(np.r_[a, b])
        to = order[least[own]]
        return pd.DataFrame({"k": names[own], "id": ids[own], "links": links[own].astype(np.int64),
                             "to_id": ids[to], "to_k": names[to]})

    return count


def block_pairs(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their block, pairs of blocks) of rows (size, t, key, ball, k, in_ball)."""
    bucket = ["size", "t", "key"]
    per_ball = keyed.groupBy(*bucket, "ball").agg(F.count("*").alias("rows"))
    large = stage(per_ball.filter(F.col("rows") >= BLOCK // 2), "large-balls")
    mixed = per_ball.join(large.select(*bucket, "ball"), [*bucket, "ball"], "left_anti").groupBy(*bucket).agg(
        F.sum("rows").alias("rows"))
    groups = large.unionByName(mixed.withColumn("ball", F.lit(None).cast("binary")))
    groups = groups.withColumn("own", F.coalesce("ball", F.lit(b"")))
    parts = F.ceil(F.col("rows") / BLOCK).cast("int")
    blocks = stage(groups.select(*bucket, "own", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
                                 "rows", parts.alias("parts")), "blocks")
    other = blocks.select(*bucket, F.col("own").alias("own2"), F.col("part").alias("part2"), F.col("rows").alias("rows2"))
    one, two = F.struct("own", "part"), F.struct("own2", "part2")
    pairs = blocks.join(other, bucket).filter(
        (one < two) & ((F.col("own") != F.col("own2")) | (F.col("own") == F.lit(b"")))
        | (one == two) & (F.col("own") == F.lit(b"")) & (F.col("rows") > 1))
    pairs = pairs.select(*bucket, "own", "part", "own2", "part2", (one != two).alias("two"),
                         F.sha2(F.concat_ws("|", *bucket, F.hex("own"), "part", F.hex("own2"), "part2"), 256).alias("pair"))
    return blocks, stage(pairs, "block-pairs")


def links(codes: DataFrame, classes: DataFrame, in_balls: DataFrame, bits: int, tables: int, link: float) -> DataFrame:
    """(k, id, links, to_id, to_k) for rows linked with rows of other balls, in parts."""
    bucket = ["size", "t", "key"]
    rows = stage(codes.join(in_balls.select("k", "ball"), "k", "left").withColumn(
        "ball", F.coalesce("ball", "k")).drop("centres"), "coded")
    keyed = rows.select("k", "ball", "size", F.posexplode("keys").alias("t", "key"))
    blocks, pairs = block_pairs(keyed)
    sides = pairs.select(*bucket, "own", "part", "pair", "two", F.lit(0).alias("side")).unionByName(
        pairs.filter("two").select(*bucket, F.col("own2").alias("own"), F.col("part2").alias("part"), "pair", "two",
                                   F.lit(1).alias("side")))
    sizes = blocks.select(*bucket, "own", "parts").distinct()
    larges = sizes.filter(F.col("own") != F.lit(b"")).select(*bucket, F.col("own").alias("ball"), "parts")
    mixed = sizes.filter(F.col("own") == F.lit(b"")).select(*bucket, F.col("parts").alias("mixed_parts"))
    salt = F.xxhash64("k")
    placed = keyed.withColumn("salt", salt)
    placed = join_per_key(placed, larges, [*bucket, "ball"], "salt", "left", salts=SALTS)
    placed = join_per_key(placed, mixed, bucket, "salt", "left", salts=SALTS)
    placed = placed.select(
        "k", *bucket, F.when(F.col("parts").isNotNull(), F.col("ball")).otherwise(F.lit(b"")).alias("own"),
        F.pmod(F.col("salt"), F.coalesce("parts", "mixed_parts")).cast("int").alias("part"))
    # Which rows go where, without their codes: a row for each pair of blocks a row is in.
    at = stage(placed.join(sides, [*bucket, "own", "part"]).select("k", "t", "pair", "two", "side"), "places")
    coded = rows.select("k", "id", "n", "size", "code", "factors", "q", "scale", "error", "ball")
    asked = at.join(coded, "k").groupBy("pair").applyInPandas(
        _asks(bits, tables, link), "pair string, side int, k binary")
    asked = stage(asked.join(at.select("pair", "side", "k", "t", "two"), ["pair", "side", "k"]), "asked")
    return asked.join(coded, "k").join(classes.select("k", "v"), "k").groupBy("pair").applyInPandas(
        _counts(bits, tables, link), "k binary, id long, links long, to_id long, to_k binary")


def groups(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", link: float = LINK) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    Rows are linked if their cosine is `link` or more. Vectors that are null, empty, zero
    or hold null or non-finite components link with nothing, nor do vectors of different
    lengths. Rows that repeat an id are vectors of their own. A row without id takes no part: no links, no component, kept. Columns
    but `key` and `vector` are not read. An empty table gives an empty result.
    """
    ship(rows.sparkSession)
    given = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    joins = usable(given, "v") & F.col("id").isNotNull()
    named = stage(given.filter(joins).select("id", F.transform("v", lambda x: x.cast("double")).alias("v"))
                  .mapInArrow(_name, "id long, k binary, v array<double>"), "vectors")
    classes = named.groupBy("k").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("v").alias("v"))
    classes = stage(classes.withColumn("top", F.array_max(F.transform("v", F.abs))), "classes")
    bits, tables = plan(classes.count(), link)
    codes = stage(classes.select("k", "id", "n", "v").mapInArrow(_coder(bits, tables), CODES), "codes")
    in_balls = stage(balls(codes, classes, link), "balls")
    parts = stage(links(codes, classes, in_balls, bits, tables, link), "links")

    centres = in_balls.select("ball").distinct().select(F.col("ball").alias("k"), "ball")
    # A centre that is in no other ball is in its own.
    members = in_balls.select("k", "ball").unionByName(centres.join(in_balls.select("k"), "k", "left_anti"))
    members = stage(members, "members")
    per_ball = members.join(codes.select("k", "n"), "k").groupBy("ball").agg(F.sum("n").alias("in_ball"))
    counted = members.join(per_ball, "ball").select("k", F.col("in_ball").alias("m"))
    found = parts.groupBy("k").agg(F.sum("links").alias("m"))

    def node(name: str, k: str) -> Column:
        return F.struct(F.col(name).alias("id"), F.col(k).alias("k"))

    edges = parts.select(node("id", "k").alias("u"), node("to_id", "to_k").alias("v")).unionByName(
        in_balls.join(codes.select("k", "id"), "k").select(node("id", "k").alias("u"), node("centre_id", "ball").alias("v")))
    labels = components(edges).select(F.col("node.k").alias("k"), F.col("component.id").alias("component"))
    result = (codes.select("k", "id", "n").join(counted, "k", "left").join(found.withColumnRenamed("m", "outside"), "k", "left")
              .join(labels, "k", "left")
              .select("k", (F.coalesce("m", "n") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"),
                      F.coalesce("component", "id").alias("component_id")))
    done = join_per_key(named.select("id", "k"), stage(result, "classed"), ["k"], "id", salts=SALTS)
    alone = given.filter(~F.coalesce(joins, F.lit(False))).select(
        F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return done.select(F.col("id").alias("vec_id"), "n_links", "component_id").unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
