"""Tries of conversation prefixes.

Conversations are keys of fixed-width turn ids, WIDTH bytes each: the first bytes of the
SHA-256 of (role, text), so equal turns have equal ids, and the order of ids is the order
of their bytes, big end first. Equal conversations are one key with a count. Keys are
range-partitioned in byte order, and each task builds an adaptive radix tree over its
range: inner nodes grow from 4 to 16, 48 and 256 children as they fill, and bytes that all
keys below a node share are kept in one compressed path. A node of the result is a prefix
of whole turns, so only depths that are multiples of WIDTH emit one, in the middle of a
compressed path, too.

Ranges cut only the nodes on their borders: the prefixes that the last key of a range
shares with the first key of the next. A task gives what it knows about those in parts;
parts are added up, and the trie of cut nodes, at most one path of turns for each range,
is folded bottom-up as one sorted stream. All other nodes are whole in their task. A group
of conversations with the same first turns is so spread over as many tasks as it needs.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relay.llm.common import said
from relay.operators.positions import join_per_key
from relay.session import ship, stage

WIDTH = 16
RANGE_TURNS = 1 << 18
IDS_IN_BLOCK = 8192
SALTS = 8
# The sizes of inner nodes.
LAYOUTS = (4, 16, 48, 256)
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Children:
    """Child nodes by byte, in the smallest layout that holds them: sorted bytes beside
    their nodes (4, 16), a table of places for every byte (48), or a place a byte (256)."""

    __slots__ = ("layout", "count", "index", "nodes")

    def __init__(self):
        self.layout, self.count, self.index, self.nodes = LAYOUTS[0], 0, bytearray(), []

    def get(self, byte: int):
        if self.layout == LAYOUTS[3]:
            return self.nodes[byte]
        if self.layout == LAYOUTS[2]:
            place = self.index[byte]
            return self.nodes[place - 1] if place else None
        place = self.index.find(byte)
        return self.nodes[place] if place >= 0 else None

    def put(self, byte: int, node) -> None:
        """Add or exchange the child of a byte."""
        old = self.get(byte)
        if old is None and self.count == self.layout:
            self._grow()
        if self.layout == LAYOUTS[3]:
            self.nodes[byte] = node
        elif self.layout == LAYOUTS[2]:
            if old is None:
                self.nodes.append(node)
                self.index[byte] = len(self.nodes)
            else:
                self.nodes[self.index[byte] - 1] = node
        elif old is None:
            place = sum(b < byte for b in self.index)
            self.index.insert(place, byte)
            self.nodes.insert(place, node)
        else:
            self.nodes[self.index.find(byte)] = node
        self.count += old is None

    def _grow(self) -> None:
        held = list(self.items())
        self.layout = LAYOUTS[LAYOUTS.index(self.layout) + 1]
        if self.layout == LAYOUTS[2]:
            self.index, self.nodes = bytearray(256), [node for _, node in held]
            for place, (byte, _) in enumerate(held, 1):
                self.index[byte] = place
        elif self.layout == LAYOUTS[3]:
            self.index, self.nodes = bytearray(), [None] * 256
            for byte, node in held:
                self.nodes[byte] = node

    def items(self) -> Iterator[tuple[int, object]]:
        """(byte, node) in order of bytes."""
        if self.layout == LAYOUTS[3]:
            return ((b, n) for b, n in enumerate(self.nodes) if n is not None)
        if self.layout == LAYOUTS[2]:
            return ((b, self.nodes[p - 1]) for b, p in enumerate(self.index) if p)
        return zip(self.index, self.nodes)


class Node:
    """A node with the bytes from its parent's branching byte on, and the key ending in it."""

    __slots__ = ("path", "children", "value")

    def __init__(self, path: bytes, value=None):
        self.path, self.children, self.value = path, Children(), value


class RadixTree:
    """Adaptive radix tree over byte strings."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while True:
            # The whole path of `node` is matched here.
            if at == len(key):
                node.value = value
                return
            child = node.children.get(key[at])
            if child is None:
                node.children.put(key[at], Node(key[at:], value))
                return
            path, same = child.path, 0
            most = min(len(path), len(key) - at)
            if path[:most] == key[at:at + most]:
                same = most
            else:
                while path[same] == key[at + same]:
                    same += 1
            if same < len(path):  # split the path
                upper = Node(path[:same])
                child.path = path[same:]
                upper.children.put(child.path[0], child)
                node.children.put(key[at], upper)
                child = upper
            node, at = child, at + same


PART = ("key binary, depth int, parent binary, conv_id long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string, size long, cut boolean")
PART_TYPES = pa.schema([
    ("key", pa.binary()), ("depth", pa.int32()), ("parent", pa.binary()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("size", pa.int64()), ("cut", pa.bool_())])


def walk(tree: RadixTree, cut: bytes, cut_too: bytes) -> Iterator[tuple]:
    """Nodes at whole turns, as rows of PART, children before parents.

    `cut` and `cut_too` are the prefixes shared with the ranges before and behind: nodes
    on these paths, the root among them, are cut, and their row counts only what is whole
    in this range. Values of the tree are (count, smallest id, sizes of texts, digest of
    ids). Keys are given for cut nodes and for those whose parent is cut.
    """
    cuts = {c[:i] for c in (cut, cut_too) for i in range(0, len(c) + 1, WIDTH)}
    # Each entry: node, bytes before its path, children still to visit, what the children gave.
    stack = [[tree.root, b"", tree.root.children.items(), []]]
    sizes: tuple = ()
    while stack:
        node, before, rest, below = stack[-1]
        step = next(rest, None)
        if step is not None:
            stack.append([step[1], before + node.path, step[1].children.items(), []])
            continue
        stack.pop()
        key = before + node.path
        count, least, ends = 0, None, NO_ENDS
        if node.value is not None:
            count, least, sizes, ends = node.value
        # What hangs below the lowest whole turn of this path: the rows of its children.
        count += sum(x["n_convs"] for x in below)
        least = min([x["conv_id"] for x in below] + ([] if least is None else [least]), default=None)
        above = -1 if node is tree.root else len(before) // WIDTH
        for depth in range(len(key) // WIDTH, above, -1):
            prefix = key[:depth * WIDTH]
            is_cut = prefix in cuts
            whole = [x for x in below if not x["cut"]]
            row = {"key": prefix, "depth": depth, "conv_id": least, "n_convs": count, "n_children": len(whole),
                   "n_leaves": sum(x["n_leaves"] for x in whole), "saved": sum(x["saved"] for x in whole),
                   "ends": ends, "size": sizes[depth - 1] if depth else 0, "cut": is_cut}
            ends = NO_ENDS
            if not is_cut:
                row["n_leaves"] += not below
                row["saved"] += (count - 1) * row["size"]
            for x in below:
                yield _row(x, row)
            below = [row]
        if stack:
            stack[-1][3].extend(below)
        else:
            for x in below:
                yield _row(x, None)


def _row(x: dict, parent: dict | None) -> tuple:
    under_cut = parent is not None and parent["cut"]
    return (x["key"] if x["cut"] else None, x["depth"], parent["key"] if under_cut else None, x["conv_id"],
            None if parent is None or under_cut else parent["conv_id"], x["n_convs"], x["n_children"],
            x["n_leaves"], x["saved"], x["ends"], x["size"], x["cut"])


def shared_turns(a: Column, b: Column) -> Column:
    """The bytes of the first turns that two keys share; none if one is null."""
    most = F.coalesce(F.floor(F.least(F.length(a), F.length(b)) / WIDTH).cast("int"), F.lit(0))

    def turn(key: Column, i: Column) -> Column:
        return F.substring(key, i * WIDTH + 1, F.lit(WIDTH))

    places = F.when(most > 0, F.sequence(F.lit(0), most - 1)).otherwise(F.array().cast("array<int>"))
    other = F.array_min(F.filter(places, lambda i: turn(a, i) != turn(b, i)))
    return F.substring(F.coalesce(a, F.unhex(F.lit(""))), F.lit(1), F.coalesce(other, most) * WIDTH)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, key and sizes of every rebuilt conversation: the first h turns of
    conversation c - c % 5, then the own turns after the first h, h = crc32(c) % 9."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    own = rows.select("conv_id", F.struct(
        "turn", F.substring(said("role", "text"), 1, WIDTH).alias("id"), F.octet_length("text").alias("size")).alias("t"))
    own = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    own = stage(own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5), "conversations")
    heads = own.filter("conv_id = base").select("base", F.slice("turns", 1, 8).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    none = F.slice("turns", 1, 0)
    turns = F.concat(F.coalesce(F.slice("head", F.lit(1), h), none), F.slice("turns", h + 1, F.size("turns")))
    return own.join(heads, "base", "left").select("conv_id", turns.alias("turns")).select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("key"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"))


KEYS = "key binary, n long, least long, sizes array<int>, ends string"
KEY_TYPES = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("least", pa.int64()),
                       ("sizes", pa.list_(pa.int32())), ("ends", pa.string())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    for some in itertools.batched(rows, size):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)


def _same_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key from rows sorted by key and block: counts, and the digest of all
    ids, which pass as a stream of blocks."""
    def rows():
        held = digest = None
        for key, _, n, least, sizes, ids in _rows(batches):
            if held is None or key != held[0]:
                if held:
                    yield *held, digest.hexdigest()
                held, digest = [key, 0, least, sizes], hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
            held[1] += n
        if held:
            yield *held, digest.hexdigest()

    yield from _batches(rows(), KEY_TYPES)


def keys_of(conversations: DataFrame) -> DataFrame:
    """Equal conversations as one key: its count, smallest conv_id, sizes of its texts and
    the digest of its ids. A key that very many conversations share is counted in blocks
    of neighbouring ids first."""
    blocks = conversations.groupBy("key", F.floor(F.col("conv_id") / IDS_IN_BLOCK).alias("block")).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.first("sizes").alias("sizes"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    return blocks.repartition("key").sortWithinPartitions("key", "block").mapInArrow(_same_keys, KEYS)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each range; its first row, without a key, tells where it is cut."""
    def rows():
        tree = borders = None
        for key, cut, cut_too, *value in _rows(batches):
            if key is None:
                if tree:
                    yield from walk(tree, *borders)
                tree, borders = RadixTree(), (cut, cut_too)
            else:
                tree.insert(key, value)
        if tree:
            yield from walk(tree, *borders)

    yield from _batches(rows(), PART_TYPES)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut nodes, sorted by key and so parents first, with the sums of what lies below."""
    def done(stack):
        key, depth, conv, n, children, leaves, saved, ends, _ = stack.pop()
        leaves = leaves if children else 1
        above = stack[-1] if stack else None
        if above:
            above[4], above[5], above[6] = above[4] + 1, above[5] + leaves, above[6] + saved
        return (key, depth, None, conv, above and above[2], n, children, leaves, saved, ends, None, True)

    def rows():
        stack = []
        for key, depth, conv, n, children, leaves, saved, ends, size in _rows(batches):
            while stack and not key.startswith(stack[-1][0]):
                yield done(stack)
            stack.append([key, depth, conv, n, children, leaves, saved + (n - 1) * size, ends, size])
        while stack:
            yield done(stack)

    yield from _batches(rows(), PART_TYPES)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(keys: DataFrame) -> DataFrame:
    """Every prefix of whole turns of the keys, the empty one included, as a row.

    `keys` has key, n, least, sizes and ends, each key once.
    """
    spark = ship(keys.sparkSession)
    keys = stage(keys, "keys")
    turns = keys.agg(F.sum(F.size("sizes"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // RANGE_TURNS))
    keys = stage(keys.repartitionByRange(ranges, "key").withColumn("part", F.spark_partition_id()), "ranges")
    in_order = Window.orderBy("part")  # a row for each range
    borders = keys.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    borders = borders.select(
        "part", F.lit(None).cast("binary").alias("key"),
        shared_turns(F.col("low"), F.lag("high").over(in_order)).alias("cut"),
        shared_turns(F.col("high"), F.lead("low").over(in_order)).alias("cut_too"),
        F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("least"),
        F.lit(None).cast("array<int>").alias("sizes"), F.lit(None).cast("string").alias("ends"))
    rows = borders.unionByName(keys, allowMissingColumns=True)
    parts = (rows.repartition("part").sortWithinPartitions("part", F.col("key").asc_nulls_first())
             .select("key", "cut", "cut_too", "n", "least", "sizes", "ends").mapInArrow(_ranges, PART))
    parts = stage(parts, "nodes")
    cut = parts.filter("cut").groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.coalesce(F.max(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))), F.lit(NO_ENDS)).alias("ends"),
        F.max("size").alias("size"))
    cut = stage(cut.repartition(1).sortWithinPartitions("key").select(
        "key", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "size")
        .mapInArrow(_fold, PART), "cut")
    parents = cut.select(F.col("key").alias("parent"), F.col("conv_id").alias("_above"))
    under = join_per_key(parts.filter("parent IS NOT NULL AND NOT cut"), parents, ["parent"], "conv_id", salts=SALTS)
    return (parts.filter("parent IS NULL AND NOT cut").select(*COLUMNS).unionByName(cut.select(*COLUMNS))
            .unionByName(under.withColumn("parent_conv_id", F.col("_above")).select(*COLUMNS)))


def trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of rebuilt conversations: a row per node with its smallest member,
    depth, the parent's smallest member (null for the root), members, children, leaves
    below, bytes saved below by storing each node once, and the digest of the ids of the
    conversations that end in it.

    `conversations` has conv_id, turn, role and text; further columns are not read. Null
    roles and texts are empty. Turns of one conversation are ordered by turn, null first,
    and ties by the digest of (role, text). Rows without conv_id belong to no conversation
    and are left out. A conversation is one row of WIDTH bytes and a size for each turn.
    An empty table has no nodes.
    """
    found = nodes(keys_of(rebuilt(conversations)))
    return found.select(F.col("conv_id"), F.col("depth").cast("long").alias("depth"), *COLUMNS[2:])
