"""Harmonic packing of documents into fixed-length sequences.

A piece of length n belongs to class C // n: that many pieces of the class fit into a
sequence of C ids, whatever their lengths. So sequences of a class are filled by
count alone, each task for itself. Documents are first cut into whole sequences, and
their rests so that every piece nearly fills its share C / k of a sequence: if a rest
leaves more than TOLERANCE of its share empty, a piece that fills the next smaller
share exactly is cut off it.

Only the last sequence of each class can be short of pieces. Those pieces, at most
C / n - 1 for each of about 2 * sqrt(C) classes whatever the size of the corpus, are
gathered and packed first-fit by decreasing length.

Null or empty texts hold the end id alone. Rows with equal or null doc_ids are
separate documents. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relay.llm import word_tokens, words
from relay.llm.common import number_within
from relay.session import ship, stage

CAPACITY = 4096
END_ID = 2
TOLERANCE = 0.02
TEXTS_AT_ONCE = 2 << 20
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, kind int"


def lengths(n: int, capacity: int = CAPACITY, tolerance: float = TOLERANCE) -> list[int]:
    """Lengths of the pieces that a document of n ids is cut into."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        kind = capacity // rest
        share = capacity // kind
        if share - rest <= tolerance * share:
            out.append(rest)
            break
        exact = capacity // (kind + 1)
        out.append(exact)
        rest -= exact
    return out


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenize whole texts and cut them: one row per piece, with its class `kind` and
    the CRC-32 of its ids (little-endian, 32 bits each); with keep_ids also `ids`."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_tokens.load(tokenizer)
        end = np.array([END_ID], dtype="<u4")
        try:
            for batch in batches:
                for part in words.slices(batch, size=TEXTS_AT_ONCE):
                    ids, begins = known.encode(part.column("text"))
                    ids = ids.astype("<u4")
                    rows: list[tuple] = []
                    kept: list[np.ndarray] = []
                    for i, doc in enumerate(part.column("doc_id").to_pylist()):
                        own = np.concatenate([ids[begins[i]:begins[i + 1]], end])
                        start = 0
                        for n in lengths(len(own), capacity):
                            piece = own[start:start + n]
                            rows.append((doc, start, n, zlib.crc32(piece.tobytes()), len(own), capacity // n))
                            if keep_ids:
                                kept.append(piece.astype(np.int32))
                            start += n
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), [*[pa.int64()] * 5, pa.int32()])]
                    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "kind"]
                    if keep_ids:
                        columns.append(pa.array(kept, pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)
        finally:
            # Most words of another task are other ones; an idle worker need not hold these.
            known.forget()

    schema = PIECES + (", ids array<int>" if keep_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def first_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and offsets of pieces, longest first, each in the first bin with room."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    used = np.zeros(16, np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        room = np.flatnonzero(used + sizes[i] <= capacity)
        if not len(room):
            room = [len(used)]
            used = np.concatenate([used, np.zeros(len(used), np.int64)])
        bins[i], offsets[i] = room[0], used[room[0]]
        used[room[0]] += sizes[i]
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces with `length` and `kind`.

    The pieces are stored once; classes are numbered without a task per class.
    Sequences of class k are k * 2**40 + 0, 1, 2 ...; the gathered rests are 0, 1 ...
    """
    ship(pieces.sparkSession)
    stored = stage(pieces.withColumn("_row", F.monotonically_increasing_id()), "packing")
    ranked = number_within(stored, ["kind"], "_row", "_rank")
    whole = (stored.groupBy(F.col("kind").alias("_kind")).count()
             .select("_kind", (F.floor(F.col("count") / F.col("_kind")) * F.col("_kind")).alias("_whole")))
    ranked = ranked.join(whole, F.col("kind") == F.col("_kind")).drop("_kind")

    full = ranked.filter(F.col("_rank") < F.col("_whole")).withColumn(
        "sequence_id", F.shiftleft(F.col("kind").cast("long"), 40) + F.floor(F.col("_rank") / F.col("kind")))
    before = Window.partitionBy("sequence_id").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_row")
        group["sequence_id"], group["offset"] = first_fit(group["length"].to_numpy(), capacity)
        return group

    rest = ranked.filter(F.col("_rank") >= F.col("_whole")).withColumn("_all", F.lit(0))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    rest = rest.groupBy("_all").applyInPandas(fit, f"{fields}, sequence_id long, offset long").drop("_all")
    return full.unionByName(rest).drop("_row", "_rank", "_whole", "kind")
