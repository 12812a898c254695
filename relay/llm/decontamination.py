"""Benchmark items that leaked into training documents, also edited or paraphrased.

1. Word pairs of the items are hashed into a bit map of fixed size, which every task
   gets, however many items there are.
2. An alignment of m equal words and g others (mismatches and gaps) has the score m - g,
   and its m words lie in at most g + 1 runs, so it keeps at least score - 1 pairs of
   neighbours. One with an item of L words that reaches the threshold t keeps
   ceil(t * L) - 1 pairs, and takes at most (2 - t) * L words of the document. One pass
   over the whole texts keeps the passages in which so many known pairs lie so close,
   for any of the lengths of items; clean documents leave little behind.
3. The pairs of the passages are joined with those of the items, which drops chance hits
   of the bit map. Passages that share as many pairs with an item as the threshold needs
   go on, however often these pairs stand elsewhere: nothing above the threshold is lost.
4. Passage and item are aligned by Smith-Waterman (match 1, mismatch and gap -1). The
   score is that of the best local alignment divided by the words of the item: 1 for
   a full copy, about 1 - 2e if a share e of the words was exchanged.

Words are compared in lower case, without punctuation around them. Items of fewer than
N words, or with a null text or id, have no n-gram and match nothing; items of N words
match whole. Null or empty texts and null doc_ids match nothing. Documents or items that
repeat an id give one row with the best score. Ties go to the first place in the document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relay.llm import words
from relay.llm.common import fresh
from relay.session import ship, stage

N = 2
THRESHOLD = 0.5
BITS = 24
STEP = 1.25


def item_grams(items: DataFrame) -> DataFrame:
    """One row per item: item_id, word hashes and the hash of every n-gram, repeats too."""
    ship(items.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch):
                own, begins = words.hashes(part.column("text"), bare=True)
                each = [own[begins[i]:begins[i + 1]] for i in range(part.num_rows)]
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("item_id"), pa.array([w.astype(np.int64) for w in each], longs),
                     pa.array([words.ngrams(w, N).astype(np.int64) for w in each], longs)],
                    ["item_id", "item", "grams"])

    return (items.filter("item_id IS NOT NULL AND text IS NOT NULL")
            .select(F.col("item_id").cast("long").alias("item_id"), "text")
            .mapInArrow(run, "item_id long, item array<long>, grams array<long>"))


def bit_map(grams: DataFrame) -> np.ndarray:
    """2**BITS bits with the places of all n-grams set, put together by an aggregate
    whose result cannot exceed 2**(BITS - 6) rows."""
    place = F.call_function("shiftright", F.col("gram"), F.lit(64 - BITS).cast("int")).bitwiseAND((1 << BITS) - 1)
    rows = (grams.select(place.alias("place"))
            .select(F.shiftright("place", 5).cast("int").alias("at"), F.col("place").bitwiseAND(31).cast("int").alias("bit"))
            .groupBy("at").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
            .collect())
    out = np.zeros(1 << (BITS - 5), dtype=np.uint32)
    for row in rows:
        out[row["at"]] = row["bits"]
    return out


def known(grams: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = (grams >> np.uint64(64 - BITS)).astype(np.int64)
    return (bits[place >> 5] >> (place & 31).astype(np.uint32)) & 1 == 1


def needed(length: int, threshold: float) -> int:
    """The n-grams that an alignment keeps at least if it reaches the threshold."""
    return max(1, math.ceil(threshold * length - 1e-9) - 1)


def reaches(item: DataFrame, threshold: float) -> list[tuple[int, int]]:
    """How many known n-grams within how many words an alignment holds, for every class
    of item lengths. A class spans a factor of STEP, so there are few for any lengths."""
    n = F.size("item")
    rows = (item.filter(n >= N).groupBy(F.floor(F.log(n) / math.log(STEP)).alias("class"))
            .agg(F.min(n).alias("low"), F.max(n).alias("high")).collect())
    return sorted((needed(r["low"], threshold), math.floor((2 - threshold) * r["high"] + 1e-9)) for r in rows)


def close(hit: np.ndarray, doc: np.ndarray, begins: np.ndarray, reach: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Where passages begin and end: unions of all places that an alignment over close
    hits can take, none over the border of a document."""
    low, high = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for count, span in reach:
        first, last = np.arange(len(hit) - count + 1), np.arange(count - 1, len(hit))
        if not len(last):
            continue
        fits = (doc[first] == doc[last]) & (hit[last] + N - hit[first] <= span)
        first, last = first[fits], last[fits]
        low.append(np.maximum(begins[doc[first]], hit[last] + N - span))
        high.append(np.minimum(begins[doc[first] + 1], hit[first] + span))
    low, high = np.concatenate(low), np.concatenate(high)
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.flatnonzero(np.concatenate([[True], low[1:] >= high[:-1]])) if len(low) else np.zeros(0, np.int64)
    return low[new], high[np.append(new[1:] - 1, len(high) - 1)] if len(new) else high


def passages(docs: DataFrame, bits: np.ndarray, reach: list[tuple[int, int]]) -> DataFrame:
    """Parts of documents around close known n-grams: doc_id, start (in words), the words
    and the known n-grams."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in batches:
            for part in words.slices(batch):
                own, begins = words.hashes(part.column("text"), bare=True)
                grams = words.ngrams(own, N)
                hit = np.flatnonzero(known(grams, bits))
                doc = np.searchsorted(begins, hit, side="right") - 1
                inside = hit + N <= begins[doc + 1] if len(hit) else np.zeros(0, bool)
                hit, doc = hit[inside], doc[inside]
                ids = part.column("doc_id").to_pylist()
                out_id, out_start, out_words, out_grams = [], [], [], []
                for low, high in zip(*(x.tolist() for x in close(hit, doc, begins, reach))):
                    inside = hit[np.searchsorted(hit, low):np.searchsorted(hit, high - N, side="right")]
                    i = doc[np.searchsorted(hit, low)]
                    out_id.append(ids[i])
                    out_start.append(int(low - begins[i]))
                    out_words.append(own[low:high].astype(np.int64))
                    out_grams.append(np.unique(grams[inside]).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_id, pa.int64()), pa.array(out_start, pa.int64()),
                     pa.array(out_words, longs), pa.array(out_grams, longs)],
                    ["doc_id", "start", "passage", "grams"])

    return (docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, start long, passage array<long>, grams array<long>"))


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Best local alignment: its score and where it ends in the passage."""
    row = np.zeros(len(passage) + 1, np.int32)
    steps = np.arange(len(passage) + 1, dtype=np.int32)
    best, end = 0, 0
    for word in item:
        new = np.zeros_like(row)
        np.maximum(row[:-1] + np.where(passage == word, 1, -1), row[1:] - 1, out=new[1:])
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + steps) - steps
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, score and the place in the document (words start to end), for
    every pair of a document and an item that reaches the threshold."""
    item = stage(item_grams(items), "items")
    grams = (item.select("item_id", F.size("item").alias("length"), F.explode("grams").alias("gram"))
             .groupBy("item_id", "length", "gram").agg(F.count("*").alias("times")))
    reach = reaches(item, threshold)
    found = stage(passages(docs, bit_map(grams), reach).withColumn("passage_id", F.monotonically_increasing_id()), "passages")
    hits = found.select("passage_id", F.explode("grams").alias("gram"))
    least = F.greatest(F.lit(1), F.ceil(F.lit(threshold) * F.col("length") - 1e-9) - 1)
    pairs = (hits.join(grams, "gram").groupBy("passage_id", "item_id", "length").agg(F.sum("times").alias("shared"))
             .filter(F.col("shared") >= least).select("passage_id", "item_id").distinct())
    both = (pairs.join(found.select("passage_id", "doc_id", "start", "passage"), "passage_id")
            .join(item.select("item_id", "item"), "item_id"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                passage, words_ = np.asarray(r.passage), np.asarray(r.item)
                best, end = align(passage, words_)
                if best >= threshold * len(words_):
                    # Aligned backwards from its end, the passage tells where it began.
                    _, back = align(passage[:end][::-1], words_[::-1])
                    rows.append((r.doc_id, r.item_id, best / len(words_), r.start + end - back, r.start + end))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "score", "begin", "end"]).astype(
                {"doc_id": "int64", "item_id": "int64", "score": "float64", "begin": "int64", "end": "int64"})

    scored = both.select("doc_id", "item_id", "start", "passage", "item").mapInPandas(
        run, "doc_id long, item_id long, score double, begin long, end long")
    best = F.max_by(F.struct("score", "begin", "end"), F.struct("score", -F.col("begin"), -F.col("end"))).alias("x")
    return scored.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "x.score", "x.begin", "x.end")


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents in which no item was found, with all their columns."""
    name = fresh("_leaked", docs)
    found = leaks(docs, items, threshold).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(found, docs["doc_id"] == found[name], "left_anti")
