"""Quality of documents by votes of their nearest labelled neighbours.

1. Every whole text becomes counts of language-free terms: shapes of words (case,
   digits and the punctuation itself, runs cut to two), pairs of shapes, words that
   repeat the one before, repeated lines, and how often the words of the text occur
   in it. Terms are hashed to 1,024 places. The counts are stored once.
2. Document frequencies of the places are counted over all documents.
3. At most SAMPLE labelled documents of each class, those with the smallest hash of
   the doc_id, are weighted by inverse frequency and projected on the RANK strongest
   latent directions. These vectors, at most 2 * SAMPLE * RANK numbers, are sent to
   all executors; their number does not grow with the corpus.
4. Every document is projected in the same way, and exact cosine products of a block
   of documents with all labelled vectors give its NEIGHBOURS nearest ones. The score
   is the mean of their labels weighted by similarity.

Null or empty texts are documents with one term of their own. Without labels of both
classes the score is the one class's label, and 0.5 without any. Rows that repeat are
scored alike; a label with a null doc_id or other values than 0 and 1 is not used.
"""

from __future__ import annotations

import itertools
import math
import operator
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relay.llm import words
from relay.session import ship, stage

PLACES = 1024
SAMPLE = 1500
RANK = 48
NEIGHBOURS = 15
BLOCK = 1024

MARKS = re.compile(r"[^\w\s.,;:?!'\"()-]+")
RUNS = re.compile(r"(.)\1{2,}", re.DOTALL)


class Shapes(dict):
    """Code points to their class, filled as they are met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else " " if c.isspace() else c
        self[code] = kind
        return kind


def terms(text: str, shapes: Shapes, known: dict[str, str]) -> Counter:
    """Counts of the terms of one text."""
    tokens = text.split()
    if not tokens:
        return Counter({"empty": 1})
    distinct = Counter(tokens)
    shape_of = {}
    for word in distinct:
        shape = known.get(word)
        if shape is None:
            shape = RUNS.sub(r"\1\1", word.translate(shapes))
            shape = known[word] = re.sub(r"a+", "a", shape)[:12]
        shape_of[word] = shape
    shaped = list(map(shape_of.__getitem__, tokens))
    found = Counter(shaped)
    found.update(Counter(itertools.pairwise(shaped)))
    out = Counter({("w", k) if isinstance(k, str) else ("p", *k): n for k, n in found.items()})
    for shape, n in found.items():
        if isinstance(shape, str) and (marked := MARKS.sub("#", shape)) != shape:
            out["m", marked] += 2 * n
    out["again"] = 2 * sum(map(operator.eq, tokens, tokens[1:]))
    once = sum(1 for n in distinct.values() if n == 1)
    total = len(tokens)
    out["rare", int(4 * math.log2(1 + total)), int(10 * once / total)] = 1 + total // 4
    out["distinct", int(10 * len(distinct) / total)] = 1 + total // 4
    lines = [x for x in text.split("\n") if x]
    out["line again"] = 10 * (len(lines) - len(set(lines)))
    return +out


def place(term) -> int:
    return xxhash.xxh64_intdigest(repr(term)) % PLACES


def count_terms(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and the places and counts of its terms."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, known, placed = Shapes(), {}, {}
        for batch in batches:
            for part in words.slices(batch):
                at, n = [], []
                for text in part.column("text").to_pylist():
                    counts: dict[int, int] = {}
                    for term, count in terms(text or "", shapes, known).items():
                        where = placed.get(term)
                        if where is None:
                            where = placed[term] = place(term)
                        counts[where] = counts.get(where, 0) + count
                    at.append(np.fromiter(counts.keys(), np.int16, len(counts)))
                    n.append(np.fromiter(counts.values(), np.int32, len(counts)))
                for cache in (known, placed):
                    if len(cache) > 200_000:
                        cache.clear()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(at, pa.list_(pa.int16())), pa.array(n, pa.list_(pa.int32()))],
                    ["doc_id", "at", "n"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, at array<short>, n array<int>")


def dense(at: list, n: list, idf: np.ndarray) -> np.ndarray:
    """Weighted, normed rows of counts."""
    rows = np.zeros((len(at), PLACES), np.float32)
    for i, (places, counts) in enumerate(zip(at, n)):
        counts = np.asarray(counts, np.float32)
        rows[i, np.asarray(places, np.int64)] = np.sqrt(counts / counts.sum())
    rows *= idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def vote(rows: np.ndarray, basis: np.ndarray, known: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Scores of weighted rows: exact cosine products with all labelled vectors."""
    own = rows @ basis
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
    cosine = own @ known.T
    k = min(NEIGHBOURS, len(labels))
    nearest = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosine, nearest, axis=1), 1e-6)
    return np.clip((weight * labels[nearest]).sum(axis=1) / weight.sum(axis=1), 0, 1)


def fit(counted: DataFrame, labels: DataFrame, label: str, idf: np.ndarray) -> tuple[np.ndarray, ...] | None:
    """Latent basis, labelled vectors in it and their labels, from a bounded sample."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    sample = None
    for value in (0, 1):
        some = (usable.filter(F.col(label) == value).select("doc_id", label).distinct()
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
        sample = some if sample is None else sample.unionByName(some)
    found = counted.join(F.broadcast(sample), "doc_id").groupBy("doc_id", label).agg(
        F.min(F.struct("at", "n")).alias("x")).orderBy("doc_id", label).collect()
    if not found:
        return None
    rows = dense([r["x"]["at"] for r in found], [r["x"]["n"] for r in found], idf)
    values, vectors = np.linalg.eigh(rows.T.astype(np.float64) @ rows)
    basis = vectors[:, np.argsort(-values)[:RANK]].astype(np.float32)
    known = rows @ basis
    known /= np.maximum(np.linalg.norm(known, axis=1, keepdims=True), 1e-9)
    return basis, known, np.array([r[label] for r in found], np.float32)


def score(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id and score for every document. `labels` are those to learn from."""
    counted = stage(count_terms(docs.select("doc_id", "text")), "terms")
    frequency = np.zeros(PLACES)
    for row in counted.select(F.explode("at").alias("at")).groupBy("at").count().collect():
        frequency[row["at"]] = row["count"]
    idf = np.log1p(counted.count() / np.maximum(frequency, 1)).astype(np.float32)
    model = fit(counted, labels, label, idf)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), BLOCK):
                part = batch.iloc[i:i + BLOCK]
                rows = dense(part["at"].tolist(), part["n"].tolist(), idf)
                scores = np.full(len(part), 0.5) if model is None else vote(rows, *model)
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "score": scores.astype(float)})

    return counted.mapInPandas(run, "doc_id long, score double")


def held_out(remainder: int, of: int) -> Column:
    """Rows kept from learning: CRC-32 of the doc_id as text."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of)) == remainder,
                      F.lit(False))
