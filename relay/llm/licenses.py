"""License statements in documents, whole or with small changes.

Every text is seen through overlapping windows of 2 * L words, one beginning every L
words, for L = 4, 8, 16 ... So a statement of up to L words lies whole in a window.
Windows and templates are compared by MinHash over pairs of words, in bands of one
value: a window that holds the share CONTAINMENT of a template's pairs has a Jaccard
similarity of at least `floor_similarity`, and `bands` gives the number of values at
which such a window is retrieved with probability GUARANTEE. Then the distinct pairs
of the template that stand in the window are counted exactly.

Row-local: no shuffle, and memory for a batch. Templates are a parameter of a bounded
number. Null or empty texts match nothing; a statement that overlaps two windows is
told once; rows may repeat. Words are compared in lower case, without punctuation
around them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relay.llm import words
from relay.session import ship

CONTAINMENT = 0.8
GUARANTEE = 0.9999
MAX_TEMPLATES = 10_000
SMALLEST = 4

# Statements of common licenses.
TEMPLATES = {
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "all-rights-reserved": "All rights reserved.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                      "and associated documentation files (the \"Software\"), to deal in the Software without "
                      "restriction",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are "
                          "permitted provided that the following conditions are met",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
}


def level(n_words: int) -> int:
    """The window step for a template: the power of two that holds it."""
    return max(SMALLEST, 1 << (n_words - 1).bit_length())


def floor_similarity(containment: float = CONTAINMENT) -> float:
    """Least Jaccard similarity of a window of 2L words with a template of more than L/2
    words whose pairs it holds to the given share: c t / (t + w - c t) for t = L/2
    pairs of the template and w = 2L - 1 pairs of the window."""
    return containment * 0.5 / (0.5 + 2 - containment * 0.5)


def bands(similarity: float, guarantee: float = GUARANTEE) -> int:
    """Values at which two sets of this similarity agree in one with the guarantee."""
    return math.ceil(math.log(1 - guarantee) / math.log(1 - similarity))


def prepare(templates: dict[str, str], factors: np.ndarray) -> dict[int, list[tuple]]:
    """Templates by window step: name, distinct pairs, MinHash values."""
    out: dict[int, list[tuple]] = {}
    for name, text in templates.items():
        own, _ = words.hashes(pa.array([text]), bare=True)
        pairs = np.unique(words.ngrams(own, 2))
        if not len(pairs):
            raise ValueError(f"template {name!r} has fewer than two words")
        values = np.multiply.outer(factors, pairs).min(axis=1)
        out.setdefault(level(len(own)), []).append((name, pairs, values))
    return out


def retrieve(pairs: np.ndarray, prepared: dict[int, list[tuple]], factors: np.ndarray) -> list[tuple]:
    """(first pair, end, template) of the windows that share a value with a template."""
    top = max(prepared)
    padded = np.full(-(-len(pairs) // top) * top, np.iinfo(np.uint64).max, np.uint64)
    found: dict[int, np.ndarray] = {
        step: np.zeros((len(padded) // step, len(held)), bool) for step, held in prepared.items()}
    for f, factor in enumerate(factors):
        np.multiply(pairs, factor, out=padded[:len(pairs)])
        least, step = padded, 1
        while step < top:
            grow = SMALLEST if step == 1 else 2
            least = least.reshape(-1, grow).min(axis=1)
            step *= grow
            if step in prepared:
                window = least.copy()
                np.minimum(window[:-1], least[1:], out=window[:-1])
                for k, (_, _, values) in enumerate(prepared[step]):
                    found[step][:, k] |= window == values[f]
    return [(int(w) * step, int(w + 2) * step, prepared[step][k])
            for step, hits in found.items() for w, k in np.argwhere(hits)]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, license, begin and end (in words) and containment of every statement."""
    templates = TEMPLATES if templates is None else templates
    if not 0 < len(templates) <= MAX_TEMPLATES:
        raise ValueError(f"1 to {MAX_TEMPLATES} templates")
    ship(docs.sparkSession)
    random = np.random.default_rng(11)
    count = bands(floor_similarity(containment))
    factors = random.integers(0, 2 ** 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    prepared = prepare(templates, factors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch):
                own, begins = words.hashes(part.column("text"), bare=True)
                pairs = words.ngrams(own, 2)
                ids = part.column("doc_id").to_pylist()
                spans: dict[tuple[int, str], list[tuple]] = {}
                for low, high, (name, wanted, _) in retrieve(pairs, prepared, factors) if len(pairs) else []:
                    first = int(np.searchsorted(begins, low, side="right")) - 1
                    for i in range(first, part.num_rows):
                        if begins[i] >= high:
                            break
                        a, b = max(low, int(begins[i])), min(high, int(begins[i + 1]) - 1)
                        at = np.flatnonzero(np.isin(pairs[a:b], wanted))
                        share = len(np.unique(pairs[a:b][at])) / len(wanted)
                        if share >= containment:
                            spans.setdefault((i, name), []).append(
                                (a + int(at[0]) - int(begins[i]), a + int(at[-1]) + 2 - int(begins[i]), share))
                rows = []
                for (i, name), each in sorted(spans.items()):
                    merged: list[list] = []
                    for begin, end, share in sorted(each):
                        if merged and begin < merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], end)
                            merged[-1][2] = max(merged[-1][2], share)
                        else:
                            merged.append([begin, end, share])
                    rows += [(ids[i], name, *m) for m in merged]
                columns = list(zip(*rows)) or [[]] * 5
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["doc_id", "license", "begin", "end", "containment"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, license string, begin long, end long, containment double")
