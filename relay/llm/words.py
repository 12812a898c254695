"""Hashes of the words of texts, computed in Arrow and NumPy inside a task.

Words are runs of anything but space, tab, line feed, vertical tab, form feed and
carriage return; A-Z are lower-cased, other letters stay. A batch is split and its
distinct words are found in Arrow, so Python touches each distinct word once.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

AROUND = ".,;:!?\"'()[]{}<>*#$%&|-_«»“”„’‘…"
TEXT_BYTES_AT_ONCE = 4 << 20


def slices(batch: pa.RecordBatch, column: str = "text", size: int = TEXT_BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `size` bytes of text, or one longer text."""
    begin, held = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        held += n or 0
        if held >= size:
            yield batch.slice(begin, i + 1 - begin)
            begin, held = i + 1, 0
    if begin < batch.num_rows:
        yield batch.slice(begin)
    # Arrow's pool keeps what it once had, and a worker lives on for the tasks of others.
    pa.default_memory_pool().release_unused()


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch of texts in a row as they stand, dictionary-encoded, and where
    each text begins (one more entry than texts). Null texts have no words."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    # Byte patterns only: the ASCII kernels of Arrow also act on parts of other letters.
    for blank in "\t\n\v\f\r":
        texts = pc.replace_substring(texts, blank, " ")
    # Runs of blanks give empty words, which are left out.
    parts = pc.split_pattern(texts, " ")
    borders = np.asarray(parts.offsets)
    values = parts.values.slice(borders[0], borders[-1] - borders[0])
    real = np.asarray(pc.greater(pc.binary_length(values), 0)).astype(bool)
    before = np.concatenate([[0], np.cumsum(real)])
    return values.filter(pa.array(real)).dictionary_encode(), before[borders - borders[0]]


LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def hashes(texts: pa.Array, bare: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a batch, and where each text begins. `bare` words
    are lower-cased in full and have no punctuation around them, if they hold more."""
    words, begins = split(texts)
    distinct = words.dictionary.to_pylist()
    if bare:
        distinct = [w.lower().strip(AROUND) or w for w in distinct]
    else:
        distinct = [w if w.islower() else w.translate(LOWER) for w in distinct]
    own = np.fromiter(map(xxhash.xxh64_intdigest, distinct), dtype=np.uint64, count=len(distinct))
    return own[np.asarray(words.indices)], begins


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def ngrams(own: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of n words, in order; none if there are fewer words."""
    if len(own) < n:
        return np.zeros(0, np.uint64)
    total = own[:len(own) - n + 1].copy()
    for i in range(1, n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + own[i:len(own) - n + 1 + i]
    return mix(total)


def shingle_set(own: np.ndarray, n: int = 5) -> np.ndarray:
    """Distinct n-word shingles, sorted; a shorter text is one shingle, an empty none."""
    if 0 < len(own) < n:
        return ngrams(own, len(own))
    return np.unique(ngrams(own, n))
