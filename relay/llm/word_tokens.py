"""Tokenizing whole texts one distinct word at a time, inside a task.

Blanks and line breaks end a word for the tokenizers used here, so the ids of a text
are the ids of its blank-separated words one after another. Words repeat, texts do
not: a task splits a batch of texts, finds its distinct words in Arrow and asks the
tokenizer only for those it has not met; when it knows too many it starts afresh.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A word of letters that stay one piece each when normalized, and punctuation after
# it, which the pre-tokenizer always cuts off.
LATIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*#$%&|()]*)")
# The same behind an ASCII letter (Arrow's patterns go by bytes), to be cut off before
# words are looked up; the others are put together of stem and tail.
TAIL = r"([A-Za-z])([.,;:!?*#$%&|()]+)( |$)"
KNOWN_WORDS = 400_000
JOINED = 256

_loaded: dict[str, WordTokenizer] = {}


class WordTokenizer:
    """Ids of texts, from a tokenizer file whose pre-tokenizer splits at white space,
    lower-cases, and marks the last piece of each word with `</w>`."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        """No word is known. Ids of known words stand in `flat` in a row."""
        self.number: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.firsts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        known = len(self.number)
        self.number.update(zip(words, range(known, known + len(words))))
        firsts = len(self.flat) + np.cumsum(sizes) - sizes
        self.firsts = np.concatenate([self.firsts, firsts.astype(np.int32)])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
        self.flat = np.concatenate([self.flat, ids])

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known words in a row, and where each word's ids end."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes, dtype=np.int64)
        if not len(ends):
            return np.zeros(0, np.uint32), ends
        at = np.repeat((self.firsts[numbers] - (ends - sizes)).astype(np.int32), sizes)
        at += np.arange(ends[-1], dtype=np.int32)
        return self.flat[at], ends

    def _learn(self, words: list[str]) -> None:
        """Plain lower-case words are encoded many at a time, as each ends at one
        `</w>`; words with capitals or punctuation behind are put together of those;
        all others are encoded alone."""
        other, composed, stems = [], [], {}
        for word in words:
            match = LATIN_WORD.fullmatch(word)
            if match is None:
                other.append(word)
                continue
            stem, tail = match[1].lower(), match[2]
            if stem not in self.number:
                stems[stem] = None
            if stem != word:
                composed.append((word, stem, tail))
                if tail and tail not in self.number:
                    other.append(tail)
        plain = list(stems)
        joined = [" ".join(plain[i:i + JOINED]) for i in range(0, len(plain), JOINED)]
        encoded = self.tokenizer.encode_batch(joined, add_special_tokens=False)
        if encoded:
            ids = np.concatenate([np.asarray(e.ids, dtype=np.uint32) for e in encoded])
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(plain):
                raise ValueError("the tokenizer does not end every word with </w>")
            self._add(plain, ids, np.diff(stops, prepend=0))
        other = [w for w in dict.fromkeys(other) if w not in self.number]
        encoded = self.tokenizer.encode_batch(other, add_special_tokens=False)
        if encoded:
            self._add(other, np.concatenate([np.asarray(e.ids, dtype=np.uint32) for e in encoded]),
                      np.array([len(e.ids) for e in encoded]))
        if composed:
            at = np.array([[self.number[s], self.number[t] if t else -1] for _, s, t in composed])
            flat = at.ravel()
            ids, _ = self._gather(flat[flat >= 0])
            sizes = np.where(at >= 0, self.sizes[at], 0).sum(axis=1)
            self._add([w for w, _, _ in composed], ids, sizes)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of texts in a row, and where each text begins (one more
        entry than texts). Null texts have no ids."""
        if len(self.number) > KNOWN_WORDS:
            self.forget()
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " ")
        # Lower case only now: Arrow's kernel goes wrong on a slice.
        texts = pc.replace_substring_regex(pc.ascii_lower(texts), TAIL, r"\1 \2\3")
        split = pc.split_pattern(texts, " ")
        borders = np.asarray(split.offsets)
        coded = split.values.slice(borders[0], borders[-1] - borders[0]).dictionary_encode()
        words = coded.dictionary.to_pylist()
        numbers = list(map(self.number.get, words))
        if None in numbers:
            self._learn([w for w, n in zip(words, numbers) if n is None])
            numbers = list(map(self.number.__getitem__, words))
        ids, ends = self._gather(np.array(numbers, dtype=np.int64)[np.asarray(coded.indices)])
        return ids, np.concatenate([[0], ends])[borders - borders[0]]


def load(path: str) -> WordTokenizer:
    """The tokenizer of a file, kept by the Python worker between tasks."""
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]
