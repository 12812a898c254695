"""Toxicity of documents: a learned lexicon, found also where terms are misspelled.

1. Lexicon, from at most SAMPLE labelled documents of each class, those with the
   smallest hash of the doc_id: words whose labelled documents are nearly all toxic. Documents are counted
   once per smallest 5-word shingle, so that many copies of one toxic text do not make
   their other words toxic. A term must stand in the share SUPPORT of the toxic
   documents, so at most (words of a document) / SUPPORT terms can pass, however large
   the corpus is, and in so many that no word is expected to pass by chance.
2. Matching: the terms are the branches of a trie. Levenshtein automata of all terms
   are followed through it together: a state is the set of (trie node, errors so far)
   that a prefix of a word can have reached. States are made once, when first met, so
   a word costs one lookup per letter and most words end after a few. One error is
   allowed in terms of LONG letters or more, with LEET signs read as letters first.
3. Context: a hit inside quotation marks, or within WINDOW words behind a word of
   citing that was learned from labelled documents with hits that are not toxic, is
   discounted by the share of such hits that are toxic.
4. Score: 1 - product of (1 - weight of hit), the weights being shares of labelled
   documents with such hits that are toxic, by kind (exact, misspelled; quoted or not).

Null or empty texts and texts without hits get the score of a document without hits.
Rows may repeat. Labels with null ids or other values than 0 and 1 are not used;
without toxic labels there is no lexicon and every score is 0.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relay.llm import words
from relay.session import ship, stage

SAMPLE = 4000
SUPPORT = 0.01
CAUTION = 1.0
PURITY = 0.9
LEAST = 2
LONG = 5
WINDOW = 6
QUOTES = "\"“”„«»‘’"
# Signs that stand for letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
WORD = re.compile(r"[^\W_]+(?:[@$!][^\W_]+)*")
KINDS = ("exact", "misspelled", "exact quoted", "misspelled quoted")


MARKS = re.compile("[\"«»“”„]")
CLOSING = {'"': '"', "„": "“”", "“": "”", "«": "»", "»": "«"}
QUOTED_WORDS = 60


class Automaton:
    """All words within one edit of a term, as a deterministic automaton made lazily."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        # Errors allowed below a node: those of the most tolerant term there.
        self.tolerance: list[int] = [0]
        for term in sorted(terms):
            allowed = int(len(term) >= LONG)
            node = 0
            self.tolerance[0] = max(self.tolerance[0], allowed)
            for letter in term:
                node = self.children[node].setdefault(letter, len(self.children))
                if node == len(self.ends):
                    self.children.append({})
                    self.ends.append(None)
                    self.tolerance.append(0)
                self.tolerance[node] = max(self.tolerance[node], allowed)
            self.ends[node] = term
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self.start = self._state({(0, 0)})

    def _state(self, positions: set[tuple[int, int]]) -> int:
        """The state of these positions and those that skip letters of terms."""
        todo = list(positions)
        reached = set(todo)
        while todo:
            node, errors = todo.pop()
            for child in self.children[node].values():
                step = (child, errors + 1)
                if errors + 1 <= self.tolerance[child] and step not in reached:
                    reached.add(step)
                    todo.append(step)
        key = frozenset(reached)
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            ended = sorted((errors, self.ends[node]) for node, errors in key
                           if self.ends[node] is not None and errors <= int(len(self.ends[node]) >= LONG))
            self.found.append((ended[0][1], ended[0][0]) if ended else None)
        return self.numbers[key]

    def _move(self, state: int, letter: str) -> int:
        after = set()
        for node, errors in self.states[state]:
            if letter in self.children[node]:
                after.add((self.children[node][letter], errors))
            if errors + 1 <= self.tolerance[node]:
                after.add((node, errors + 1))
            for child in self.children[node].values():
                if errors + 1 <= self.tolerance[child]:
                    after.add((child, errors + 1))
        self.moves[state][letter] = number = self._state(after) if after else -1
        return number

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within reach and its number of errors."""
        state = self.start
        for letter in word:
            state = self.moves[state].get(letter) if letter in self.moves[state] else self._move(state, letter)
            if state < 0:
                return None
        return self.found[state]


class Matcher:
    """Hits of a lexicon in texts. Words met are remembered, in bounded number."""

    def __init__(self, terms: list[str]):
        self.automaton = Automaton(terms)
        self.known: dict[str, tuple[str, int] | None] = {}

    def of(self, word: str) -> tuple[str, int] | None:
        best = self.automaton.match(word)
        if best is None or best[1]:
            plain = word.translate(LEET)
            if plain != word:
                other = self.automaton.match(plain)
                # A sign in place of a letter is a misspelling, whatever is left.
                best = (other[0], 1) if other is not None else best
        return best

    def hits(self, text: str) -> list[tuple[int, int, str, int]]:
        """Place in the text, number of the word, term and errors of every hit."""
        low = text.lower()
        found = WORD.findall(low)
        known = self.known
        new = [w for w in set(found) if w not in known]
        if new:
            if len(known) > 500_000:
                known.clear()
                new = set(found)
            for w in new:
                known[w] = self.of(w)
        if not any(map(known.__getitem__, set(found))):
            return []
        return [(m.start(), i, *known[m[0]]) for i, m in enumerate(WORD.finditer(low)) if known[m[0]]]


def quotations(text: str) -> list[tuple[int, int]]:
    """Places between two marks that belong together, on one line and at most
    QUOTED_WORDS words apart. A mark without its other end quotes nothing."""
    out: list[tuple[int, int]] = []
    begin = 0
    for line in text.split("\n"):
        opened: list[tuple[int, str]] = []
        for m in MARKS.finditer(line):
            at, mark = m.start(), m[0]
            opens = mark == '"' and line[at - 1:at].isspace() and line[at + 1:at + 2].isalnum()
            fits = [k for k, (_, other) in enumerate(opened) if mark in CLOSING[other] and not opens]
            if fits and len(WORD.findall(line[opened[fits[-1]][0] + 1:at])) <= QUOTED_WORDS:
                out.append((begin + opened[fits[-1]][0], begin + at))
                del opened[fits[-1]:]
            # Inches, and marks at the end of words, open nothing.
            elif mark in CLOSING and not (mark in "\"«»" and at and line[at - 1].isalnum()):
                opened = [*opened[-7:], (at, mark)]
        begin += len(line) + 1
    return out


def cited(tokens: list[str], number: int, citing: frozenset[str]) -> bool:
    return any(w in citing for w in tokens[max(0, number - WINDOW):number])


def kinds(text: str, matcher: Matcher, citing: frozenset[str]) -> list[str]:
    hits = matcher.hits(text)
    if not hits:
        return []
    low = text.lower()
    spans: list[tuple[int, int]] = []
    for span in sorted(quotations(low)):  # one inside of another adds nothing
        if not spans or span[0] > spans[-1][1]:
            spans.append(span)
    begins = [a for a, _ in spans]
    tokens = WORD.findall(low) if citing else []
    out = []
    for at, number, _, errors in hits:
        kind = "misspelled" if errors else "exact"
        inside = bisect_right(begins, at)
        quoted = inside > 0 and at < spans[inside - 1][1]
        out.append(kind + " quoted" if quoted or citing and cited(tokens, number, citing) else kind)
    return out


def tokens_of(df: DataFrame) -> DataFrame:
    """Distinct words of labelled documents, one document per smallest shingle."""
    low = F.lower(F.coalesce("text", F.lit("")))
    parts = F.filter(F.split(low, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    last = F.size("parts") - 5
    smallest = F.when(last >= 0, F.array_min(F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(F.slice("parts", i + 1, F.lit(5)))))).otherwise(F.xxhash64("parts"))
    return (df.withColumn("parts", parts).select("toxic", smallest.alias("copy"), F.array_distinct("parts").alias("w"))
            .dropDuplicates(["toxic", "copy"]))


def learn(docs: DataFrame, labels: DataFrame) -> tuple[list[str], frozenset[str], dict[str, float]]:
    """Terms, words of citing, and weights by kind of hit, from labelled documents."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    sample = None
    for value in (0, 1):
        some = usable.filter(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        sample = some if sample is None else sample.unionByName(some)
    known = stage(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
                  .select("doc_id", "text", "toxic"), "labelled")
    seen = tokens_of(known)
    toxic = seen.filter("toxic = 1").count()
    counted = (seen.select("toxic", F.explode("w").alias("w")).groupBy("w")
               .agg(F.sum("toxic").alias("t"), F.count("*").alias("n")))
    # A word in n documents, all toxic by chance, has the probability (share of toxic
    # documents) ** n; n must be so large that none of all words is expected to pass.
    share = min(max(toxic / max(seen.count(), 1), 0.01), 0.5)
    chance = (math.log(max(counted.count(), 1)) + CAUTION) / -math.log(share)
    least = max(LEAST, SUPPORT * toxic, chance)
    terms = sorted(r["w"] for r in counted.filter(
        (F.col("t") >= least) & (F.col("t") >= PURITY * F.col("n")) & (F.length("w") >= 3)).select("w").collect())
    if not terms:
        return [], frozenset(), {}
    ship(docs.sparkSession)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words before hits, with the label of their document."""
        matcher = Matcher(terms)
        for batch in batches:
            for part in words.slices(batch):
                before, label = [], []
                for text, toxic_ in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    hits = matcher.hits(text or "")
                    if hits:
                        tokens = WORD.findall(text.lower())
                        near = {w for _, i, _, _ in hits for w in tokens[max(0, i - WINDOW):i]}
                        before += near
                        label += [toxic_] * len(near)
                yield pa.RecordBatch.from_arrays([pa.array(before, pa.string()), pa.array(label, pa.int64())],
                                                 ["w", "toxic"])

    citing = (known.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(around, "w string, toxic long")
              .groupBy("w").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
              .filter((F.col("n") >= max(5, least)) & (F.col("t") < 0.2 * F.col("n"))).select("w").collect())
    citing = frozenset(r["w"] for r in citing) - set(terms)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        for batch in batches:
            for part in words.slices(batch):
                kind, label = [], []
                for text, toxic_ in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    # A document speaks for its strongest kind of hit alone.
                    held = kinds(text or "", matcher, citing)
                    kind.append(min(held, key=KINDS.index) if held else "none")
                    label.append(toxic_)
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(label, pa.int64())],
                                                 ["kind", "toxic"])

    rows = (known.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(tell, "kind string, toxic long")
            .groupBy("kind").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).collect())
    # Shares with a weak prior: exact terms are taken for toxic, quoted ones are not.
    prior = {"none": 0.0, "exact": 0.9, "misspelled": 0.6, "exact quoted": 0.2, "misspelled quoted": 0.1}
    weights = {kind: prior[kind] for kind in prior}
    for r in rows:
        weights[r["kind"]] = (r["t"] + 2 * prior[r["kind"]]) / (r["n"] + 2)
    return terms, citing, weights


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score and hits for every document. `labels` are those to learn from."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    terms, citing, weights = learn(docs, labels)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        for batch in batches:
            for part in words.slices(batch):
                scores, counts = [], []
                for text in part.column("text").to_pylist():
                    held = kinds(text, matcher, citing) if text and terms else []
                    clean = 1 - weights.get("none", 0.0)
                    for kind in held:
                        clean *= 1 - weights[kind]
                    scores.append(1 - clean)
                    counts.append(len(held))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())],
                    ["doc_id", "score", "hits"])

    return docs.mapInArrow(run, "doc_id long, score double, hits long")
