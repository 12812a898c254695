"""Repair of conversation structure by weighted interval parsing.

A conversation is well formed when the initials of its roles are `(s?(ua)+)?`: a system
turn or none, then exchanges of user and assistant; an empty one is well formed, too.
Every turn can be kept, given another role, or deleted, and turns can be inserted; each
edit has a cost, and the cheapest series of edits is wanted, of equal ones the one whose
initials (D, I, K, R) come first in ASCII order.

The grammar is in Chomsky normal form. Its nonterminals are pairs of states of the wanted
structure (EMPTY, after the system turn, after a user turn, after an assistant turn):
[p, q] derives the spans that lead from p to q, by the rules [p, q] -> [p, r] [r, q], and
single turns by their edits. The insertion closure adds, before and after each turn, the
cheapest inserted turns from one state to another. A cell holds for every nonterminal of
a span the least (cost, audit). As a span split at any place passes that place in some
state r, every split gives the same cell, so the chart needs one split of each span:
spans of 1, 2, 4, ... turns are combined bottom-up, by span length. Two audits of equal
cost for one span are never one the beginning of the other, as more inserted turns cost
more; so the least of the parts makes the least of the whole.

Blocks of BLOCK turns are parsed in one pass over rows sorted by conversation and block;
their cells are combined FAN at a time, span by span, in as many rounds as the longest
conversation needs, so a conversation that holds a large share of all rows is spread over
tasks. A cell grows by one letter a turn; texts are read once more at the end, as a
stream in order of turns, for the digest of the repaired conversation.
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

BLOCK = 256
FAN = 16
SLOT = 1024
SALTS = 8
KNOWN = 20_000
# Costs of the edits, and the extra cost of keeping a truncated turn.
COSTS = {"keep": 0, "rerole": 1, "delete": 2, "insert": 5, "truncated": 5}
# The wanted structure as state -> {role initial: next state}.
STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
START, FINAL = 0, (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
BLANKS = r"\x20\x09-\x0D"

Cell = dict[tuple[int, int], tuple[int, str]]


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of a span from those of its two halves: [p, q] -> [p, r] [r, q]."""
    out: Cell = {}
    starts: dict[int, list] = {}
    for (r, q), cell in right.items():
        starts.setdefault(r, []).append((q, cell))
    for (p, r), (cost, audit) in left.items():
        for q, (more, letters) in starts.get(r, ()):
            total, best = cost + more, out.get((p, q))
            if best is None or total < best[0] or (total == best[0] and audit + letters < best[1]):
                out[p, q] = total, audit + letters
    return out


def span(cells: list[Cell]) -> Cell:
    """The cell of neighbouring spans, by spans of doubling length."""
    while len(cells) > 1:
        pairs = [combine(a, b) for a, b in itertools.batched(cells[: len(cells) // 2 * 2], 2)]
        cells = pairs + cells[len(cells) // 2 * 2:]
    return cells[0]


def insertions(costs: dict[str, int]) -> Cell:
    """The insertion closure: the cheapest inserted turns from each state to each other."""
    closure: Cell = {(p, p): (0, "") for p in STEPS}
    one = {(p, STEPS[p][i]): (costs["insert"], "I") for p in STEPS for i in ROLES if i in STEPS[p]}
    for _ in STEPS:
        longer = combine(closure, one)
        closure = {k: min(closure.get(k, longer.get(k)), longer.get(k, closure.get(k))) for k in closure | longer}
    return closure


class Chart:
    """Cells of single turns, by role initial and fault, for given costs."""

    def __init__(self, costs: dict[str, int] | None = None):
        self.costs = costs or COSTS
        if self.costs["insert"] <= 0:
            raise ValueError("an inserted turn must cost something, or repairs have no least one")
        self.inserted = insertions(self.costs)
        self.initials = {i for nexts in STEPS.values() for i in nexts}
        self.known: dict[tuple[str, str], Cell] = {}

    def turn(self, initial: str, fault: str) -> Cell:
        """Edits of one turn, with insertions before it. Those behind the last turn are
        added by `whole`."""
        initial = initial if initial in self.initials else ""
        if (initial, fault) not in self.known:
            c, edits = self.costs, {(p, p): (self.costs["delete"], "D") for p in STEPS}
            if fault not in ("blank", "duplicate"):
                extra = c["truncated"] if fault == "truncated" else 0
                for p, nexts in STEPS.items():
                    for i, q in nexts.items():
                        if i == initial:
                            edits[p, q] = c["keep"] + extra, "K"
                        elif i in ROLES:
                            edits[p, q] = c["rerole"] + extra, "R"
            self.known[initial, fault] = combine(self.inserted, edits)
        return self.known[initial, fault]

    def whole(self, cell: Cell | None) -> tuple[int, str]:
        """The least (cost, audit) of a whole conversation."""
        done = combine(cell, self.inserted) if cell else self.inserted
        return min(done[START, q] for q in FINAL if (START, q) in done)


def _text(cell: Cell) -> str:
    return ";".join(f"{p},{q},{cost},{audit}" for (p, q), (cost, audit) in cell.items())


def _cell(text: str) -> Cell:
    parts = (x.split(",") for x in text.split(";"))
    return {(int(p), int(q)): (int(cost), audit) for p, q, cost, audit in parts}


def edited_roles(audit: str, initials: Iterator[str]) -> Iterator[tuple[str, str | None]]:
    """(letter, new role) of every edit; None where the role stays or the turn goes. Only
    a kept system turn leads to state 1, so the letters tell all states."""
    state = START
    for letter in audit:
        initial = "" if letter == "I" else next(initials)
        if letter == "D":
            yield letter, None
            continue
        to = initial if letter == "K" else next(i for i in STEPS[state] if i in ROLES)
        state = STEPS[state][to]
        yield letter, None if letter == "K" else ROLES[to]


# One letter for each fault, in the order in which the first counts.
FAULTS = {"blank": "b", "duplicate": "d", "truncated": "t", "": "-"}
COUNTED = ["blank", "duplicate", "truncated", "illegal"]


def _ordered(rows: DataFrame) -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("said").asc()]


def numbered(rows: DataFrame) -> DataFrame:
    """conv_id, no, turn, role initial and fault of every row, without texts.

    Rows are numbered from 0 by turn (null first), then role and text; a task orders
    the rows of one conversation and SLOT turns.
    """
    lean = rows.select(
        "conv_id", "turn", "role", said("role", "text").alias("said"),
        F.coalesce(F.floor(F.col("turn") / SLOT), F.lit(-(1 << 62))).cast("long").alias("slot"),
        F.when(~F.col("text").rlike(f"[^{BLANKS}]"), F.lit("b"))
        .when(~F.col("text").rlike(f"[.!?][{BLANKS}]*\\z"), F.lit("t")).otherwise(F.lit("-")).alias("fault"))
    lean = lean.withColumn("inside", F.row_number().over(
        Window.partitionBy("conv_id", "slot").orderBy(*_ordered(lean))) - 1)
    lean = stage(lean.select("conv_id", "slot", "inside", "turn", F.substring("role", 1, 1).alias("initial"),
                             "said", "fault"), "turns")
    before = Window.partitionBy("conv_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = lean.groupBy("conv_id", "slot").count().select(
        "conv_id", "slot", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    lean = join_per_key(lean, starts, ["conv_id", "slot"], "inside", salts=SALTS).withColumn(
        "no", F.col("start") + F.col("inside"))
    first = lean.groupBy("conv_id", "said").agg(F.min("no").alias("no")).select(
        "conv_id", "no", F.lit(True).alias("new"))
    again = F.col("new").isNull() & (F.col("fault") != "b")
    return lean.join(first, ["conv_id", "no"], "left").select(
        "conv_id", "no", "turn", "initial", F.when(again, F.lit("d")).otherwise(F.col("fault")).alias("fault"))


SPAN = "conv_id long, block long, cell string, head string, tail string, " + ", ".join(f"{c} long" for c in COUNTED)


def _runs(batches: Iterator[pa.RecordBatch], fan: int) -> Iterator[tuple[int, int, list]]:
    """Neighbouring rows of the same conversation and block // fan."""
    key, held = None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for row in zip(*columns):
            now = row[0], row[1] // fan
            if now != key:
                if held:
                    yield *key, held
                key, held = now, []
            held.append(row)
    if held:
        yield *key, held


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    for some in itertools.batched(rows, size):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split(" ") for x in ddl.split(", "))])


def _spans(costs: dict[str, int] | None):
    """Parse runs of turns: rows (conv_id, no, initial, fault) to one row a block."""
    names = {letter: fault for fault, letter in FAULTS.items()}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chart, known = Chart(costs), {}

        def rows():
            for conv, block, held in _runs(batches, BLOCK):
                turns = tuple((r[2], r[3]) for r in held)
                if turns not in known:
                    cell = _text(span([chart.turn(i, names[f]) for i, f in turns]))
                    counts = [sum(f == FAULTS[c] for _, f in turns) for c in COUNTED[:3]]
                    illegal = sum(a + b not in LEGAL for (a, _), (b, _) in itertools.pairwise(turns))
                    if len(turns) > 16 or len(known) > KNOWN:
                        yield conv, block, cell, turns[0][0], turns[-1][0], *counts, illegal
                        continue
                    known[turns] = cell, turns[0][0], turns[-1][0], *counts, illegal
                yield conv, block, *known[turns]

        yield from _batches(rows(), _arrow(SPAN))

    return parse


def _join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Combine up to FAN neighbouring spans of a conversation."""
    def rows():
        for conv, block, held in _runs(batches, FAN):
            sums = [sum(r[5 + i] for r in held) for i in range(4)]
            sums[3] += sum(a[4] + b[3] not in LEGAL for a, b in itertools.pairwise(held))
            yield conv, block, _text(span([_cell(r[2]) for r in held])), held[0][3], held[-1][4], *sums

    yield from _batches(rows(), _arrow(SPAN))


def parse(turns: DataFrame, costs: dict[str, int] | None = None) -> DataFrame:
    """One row per conversation from `numbered` turns: its cell and counts of faults."""
    ship(turns.sparkSession)
    block = F.floor(F.col("no") / BLOCK)
    longest = turns.agg(F.max("no")).first()[0]
    spans = (turns.select("conv_id", "no", "initial", "fault").repartition(F.col("conv_id"), block)
             .sortWithinPartitions("conv_id", "no").mapInArrow(_spans(costs), SPAN))
    blocks = (longest or 0) // BLOCK + 1
    while blocks > 1:
        spans = stage(spans, "spans")
        spans = (spans.repartition(F.col("conv_id"), F.floor(F.col("block") / FAN))
                 .sortWithinPartitions("conv_id", "block").mapInArrow(_join_spans, SPAN))
        blocks = -(-blocks // FAN)
    return spans


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def _rewrite(costs: dict[str, int] | None):
    """Digest of the repaired conversations. Rows come sorted by conversation, a head row
    with its cell first, then its turns; texts are hashed as they pass."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chart = Chart(costs)

        def rows():
            out = edits = None
            for batch in batches:
                columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
                for conv, is_turn, role, text, cell, *counts in zip(*columns):
                    if not is_turn:
                        if out:
                            yield finish(*out)
                        cost, audit = chart.whole(_cell(cell)) if cell else (0, "")
                        waiting: list[str] = []
                        edits = edited_roles(audit, iter(waiting.pop, None))
                        out = [conv, counts, cost, audit, hashlib.sha256(), edits, [True]]
                        continue
                    waiting.append(role[:1])
                    for letter, to in edits:
                        if letter != "D":
                            say(out, to or role, "" if letter == "I" else text)
                        if letter != "I":
                            break
            if out:
                yield finish(*out)

        def say(out, role, text):
            out[4].update(("" if out[6][0] else "\n").encode() + f"{role}:{text}".encode())
            out[6][0] = False

        def finish(conv, counts, cost, audit, digest, edits, fresh):
            for _, to in edits:  # inserted behind the last turn
                say([0, 0, 0, 0, digest, 0, fresh], to, "")
            return conv, *[x or 0 for x in counts], cost, audit, digest.hexdigest()

        yield from _batches(rows(), _arrow(RESULT))

    return walk


def repair(conversations: DataFrame, originals: DataFrame | None = None,
           costs: dict[str, int] | None = None) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired text of every conversation.

    `conversations` has conv_id, turn, role and text; further columns are not read. Null
    roles and texts count as one space. Rows of one conversation are taken by turn, null
    first, and ties by role and text, so rows that are equal stand together and all but
    the first are duplicates. Conversations of `originals` without rows give zeros, an
    empty audit and the digest of an empty text. Rows without conv_id belong to no
    conversation and are left out. An empty table gives an empty result. The digest
    reads a conversation in order: its texts pass through one task as a stream, one
    row at a time, which SHA-256 of a whole text asks for.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    turns = stage(numbered(rows), "numbered")
    spans = parse(turns, costs)
    turned = turns.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    ids = (conversations if originals is None else originals).select(F.col("conv_id").cast("long").alias("conv_id"))
    ids = ids.filter("conv_id IS NOT NULL").distinct()
    heads = ids.join(spans, "conv_id", "left").join(turned, "conv_id", "left").select(
        "conv_id", F.lit(0).alias("is_turn"), F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("binary").alias("said"), "cell", F.coalesce("gaps", F.lit(0)).alias("gaps"), *COUNTED)
    none = [F.lit(None).cast("string").alias("cell"),
            *[F.lit(None).cast("long").alias(c) for c in ["gaps", *COUNTED]]]
    lines = rows.select("conv_id", F.lit(1).alias("is_turn"), "turn", "role", "text",
                        said("role", "text").alias("said"), *none)
    both = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id"), F.col("is_turn"), *_ordered(lines))
    return both.select("conv_id", "is_turn", "role", "text", "cell", "gaps", *COUNTED).mapInArrow(
        _rewrite(costs), RESULT)


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage of the contract, by crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1
    empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes its role user.
    Nulls are replaced by one space first, in the hashed key, too."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(
        F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
