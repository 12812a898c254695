"""A breaker as the state of a stream, which wakes by itself.

Requests and outcomes come as one stream. Requests pass while the breaker of their sink is
closed; while it is open they wait in the state of the stream, and a processing-time timer
set for the end of the reset lets them go, whether or not new records come. Outcomes count
in the order in which they finished.

A sink's requests are dealt into lanes, so that a sink with most of the requests is many
tasks; every lane gets all outcomes, which are one flag each, and so comes to the same
state. State and timers live in the checkpoint: a restarted query goes on where it was.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from relay.operators import breaker, delivery
from relay.session import configure
from relay.streaming.stores import Stores

# The state store that timers need; set it before a query with a gate starts.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
REQUEST = "request_id string, first_offset long, size int, body string"
EVENT = f"sink string, {REQUEST}, ok boolean, finished_at double, attempt int"
PASSED = f"sink string, {REQUEST}, waited boolean"
OUTCOME = "sink string, request_id string, attempt int, ok boolean, finished_at double"
STATE = "flags array<boolean>, is_open boolean, opened_ms long"
AT_ONCE = 1024


@dataclass
class Breaker:
    """The last `n` outcomes, and whether that many failures keep requests back."""

    n: int = breaker.WINDOW
    threshold: int = breaker.THRESHOLD
    reset_ms: int = 10_000
    flags: list[bool] = field(default_factory=list)
    is_open: bool = False
    opened_ms: int = 0

    def count(self, ok: bool, now_ms: int) -> None:
        """Take one outcome in; only a full window opens or closes."""
        self.flags = [*self.flags[-self.n + 1:], ok] if self.n > 1 else [ok]
        if len(self.flags) < self.n:
            return
        failing = self.flags.count(False) * 100 // self.n >= self.threshold
        if failing and not self.is_open:
            self.opened_ms = now_ms
        self.is_open = failing

    def wakes(self, now_ms: int) -> bool:
        """Whether an open breaker's time is over; it then forgets its window."""
        if not self.is_open or now_ms - self.opened_ms < self.reset_ms:
            return False
        self.is_open, self.flags = False, []
        return True


class BreakerGate(StatefulProcessor):
    """Lets requests of one (sink, lane) through, or keeps them until the breaker closes."""

    def __init__(self, n: int, threshold: int, reset_ms: int):
        self.settings = {"n": n, "threshold": threshold, "reset_ms": reset_ms}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("breaker", STATE)
        self.waiting = handle.getListState("waiting", REQUEST)

    def close(self) -> None:
        pass

    def _load(self) -> Breaker:
        saved = self.state.get() if self.state.exists() else None
        if saved is None:
            return Breaker(**self.settings)
        flags, is_open, opened_ms = saved
        return Breaker(**self.settings, flags=list(flags), is_open=is_open, opened_ms=opened_ms)

    def _save(self, now: Breaker) -> None:
        self.state.update((now.flags, now.is_open, now.opened_ms))

    def _release(self, sink: str) -> Iterator[pd.DataFrame]:
        """Everything that waits, a bounded number of rows at a time."""
        if not self.waiting.exists():
            return
        some: list[tuple] = []
        for row in self.waiting.get():
            some.append(tuple(row))
            if len(some) == AT_ONCE:
                yield _frame(sink, some, True)
                some = []
        if some:
            yield _frame(sink, some, True)
        self.waiting.clear()

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        sink, now_ms = key[0], timerValues.getCurrentProcessingTimeInMs()
        outcomes, requests = [], []
        for frame in rows:
            done = frame[frame["finished_at"].notna()]
            outcomes += done[["finished_at", "request_id", "attempt", "ok"]].values.tolist()
            asked = frame[frame["finished_at"].isna()]
            requests += asked[["request_id", "first_offset", "size", "body"]].values.tolist()
        now = self._load()
        now.wakes(now_ms)
        for *_, ok in sorted(outcomes):
            was_open = now.is_open
            now.count(bool(ok), now_ms)
            if now.is_open and not was_open:
                self.handle.registerTimer(now.opened_ms + now.reset_ms)
        self._save(now)
        if not now.is_open:
            yield from self._release(sink)
        requests = [(r, int(first), int(size), body) for r, first, size, body in sorted(requests, key=lambda r: (r[1], r[0]))]
        for start in range(0, len(requests), AT_ONCE):
            some = requests[start:start + AT_ONCE]
            if now.is_open:
                self.waiting.appendList(some)
            else:
                yield _frame(sink, some, False)

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = self._load()
        now.wakes(timerValues.getCurrentProcessingTimeInMs())
        if not now.is_open:
            self._save(now)
            yield from self._release(key[0])


def _frame(sink: str, rows: list[tuple], waited: bool) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["request_id", "first_offset", "size", "body"])
    frame.insert(0, "sink", sink)
    frame["waited"] = waited
    return frame


def gate(requests: DataFrame, outcomes: DataFrame, n: int = breaker.WINDOW, threshold: int = breaker.THRESHOLD,
         reset_s: float = 10.0, lanes: int = 1) -> DataFrame:
    """The requests that may be sent, as they may: PASSED rows of a stream of requests
    (`sink` and REQUEST) and a stream of outcomes (OUTCOME)."""
    if not 0 < threshold <= 100 or n <= 0 or lanes <= 0:
        raise ValueError("breaker threshold is a percentage, its window and lanes positive")
    none = {"ok": "boolean", "finished_at": "double", "attempt": "int"}
    asked = requests.select("sink", "request_id", "first_offset", "size", "body", *[
        F.lit(None).cast(t).alias(c) for c, t in none.items()],
        F.pmod(F.xxhash64("request_id"), F.lit(lanes)).cast("int").alias("lane"))
    done = outcomes.select(
        "sink", "request_id", F.lit(None).cast("long").alias("first_offset"), F.lit(None).cast("int").alias("size"),
        F.lit(None).cast("string").alias("body"), "ok", "finished_at", "attempt",
        F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    return asked.unionByName(done).groupBy("sink", "lane").transformWithStateInPandas(
        BreakerGate(n, threshold, round(reset_s * 1000)), PASSED, "Append", "ProcessingTime")


def start_gated(requests: DataFrame, stores: Stores, transport: delivery.Transport, checkpoint: str,
                n: int = breaker.WINDOW, threshold: int = breaker.THRESHOLD, reset_s: float = 10.0,
                lanes: int = 1, concurrency: int = 16, **trigger: Any) -> StreamingQuery:
    """Send a stream of requests through a gate. What is sent is written to the table
    `gate_outcomes` of the stores, which the same query reads back as its outcomes.

    A micro-batch that is replayed sends nothing again once its outcomes are there.
    """
    spark = configure(stores.spark)
    spark.conf.set(*STATE_STORE)
    # A first folder without rows, so that the stream of outcomes has a place to look in.
    if not stores.complete("gate_outcomes", -1):
        stores.write("gate_outcomes", -1, spark.createDataFrame([], OUTCOME))
    outcomes = spark.readStream.schema(OUTCOME).parquet(f"{stores.base}/gate_outcomes/micro_batch=*")

    def send(passed: DataFrame, batch: int) -> None:
        sent = delivery.deliver(passed, transport, concurrency, finished="finished_at")
        stores.write_once("gate_outcomes", batch, sent.withColumns({
            "ok": F.col("status_code").between(200, 299), "attempt": F.lit(0)}))

    writer = gate(requests, outcomes, n, threshold, reset_s, lanes).writeStream.foreachBatch(send)
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()
