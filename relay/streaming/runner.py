"""The delivery of a topic, one micro-batch at a time.

    decode - validate - filter - batch - deliver - route - retry - dead letters
                                                       - ledger - commits

Spark's checkpoint owns the source offsets. Within a micro-batch the classified
records are written first; the outcomes and the retries, which have side
effects, are written once and reused when the micro-batch is replayed; what
follows is derived from them. Delivery is at least once: a lost task repeats
its own requests, a replayed micro-batch none.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from relay.functions import status
from relay.functions.json_values import computed_once, parse, starts_object
from relay.functions.predicates import truthy
from relay.operators import batching, breaker, delivery, ledger, responses, routing, validation
from relay.operators.filtering import check_boolean, make_filter
from relay.operators.metrics import DROPPED, INVALID, REJECT, SENT
from relay.session import configure
from relay.sources.envelope import ENVELOPE, POSITION
from relay.streaming.keyed import KeyedSink
from relay.streaming.stores import Stores

log = logging.getLogger(__name__)

PLACE = ("chunk_no", "seq", "first_offset", "batch_id", "request_no", "request_id")
FAILED = [*[f.name for f in ENVELOPE], "batch_id", "first_offset", "status_code", "error_message",
          "error_type", "retried"]
WORKING = ("classified", "outcomes", "failures", "retries", "deferred", "breaker")


@dataclass(frozen=True)
class RelayOptions:
    """What to do with the records of a topic.

    `filter` and `rules` are texts, or functions without arguments that build
    the columns once a session exists. `decoder` adds `decoded` to envelopes.
    Up to `concurrency` requests at a time are sent by each of `tasks` tasks (by
    default the cluster's parallelism); `ordered` sends one at a time. With
    `keep_batches` the working tables of older micro-batches are removed, with
    `keep_ledger` older micro-batches of the ledger whose offsets are all committed;
    the dead letters and the commits stay.
    """

    sink: str = "http"
    decoder: Callable[[DataFrame], DataFrame] | None = None
    rules: str | Callable[[], validation.Rules] | None = None
    on_failure: str = "dlq"
    filter: str | Callable[[], Column] | None = None
    mode: str = "batch"
    chunk_size: int = 50
    span: int | None = 65_536
    max_size: int = 500
    seq_field: str = batching.SEQ_FIELD
    response: responses.ResponseFields = field(default_factory=responses.ResponseFields)
    ordered: bool = False
    concurrency: int = 16
    tasks: int | None = None
    keep_batches: int | None = None
    keep_ledger: int | None = None
    ranges: routing.RouteRanges = field(default_factory=routing.RouteRanges)
    max_attempts: int = 3
    backoff_initial_ms: int = 100
    backoff_max_ms: int = 10_000
    backoff_multiplier: float = 2.0
    breaker_enabled: bool = True
    breaker_window: int = breaker.WINDOW
    breaker_threshold: int = breaker.THRESHOLD
    breaker_reset_s: float = 10.0
    on_open: str = "wait"

    def __post_init__(self) -> None:
        if self.mode not in batching.MODES:
            raise ValueError(f"unknown batch mode {self.mode!r}")
        if self.on_failure not in ("dlq", "ignore", "drop"):
            raise ValueError(f"on_failure is dlq, ignore or drop, not {self.on_failure!r}")
        if self.on_open not in ("wait", "defer"):
            raise ValueError(f"on_open is wait or defer, not {self.on_open!r}")
        if self.chunk_size <= 0 or self.concurrency <= 0:
            raise ValueError("chunk_size and concurrency must be positive")
        if self.keep_batches is not None and self.keep_batches < 2:
            raise ValueError("keep at least two micro-batches: a replay reads them")
        if self.keep_ledger is not None and self.keep_ledger < 1:
            raise ValueError("keep at least one micro-batch of the ledger")
        if not 0 < self.breaker_threshold <= 100 or self.breaker_window <= 0:
            raise ValueError("breaker threshold is a percentage, its window positive")


def classify(messages: DataFrame, options: RelayOptions, objects_only: bool = False) -> DataFrame:
    """Envelopes with `stage` (reject, invalid, dropped, sent) and `reason`. With
    `objects_only` payloads that are no JSON object are rejected in every mode.

    Row-local: one pass, the payload parsed once, no shuffle.
    """
    rows = messages.select(*[f.name for f in ENVELOPE])
    undecoded = F.lit(False)
    if options.decoder:
        decoded = options.decoder(rows)
        undecoded = F.col("decoded").isNull()
        rows = decoded.withColumn("value", F.coalesce(F.col("decoded").cast("binary"), "value"))
    rows = computed_once(rows, "any_message", parse("value"))
    rows = computed_once(rows, "message", F.when(starts_object("value"), F.col("any_message")))

    reason = F.lit(None).cast("string")
    if options.rules:
        rules = options.rules() if callable(options.rules) else options.rules
        pairs = validation.parse_rules(rules)
        for _, condition in pairs:
            check_boolean(rows, condition)
        reason = validation.failure_reason(pairs)
    passed = F.lit(True)
    if options.filter:
        spec = options.filter() if callable(options.filter) else options.filter
        by_path = isinstance(spec, str) and spec.strip().startswith("$")
        passed = truthy(make_filter(spec, message="any_message" if by_path else "message",
                                    raw="value", df=rows))
    # What cannot stand in a body is a dead letter, never silently left out.
    unusable = (F.col("message").isNull() if objects_only or options.mode == "with_response"
                else F.col("value").isNull() if options.mode == "batch" else F.lit(False))

    rows = computed_once(rows, "reason", reason)
    stage = (F.when(undecoded, REJECT).when(F.col("reason").isNotNull(), INVALID)
             .when(~passed, DROPPED).when(unusable, REJECT).otherwise(SENT))
    return computed_once(rows, "stage", stage).select(*[f.name for f in ENVELOPE], "stage", "reason")


class Relay:
    """Runs micro-batches: `process` is the function for `foreachBatch`.

    `dead_letter_writer(df, batch)` gets (key, value, headers) rows in addition
    to the `dlq` table. `clock` and `sleep` are there for tests. A `KeyedSink` in place
    of a transport keeps a table by key: refused rows are failures like those of any
    sink, and payloads that are no JSON object dead letters.
    """

    def __init__(self, stores: Stores, transport: delivery.Transport | KeyedSink, options: RelayOptions,
                 dead_letter_writer: Callable[[DataFrame, int], Any] | None = None,
                 clock: Callable[[], float] = time.time,
                 sleep: Callable[[float], None] = time.sleep):
        self.stores, self.transport, self.options = stores, transport, options
        self.dead_letter_writer, self.clock, self.sleep = dead_letter_writer, clock, sleep
        configure(stores.spark)

    # --- steps ---------------------------------------------------------------

    def process(self, messages: DataFrame, batch: int) -> None:
        options, stores = self.options, self.stores
        messages = messages.select(*[f.name for f in ENVELOPE])
        waiting = stores.read_batch("deferred", batch - 1)
        if waiting is not None:
            messages = messages.unionByName(waiting)
        # A micro-batch that has delivered already is finished, not deferred.
        if not stores.complete("outcomes", batch) and not self._may_send(batch):
            stores.write("deferred", batch, messages)
            return

        records = stores.write("classified", batch, self._placed(classify(
            messages, options, objects_only=isinstance(self.transport, KeyedSink))))
        members = records.filter(F.col("stage") == SENT)
        if isinstance(self.transport, KeyedSink):
            outcomes, failed = self._merge(members, batch)
        else:
            outcomes = stores.write_once("outcomes", batch, self._deliver(members))
            failed = self._failures(outcomes, members)
        failures = stores.write("failures", batch, routing.with_action(failed, options.ranges))
        self._stop_on_fail(failures)

        retries = stores.write_once("retries", batch, self._retry(failures))
        final = self._dispositions(failures, retries)
        entries = stores.write("ledger", batch, self._ledger(records, final))
        self._dead_letters(records, final, batch)
        self._commit(entries, batch)
        if options.breaker_enabled:
            self._update_breaker(outcomes, failures, retries, batch)
        if options.keep_batches:
            for table in WORKING:
                stores.drop(table, batch - options.keep_batches)

    @property
    def _tasks(self) -> int:
        return self.options.tasks or self.stores.spark.sparkContext.defaultParallelism

    def _placed(self, records: DataFrame) -> DataFrame:
        """Records with their place in a batch; only sent ones get one. All are
        numbered in the same pass, each stage by itself."""
        options = self.options
        cut = batching.split_max(
            batching.chunk(records, options.chunk_size, options.span,
                           keys=[*batching.PARTITION, "stage"]),
            options.max_size if options.mode == "with_response" else 0)
        if options.mode == "individual":
            cut = cut.withColumn("request_id", F.concat_ws("-", *POSITION))
        sent = F.col("stage") == SENT
        # Dropped records are counted, never sent: their payload is not stored.
        stored = {name: F.when(F.col("stage") != DROPPED, F.col(name)) for name in ("key", "value")}
        return cut.withColumns({**stored, **{name: F.when(sent, F.col(name)) for name in PLACE}})

    def _deliver(self, members: DataFrame) -> DataFrame:
        options = self.options
        requests = batching.build_requests(members, options.mode, options.seq_field).withColumn(
            "sink", F.lit(options.sink))
        if options.ordered:
            return delivery.ordered_deliver(requests, self.transport)
        return delivery.deliver(requests, self.transport, options.concurrency, self._tasks)

    def _merge(self, members: DataFrame, batch: int) -> tuple[DataFrame, DataFrame]:
        """(outcomes, failures) of merging messages into a keyed table: one outcome per
        batch, as the table takes a micro-batch whole or not at all."""
        started = self.clock()
        messages = computed_once(members, "message", parse("value"))
        refused = self.transport.push(self.stores, messages, batch)
        took = self.clock() - started
        requests = members.groupBy("batch_id", "request_id").agg(
            F.min("first_offset").alias("first_offset"), F.count("*").cast("int").alias("size"))
        outcomes = requests.select(
            F.lit(self.options.sink).alias("sink"), "batch_id", "request_id", "first_offset", "size",
            F.lit(200).alias("status_code"), F.lit(None).cast("string").alias("response_body"),
            F.lit(None).cast("string").alias("error"), F.lit(float(took)).alias("latency_s"))
        return self.stores.write_once("outcomes", batch, outcomes), refused.select(*FAILED)

    def _failures(self, outcomes: DataFrame, members: DataFrame) -> DataFrame:
        if self.options.mode == "with_response":
            failed = responses.response_failures(outcomes, members, self.options.response)
        else:
            failed = delivery.expand_batch_failure(outcomes, members)
        return failed.select(*FAILED)

    def _stop_on_fail(self, failures: DataFrame) -> None:
        """Stop the query before its offsets are committed."""
        fatal = failures.filter(F.col("action") == status.FAIL).select(
            *POSITION, "status_code", "error_message").limit(1).collect()
        if fatal:
            raise RuntimeError(f"FAIL action, stopping: {fatal[0].asDict()}")

    def _retry(self, failures: DataFrame) -> DataFrame:
        options = self.options
        if isinstance(self.transport, KeyedSink):
            return failures.filter(F.lit(False)).withColumns({
                "attempts": F.array().cast(delivery.ATTEMPTS), "delivered": F.lit(False), "retried": F.lit(True)})
        return delivery.retry(
            failures.filter(F.col("action") == status.RETRY), self.transport, options.max_attempts,
            options.backoff_initial_ms, options.backoff_max_ms, options.backoff_multiplier,
            1 if options.ordered else options.concurrency, self._tasks, self._single_body(),
            responses.SingleResult(options.response) if options.mode == "with_response" else None)

    def _single_body(self) -> Column:
        """Body of a message sent by itself, in the form the sink expects."""
        text = F.col("value").cast("string")
        if self.options.mode == "individual":
            return text
        if self.options.mode == "with_response":
            text = batching.with_seq(text, F.lit(0), self.options.seq_field)
        return F.concat(F.lit("["), text, F.lit("]"))

    def _dispositions(self, failures: DataFrame, retries: DataFrame) -> DataFrame:
        """Failed messages with their final `disposition` and number of tries."""
        again = self.options.ranges.action("status_code", F.lit(True))
        direct = failures.filter(F.col("action") != status.RETRY).withColumns({
            "disposition": F.col("action"), "tries": F.lit(0)})
        retried = retries.withColumns({
            "disposition": F.when(F.col("delivered"), "DELIVERED").otherwise(again),
            "tries": F.size("attempts")}).drop("attempts", "delivered")
        return direct.unionByName(retried)

    def _ledger(self, records: DataFrame, final: DataFrame) -> DataFrame:
        """One row per record of the micro-batch, all of them done."""
        ended = final.select(*POSITION, F.col("status_code").alias("_code"), "error_type", "action",
                             "tries", "disposition")
        sent = F.col("stage") == SENT
        return (
            records.select(*POSITION, "stage", "reason", "batch_id")
            .join(ended, POSITION, "left")
            .withColumns({
                "sink": F.lit(self.options.sink),
                "failed": F.col("_code").isNotNull(),
                "status_code": F.when(sent, F.coalesce("_code", F.lit(200))),
                "error_type": (F.when(F.col("stage") == REJECT, status.DESERIALIZATION)
                               .when(F.col("stage") == INVALID, status.INVALID_MESSAGE)
                               .when(sent, F.coalesce("error_type", F.lit(status.NONE)))),
                "disposition": (F.when(sent, F.coalesce("disposition", F.lit("DELIVERED")))
                                .when(F.col("stage") == REJECT, status.DLQ)
                                .when((F.col("stage") == INVALID)
                                      & F.lit(self.options.on_failure == "dlq"), status.DLQ)
                                .when(F.col("stage") == INVALID, status.IGNORE)),
                "committable": F.lit(True),
            })
            .drop("_code")
        )

    def _dead_letters(self, records: DataFrame, final: DataFrame, batch: int) -> None:
        envelope = [f.name for f in ENVELOPE]
        parts = final.filter(F.col("disposition") == status.DLQ).select(
            *envelope, "error_type", "status_code", "error_message")
        skipped = [(REJECT, status.DESERIALIZATION, F.lit("payload cannot be decoded"))]
        if self.options.on_failure == "dlq":
            skipped.append((INVALID, status.INVALID_MESSAGE, F.col("reason")))
        for stage, kind, text in skipped:
            parts = parts.unionByName(records.filter(F.col("stage") == stage).select(
                *envelope, F.lit(kind).alias("error_type"), F.lit(0).alias("status_code"),
                text.alias("error_message")))
        letters = self.stores.write("dlq", batch, routing.to_dlq(parts))
        if self.dead_letter_writer:
            self.dead_letter_writer(letters, batch)

    # --- commits ---------------------------------------------------------------

    def _commit(self, entries: DataFrame, batch: int) -> None:
        """Take a micro-batch into the intervals of done offsets, and write how far every
        partition got (`commits`) and which moved on (`commit_report`).

        Only the intervals of the newest micro-batches are kept. With `keep_ledger`
        older micro-batches of the ledger go once all their offsets are committed.
        """
        stores = self.stores
        done = [b for b in stores.batches("intervals") if b < batch]
        before = stores.read_batch("intervals", max(done)) if done else None
        known = stores.write("intervals", batch, ledger.intervals(entries, before))
        now = stores.write("commits", batch, ledger.committed(known))
        previous = ledger.committed(before) if before is not None else now.filter(F.lit(False))
        stores.write("commit_report", batch, ledger.commit_report(previous, now))
        for old in done[:-1]:
            stores.drop("intervals", old)
        if self.options.keep_ledger:
            for old in [b for b in stores.batches("ledger") if b <= batch - self.options.keep_ledger]:
                if ledger.prune(stores.read_batch("ledger", old), now).isEmpty():
                    stores.drop("ledger", old)

    # --- breaker ---------------------------------------------------------------

    def _state(self, batch: int) -> dict[str, Any]:
        """State after the newest micro-batch before `batch` that has one."""
        saved = self.stores.read_batch("breaker", batch)
        return saved.first().asDict() if saved is not None else {
            "window": [], "is_open": False, "opened_at": None}

    def _may_send(self, batch: int) -> bool:
        """Whether the breaker lets this micro-batch through, after waiting."""
        if not self.options.breaker_enabled:
            return True
        state = self._state(batch - 1)
        if state["is_open"]:
            left = state["opened_at"] + self.options.breaker_reset_s - self.clock()
            if left > 0 and self.options.on_open == "defer":
                self._save_state(batch, state)
                return False
            while left > 0:
                self.sleep(min(left, 1.0))
                left = state["opened_at"] + self.options.breaker_reset_s - self.clock()
            log.info("breaker reset, sending again")
            self._save_state(batch - 1, {"window": [], "is_open": False, "opened_at": None})
        return True

    def _update_breaker(self, outcomes: DataFrame, failures: DataFrame, retries: DataFrame,
                        batch: int) -> None:
        """Decide at the end of a micro-batch from the last outcomes.

        Only the window, a fixed number of flags, comes to the driver.
        """
        n = self.options.breaker_window
        attempts = retries.select(
            F.lit(self.options.sink).alias("sink"), "batch_id", "first_offset", "offset",
            F.explode("attempts").alias("a")).select(
            "sink", "batch_id", "first_offset", "offset", "a.attempt", "a.ok")
        sent = outcomes.groupBy("sink", "batch_id").agg(F.min("first_offset").alias("first_offset"))
        feed = breaker.breaker_feed(sent, failures, attempts)
        newest = feed.orderBy(F.desc("first_offset"), F.desc("batch_id"), F.desc("offset"),
                              F.desc("attempt")).select("success").limit(n).collect()
        state = self._state(batch - 1)
        window = (list(state["window"]) + [row["success"] for row in reversed(newest)])[-n:]
        is_open, opened_at = state["is_open"], state["opened_at"]
        if len(window) == n:
            now_open = window.count(False) * 100 // n >= self.options.breaker_threshold
            if now_open and not is_open:
                opened_at = self.clock()
            is_open = now_open
        self._save_state(batch, {"window": window, "is_open": is_open, "opened_at": opened_at})

    def _save_state(self, batch: int, state: dict[str, Any]) -> None:
        schema = "window array<boolean>, is_open boolean, opened_at double"
        self.stores.write("breaker", batch, self.stores.spark.createDataFrame(
            [(list(state["window"]), state["is_open"], state["opened_at"])], schema).coalesce(1))

    # --- start ---------------------------------------------------------------------

    def start(self, messages: DataFrame, checkpoint: str, **trigger: Any) -> StreamingQuery:
        """Start the stream; `trigger` is e.g. availableNow=True."""
        writer = messages.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()
