"""Delivery of requests through a user transport, and retries.

A transport is a picklable callable `request -> (status, body)`. `request` is a
dict with the request's columns. If it has `open()` that is called once per
task before the first request, `close()` after the last one. An exception, or
status 0, is a transport failure. With a concurrency over 1 it is called from
several threads of a task.

Delivery has side effects: stage its result (`relay.session.stage`) before
reading it more than once.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relay.functions import status
from relay.operators.batching import PARTITION
from relay.sources.envelope import POSITION

Transport = Callable[[dict[str, Any]], tuple[int, str | None]]

OUTCOME_FIELDS = [
    T.StructField("status_code", T.IntegerType()),
    T.StructField("response_body", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("latency_s", T.DoubleType()),
]
ATTEMPTS = T.ArrayType(T.StructType([
    T.StructField("attempt", T.IntegerType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("ok", T.BooleanType()),
]))


def parse_headers(headers: str | dict[str, str] | None) -> dict[str, str]:
    """`K:V,K:V` or a dict; pairs without a name or colon are skipped."""
    if isinstance(headers, dict):
        found = dict(headers)
    else:
        found = {}
        for pair in (headers or "").split(","):
            name, colon, value = pair.partition(":")
            if colon and name.strip():
                found[name.strip()] = value.strip()
    if "content-type" not in {name.lower() for name in found}:
        found["Content-Type"] = "application/json"
    return found


class HttpTransport:
    """POST or PUT a request body; one HTTP session per task."""

    def __init__(self, url: str, method: str = "POST",
                 headers: str | dict[str, str] | None = None, timeout_s: float = 10.0):
        if method not in ("POST", "PUT"):
            raise ValueError(f"method is POST or PUT, not {method!r}")
        self.url, self.method, self.timeout_s = url, method, timeout_s
        self.headers = parse_headers(headers)
        self.session = None

    def open(self) -> None:
        import requests

        self.session = requests.Session()

    def close(self) -> None:
        self.session.close()
        self.session = None

    def __call__(self, request: dict[str, Any]) -> tuple[int, str]:
        response = self.session.request(self.method, self.url, data=request["body"].encode("utf-8"),
                                        headers=self.headers, timeout=self.timeout_s)
        return response.status_code, response.text


def _send(transport: Transport, request: dict[str, Any]) -> tuple[int, str | None, str | None, float]:
    started = time.perf_counter()
    try:
        code, body = transport(request)
        error = None if code else "transport failure"
    except Exception as failure:  # whatever the transport raises is an outcome
        code, body, error = 0, None, str(failure) or type(failure).__name__
    return int(code), body, error, time.perf_counter() - started


def _in_task(transport: Transport, concurrency: int, handle: Callable[[dict[str, Any]], tuple],
             names: list[str]) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The mapInPandas function: rows of a task in order, at most `concurrency`
    at a time, results next to their rows."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if hasattr(transport, "open"):
            transport.open()
        try:
            with ThreadPoolExecutor(concurrency) as pool:
                for frame in frames:
                    rows = frame.to_dict("records")
                    results = list(pool.map(handle, rows) if concurrency > 1 else map(handle, rows))
                    added = pd.DataFrame(results, columns=names, index=frame.index)
                    yield pd.concat([frame, added], axis=1)
        finally:
            if hasattr(transport, "close"):
                transport.close()

    return run


def deliver(requests: DataFrame, transport: Transport, concurrency: int = 1,
            tasks: int | None = None, finished: str | None = None) -> DataFrame:
    """Send every request once; adds status_code, response_body, error, latency_s.

    `tasks` spreads the requests over that many tasks, for small batches that
    Spark would otherwise keep in a few; `concurrency` is per task. `finished` names a
    further column for the time, in seconds, at which the answer was there.
    """
    if tasks:
        requests = requests.repartition(tasks, "request_id")
    fields = OUTCOME_FIELDS + ([T.StructField(finished, T.DoubleType())] if finished else [])
    schema = T.StructType(requests.schema.fields + fields)
    names = [f.name for f in fields]

    def send(request):
        outcome = _send(transport, request)
        return (*outcome, time.time()) if finished else outcome

    return requests.mapInPandas(_in_task(transport, concurrency, send, names), schema)


def ordered_deliver(requests: DataFrame, transport: Transport) -> DataFrame:
    """Send the requests of each partition strictly in offset order.

    Order asks for one task per partition; different partitions run in parallel.
    """
    ordered = (requests.repartition(*PARTITION)
               .sortWithinPartitions(*PARTITION, "first_offset"))
    return deliver(ordered, transport)


def retry(failures: DataFrame, transport: Transport, max_attempts: int = 3, initial: int = 100,
          maximum: int = 10_000, multiplier: float = 2.0, concurrency: int = 1,
          tasks: int | None = None, body: Column | None = None,
          accepted: Callable[[int, str | None], bool] | None = None,
          sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Resend each failed message by itself until one attempt succeeds.

    Adds `attempts` (array of attempt, status_code, ok) and `delivered`; the
    original error stays, `retried` becomes true. `body` is the request body (the
    raw value by default), `accepted` decides on a 2xx answer from its text.
    Rows are spread evenly first, as the failures of one partition may be most
    of them.
    """
    spread = failures.repartition(*([tasks] if tasks else []), *POSITION)
    text = F.col("value").cast("string") if body is None else body
    rows = spread.withColumns({"body": text, "size": F.lit(1)})
    fields = rows.schema.fields + [T.StructField("attempts", ATTEMPTS),
                                   T.StructField("delivered", T.BooleanType())]
    delays = [min(float(maximum), initial * multiplier ** n) / 1000 for n in range(max_attempts)]

    def resend(message):
        attempts = []
        for number, delay in enumerate(delays, start=1):
            sleep(delay)
            code, answer, *_ = _send(transport, message)
            ok = 200 <= code <= 299 and (accepted is None or accepted(code, answer))
            attempts.append({"attempt": number, "status_code": code, "ok": ok})
            if ok:
                break
        return attempts, bool(attempts) and attempts[-1]["ok"]

    run = _in_task(transport, concurrency, resend, ["attempts", "delivered"])
    return (rows.mapInPandas(run, T.StructType(fields))
            .drop("body", "size").withColumn("retried", F.lit(True)))


def expand_batch_failure(outcomes: DataFrame, members: DataFrame,
                         reason: str = "the sink refused the request") -> DataFrame:
    """All-or-nothing: every message of a failed request with its status."""
    failed = outcomes.filter(~status.is_success("status_code")).select(
        "request_id", "status_code",
        F.coalesce("error", F.lit(reason)).alias("error_message"))
    return as_failures(members.join(failed, "request_id"))


def as_failures(messages: DataFrame) -> DataFrame:
    """Complete failure rows from `status_code` and `error_message`."""
    return messages.withColumns({"error_type": status.error_type("status_code"),
                                 "retried": F.lit(False)})


def batch_error(members: DataFrame, message: str) -> DataFrame:
    """Failures of a batch whose sink broke down before any status."""
    return members.withColumns({
        "error_type": F.lit(status.DEFAULT),
        "status_code": F.lit(0),
        "error_message": F.lit(message),
        "retried": F.lit(False),
    })
