"""Status codes, error types, routing actions and back-off as columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from relay.functions.json_values import as_column

# Error types, actions and default status ranges.
NONE = "NONE"
SINK_4XX = "SINK_4XX_ERROR"
SINK_5XX = "SINK_5XX_ERROR"
DESERIALIZATION = "DESERIALIZATION_ERROR"
INVALID_MESSAGE = "INVALID_MESSAGE_ERROR"
UNKNOWN_FIELDS = "UNKNOWN_FIELDS_ERROR"
SINK_UNKNOWN = "SINK_UNKNOWN_ERROR"
DEFAULT = "DEFAULT_ERROR"

RETRY = "RETRY"
DLQ = "DLQ"
IGNORE = "IGNORE"
FAIL = "FAIL"

DEFAULT_RETRY = "500-599,429,408"
DEFAULT_DLQ = "400-428,430-499,500-599"
DEFAULT_FAIL = ""

# Remote-call codes by outcome.
GRPC_OK = ("OK",)
GRPC_PERMANENT = ("InvalidArgument", "NotFound", "AlreadyExists", "PermissionDenied")
GRPC_TRANSIENT = ("Unavailable", "DeadlineExceeded", "ResourceExhausted", "Aborted")

# How stores report a duplicate key.
DUPLICATE_CODES = (11000, 23505)
DUPLICATE_TEXTS = ("unique constraint", "duplicate key", "23505")

Ranges = str | Sequence[tuple[int, int]]


def parse_ranges(ranges: Ranges) -> list[tuple[int, int]]:
    """`500-599,429` or pairs as inclusive pairs; empty text matches nothing."""
    if not isinstance(ranges, str):
        return [(int(start), int(end)) for start, end in ranges]
    pairs = []
    for part in ranges.split(","):
        part = part.strip()
        if not part:
            continue
        start, dash, end = part.partition("-")
        try:
            pairs.append((int(start), int(end if dash else start)))
        except ValueError:
            raise ValueError(f"not a status range: {part!r}") from None
    return pairs


def in_ranges(code: Column | str, ranges: Ranges) -> Column:
    """Whether a code lies in any of the inclusive ranges."""
    code = as_column(code)
    tests = [code.between(start, end) for start, end in parse_ranges(ranges)]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def is_success(code: Column | str) -> Column:
    return as_column(code).between(200, 299)


def error_type(code: Column | str) -> Column:
    code = as_column(code)
    return (
        F.when(is_success(code), NONE)
        .when(code.between(400, 499), SINK_4XX)
        .when(code.between(500, 599), SINK_5XX)
        .otherwise(SINK_UNKNOWN)
    )


def route(code: Column | str, retried: Column | str, retry: Ranges = DEFAULT_RETRY,
          dlq: Ranges = DEFAULT_DLQ, fail: Ranges = DEFAULT_FAIL) -> Column:
    """The action for a failed message. Code 0 is a transport failure: it is
    retried first, and once retried it is dead-lettered like a 500."""
    code, retried = as_column(code), as_column(retried)
    transport = code == 0
    return (
        F.when(in_ranges(code, fail), FAIL)
        .when(~retried & (transport | in_ranges(code, retry)), RETRY)
        .when(in_ranges(F.when(transport, F.lit(500)).otherwise(code), dlq)
              | in_ranges(code, dlq), DLQ)
        .otherwise(IGNORE)
    )


def backoff_ms(attempt: Column | str, initial: int = 100, maximum: int = 10_000,
               multiplier: float = 2.0) -> Column:
    """Exponential delay before an attempt, capped, in whole milliseconds."""
    step = F.greatest(as_column(attempt), F.lit(1)) - 1
    delay = F.lit(float(initial)) * F.pow(F.lit(float(multiplier)), step)
    return F.least(F.lit(float(maximum)), delay).cast("bigint")


def classify_grpc(code: Column | str) -> Column:
    """Remote-call code name to (success, error_type, status_code)."""
    code = as_column(code)

    def outcome(success: bool, kind: str, status: int) -> Column:
        return F.struct(F.lit(success).alias("success"), F.lit(kind).alias("error_type"),
                        F.lit(status).alias("status_code"))

    return (
        F.when(code.isin(*GRPC_OK), outcome(True, NONE, 200))
        .when(code.isin(*GRPC_PERMANENT), outcome(False, SINK_4XX, 400))
        .when(code.isin(*GRPC_TRANSIENT), outcome(False, SINK_5XX, 503))
        .otherwise(outcome(False, SINK_5XX, 500))
    )


def classify_store_error(code: Column | str, message: Column | str,
                         denied: Sequence[int] = ()) -> Column:
    """Store error to (error_type, status_code, retried).

    A duplicate key or a listed code is permanent: it counts as already retried,
    so routing sends it to the dead letters. Everything else is transient.
    """
    code, message = as_column(code), as_column(message)
    permanent = code.isin(*DUPLICATE_CODES, *denied)
    for part in DUPLICATE_TEXTS:
        permanent = permanent | message.contains(part)
    permanent = F.coalesce(permanent, F.lit(False))

    def outcome(kind: str, status: int, retried: bool) -> Column:
        return F.struct(F.lit(kind).alias("error_type"), F.lit(status).alias("status_code"),
                        F.lit(retried).alias("retried"))

    return F.when(permanent, outcome(SINK_4XX, 409, True)).otherwise(outcome(SINK_5XX, 500, False))
