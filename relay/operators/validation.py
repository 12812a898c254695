"""Rule-based validation that names the first failing rule."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relay.functions import status
from relay.functions.json_values import computed_once
from relay.functions.predicates import truthy
from relay.operators.filtering import check_boolean

log = logging.getLogger(__name__)

INVALID_JSON = "invalid JSON"
Rules = str | Sequence[str | tuple[str, Column]]


def parse_rules(rules: Rules) -> list[tuple[str, Column]]:
    """(text, condition) pairs from `rule; rule` text, texts or ready pairs."""
    if isinstance(rules, str):
        rules = rules.split(";")
    pairs = []
    for rule in rules:
        if isinstance(rule, str):
            text = rule.strip()
            if text:
                pairs.append((text, F.expr(text)))
        else:
            pairs.append(rule)
    if not pairs:
        raise ValueError("no validation rules")
    return pairs


def failure_reason(rules: Sequence[tuple[str, Column]], message: str = "message") -> Column:
    """Text of the first rule that is not true, NULL when all are."""
    reason = F.when(F.col(message).isNull(), INVALID_JSON)
    for text, condition in rules:
        reason = reason.when(~truthy(condition), text)
    return reason


def validate(df: DataFrame, rules: Rules, message: str = "message",
             on_invalid: str = "raise") -> DataFrame:
    """Add `valid` and `reason`. `message` must be NULL for non-objects.

    A rule that cannot be analysed raises, or with `on_invalid="disable"` turns
    validation off: every message is then valid.
    """
    if on_invalid not in ("raise", "disable"):
        raise ValueError(f"on_invalid is raise or disable, not {on_invalid!r}")
    try:
        pairs = parse_rules(rules)
        for _, condition in pairs:
            check_boolean(df, condition)
    except (ValueError, TypeError, PySparkException) as error:
        if on_invalid == "raise":
            raise ValueError(f"invalid validation rules: {error}") from error
        log.warning("validation disabled: %s", error)
        return df.withColumns({"valid": F.lit(True), "reason": F.lit(None).cast("string")})
    checked = computed_once(df, "reason", failure_reason(pairs, message))
    return checked.withColumn("valid", F.col("reason").isNull())


def route_invalid(df: DataFrame, on_failure: str = "dlq") -> tuple[DataFrame, DataFrame]:
    """(valid rows, dead letters) of validated rows.

    With `dlq` invalid rows become failures; with `ignore` or `drop` the second
    half is empty and the rows only count as done.
    """
    if on_failure not in ("dlq", "ignore", "drop"):
        raise ValueError(f"on_failure is dlq, ignore or drop, not {on_failure!r}")
    invalid = df.filter(~F.col("valid") if on_failure == "dlq" else F.lit(False))
    return df.filter("valid"), invalid.withColumns({
        "error_type": F.lit(status.INVALID_MESSAGE),
        "status_code": F.lit(0),
        "error_message": F.col("reason"),
        "retried": F.lit(True),
    })
