"""Filters: a condition, a split into two halves, and filters given as text."""

from __future__ import annotations

import logging

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relay.functions.paths import path_equals, split_filter_text
from relay.functions.predicates import truthy

log = logging.getLogger(__name__)


def check_boolean(df: DataFrame, condition: Column) -> None:
    """Raise TypeError unless the condition is boolean for these rows."""
    found = df.select(condition.alias("c")).schema["c"].dataType
    if not isinstance(found, T.BooleanType):
        raise TypeError(f"a filter condition must be boolean, not {found.simpleString()}")


def split(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(passed, dropped); NULL goes to dropped, so the halves make up the input."""
    check_boolean(df, condition)
    passed = truthy(condition)
    return df.filter(passed), df.filter(~passed)


def filter_noop() -> Column:
    return F.lit(True)


def make_filter(spec: Column | str | None, engine: str | None = None,
                message: Column | str = "message", raw: Column | str | None = None,
                df: DataFrame | None = None, on_invalid: str = "raise") -> Column:
    """A filter condition from a Column, a path text or a SQL text.

    Text starting with `$` is `path:value`, other text is a SQL expression over
    `message`. `engine` ("path" or "expression") overrides the choice. Give `df`
    to check an expression now; with `on_invalid="noop"` a bad text passes all.
    """
    if on_invalid not in ("raise", "noop"):
        raise ValueError(f"on_invalid is raise or noop, not {on_invalid!r}")
    if engine not in (None, "path", "expression"):
        raise ValueError(f"unknown filter engine {engine!r}: use path or expression")
    if spec is None:
        return filter_noop()
    if isinstance(spec, Column):
        return spec
    text = spec.strip()
    if not text:
        return filter_noop()
    try:
        if engine == "path" or (engine is None and text.startswith("$")):
            path, value = split_filter_text(text)
            condition = path_equals(path, value, message, raw)
        else:
            condition = F.expr(text)
        if df is not None:
            check_boolean(df, condition)
        return condition
    except (ValueError, TypeError, PySparkException) as error:
        if on_invalid == "raise":
            raise ValueError(f"invalid filter {text!r}: {error}") from error
        log.warning("invalid filter %r, passing every message: %s", text, error)
        return filter_noop()
