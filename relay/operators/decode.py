"""Decoding of payloads and the split of those that cannot be decoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relay.functions import status
from relay.functions.json_values import as_column, computed_once, parse, parse_object


def decode_json(df: DataFrame, objects_only: bool = False) -> DataFrame:
    """Add `message`, the payload as VARIANT, parsed once. `value` stays as it is.

    With `objects_only` other roots become NULL, which every predicate drops.
    """
    return computed_once(df, "message", parse_object("value") if objects_only else parse("value"))


def apply_decoder(df: DataFrame, decoder: Callable[[Column], Column],
                  output: str = "decoded") -> DataFrame:
    """Run a user decoder: a Column function of `value` (built-in expression or
    Arrow UDF) that yields NULL where it fails."""
    return computed_once(df, output, decoder(F.col("value")))


def split_decode_errors(df: DataFrame, decoded: Column | str = "decoded") -> tuple[DataFrame, DataFrame]:
    """(decoded rows, rejects): rejects carry a deserialization error."""
    decoded = as_column(decoded)
    rejects = df.filter(decoded.isNull()).withColumns({
        "error_type": F.lit(status.DESERIALIZATION),
        "status_code": F.lit(0),
        "error_message": F.lit("payload cannot be decoded"),
        "retried": F.lit(False),
    })
    return df.filter(decoded.isNotNull()), rejects
