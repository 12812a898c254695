"""JSON payloads as VARIANT columns."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BARE_KEY = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is evaluated once per row however often it is read.

    A projected column is copied into every filter and expression above it; the
    output of a generator is not. Exploding an array of one element keeps rows
    as they are and stays inside whole-stage codegen; conditions on other
    columns still move below it.
    """
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode_outer(F.array(value)).alias(name))


def parse(value: Column | str = "value") -> Column:
    """The payload as VARIANT; NULL when it is not JSON."""
    return F.try_parse_json(as_column(value).cast("string"))


def parse_object(value: Column | str = "value") -> Column:
    """The payload as VARIANT; NULL when it is not a JSON object.

    The root type of valid JSON follows from its first non-blank character, so
    payloads with another root are not even parsed.
    """
    return F.when(starts_object(value), parse(value))


def starts_object(value: Column | str = "value") -> Column:
    return F.ltrim(as_column(value).cast("string"), F.lit(" \t\r\n")).startswith("{")


def json_path(path: str) -> str:
    """`a.b`, `items[0]` or `$.a.b` as a variant path starting at the root."""
    path = path.strip()
    if path in ("", "$"):
        return "$"
    if path.startswith("$"):
        return path
    return "$" + path if path.startswith("[") else "$." + path


def key_path(name: str) -> str:
    """Path of one top-level key, whatever characters it has."""
    if _BARE_KEY.fullmatch(name):
        return f"$.{name}"
    if '"' in name and "'" in name:
        raise ValueError(f"key with both quote characters: {name!r}")
    return f"$['{name}']" if "'" not in name else f'$["{name}"]'


def is_literal(text: str) -> bool:
    """Whether a text can stand in JSON without quotes."""
    try:
        return not isinstance(json.loads(text), (str, list, dict))
    except ValueError:
        return False


def leaf(message: Column | str, path: str) -> Column:
    """The value at a path as VARIANT: NULL when absent, JSON null when null."""
    message = as_column(message)
    path = json_path(path)
    return message if path == "$" else F.try_variant_get(message, path, "variant")


def typed(message: Column | str, path: str, type_name: str) -> Column:
    return F.try_variant_get(as_column(message), json_path(path), type_name)


def is_string(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def is_boolean(value: Column) -> Column:
    return F.schema_of_variant(value) == "BOOLEAN"


def is_number(value: Column) -> Column:
    """BIGINT, DECIMAL(p,s), DOUBLE and FLOAT, told by their first letters."""
    return F.schema_of_variant(value).substr(1, 3).isin("BIG", "DEC", "DOU", "FLO")


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")
