"""Path filters: compare the value found at a JSON path with a text."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from relay.functions.json_values import as_column, is_literal, is_string, leaf, typed

_PLAIN_NAME = re.compile(r"[A-Za-z0-9_\- ]+")
_NUMBER = re.compile(r"-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?")
_SMALL_ESCAPE = re.compile(r"\\u00[0-9a-f]{2}")


def path_equals(path: str, value: str | None, message: Column | str = "message",
                raw: Column | str | None = None) -> Column:
    """True when the value at `path` has the text `value`.

    An array passes when any element does; `[*]` looks into every element and
    `..name` into every depth. With `value=None` the path only has to exist.
    `raw` is the unparsed payload, used to skip rows that cannot match `..name`.
    """
    path = path.strip()
    if not path.startswith("$"):
        raise ValueError(f"a path starts with '$': {path!r}")
    if ".." in path:
        return _any_depth(path, value, as_column(message), raw)
    return _at(path, value, as_column(message))


def _at(path: str, value: str | None, message: Column) -> Column:
    head, star, tail = path.partition("[*]")
    if star:
        elements = typed(message, head, "array<variant>")
        return F.exists(elements, lambda x: F.coalesce(_at("$" + tail, value, x), F.lit(False)))
    if value is None:
        return leaf(message, path).isNotNull()
    elements = typed(message, path, "array<variant>")
    return F.coalesce(F.exists(elements, lambda x: F.coalesce(_same(x, value), F.lit(False))),
                      _same(leaf(message, path), value))


def _same(found: Column, value: str) -> Column:
    """Equal as text, or, for numbers, equal however they are written (1e3 and 1000)."""
    same = typed(found, "$", "string") == value
    if not _NUMBER.fullmatch(value):
        return same
    return same | F.coalesce(~is_string(found) & (typed(found, "$", "double") == float(value)), F.lit(False))


def _any_depth(path: str, value: str | None, message: Column, raw: Column | str | None) -> Column:
    """`$..name` as one regular expression over the compact JSON text.

    In compact JSON a quote right after `{` or `,` can only open a key or an
    element, because quotes inside strings are escaped. `[{,]"name":` therefore
    finds the key at every depth, and nothing else.
    """
    head, _, name = path.rpartition("..")
    if ".." in head or not name or re.search(r"[.\[\]*'\"]", name):
        raise ValueError(f"only one trailing '..name' is supported: {path!r}")
    scope = F.to_json(leaf(message, head))
    pattern = r"[{,]" + re.escape(_json_text(name)) + ":"
    if value is not None:
        forms = [re.escape(_json_text(value))]
        if value != "null" and is_literal(value):
            forms.append(re.escape(value))
        pattern += "(?:" + "|".join(forms) + r")(?=[,}])"
    found = scope.rlike(pattern)
    if raw is None or not _PLAIN_NAME.fullmatch(name):
        return found
    # Without an escape sequence the name must stand in the payload as it is.
    text = as_column(raw).cast("string")
    return F.when(text.contains(name) | text.contains("\\u"), found).otherwise(F.lit(False))


def _json_text(value: str) -> str:
    quoted = json.dumps(value, ensure_ascii=False)
    return _SMALL_ESCAPE.sub(lambda m: "\\u" + m.group()[2:].upper(), quoted)


def split_filter_text(text: str) -> tuple[str, str | None]:
    """`$.path:value` split at the first colon, both sides trimmed."""
    path, colon, value = text.partition(":")
    return path.strip(), value.strip() if colon else None
