"""Predicates over a parsed payload column (`message`, a VARIANT).

Three-valued logic carries the error rules: a missing field or an operation on
the wrong type is NULL, `true OR NULL` is true, `false AND NULL` is false, and
what is still NULL at the end does not pass (`truthy`). Combine predicates with
`&`, `|` and `~`.

Every function takes a path (`status`, `order.status`, `items[0]`) and, as the
last argument, the column to look into; inside `every`, `some` and `keep` pass
the element and the path "".
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from relay.functions.json_values import (
    as_column,
    is_boolean,
    is_number,
    is_object,
    is_string,
    json_path,
    leaf,
    typed,
)

Scalar = str | int | float | bool | None
MESSAGE = "message"
_NESTED = re.compile(r"(\$.+)\.\w+")


# --- equality -------------------------------------------------------------

def _same(found: Column, value: Scalar) -> Column:
    """Type-strict equality of a present value with a literal."""
    if value is None:
        return F.is_variant_null(found)
    if isinstance(value, bool):
        same = is_boolean(found) & (typed(found, "$", "boolean") == F.lit(value))
    elif isinstance(value, (int, float)):
        same = is_number(found) & (typed(found, "$", "double") == F.lit(float(value)))
    else:
        same = is_string(found) & (typed(found, "$", "string") == F.lit(value))
    return F.coalesce(same, F.lit(False))


def eq(path: str, value: Scalar, message: Column | str = MESSAGE) -> Column:
    """Equal to a string, number, boolean or null of the same JSON type."""
    found = leaf(message, path)
    return F.when(found.isNotNull(), _same(found, value))


def ne(path: str, value: Scalar, message: Column | str = MESSAGE) -> Column:
    """Not equal: true for null or another type, NULL for a missing field."""
    return ~eq(path, value, message)


def one_of(path: str, values: Iterable[Scalar], message: Column | str = MESSAGE) -> Column:
    """Membership in a list of literals, type-strict."""
    values = list(values)
    found = leaf(message, path)
    hits = []
    strings = [v for v in values if isinstance(v, str)]
    numbers = [float(v) for v in values if isinstance(v, (int, float)) and not isinstance(v, bool)]
    if strings:
        hits.append(is_string(found) & typed(found, "$", "string").isin(strings))
    if numbers:
        hits.append(is_number(found) & typed(found, "$", "double").isin(numbers))
    hits += [_same(found, v) for v in values if v is None or isinstance(v, bool)]
    member = F.lit(False)
    for hit in hits:
        member = member | F.coalesce(hit, F.lit(False))
    return F.when(found.isNotNull(), member)


# --- order ----------------------------------------------------------------

def _ordered(path: str, value: str | int | float, message: Column | str,
             compare: Callable[[Column, Column], Column]) -> Column:
    found = leaf(message, path)
    if isinstance(value, str):
        return F.when(is_string(found), compare(typed(found, "$", "string"), F.lit(value)))
    if isinstance(value, bool):
        return F.when(is_boolean(found), compare(typed(found, "$", "boolean"), F.lit(value)))
    return F.when(is_number(found), compare(typed(found, "$", "double"), F.lit(float(value))))


def lt(path: str, value: str | int | float, message: Column | str = MESSAGE) -> Column:
    return _ordered(path, value, message, lambda a, b: a < b)


def le(path: str, value: str | int | float, message: Column | str = MESSAGE) -> Column:
    return _ordered(path, value, message, lambda a, b: a <= b)


def gt(path: str, value: str | int | float, message: Column | str = MESSAGE) -> Column:
    return _ordered(path, value, message, lambda a, b: a > b)


def ge(path: str, value: str | int | float, message: Column | str = MESSAGE) -> Column:
    return _ordered(path, value, message, lambda a, b: a >= b)


# --- presence and text ----------------------------------------------------

def has(path: str, message: Column | str = MESSAGE) -> Column:
    """Key present (JSON null counts). NULL when its parent is not an object."""
    message = as_column(message)
    full = json_path(path)
    present = leaf(message, full).isNotNull()
    nested = _NESTED.fullmatch(full)
    if not nested:
        return F.when(message.isNotNull(), present)
    return F.when(is_object(leaf(message, nested[1])), present)


def text(path: str, message: Column | str = MESSAGE) -> Column:
    """The value of a JSON string; NULL for anything else."""
    found = leaf(message, path)
    return F.when(is_string(found), typed(found, "$", "string"))


def number(path: str, message: Column | str = MESSAGE) -> Column:
    """The value of a JSON number as double; NULL for anything else."""
    found = leaf(message, path)
    return F.when(is_number(found), typed(found, "$", "double"))


def boolean(path: str, message: Column | str = MESSAGE) -> Column:
    """The value of a JSON boolean; NULL for anything else."""
    found = leaf(message, path)
    return F.when(is_boolean(found), typed(found, "$", "boolean"))


def starts_with(path: str, prefix: str, message: Column | str = MESSAGE) -> Column:
    return text(path, message).startswith(prefix)


def ends_with(path: str, suffix: str, message: Column | str = MESSAGE) -> Column:
    return text(path, message).endswith(suffix)


def contains(path: str, part: str, message: Column | str = MESSAGE) -> Column:
    return text(path, message).contains(part)


def matches(path: str, pattern: str, message: Column | str = MESSAGE) -> Column:
    """Unanchored regular expression match."""
    return text(path, message).rlike(pattern)


# --- collections ----------------------------------------------------------

def items(path: str, message: Column | str = MESSAGE) -> Column:
    """Elements of a JSON array, or the keys of an object, as array<variant>."""
    keys = F.map_keys(typed(message, path, "map<string,variant>"))
    return F.coalesce(
        typed(message, path, "array<variant>"),
        F.transform(keys, lambda k: k.cast("variant")),
    )


def size_of(path: str, message: Column | str = MESSAGE) -> Column:
    """Elements of an array, characters of a string or entries of an object."""
    return F.coalesce(
        F.array_size(typed(message, path, "array<variant>")),
        F.char_length(text(path, message)),
        F.array_size(F.map_keys(typed(message, path, "map<string,variant>"))),
    )


def every(path: str, test: Callable[[Column], Column], message: Column | str = MESSAGE) -> Column:
    return F.forall(items(path, message), test)


def some(path: str, test: Callable[[Column], Column], message: Column | str = MESSAGE) -> Column:
    return F.exists(items(path, message), test)


def keep(path: str, test: Callable[[Column], Column], message: Column | str = MESSAGE) -> Column:
    """Elements that pass; NULL when the test fails to evaluate on one."""
    found = items(path, message)
    return F.when(~F.exists(found, lambda x: test(x).isNull()), F.filter(found, test))


# --- arithmetic and result ------------------------------------------------

def divide(left: Any, right: Any) -> Column:
    """Division that yields NULL for a zero divisor instead of failing the job."""
    return F.try_divide(_operand(left), _operand(right))


def modulo(left: Any, right: Any) -> Column:
    return F.try_mod(_operand(left), _operand(right))


def _operand(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def truthy(condition: Column) -> Column:
    """True only for true: NULL (missing, mistyped, bad payload) does not pass."""
    return F.coalesce(condition, F.lit(False))
