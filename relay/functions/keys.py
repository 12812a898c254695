"""Store keys, hash fields and expiry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relay.functions.json_values import as_column, key_path, typed

KEY_PREFIX = "relay"


def field_text(name: str, message: Column | str = "message") -> Column:
    """Text of a top-level field: strings without quotes, others as JSON."""
    return typed(message, key_path(name), "string")


def build_key(template: str | None = None, key_field: str | None = None,
              key: Column | str = "key", offset: Column | str = "offset",
              message: Column | str = "message", prefix: str = KEY_PREFIX) -> Column:
    """Store key of a message.

    With a template every `%s` takes the text of `key_field` ('' when absent);
    without one the message key is used, or `prefix:offset` when it is empty.
    """
    if not template:
        own = F.nullif(as_column(key).cast("string"), F.lit(""))
        return F.coalesce(own, F.concat(F.lit(prefix + ":"), as_column(offset).cast("string")))
    value = F.coalesce(field_text(key_field, message), F.lit("")) if key_field else F.lit("")
    return F.replace(F.lit(template), F.lit("%s"), value)


def hash_field(field: str = "", message: Column | str = "message") -> Column:
    """Field of a hash entry: `data` by default, `$.name` reads the message and
    keeps the literal when the name is absent."""
    if not field.startswith("$."):
        return F.lit(field or "data")
    return F.coalesce(field_text(field[2:], message), F.lit(field))


def ttl_expiry(written_at: Column | str, ttl_type: str = "DISABLE", seconds: int = 0) -> Column:
    """When an entry expires; NULL without a positive time to live."""
    written_at = as_column(written_at)
    if ttl_type in ("", "DISABLE") or seconds <= 0:
        return F.nullif(written_at, written_at)
    return written_at + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))
