"""Keyed tables built from messages: inserts, merges and key-value views.

"Last" and "first" follow (partition, offset). Aggregates combine before the
shuffle, so a key with most of the messages costs one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relay.functions import status
from relay.functions.json_values import computed_once, key_path, leaf, parse_object, typed
from relay.operators.positions import SLOT_WIDTH, number_rows
from relay.session import stage
from relay.sources.envelope import POSITION



def split_bad_json(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages with `message`, failures): payloads that are no JSON object."""
    parsed = computed_once(df, "message", parse_object("value"))
    bad = parsed.filter(F.col("message").isNull()).drop("message").withColumns({
        "error_type": F.lit(status.DESERIALIZATION),
        "status_code": F.lit(0),
        "error_message": F.lit("payload is not a JSON object"),
        "retried": F.lit(False),
    })
    return parsed.filter(F.col("message").isNotNull()), bad


def json_to_rows(messages: DataFrame, keep: Sequence[str] = POSITION) -> DataFrame:
    """Top-level keys in long form: one row per message and key, with `name` and `value`
    (the text of the value, NULL for JSON null). For keys that are not known before."""
    fields = typed("message", "$", "map<string,variant>")
    return messages.select(*keep, F.explode(fields).alias("name", "_value")).select(
        *keep, "name", F.col("_value").cast("string").alias("value"))


def _schema(columns: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    types = columns if isinstance(columns, Mapping) else dict.fromkeys(columns, "string")
    return {name: types[name] for name in sorted(types)}


def typed_columns(columns: Sequence[str] | Mapping[str, str]) -> list[Column]:
    """The top-level keys of `message` as columns, sorted by name."""
    return [typed("message", key_path(name), type_name).alias(name) for name, type_name in _schema(columns).items()]


def json_to_columns(messages: DataFrame, columns: Sequence[str] | Mapping[str, str],
                    keep: Sequence[str] = POSITION) -> DataFrame:
    """Top-level keys as table columns, sorted by name.

    `columns` gives names (text columns) or names with types. A table cannot have
    columns that only the data tell: see `json_to_rows` for those.
    """
    return messages.select(*keep, *typed_columns(columns))


def _position() -> Column:
    return F.struct("partition", "offset")


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def keyed_flags(rows: DataFrame, keys: Sequence[str], target: DataFrame | None = None,
                position: Sequence[str] = POSITION) -> DataFrame:
    """Rows with `won`: the first of their key, unless the target has the key.

    Winners are found by a combined aggregate and joined back on the position, which
    is unique, so a hot key does not gather in one task. Rows without a key are
    duplicates of none: they win, as SQL treats NULLs as distinct.
    """
    place = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(position)])
    winners = rows.filter(~_any_null(keys)).groupBy(*keys).agg(F.min(place).alias("_first"))
    if target is not None:
        winners = winners.join(target.select(*keys), list(keys), "left_anti")
    winners = winners.select(*[F.col(f"_first._{i}").alias(c) for i, c in enumerate(position)],
                             F.lit(True).alias("won"))
    return rows.join(winners, list(position), "left").withColumn(
        "won", F.col("won").isNotNull() | _any_null(keys)).select(*rows.columns, "won")


def duplicate_key(rows: DataFrame) -> DataFrame:
    """Rows with the error of a key that is there already."""
    return rows.withColumns({
        "error_type": F.lit(status.SINK_4XX),
        "status_code": F.lit(409),
        "error_message": F.lit("duplicate key"),
        "retried": F.lit(True),
    })


def keyed_insert(rows: DataFrame, keys: Sequence[str],
                 target: DataFrame | None = None, staged: bool = True) -> tuple[DataFrame, DataFrame]:
    """(inserted, duplicates) of rows that carry their envelope position, by
    `keyed_flags`. The flagged rows are written once to the shared folder, so what is
    upstream is not computed for each half."""
    flags = keyed_flags(rows, keys, target)
    if staged:
        flags = stage(flags, "keyed")
    return (flags.filter("won").select(*rows.columns),
            duplicate_key(flags.filter("NOT won").select(*rows.columns)))


def latest_columns(messages: DataFrame, keys: Sequence[str],
                   columns: Sequence[str] | Mapping[str, str], alone: str | None = None) -> DataFrame:
    """Per key and column the last value given: a struct, NULL where no message
    of the key has the column, holding NULL for an explicit JSON null.

    With `alone` messages in which a key is missing or null stay rows of their own,
    told apart by their position in that column; the others have NULL there.
    """
    schema = _schema(columns)
    values = {n: t for n, t in schema.items() if n not in keys}
    flat = messages.select(
        *[typed("message", key_path(k), schema[k]).alias(k) for k in keys],
        _position().alias("_at"), F.concat_ws("/", *[c for c in POSITION if c in messages.columns]).alias("_place"),
        *[F.when(leaf("message", key_path(n)).isNotNull(),
                 F.struct(typed("message", key_path(n), t).alias("value"))).alias(n)
          for n, t in values.items()])
    groups = list(keys)
    if alone:
        flat = flat.withColumn(alone, F.when(_any_null(keys) if keys else F.lit(True), F.col("_place")))
        groups.append(alone)
    newest = [F.max_by(F.col(n), F.when(F.col(n).isNotNull(), F.col("_at"))).alias(n) for n in values]
    return flat.groupBy(*groups).agg(*newest) if newest else flat.select(*groups).distinct()


def keyed_upsert(target: DataFrame | None, messages: DataFrame, keys: Sequence[str] | None,
                 columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """The target after merging messages column by column.

    Only the keys present in a message overwrite; an explicit null does too.
    Without `keys` messages are appended, and so is every message in which a key is
    missing or null: NULL keys are never the same, neither here nor in `keyed_insert`.
    """
    schema = _schema(columns)
    if not keys:
        added = json_to_columns(messages, schema, keep=[])
        return added if target is None else target.select(*schema).unionByName(added)
    latest = latest_columns(messages, keys, schema, alone="_alone").drop("_alone")
    values = [n for n in schema if n not in keys]
    if target is None:
        return latest.select(*keys, *[F.col(n)["value"].alias(n) for n in values])
    old = target.select(*keys, *[F.col(n).alias(f"_old_{n}") for n in values])
    return latest.join(old, list(keys), "full_outer").select(
        *keys,
        *[F.when(F.col(n).isNotNull(), F.col(n)["value"]).otherwise(F.col(f"_old_{n}")).alias(n)
          for n in values])


def materialize_keyvalue(messages: DataFrame, store_key: Column,
                         expires_at: Column | None = None) -> DataFrame:
    """Last whole value written to each store key, with its expiry."""
    expiry = F.lit(None).cast("timestamp") if expires_at is None else expires_at
    entry = F.struct(F.col("value").cast("string").alias("value"), expiry.alias("expires_at"))
    return (messages.select(store_key.alias("store_key"), _position().alias("_at"), entry.alias("e"))
            .groupBy("store_key").agg(F.max_by("e", "_at").alias("e"))
            .select("store_key", "e.value", "e.expires_at"))


def alive(entries: DataFrame, now: Column) -> DataFrame:
    """Entries that have not expired at a moment."""
    return entries.filter(F.col("expires_at").isNull() | (F.col("expires_at") > now))


def materialize_hash(messages: DataFrame, store_key: Column, field: Column) -> DataFrame:
    """Last whole value of each (store key, field)."""
    return (messages.select(store_key.alias("store_key"), field.alias("field"),
                            F.col("value").cast("string").alias("value"), _position().alias("_at"))
            .groupBy("store_key", "field").agg(F.max_by("value", "_at").alias("value")))


def materialize_list(messages: DataFrame, store_key: Column, width: int = SLOT_WIDTH) -> DataFrame:
    """Lists with the newest value first: one row per (store key, index).

    A row per element keeps long lists spread over tasks; index 0 is the newest.
    """
    rows = messages.select(store_key.alias("store_key"), "partition", "offset",
                           F.col("value").cast("string").alias("value"))
    numbered = number_rows(rows, ["store_key"], ["partition", "offset"], "index", width,
                           descending=True)
    return numbered.select("store_key", "index", "value")


def write_table(df: DataFrame, path: str, mode: str = "append",
                partition_by: Sequence[str] = ()) -> None:
    """Write to parquet."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_topic(df: DataFrame, brokers: str, topic: str) -> None:
    """Write (key, value, headers) rows to a topic (needs the Kafka package)."""
    (df.write.format("kafka").option("kafka.bootstrap.servers", brokers)
     .option("includeHeaders", "true").option("topic", topic).save())


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               mode: str = "append") -> None:
    """Write to a database table (needs the driver on the class path)."""
    df.write.jdbc(url, table, mode=mode, properties=dict(properties or {}))
