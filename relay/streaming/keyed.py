"""Keyed tables as the sink of a stream.

A table is kept in buckets of keys. A merge writes only the keys of its micro-batch, as a
delta of the buckets they fall in; a bucket with more than `deltas` of them is folded into
a new snapshot of that bucket alone. What belongs to the table after a micro-batch is told
by its manifest, a list of (bucket, kind, version) with at most buckets * (deltas + 1)
rows, which is written last: a replay of a finished micro-batch changes nothing, one that
broke off begins again, and readers see whole micro-batches only.

    rows/kind=snapshot|delta/version=<micro-batch>/bucket=<n>      manifest/micro_batch=<n>

Rows hold every column as a struct, null where no message gave the column, so that a
message overwrites only what it has and an explicit null is a value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relay.operators import tables
from relay.sources.envelope import POSITION
from relay.streaming.stores import Stores

SNAPSHOT, DELTA = "snapshot", "delta"
MANIFEST = "bucket int, kind string, version long"
LOADED = -1  # the version of rows that were there before the stream


class KeyedTable:
    """A table of `columns` (name to type) by `keys` (some of its columns) under `stores`.

    `buckets` stays as it was when the table began; choose it so that a bucket is about
    as large as a task can fold. Without keys every row is appended. Rows with a NULL key
    are never the same: they are appended, too.
    """

    def __init__(self, stores: Stores, name: str, keys: Sequence[str], columns: Mapping[str, str],
                 buckets: int = 64, deltas: int = 4, keep: int = 2):
        if not set(keys) <= set(columns):
            raise ValueError(f"keys {list(keys)} must be columns")
        if buckets <= 0 or deltas < 0 or keep < 1:
            raise ValueError("a table has buckets, no fewer than 0 deltas and keeps a manifest")
        self.stores, self.name, self.keys = stores, name, list(keys)
        self.columns = {n: columns[n] for n in sorted(columns)}
        self.values = [n for n in self.columns if n not in self.keys]
        self.buckets, self.deltas, self.keep = buckets, deltas, keep

    # --- files -----------------------------------------------------------------------

    @property
    def _rows(self) -> str:
        return f"{self.stores.base}/{self.name}/rows"

    @property
    def _manifests(self) -> str:
        return f"{self.name}/manifest"

    def _schema(self) -> T.StructType:
        fields = [*[f"`{k}` {self.columns[k]}" for k in self.keys], "_row string",
                  *[f"`{n}` struct<value: {self.columns[n]}>" for n in self.values],
                  "kind string", "version long", "bucket int"]
        return T.StructType.fromDDL(", ".join(fields))

    def _bucket(self) -> Column:
        """The bucket of a key; rows that are appended are dealt by their position."""
        return F.pmod(F.xxhash64(*self.keys, "_row"), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, kind: str, version: int) -> list[int]:
        """Write rows and return the buckets that got some, at most `buckets` numbers."""
        path = f"{self._rows}/kind={kind}/version={version}"
        rows = rows.select(*[c for c in self._schema().names if c not in ("kind", "version")])
        # Rebalancing keeps a bucket in few files and still splits one that is large.
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        found = self.stores.spark.read.schema(rows.schema).parquet(path)
        return sorted(r["bucket"] for r in found.select("bucket").distinct().collect())

    def manifest(self, before: int | None = None) -> list[tuple[int, str, int]]:
        """The parts of the newest finished micro-batch, or of the newest before one."""
        done = [v for v in self.stores.batches(self._manifests) if before is None or v < before]
        if not done:
            return []
        return [tuple(r) for r in self.stores.read_batch(self._manifests, max(done)).select(
            "bucket", "kind", "version").collect()]

    def _stored(self, parts: Sequence[tuple[int, str, int]]) -> DataFrame:
        schema = self._schema()
        if not parts:
            return self.stores.spark.createDataFrame([], schema)
        paths = [f"{self._rows}/kind={k}/version={v}/bucket={b}" for b, k, v in parts]
        return self.stores.spark.read.schema(schema).option("basePath", self._rows).parquet(*paths)

    def _folded(self, parts: Sequence[tuple[int, str, int]]) -> DataFrame:
        """One row per key from snapshots and deltas: of each column the newest given."""
        newest = [F.max_by(F.col(n), F.when(F.col(n).isNotNull(), F.col("version"))).alias(n) for n in self.values]
        rows = self._stored(parts).groupBy(*self.keys, "_row", "bucket")
        return rows.agg(*newest) if newest else rows.agg(F.lit(None).alias("_none")).drop("_none")

    def _merge(self, delta: DataFrame, version: int, kind: str = DELTA) -> None:
        parts = self.manifest(before=version)
        parts += [(b, kind, version) for b in self._write(delta.withColumn("bucket", self._bucket()), kind, version)]
        count: dict[int, int] = {}
        for bucket, part, _ in parts:
            count[bucket] = count.get(bucket, 0) + (part == DELTA)
        full = {b for b, n in count.items() if n > self.deltas}
        if full:
            old = [p for p in parts if p[0] in full]
            self._write(self._folded(old), SNAPSHOT, version)
            parts = [p for p in parts if p[0] not in full] + [(b, SNAPSHOT, version) for b in sorted(full)]
        rows = self.stores.spark.createDataFrame(parts, MANIFEST).coalesce(1)
        self.stores.write(self._manifests, version, rows)
        self._clean(version)

    def _clean(self, version: int) -> None:
        """Drop manifests before the last `keep`, and versions that none of those names."""
        batches = sorted(v for v in self.stores.batches(self._manifests) if v <= version)
        old, kept = batches[:-self.keep], batches[-self.keep:]
        if not old:
            return
        named = {(k, v) for b in kept for _, k, v in map(tuple, self.stores.read_batch(self._manifests, b).select(
            "bucket", "kind", "version").collect())}
        for kind in (SNAPSHOT, DELTA):
            for v in self.stores.folders(f"{self.name}/rows/kind={kind}", "version"):
                if v <= version and (kind, v) not in named:
                    self.stores.remove(f"{self.name}/rows/kind={kind}/version={v}")
        for batch in old:
            self.stores.drop(self._manifests, batch)

    # --- use -------------------------------------------------------------------------

    def load(self, target: DataFrame) -> None:
        """Begin with the rows of a table; before the first micro-batch only."""
        if self.manifest():
            raise ValueError(f"table {self.name!r} has rows already")
        alone = F.when(self._keyless(), F.concat(F.lit("loaded/"), F.monotonically_increasing_id().cast("string")))
        rows = target.select(*[F.col(k).cast(self.columns[k]) for k in self.keys], alone.alias("_row"),
                             *[F.struct(F.col(n).cast(self.columns[n]).alias("value")).alias(n) for n in self.values])
        self._merge(rows, LOADED, SNAPSHOT)

    def _keyless(self) -> Column:
        condition = F.lit(not self.keys)
        for k in self.keys:
            condition = condition | F.col(k).isNull()
        return condition

    def finished(self, batch: int) -> bool:
        return self.stores.complete(self._manifests, batch)

    def upsert(self, messages: DataFrame, batch: int) -> None:
        """Merge the columns that messages (with `message` and their position) have."""
        if not self.finished(batch):
            self._merge(tables.latest_columns(messages, self.keys, self.columns, alone="_row"), batch)

    def insert(self, messages: DataFrame, batch: int) -> DataFrame:
        """Add messages with new keys; returns those whose key was there, as failures.

        Only the buckets that the keys fall in are looked up. What was decided is
        stored before the merge, so a replay decides the same; it is kept, and the
        result with it, for `keep` micro-batches.
        """
        label = f"{self.name}/decided"
        if not self.stores.complete(label, batch):
            record = F.struct(*[c for c in messages.columns if c != "message"])
            flat = messages.select(record.alias("_record"), F.struct(*tables.typed_columns(self.columns)).alias("_columns"))
            at, keys = [f"_at_{c}" for c in POSITION], [f"_key_{k}" for k in self.keys]
            flat = flat.select("*", *[F.col("_record")[c].alias(n) for c, n in zip(POSITION, at)],
                               *[F.col("_columns")[k].alias(n) for k, n in zip(self.keys, keys)])
            if keys:
                flags = tables.keyed_flags(flat, keys, self._known(flat, keys, batch), at)
            else:
                flags = flat.withColumn("won", F.lit(True))
            self.stores.write(label, batch, flags.select("_record", "_columns", "won"))
        decided = self.stores.read_batch(label, batch)
        if not self.finished(batch):
            won = decided.filter("won").select("_record", "_columns", *[F.col("_columns")[k].alias(k) for k in self.keys])
            alone = F.when(self._keyless(), F.concat_ws("/", *[F.col("_record")[c] for c in POSITION]))
            self._merge(won.select(*self.keys, alone.alias("_row"), *[
                F.struct(F.col("_columns")[n].alias("value")).alias(n) for n in self.values]), batch)
            self.stores.drop(label, batch - self.keep)
        return tables.duplicate_key(decided.filter("NOT won").select("_record.*"))

    def _known(self, flat: DataFrame, keys: Sequence[str], batch: int) -> DataFrame:
        """Keys of the table, from the buckets that a micro-batch touches."""
        own = flat.select(*[F.col(n).alias(k) for k, n in zip(self.keys, keys)], F.lit(None).cast("string").alias("_row"))
        touched = {r[0] for r in own.select(self._bucket()).distinct().collect()}
        there = self._stored([p for p in self.manifest(before=batch) if p[0] in touched])
        return there.filter("_row IS NULL").select(*[F.col(k).alias(n) for k, n in zip(self.keys, keys)])

    def read(self) -> DataFrame:
        """The table after the newest finished micro-batch."""
        rows = self._folded(self.manifest())
        return rows.select(*[F.col(n) if n in self.keys else F.col(n)["value"].alias(n) for n in self.columns])


@dataclass(frozen=True)
class KeyedSink:
    """Delivery into a keyed table: `insert` refuses keys that are there with 409, which
    goes to the dead letters; `upsert` merges column by column. Both need JSON objects."""

    name: str
    keys: tuple[str, ...]
    columns: Mapping[str, str]
    mode: str = "upsert"
    buckets: int = 64
    deltas: int = 4
    keep: int = 2

    def __post_init__(self) -> None:
        if self.mode not in ("insert", "upsert"):
            raise ValueError(f"mode is insert or upsert, not {self.mode!r}")

    def table(self, stores: Stores) -> KeyedTable:
        return KeyedTable(stores, self.name, self.keys, self.columns, self.buckets, self.deltas, self.keep)

    def push(self, stores: Stores, messages: DataFrame, batch: int) -> DataFrame:
        """Deliver messages with `message`; returns the failed ones with their error."""
        table = self.table(stores)
        if self.mode == "insert":
            return table.insert(messages, batch)
        table.upsert(messages, batch)
        return tables.duplicate_key(messages.drop("message").filter(F.lit(False)))
