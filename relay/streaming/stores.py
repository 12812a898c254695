"""Tables a delivery writes, one folder per micro-batch.

Writing a micro-batch again replaces its folder, so a replay leaves no
duplicates. A folder is complete once the writer has put its success marker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Stores:
    """Parquet tables under one base folder that all executors can reach."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, table: str, batch: int) -> str:
        return f"{self.base}/{table}/micro_batch={batch}"

    def _file(self, path: str):
        """A path and its file system, wherever the base folder is."""
        context = self.spark.sparkContext
        file = context._jvm.org.apache.hadoop.fs.Path(path)
        return file, file.getFileSystem(context._jsc.hadoopConfiguration())

    def complete(self, table: str, batch: int) -> bool:
        file, system = self._file(f"{self.path(table, batch)}/_SUCCESS")
        return system.exists(file)

    def folders(self, path: str, label: str) -> list[int]:
        """The numbers of the folders `label=<number>` under a path, sorted."""
        file, system = self._file(f"{self.base}/{path}")
        if not system.exists(file):
            return []
        names = [entry.getPath().getName() for entry in system.listStatus(file)]
        return sorted(int(n.removeprefix(f"{label}=")) for n in names if n.startswith(f"{label}="))

    def batches(self, table: str) -> list[int]:
        """The complete micro-batches of a table."""
        return [n for n in self.folders(table, "micro_batch") if self.complete(table, n)]

    def remove(self, path: str) -> None:
        """Remove a folder that nothing reads any more."""
        file, system = self._file(f"{self.base}/{path}")
        system.delete(file, True)

    def drop(self, table: str, batch: int) -> None:
        """Remove a micro-batch of a table that nothing reads any more."""
        self.remove(f"{table}/micro_batch={batch}")

    def write(self, table: str, batch: int, df: DataFrame) -> DataFrame:
        """Replace a micro-batch of a table and read it back."""
        path = self.path(table, batch)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_once(self, table: str, batch: int, df: DataFrame) -> DataFrame:
        """As `write`, but a complete micro-batch is kept: for side effects that
        must not happen again when the micro-batch is replayed."""
        if self.complete(table, batch):
            return self.spark.read.schema(df.schema).parquet(self.path(table, batch))
        return self.write(table, batch, df)

    def read_batch(self, table: str, batch: int) -> DataFrame | None:
        if not self.complete(table, batch):
            return None
        return self.spark.read.parquet(self.path(table, batch))

    def read(self, table: str) -> DataFrame:
        """All micro-batches of a table."""
        return self.spark.read.parquet(f"{self.base}/{table}")
