"""Session settings and staging of intermediate tables."""

from __future__ import annotations

import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The one setting the results depend on: a JSON object with a repeated key keeps
# the last value. Adaptive execution (on by default) is recommended; it is left to the
# owner of the session.
RUNTIME_SETTINGS = {"spark.sql.variant.allowDuplicateKeys": "true"}

# Python workers go through a few MB of text at a time, so larger Arrow batches only take
# memory of every task, in the executor and in its worker. A lower setting stays.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: dict[str, str] = {}
_local_folders: dict[str, str] = {}


def size_of(setting: str) -> int:
    """Bytes of a size as Spark writes it: 4194304b, 512k, 4m, 4mb."""
    number = setting.strip().lower().removesuffix("b")
    return int(number[:-1]) << {"k": 10, "m": 20, "g": 30}[number[-1]] if number[-1] in "kmg" else int(number)


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers of a session, once per application, and
    bound the batches they are sent."""
    context = spark.sparkContext
    if not 0 < size_of(spark.conf.get(BATCH_SETTING)) <= BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    if _shipped.get("app") != context.applicationId:
        package = pathlib.Path(__file__).resolve().parent
        target = tempfile.mkdtemp(prefix="relay-package-")
        context.addPyFile(shutil.make_archive(f"{target}/relay", "zip", package.parent, package.name))
        _shipped["app"] = context.applicationId
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the setting above to a session, ship this package and return the session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return ship(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in `spark.checkpoint.dir`.

    Only a local session without that setting falls back to a new temporary
    folder; on a cluster a machine-local folder would not be readable by others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can read")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="relay-")
    return _local_folders[application]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back.

    Used before a result with side effects or a high cost is read several
    times. The copy survives the loss of executors, and its file sizes let
    Catalyst choose between broadcast and shuffled joins.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/relay-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
