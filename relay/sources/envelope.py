"""The envelope table and its readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relay.functions.json_values import as_column

ENVELOPE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
])
POSITION = ["topic", "partition", "offset"]


def kafka_options(brokers: str, topic: str, group_id: str | None = None,
                  starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                  extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of Spark's Kafka source for one topic."""
    brokers = ",".join(b.strip() for b in brokers.split(",") if b.strip())
    if not brokers:
        raise ValueError("brokers are required")
    if not topic.strip():
        raise ValueError("a topic is required")
    if starting_offsets not in ("latest", "earliest"):
        raise ValueError(f"starting offsets are latest or earliest, not {starting_offsets!r}")
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic.strip(),
        "startingOffsets": starting_offsets,
        "kafka.max.partition.fetch.bytes": "10000000",
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return {**options, **(extra or {})}


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A topic as a streaming DataFrame of envelopes (needs the Kafka package)."""
    source = spark.readStream.format("kafka").options(**options).load()
    return source.select(*[f.name for f in ENVELOPE])


def read_envelope_files(spark: SparkSession, path: str, streaming: bool = False,
                        max_files: int | None = None,
                        schema: T.StructType = ENVELOPE) -> DataFrame:
    """Parquet files of envelopes, as a batch or as a stream of new files."""
    if not streaming:
        return spark.read.schema(schema).parquet(path)
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


def to_envelope(df: DataFrame, topic: Column | str, partition: Column | str,
                offset: Column | str, key: Column | str, value: Column | str) -> DataFrame:
    """Map any table to envelopes. `topic` given as text is the topic's name."""
    topic = F.lit(topic) if isinstance(topic, str) else topic
    return df.select(
        topic.cast("string").alias("topic"),
        as_column(partition).cast("int").alias("partition"),
        as_column(offset).cast("bigint").alias("offset"),
        as_column(key).cast("string").cast("binary").alias("key"),
        as_column(value).cast("string").cast("binary").alias("value"),
    )
