"""Poll cycles, delivery batches and request bodies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relay.operators.positions import SLOT_WIDTH, number_rows

PARTITION = ["topic", "partition"]
DEFAULT_POLL = 500
DEFAULT_CHUNK = 10
SEQ_FIELD = "_relay_seq"
MODES = ("batch", "all_or_nothing", "with_response", "individual")


def _quotient(column: str, size: int) -> Column:
    return F.expr(f"`{column}` div {int(size)}L")


def poll_batch(df: DataFrame, max_records: int = DEFAULT_POLL, width: int = SLOT_WIDTH) -> DataFrame:
    """Add `poll_id`: records per partition in cycles of at most `max_records`.

    Table form of a bounded read; a stream bounds its micro-batches with
    `maxOffsetsPerTrigger` or `maxFilesPerTrigger` instead.
    """
    size = max_records if max_records > 0 else 100
    numbered = number_rows(df, PARTITION, ["offset"], "_position", width)
    return numbered.withColumn("poll_id", _quotient("_position", size)).drop("_position")


def chunk(df: DataFrame, size: int = DEFAULT_CHUNK, span: int | None = None,
          width: int = SLOT_WIDTH, keys: Sequence[str] = PARTITION) -> DataFrame:
    """Cut each partition's records into delivery batches of `size`.

    Adds `chunk_no`, `seq` (0-based within the batch), `first_offset` and
    `batch_id` (`topic-partition-firstOffset`, the same after a replay).

    Only a partition's last batch is short; this reads the input twice, to count
    and to number. With `span` every `span` offsets are cut by themselves, which
    needs one pass and one shuffle and leaves one short batch per span.
    `keys` may add columns whose values must not share a batch.
    """
    size = size if size > 0 else DEFAULT_CHUNK
    if span:
        start = F.col("offset") - F.pmod(F.col("offset"), F.lit(span).cast("bigint"))
        inside = Window.partitionBy(*keys, "_span").orderBy("offset")
        numbered = df.withColumn("_span", start).withColumn(
            "_position", F.row_number().over(inside) - 1)
        # Chunk numbers of different spans must not meet: a span has at most
        # `span` records, so its numbers start at its own first offset.
        chunk_no = F.col("_span") + _quotient("_position", size)
        members = Window.partitionBy(*keys, "_span", "chunk_no")
    else:
        numbered = number_rows(df, keys, ["offset"], "_position", width)
        chunk_no = _quotient("_position", size)
        members = Window.partitionBy(*keys, "chunk_no")
    return (
        numbered.withColumns({
            "chunk_no": chunk_no.cast("bigint"),
            "seq": F.pmod(F.col("_position"), F.lit(size)).cast("int"),
        })
        .withColumn("first_offset", F.min("offset").over(members))
        .withColumn("batch_id", F.concat_ws("-", "topic", "partition", "first_offset"))
        .select(*df.columns, "chunk_no", "seq", "first_offset", "batch_id")
    )


def split_max(df: DataFrame, max_size: int = 0) -> DataFrame:
    """Cut batches further into requests of at most `max_size` messages.

    Adds `request_no` and `request_id`, and restarts `seq` in every request;
    0 or less keeps one request per batch.
    """
    if max_size <= 0:
        return df.withColumns({"request_no": F.lit(0).cast("bigint"),
                               "request_id": F.concat(F.col("batch_id"), F.lit("/0"))})
    return (
        df.withColumn("request_no", _quotient("seq", max_size))
        .withColumns({
            "request_id": F.concat_ws("/", "batch_id", "request_no"),
            "seq": F.pmod(F.col("seq"), F.lit(int(max_size))).cast("int"),
        })
    )


def with_seq(value: Column, seq: Column, seq_field: str = SEQ_FIELD) -> Column:
    """A JSON object text with its index added under `seq_field`. Of a key that is given
    several times the last value stays."""
    fields = F.from_json(value.cast("string"), "map<string,variant>")
    names = F.reverse(F.map_keys(fields))
    last = F.size(names)
    others = F.filter(F.map_entries(fields), lambda entry, at: (entry["key"] != seq_field)
                      & (at == last - F.array_position(names, entry["key"])))
    own = F.array(F.struct(F.lit(seq_field).alias("key"), seq.cast("variant").alias("value")))
    return F.to_json(F.map_from_entries(F.concat(others, own)))


def _bodies(members: DataFrame, text: Column) -> DataFrame:
    """One request per (batch, request_no). A group holds at most one batch, so
    the collected list is bounded by the batch size. A value without text would be
    missing in the body, so it is an error."""
    text = F.coalesce(text, F.raise_error(F.lit(
        "a value has no text for a request body: split such messages off first")).cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct("seq", text.alias("text"))))
    joined = F.array_join(F.transform(ordered, lambda x: x["text"]), ",")
    groups = [*PARTITION, "chunk_no", "request_no", "batch_id", "request_id"]
    return (
        members.groupBy(*groups)
        .agg(F.min("offset").alias("first_offset"), F.count("*").cast("int").alias("size"),
             F.concat(F.lit("["), joined, F.lit("]")).alias("body"))
        .drop("chunk_no", "request_no")
    )


def batch_body(members: DataFrame) -> DataFrame:
    """One request per batch: a JSON array of the raw values in order, none of them NULL."""
    return _bodies(members, F.col("value").cast("string"))


def batch_body_with_seq(members: DataFrame, seq_field: str = SEQ_FIELD) -> DataFrame:
    """One request per batch with the index added to every object.

    Values must be JSON objects: split others off first (`split_bad_json`).
    """
    return _bodies(members, with_seq(F.col("value"), F.col("seq"), seq_field))


def individual_requests(members: DataFrame) -> DataFrame:
    """One request per message, its body the raw value. No shuffle."""
    return members.select(
        *PARTITION, "batch_id",
        F.concat_ws("-", "topic", "partition", "offset").alias("request_id"),
        F.col("offset").alias("first_offset"), F.lit(1).alias("size"),
        F.col("value").cast("string").alias("body"),
    )


def build_requests(members: DataFrame, mode: str = "batch", seq_field: str = SEQ_FIELD) -> DataFrame:
    """Requests of batch members (after `split_max`) in one of the modes."""
    if mode not in MODES:
        raise ValueError(f"unknown batch mode {mode!r}: use one of {', '.join(MODES)}")
    if mode == "individual":
        return individual_requests(members)
    return batch_body_with_seq(members, seq_field) if mode == "with_response" else batch_body(members)
