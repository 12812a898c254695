"""Per-message results in the response of a batch request."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relay.functions import status
from relay.functions.json_values import (
    computed_once,
    is_boolean,
    is_literal,
    is_object,
    is_string,
    key_path,
    leaf,
    parse_object,
    typed,
)
from relay.operators.delivery import as_failures

NO_RESULT = "the answer has no entry for this message"
UNREADABLE = "batch response cannot be parsed"


@dataclass(frozen=True)
class ResponseFields:
    """Names in a response: the top-level list and the fields of its entries."""

    results: str = "results"
    seq: str = "seq"
    status: str = "status"
    error: str = "error"
    retryable: str = "is_retryable"
    success: str = "success"


@dataclass(frozen=True)
class SingleResult:
    """Whether the response to a batch of one reports success. Used inside
    retries, where the next step depends on the answer."""

    fields: ResponseFields = ResponseFields()

    def __call__(self, code: int, body: str | None) -> bool:
        try:
            entries = json.loads(body or "")[self.fields.results]
            mine = [e for e in entries or [] if str(e.get(self.fields.seq)).strip() == "0"]
            return bool(mine) and mine[-1].get(self.fields.status) == self.fields.success
        except (ValueError, TypeError, KeyError, AttributeError):
            return False


def _index_text(found: Column) -> Column:
    """An index given as an integer or a string, as text; NULL otherwise."""
    return F.when(F.schema_of_variant(found).isin("BIGINT", "STRING"), F.trim(typed(found, "$", "string")))


def _index(text: Column) -> Column:
    """The index in a text, NULL if it is none. The pattern keeps bad text from the
    cast, where every failure costs an exception."""
    return F.when(text.rlike(r"^[+-]?[0-9]{1,18}$"), text.cast("bigint"))


def _equals(found: Column, text: str) -> Column:
    """Whether a value is this string. Only a text that is itself a JSON literal
    can be mistaken for a value of another type, so only then look at the type."""
    same = typed(found, "$", "string") == text
    return F.coalesce(is_string(found) & same if is_literal(text) else same, F.lit(False))


def _text(found: Column) -> Column:
    return F.coalesce(F.when(is_string(found), typed(found, "$", "string")), F.lit(""))


def _flag(found: Column) -> Column:
    """Whether a value is true. A text may be read as true, so look at its type then."""
    return F.coalesce(typed(found, "$", "boolean") & is_boolean(found), F.lit(False))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _slots(responses: DataFrame, fields: ResponseFields, body: str, size: str) -> DataFrame:
    """Add `_slots`, a result for every index from 0 to size - 1, and `parse_error`;
    the body goes.

    All of it happens inside the row. The list is read by one cast to structs, which
    fails as a whole if an entry is no object. Entries are put in order of index and
    place; of an index the last one stays, and the indexes without one fail.
    """
    names = [fields.seq, fields.status, fields.error, fields.retryable]
    kind = ", ".join(f"{_quoted(n)}: variant" for n in dict.fromkeys(names))
    # Every step copies its rows: what is read is dropped at once.
    found = computed_once(responses, "_found", leaf(parse_object(body), key_path(fields.results))).drop(body)
    entries = F.when(F.is_variant_null("_found"), F.lit(None)).otherwise(
        typed("_found", "$", f"array<struct<{kind}>>"))
    every = computed_once(found, "_entries", entries)
    # An entry that is null is skipped, one that is no object makes the list unreadable.
    odd = F.when(F.exists("_entries", lambda e: e.isNull()), F.exists(
        typed("_found", "$", "array<variant>"), lambda v: ~F.coalesce(F.is_variant_null(v) | is_object(v), F.lit(True))))
    unread = F.col("_entries").isNull() & ~F.coalesce(F.is_variant_null("_found"), F.lit(False))
    every = computed_once(every, "parse_error", unread | F.coalesce(odd, F.lit(False)))

    def result(entry: Column, at: Column) -> Column:
        return F.struct(
            _index(_index_text(entry[fields.seq])).alias("seq"), at.alias("at"),
            _equals(entry[fields.status], fields.success).alias("success"),
            _text(entry[fields.error]).alias("error"), _flag(entry[fields.retryable]).alias("is_retryable"))

    read = computed_once(every, "_read", F.when(~F.col("parse_error"), F.transform("_entries", result))).drop(
        "_entries", "_found")
    inside = F.filter("_read", lambda e: (e["seq"] >= 0) & (e["seq"] < F.col(size)))
    ordered = computed_once(read, "_ordered", F.sort_array(F.coalesce(
        inside, F.array().cast(read.schema["_read"].dataType))))
    last = F.filter("_ordered", lambda e, i: F.coalesce(
        F.get("_ordered", i + 1)["seq"] != e["seq"], F.lit(True)))
    kept = computed_once(ordered, "_last", last)
    every_index = F.when(F.col(size) > 0, F.sequence(F.lit(0).cast("bigint"), F.col(size).cast("bigint") - 1)).otherwise(
        F.array().cast("array<bigint>"))
    missing = F.array_except(every_index, F.transform("_last", lambda e: e["seq"]))
    none = F.transform(missing, lambda i: F.struct(
        i.alias("seq"), F.lit(-1).alias("at"), F.lit(False).alias("success"), F.lit(NO_RESULT).alias("error"),
        F.lit(True).alias("is_retryable")))
    # In order of indexes, so that a slot is found by its place.
    return computed_once(kept, "_slots", F.sort_array(F.concat("_last", none))).drop("_read", "_ordered", "_last")


def parse_batch_response(responses: DataFrame, fields: ResponseFields = ResponseFields(),
                         body: str = "response_body", size: str = "size") -> DataFrame:
    """One row per (request_id, seq) with success, error, is_retryable, parse_error.

    Entries whose index is missing, unreadable or out of range are skipped, of
    repeated ones the last wins, and an index without an entry is a retryable
    failure. On a parse error all indexes of the request are retryable failures.
    """
    listed = _slots(responses.select("request_id", body, size), fields, body, size)
    rows = listed.select("request_id", "parse_error", F.explode("_slots").alias("_slot"))
    return rows.select(
        "request_id", F.col("_slot.seq").cast("int").alias("seq"), "_slot.success",
        F.when(F.col("parse_error"), UNREADABLE).otherwise(F.col("_slot.error")).alias("error"),
        "_slot.is_retryable", "parse_error")


def responses_to_failures(results: DataFrame, members: DataFrame) -> DataFrame:
    """Members whose result is no success: 500 if retryable, 422 if not, 0 when
    the response could not be read."""
    failed = results.filter(~F.col("success")).select(
        "request_id", "seq",
        F.when(F.col("parse_error"), 0).when(F.col("is_retryable"), 500).otherwise(422)
        .alias("status_code"),
        F.col("error").alias("error_message"))
    return as_failures(members.join(failed, ["request_id", "seq"]))


def response_failures(outcomes: DataFrame, members: DataFrame,
                      fields: ResponseFields = ResponseFields()) -> DataFrame:
    """All failed messages of with-response delivery, one row each.

    A non-2xx answer fails the whole request with its status; a transport
    failure or an unreadable response fails it with 0, so that it is retried.
    Otherwise every message has its own result. Responses are read once, inside their
    rows, and meet their members once, on request_id.
    """
    ok = status.is_success("status_code")
    # A failed request has no results to read: every index fails with `_whole`.
    readable = outcomes.select("request_id", "size", *[c.alias(n) for n, c in {
        "_body": F.when(ok, F.col("response_body")),
        "_status": F.when(~ok, F.col("status_code")),
        "_whole": F.when(~ok & (F.col("status_code") == 0),
                         F.coalesce("error", F.lit("transport failure")))
        .when(~ok, "the whole batch was refused")}.items()])
    listed = _slots(readable, fields, "_body", "size").filter(
        F.col("parse_error") | F.exists("_slots", lambda e: ~e["success"]))
    # One row per request meets its members; each takes its own slot.
    mine = F.when(F.col("seq") >= 0, F.get("_slots", F.col("seq")))
    joined = computed_once(members.join(listed.select(
        "request_id", "_status", "_whole", "parse_error", "_slots"), "request_id"), "_slot", mine)
    failed = joined.filter(~F.col("_slot.success")).withColumns({
        "status_code": F.coalesce("_status", F.when(F.col("parse_error"), 0).when(
            F.col("_slot.is_retryable"), 500).otherwise(422)),
        "error_message": F.coalesce("_whole", F.when(F.col("parse_error"), UNREADABLE).otherwise(
            F.col("_slot.error")))})
    return as_failures(failed.select(*members.columns, "status_code", "error_message"))
