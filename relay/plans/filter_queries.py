"""Sources, decoding, filters, predicates and validation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from relay.functions import predicates as p
from relay.functions.paths import path_equals
from relay.operators import batching, decode, filtering, positions, validation
from relay.plans import topics
from relay.plans.registry import query
from relay.plans.topics_sql import DOCUMENTS, EVENTS, ORDERS, PARSED, sql
from relay.session import shared_dir
from relay.sources.envelope import read_envelope_files, to_envelope
from relay.sources.protobuf import decode_protobuf

POS = ["topic", "partition", "offset"]
POS_SQL = 'topic, "partition", "offset"'


def _text(df):
    """Envelope with readable key and value."""
    return df.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


# --- sources ----------------------------------------------------------------

ALL_MESSAGES = sql([EVENTS], f"SELECT {POS_SQL}, key, value FROM messages")


@query("to_envelope", ALL_MESSAGES)
def to_envelope_(spark, sf):
    return _text(topics.event_messages(spark, sf))


@query("to_envelope_dense_offsets", """
SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
       row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset",
       CAST(user_id AS VARCHAR) AS key, props AS value FROM events""")
def to_envelope_dense_offsets(spark, sf):
    events = topics.table(spark, sf, "events").withColumn("part", F.expr("user_id % 4"))
    numbered = positions.number_rows(events, ["part"], ["event_id"], "position")
    return _text(to_envelope(numbered, "events", "part", "position", "user_id", "props"))


@query("read_envelope_files", ALL_MESSAGES)
def read_envelope_files_(spark, sf):
    messages = topics.event_messages(spark, sf)
    path = f"{shared_dir(spark)}/relay-topic-{uuid.uuid4().hex}"
    messages.write.parquet(path)
    return _text(read_envelope_files(spark, path))


@query("poll_batch", sql([EVENTS], f"""
SELECT {POS_SQL}, CAST((row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1) // 500
       AS BIGINT) AS poll_id FROM messages"""))
def poll_batch(spark, sf):
    return batching.poll_batch(topics.event_messages(spark, sf), 500).select(*POS, "poll_id")


# --- decoding -----------------------------------------------------------------

@query("decode_json", sql([EVENTS, PARSED], f"""
SELECT {POS_SQL}, value, j IS NOT NULL AS is_json, o IS NOT NULL AS is_object FROM objects"""))
def decode_json(spark, sf):
    both = decode.decode_json(topics.event_messages(spark, sf)).withColumn(
        "object", decode.parse_object("value"))
    return both.select(*POS, F.col("value").cast("string").alias("value"),
                       F.col("message").isNotNull().alias("is_json"),
                       F.col("object").isNotNull().alias("is_object"))


@query("decode_protobuf_raw", sql([EVENTS], f"SELECT {POS_SQL}, value AS decoded FROM messages"))
def decode_protobuf_raw(spark, sf):
    decoded = decode_protobuf(topics.event_messages(spark, sf), mode="raw")
    return decoded.select(*POS, F.col("decoded").cast("string").alias("decoded"))


def event_descriptor() -> bytes:
    """Descriptor set of relay.test.Event {string name = 1; uint32 id = 2;}."""
    from google.protobuf import descriptor_pb2

    field = descriptor_pb2.FieldDescriptorProto
    files = descriptor_pb2.FileDescriptorSet()
    file = files.file.add(name="event.proto", package="relay.test", syntax="proto3")
    message = file.message_type.add(name="Event")
    message.field.add(name="name", number=1, type=field.TYPE_STRING, label=field.LABEL_OPTIONAL)
    message.field.add(name="id", number=2, type=field.TYPE_UINT32, label=field.LABEL_OPTIONAL)
    return files.SerializeToString()


# Wire form of (event_type, event_id): tag 0a, length, text, tag 10, base-128
# number of five bytes, enough for 32 bits. Every twentieth record is cut short.
PROTO_VALUE = """
CASE WHEN event_id % 20 = 0 THEN unhex('0a7f41')
ELSE unhex(concat('0a', lpad(hex(length(event_type)), 2, '0'), hex(event_type), '10',
     hex(event_id % 128 + 128), hex(shiftright(event_id, 7) % 128 + 128),
     hex(shiftright(event_id, 14) % 128 + 128), hex(shiftright(event_id, 21) % 128 + 128),
     lpad(hex(shiftright(event_id, 28)), 2, '0'))) END"""


@query("decode_protobuf", """
SELECT event_id, CASE WHEN event_id % 20 <> 0 THEN event_type END AS name,
       CASE WHEN event_id % 20 <> 0 THEN event_id END AS id FROM events""")
def decode_protobuf_(spark, sf):
    events = topics.table(spark, sf, "events").select("event_id", F.expr(PROTO_VALUE).alias("value"))
    decoded = decode_protobuf(events, event_descriptor(), "relay.test.Event")
    fields = F.from_json("decoded", "name string, id bigint")
    return decoded.select("event_id", fields["name"].alias("name"), fields["id"].alias("id"))


@query("split_decode_errors", sql([EVENTS, PARSED], f"""
SELECT {POS_SQL}, 'decoded' AS half, NULL::VARCHAR AS error_type FROM parsed WHERE j IS NOT NULL
UNION ALL
SELECT {POS_SQL}, 'reject', 'DESERIALIZATION_ERROR' FROM parsed WHERE j IS NULL"""))
def split_decode_errors(spark, sf):
    messages = decode.decode_json(topics.event_messages(spark, sf))
    good, rejects = decode.split_decode_errors(messages, "message")
    return good.select(*POS, F.lit("decoded").alias("half"),
                       F.lit(None).cast("string").alias("error_type")).unionByName(
        rejects.select(*POS, F.lit("reject").alias("half"), "error_type"))


# --- filters ------------------------------------------------------------------

def _halves(df, condition):
    passed, dropped = filtering.split(df, condition)
    return passed.select(*POS, F.lit("passed").alias("half")).unionByName(
        dropped.select(*POS, F.lit("dropped").alias("half")))


def _flag(parts, condition, source="objects"):
    return sql(parts, f"SELECT {POS_SQL}, coalesce({condition}, FALSE) AS passed FROM {source}")


def _passed(df, condition):
    filtering.check_boolean(df, condition)
    return df.select(*POS, p.truthy(condition).alias("passed"))


@query("filter_split", sql([EVENTS, PARSED], f"""
SELECT {POS_SQL}, CASE WHEN json_type(o, '$.status') = 'VARCHAR' AND o->>'$.status' = 'click'
       THEN 'passed' ELSE 'dropped' END AS half FROM objects"""))
def filter_split(spark, sf):
    return _halves(topics.objects(topics.event_messages(spark, sf)), p.eq("status", "click"))


@query("filter_noop", sql([EVENTS], f"SELECT {POS_SQL}, 'passed' AS half FROM messages"))
def filter_noop(spark, sf):
    return _halves(topics.event_messages(spark, sf), filtering.filter_noop())


@query("make_filter_path", _flag([EVENTS, PARSED], "o->>'$.status' = 'purchase'"))
def make_filter_path(spark, sf):
    messages = decode.decode_json(topics.event_messages(spark, sf))
    return _passed(messages, filtering.make_filter(" $.status : purchase ", df=messages))


@query("make_filter_expression", _flag(
    [EVENTS, PARSED], "o->>'$.status' = 'view' AND CAST(o->>'$.value' AS DOUBLE) > 20"))
def make_filter_expression(spark, sf):
    messages = topics.objects(topics.event_messages(spark, sf))
    return _passed(messages, filtering.make_filter(
        "try_variant_get(message, '$.status', 'string') = 'view' "
        "AND try_variant_get(message, '$.value', 'double') > 20", df=messages))


@query("filter_path_equals", _flag([ORDERS, PARSED], "o->>'$.order.status' = 'F'"))
def filter_path_equals(spark, sf):
    return _passed(decode.decode_json(topics.order_messages(spark, sf)),
                   path_equals("$.order.status", "F"))


@query("filter_path_number", _flag([EVENTS, PARSED], "o->>'$.status' = '5'"))
def filter_path_number(spark, sf):
    return _passed(decode.decode_json(topics.event_messages(spark, sf)), path_equals("$.status", "5"))


@query("filter_path_exists", _flag([EVENTS, PARSED], "json_exists(o, '$.status')"))
def filter_path_exists(spark, sf):
    return _passed(decode.decode_json(topics.event_messages(spark, sf)), path_equals("$.status", None))


@query("filter_array_any", _flag(
    [ORDERS, PARSED], "list_contains(CAST(json_extract(o, '$.tags') AS VARCHAR[]), '2-HIGH')"))
def filter_array_any(spark, sf):
    return _passed(decode.decode_json(topics.order_messages(spark, sf)),
                   path_equals("$.tags", "2-HIGH"))


@query("filter_array_index", _flag([ORDERS, PARSED], "o->>'$.tags[1]' = '1-URGENT'"))
def filter_array_index(spark, sf):
    return _passed(decode.decode_json(topics.order_messages(spark, sf)),
                   path_equals("$.tags[1]", "1-URGENT"))


@query("filter_array_wildcard", _flag(
    [ORDERS, PARSED], "o->>'$.lines[0].qty' = '4' OR o->>'$.lines[1].qty' = '4'"))
def filter_array_wildcard(spark, sf):
    return _passed(decode.decode_json(topics.order_messages(spark, sf)),
                   path_equals("$.lines[*].qty", "4"))


@query("filter_any_depth", _flag(
    [ORDERS, PARSED], "list_contains(CAST(json_extract(o, '$..status') AS VARCHAR[]), '\"P\"')"))
def filter_any_depth(spark, sf):
    return _passed(decode.decode_json(topics.order_messages(spark, sf)),
                   path_equals("$..status", "P", raw="value"))


@query("filter_any_depth_number", _flag(
    [EVENTS, PARSED], "list_contains(CAST(json_extract(o, '$..k') AS VARCHAR[]), '7')"))
def filter_any_depth_number(spark, sf):
    return _passed(decode.decode_json(topics.event_messages(spark, sf)),
                   path_equals("$..k", "7", raw="value"))


@query("filter_bad_payload", sql([EVENTS, PARSED], f"""
SELECT {POS_SQL}, coalesce(json_exists(j, '$[0]'), FALSE) AS path_passed,
       coalesce(json_exists(o, '$.value'), FALSE) AS expression_passed FROM objects"""))
def filter_bad_payload(spark, sf):
    messages = decode.decode_json(topics.event_messages(spark, sf))
    both = messages.withColumn("object", decode.parse_object("value"))
    return both.select(*POS, p.truthy(path_equals("$[0]", None)).alias("path_passed"),
                       p.truthy(p.has("value", "object")).alias("expression_passed"))


# --- predicates ---------------------------------------------------------------

def _flags(df, **conditions):
    """NULL conditions stay NULL: the three-valued result is compared too."""
    return df.select(*POS, *[c.alias(name) for name, c in conditions.items()])


def _flags_sql(parts, **conditions):
    columns = ", ".join(f"{text} AS {name}" for name, text in conditions.items())
    return sql(parts, f"SELECT {POS_SQL}, {columns} FROM objects")


def _strict(root, path, kinds, test):
    """SQL of a type-strict test: NULL when missing, false for other types."""
    return (f"CASE WHEN json_type({root}, '{path}') IS NULL THEN NULL "
            f"ELSE json_type({root}, '{path}') IN {kinds} AND {test} END")


def _guard(root, path, kinds, test):
    """SQL of a test that is NULL for missing values and other types."""
    return f"CASE WHEN json_type({root}, '{path}') IN {kinds} THEN {test} END"


TEXT = "('VARCHAR')"
NUMBER = "('UBIGINT', 'BIGINT', 'DOUBLE')"
STATUS_IS = "o->>'$.status' = "
AMOUNT = "CAST(o->>'$.order.payment.amount' AS DOUBLE)"


@query("predicate_eq", _flags_sql(
    [EVENTS, PARSED],
    eq_text=_strict("o", "$.status", TEXT, STATUS_IS + "'click'"),
    eq_number=_strict("o", "$.status", NUMBER, "try_cast(o->>'$.status' AS DOUBLE) = 5"),
    eq_null=_strict("o", "$.status", "('NULL')", "TRUE"),
    eq_flag=_strict("o", "$.status", "('BOOLEAN')", "TRUE")))
def predicate_eq(spark, sf):
    return _flags(topics.objects(topics.event_messages(spark, sf)),
                  eq_text=p.eq("status", "click"), eq_number=p.eq("status", 5),
                  eq_null=p.eq("status", None), eq_flag=p.eq("status", True))


@query("predicate_eq_boolean", _flags_sql(
    [ORDERS, PARSED],
    urgent=_strict("o", "$.order.urgent", "('BOOLEAN')", "o->>'$.order.urgent' = 'true'"),
    text_is_no_flag=_strict("o", "$.order.status", "('BOOLEAN')", "FALSE")))
def predicate_eq_boolean(spark, sf):
    return _flags(topics.objects(topics.order_messages(spark, sf)),
                  urgent=p.eq("order.urgent", True), text_is_no_flag=p.eq("order.status", True))


@query("predicate_ne", _flags_sql(
    [EVENTS, PARSED],
    ne_text="NOT " + _strict("o", "$.status", TEXT, STATUS_IS + "'click'"),
    ne_number="NOT " + _strict("o", "$.status", NUMBER, "try_cast(o->>'$.status' AS DOUBLE) = 5")))
def predicate_ne(spark, sf):
    return _flags(topics.objects(topics.event_messages(spark, sf)),
                  ne_text=p.ne("status", "click"), ne_number=p.ne("status", 5))


@query("predicate_order", _flags_sql(
    [EVENTS, PARSED],
    lt=_guard("o", "$.value", NUMBER, "CAST(o->>'$.value' AS DOUBLE) < 20"),
    le=_guard("o", "$.value", NUMBER, "CAST(o->>'$.value' AS DOUBLE) <= 6.55"),
    gt=_guard("o", "$.value", NUMBER, "CAST(o->>'$.value' AS DOUBLE) > 20"),
    ge=_guard("o", "$.value", NUMBER, "CAST(o->>'$.value' AS DOUBLE) >= 6.55"),
    text_lt=_guard("o", "$.status", TEXT, "o->>'$.status' < 'purchase'"),
    text_ge=_guard("o", "$.status", TEXT, "o->>'$.status' >= 'purchase'"),
    number_of_text=_guard("o", "$.status", NUMBER, "try_cast(o->>'$.status' AS DOUBLE) > 1")))
def predicate_order(spark, sf):
    return _flags(topics.objects(topics.event_messages(spark, sf)),
                  lt=p.lt("value", 20), le=p.le("value", 6.55), gt=p.gt("value", 20),
                  ge=p.ge("value", 6.55), text_lt=p.lt("status", "purchase"),
                  text_ge=p.ge("status", "purchase"), number_of_text=p.gt("status", 1))


CLICK = _strict("o", "$.status", TEXT, STATUS_IS + "'click'")
ERROR = _strict("o", "$.status", TEXT, STATUS_IS + "'error'")
LARGE = _guard("o", "$.value", NUMBER, "CAST(o->>'$.value' AS DOUBLE) > 20")


@query("predicate_and", _flag([EVENTS, PARSED], f"({CLICK}) AND ({LARGE})"))
def predicate_and(spark, sf):
    return _passed(topics.objects(topics.event_messages(spark, sf)),
                   p.eq("status", "click") & p.gt("value", 20))


@query("predicate_or", _flag([EVENTS, PARSED], f"({CLICK}) OR ({ERROR}) OR ({LARGE})"))
def predicate_or(spark, sf):
    return _passed(topics.objects(topics.event_messages(spark, sf)),
                   p.eq("status", "click") | p.eq("status", "error") | p.gt("value", 20))


@query("predicate_not", _flag([EVENTS, PARSED], f"NOT (({CLICK}) OR ({LARGE}))"))
def predicate_not(spark, sf):
    return _passed(topics.objects(topics.event_messages(spark, sf)),
                   ~(p.eq("status", "click") | p.gt("value", 20)))


@query("predicate_in", _flags_sql(
    [EVENTS, PARSED],
    texts=_strict("o", "$.status", TEXT, "o->>'$.status' IN ('click', 'view')"),
    mixed="CASE WHEN json_type(o, '$.status') IS NULL THEN NULL "
          "WHEN json_type(o, '$.status') = 'VARCHAR' THEN o->>'$.status' = 'click' "
          f"WHEN json_type(o, '$.status') IN {NUMBER} THEN CAST(o->>'$.status' AS DOUBLE) IN (5, 7) "
          "ELSE FALSE END"))
def predicate_in(spark, sf):
    return _flags(topics.objects(topics.event_messages(spark, sf)),
                  texts=p.one_of("status", ["click", "view"]),
                  mixed=p.one_of("status", ["click", 5, 7]))


@query("predicate_has", _flags_sql(
    [EVENTS, PARSED],
    status="CASE WHEN o IS NULL THEN NULL ELSE json_exists(o, '$.status') END",
    nested="CASE WHEN json_type(o, '$.props') = 'OBJECT' THEN json_exists(o, '$.props.k') END"))
def predicate_has(spark, sf):
    return _flags(topics.objects(topics.event_messages(spark, sf)),
                  status=p.has("status"), nested=p.has("props.k"))


def _documents(spark, sf):
    return topics.objects(topics.document_messages(spark, sf))


def _document_sql(**conditions):
    columns = ", ".join(f"{text} AS {name}" for name, text in conditions.items())
    return sql([DOCUMENTS], f"SELECT {POS_SQL}, {columns} FROM messages")


@query("predicate_starts_with", _document_sql(
    the="starts_with(text, 'The ')", en="starts_with(lang, 'en')"))
def predicate_starts_with(spark, sf):
    return _flags(_documents(spark, sf), the=p.starts_with("text", "The "),
                  en=p.starts_with("lang", "en"))


@query("predicate_ends_with", _document_sql(dot="ends_with(text, '.')", n="ends_with(lang, 'n')"))
def predicate_ends_with(spark, sf):
    return _flags(_documents(spark, sf), dot=p.ends_with("text", "."), n=p.ends_with("lang", "n"))


@query("predicate_contains", _document_sql(
    word="contains(text, 'the')", line_break="contains(text, chr(10))"))
def predicate_contains(spark, sf):
    return _flags(_documents(spark, sf), word=p.contains("text", "the"),
                  line_break=p.contains("text", "\n"))


@query("predicate_matches", _document_sql(
    digits="regexp_matches(text, '[0-9]{3,}')", mail="regexp_matches(text, '[a-z]+@[a-z]+')"))
def predicate_matches(spark, sf):
    return _flags(_documents(spark, sf), digits=p.matches("text", "[0-9]{3,}"),
                  mail=p.matches("text", "[a-z]+@[a-z]+"))


@query("predicate_size", _flags_sql(
    [ORDERS, PARSED], tags="CAST(json_array_length(o, '$.tags') AS INTEGER)",
    text="CAST(length(o->>'$.order.status') AS INTEGER)",
    entries="CAST(len(json_keys(o, '$.order')) AS INTEGER)",
    some="json_array_length(o, '$.tags') > 0"))
def predicate_size(spark, sf):
    return _flags(topics.objects(topics.order_messages(spark, sf)), tags=p.size_of("tags"),
                  text=p.size_of("order.status"), entries=p.size_of("order"),
                  some=p.size_of("tags") > 0)


@query("predicate_size_of_text", _document_sql(characters="CAST(length(text) AS INTEGER)"))
def predicate_size_of_text(spark, sf):
    return _flags(_documents(spark, sf), characters=p.size_of("text"))


@query("predicate_nested", _flags_sql(
    [ORDERS, PARSED],
    nested=f"o->>'$.order.status' = 'F' AND {AMOUNT} > 100000",
    indexed="CASE WHEN json_exists(o, '$.tags[0]') THEN o->>'$.tags[0]' = 'O' END",
    deep="CAST(o->>'$.lines[1].qty' AS DOUBLE) >= 3"))
def predicate_nested(spark, sf):
    return _flags(topics.objects(topics.order_messages(spark, sf)),
                  nested=p.eq("order.status", "F") & p.gt("order.payment.amount", 100000),
                  indexed=p.eq("tags[0]", "O"), deep=p.ge("lines[1].qty", 3))


@query("predicate_arithmetic", _flags_sql(
    [ORDERS, PARSED], plus=f"{AMOUNT} + 10 > 250000", minus=f"{AMOUNT} - 10 > 250000",
    times=f"{AMOUNT} * 2 > 250000",
    over=f"CASE WHEN CAST(o->>'$.lines[0].qty' AS DOUBLE) <> 0 THEN "
         f"{AMOUNT} / CAST(o->>'$.lines[0].qty' AS DOUBLE) > 50000 END",
    rest="CAST(o->>'$.order.id' AS BIGINT) % 4 = 1"))
def predicate_arithmetic(spark, sf):
    amount = p.number("order.payment.amount")
    return _flags(topics.objects(topics.order_messages(spark, sf)),
                  plus=amount + 10 > 250000, minus=amount - 10 > 250000, times=amount * 2 > 250000,
                  over=p.divide(amount, p.number("lines[0].qty")) > 50000,
                  rest=p.modulo(p.number("order.id"), 4) == 1)


QTYS = "[CAST(o->>'$.lines[0].qty' AS DOUBLE), CAST(o->>'$.lines[1].qty' AS DOUBLE)]"


@query("predicate_macros", _flags_sql(
    [ORDERS, PARSED], every=f"len(list_filter({QTYS}, lambda x: x > 2)) = 2",
    some=f"len(list_filter({QTYS}, lambda x: x > 2)) > 0",
    kept=f"CAST(len(list_filter({QTYS}, lambda x: x > 2)) AS INTEGER)",
    any_key="json_exists(o, '$.order.urgent')"))
def predicate_macros(spark, sf):
    def large(line):
        return p.gt("qty", 2, line)

    return _flags(topics.objects(topics.order_messages(spark, sf)), every=p.every("lines", large),
                  some=p.some("lines", large), kept=F.array_size(p.keep("lines", large)),
                  any_key=p.some("order", lambda key: p.eq("", "urgent", key)))


@query("predicate_truthy", _flag([EVENTS, PARSED], f"({CLICK}) OR ({LARGE})"))
def predicate_truthy(spark, sf):
    return _passed(topics.objects(topics.event_messages(spark, sf)),
                   p.eq("status", "click") | p.gt("value", 20))


# --- validation -----------------------------------------------------------------

def event_rules():
    return [
        ("has status", p.has("status")),
        ("status is text", p.text("status").isNotNull()),
        ("value > 10", p.gt("value", 10)),
        ("known user", p.lt("user_id", 100)),
    ]


REASON = """CASE WHEN o IS NULL THEN 'invalid JSON'
  WHEN NOT json_exists(o, '$.status') THEN 'has status'
  WHEN json_type(o, '$.status') <> 'VARCHAR' THEN 'status is text'
  WHEN NOT coalesce(CAST(o->>'$.value' AS DOUBLE) > 10, FALSE) THEN 'value > 10'
  WHEN NOT coalesce(CAST(o->>'$.user_id' AS DOUBLE) < 100, FALSE) THEN 'known user' END"""


def _validated(spark, sf):
    return validation.validate(topics.objects(topics.event_messages(spark, sf)), event_rules())


@query("validate", sql([EVENTS, PARSED], f"""
SELECT {POS_SQL}, reason IS NULL AS valid, reason FROM (SELECT *, {REASON} AS reason FROM objects)"""))
def validate(spark, sf):
    return _validated(spark, sf).select(*POS, "valid", "reason")


@query("validate_text_rules", sql([EVENTS, PARSED], f"""
SELECT {POS_SQL}, reason IS NULL AS valid, reason FROM (
  SELECT *, CASE WHEN o IS NULL THEN 'invalid JSON'
    WHEN NOT coalesce(CAST(o->>'$.value' AS DOUBLE) > 10, FALSE)
      THEN 'try_variant_get(message, ''$.value'', ''double'') > 10'
    WHEN NOT coalesce(o->>'$.status' <> 'view', FALSE)
      THEN 'try_variant_get(message, ''$.status'', ''string'') <> ''view''' END AS reason
  FROM objects)"""))
def validate_text_rules(spark, sf):
    messages = topics.objects(topics.event_messages(spark, sf))
    return validation.validate(messages, "try_variant_get(message, '$.value', 'double') > 10; ;"
                               "try_variant_get(message, '$.status', 'string') <> 'view'"
                               ).select(*POS, "valid", "reason")


@query("validate_bad_payload", sql([EVENTS, PARSED], f"""
SELECT {POS_SQL}, o IS NOT NULL AS valid,
       CASE WHEN o IS NULL THEN 'invalid JSON' END AS reason FROM objects"""))
def validate_bad_payload(spark, sf):
    messages = topics.objects(topics.event_messages(spark, sf))
    return validation.validate(messages, [("anything", F.lit(True))]).select(*POS, "valid", "reason")


@query("validate_rule_error", sql([EVENTS, PARSED], f"""
SELECT {POS_SQL}, CASE WHEN o IS NULL THEN 'invalid JSON'
  WHEN NOT coalesce({_guard('o', '$.status', TEXT, "o->>'$.status' < 'q'")}, FALSE)
  THEN 'status sorts before q' END AS reason FROM objects"""))
def validate_rule_error(spark, sf):
    messages = topics.objects(topics.event_messages(spark, sf))
    rules = [("status sorts before q", p.lt("status", "q"))]
    return validation.validate(messages, rules).select(*POS, "reason")


@query("route_invalid", sql([EVENTS, PARSED], f"""
SELECT {POS_SQL}, CASE WHEN reason IS NULL THEN 'valid' ELSE 'dlq' END AS half,
       CASE WHEN reason IS NOT NULL THEN 'INVALID_MESSAGE_ERROR' END AS error_type,
       reason AS error_message
FROM (SELECT *, {REASON} AS reason FROM objects)"""))
def route_invalid(spark, sf):
    valid, dead = validation.route_invalid(_validated(spark, sf), "dlq")
    nothing = F.lit(None).cast("string")
    return valid.select(*POS, F.lit("valid").alias("half"), nothing.alias("error_type"),
                        nothing.alias("error_message")).unionByName(
        dead.select(*POS, F.lit("dlq").alias("half"), "error_type", "error_message"))
