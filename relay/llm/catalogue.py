"""Queries over the corpus tables: one per operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relay.llm import decontamination, licenses, lines, near_copies, packing, permutation_index, prefix_trie, quality, sharding, structure, toxicity, vector_copies, wrappers
from relay.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def word_bpe() -> str:
    """The public vocabulary file, wherever it is installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out(0, 5))
    return toxicity.score(table(spark, sf_dir, "documents"), labels).select(
        "doc_id", quality.held_out(0, 5).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out(1, 3))
    return quality.score(table(spark, sf_dir, "documents"), labels).select(
        "doc_id", quality.held_out(1, 3).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines that repeat or nearly repeat earlier ones removed."""
    return lines.deduplicate(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 4096 ids."""
    pieces = packing.cut(table(spark, sf_dir, "documents"), word_bpe())
    return packing.pack(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.col("offset").cast("long").alias("offset"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License statements found in documents."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near copies of every document."""
    return near_copies.groups(table(spark, sf_dir, "documents"))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards, and its shard among 17."""
    return sharding.manifest(table(spark, sf_dir, "documents"), 16)


def op10_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return wrappers.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all first turns of the rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after the damage of the contract."""
    conversations = table(spark, sf_dir, "conversations")
    return structure.repair(structure.damaged(conversations), conversations)


def op13_vector_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near copies of every vector."""
    return vector_copies.groups(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {"op1_toxicity": op1_toxicity, "op2_quality": op2_quality, "op3_lines": op3_lines, "op4_decontamination": op4_decontamination,
            "op5_packing": op5_packing, "op6_licenses": op6_licenses, "op7_near_copies": op7_near_copies, 
            "op8_permutation_index": op8_permutation_index, "op9_sharding": op9_sharding, "op10_wrappers": op10_wrappers,
            "op11_prefix_trie": op11_prefix_trie, "op12_structure": op12_structure,
            "op13_vector_copies": op13_vector_copies}


# Lines as sets of 5-word shingles, classes of equal sets by their first line, and all
# pairs of classes that share a shingle.
OP3 = r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents),
lines AS (
  SELECT doc_id, no, s[no] AS line,
    list_filter(string_split(translate(lower(s[no]), chr(9) || chr(11) || chr(12) || chr(13), '    '), ' '),
                lambda x: x <> '') AS w
  FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS no FROM split)),
sets AS (
  SELECT doc_id, no, line, CASE
    WHEN len(w) >= 5 THEN list_sort(list_distinct(list_transform(
      range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END AS t
  FROM lines),
kinds AS (SELECT t, min((doc_id, no)) AS first FROM sets WHERE t IS NOT NULL GROUP BY t),
tokens AS (SELECT first, len(t) AS n, unnest(t) AS token FROM kinds),
matched AS (
  SELECT DISTINCT first FROM (
    SELECT b.first, count(*) AS c, any_value(a.n + b.n) AS n
    FROM tokens a JOIN tokens b ON a.token = b.token AND a.first < b.first GROUP BY a.first, b.first)
  WHERE 100 * c >= 75 * (n - c)),
stay AS (SELECT first FROM kinds WHERE first NOT IN (SELECT first FROM matched)),
marked AS (SELECT doc_id, no, line, t IS NULL OR (doc_id, no) IN (SELECT first FROM stay) AS stays FROM sets)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (NOT stays) AS INTEGER) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (stays), '') AS text
FROM marked GROUP BY doc_id"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text in SQL, byte by byte and bit by bit."""
    byte = ("list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), "
            "lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)")
    codes = f"list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {byte}))"


# Every conversation as the list of its turns' digests; nodes are the distinct beginnings.
OP11 = f"""
WITH said AS (
  SELECT conv_id, turn, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id,
    strlen(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'id': id, 'size': size}} ORDER BY turn NULLS FIRST, id) AS t FROM said GROUP BY conv_id),
h AS (SELECT conv_id, t, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own),
rebuilt AS (
  SELECT h.conv_id, list_concat(coalesce(b.t[1:h], []), h.t[h + 1:]) AS t
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 5),
beginnings AS (
  SELECT conv_id, d, len(t) = d AS ends, array_to_string(list_transform(t[1:d], lambda x: x.id), '') AS path,
    CASE WHEN d > 0 THEN t[d].size ELSE 0 END AS size
  FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends
  FROM beginnings GROUP BY path, d),
family AS (SELECT left(path, 64 * (d - 1)) AS path, count(*) AS children FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(children, 0) AS children FROM nodes LEFT JOIN family USING (path)),
below AS (
  SELECT a.path, sum(CAST(b.children = 0 AS INTEGER)) AS leaves, sum((b.n - 1) * b.size) AS saved
  FROM counted a JOIN counted b ON starts_with(b.path, a.path) GROUP BY a.path)
SELECT c.conv_id, CAST(c.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n AS n_convs,
  CAST(c.children AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(c.ends) AS ends_sha256
FROM counted c JOIN below USING (path) LEFT JOIN counted p ON c.d > 0 AND p.path = left(c.path, 64 * (c.d - 1))"""

# Best repairs so far, row by row: s0 nothing kept, s1 a system turn, s2 up to a user turn,
# s3 up to an assistant turn. At these costs no insertion is in a cheapest repair: an
# inserted turn (5) and its neighbour can both go for 2, and a system turn left alone for 2 more.
OP12 = rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("concat(conv_id, ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations WHERE conv_id IS NOT NULL),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM given WHERE kind <> 0),
said AS (SELECT *, sha256(concat(length(role), ':', role, text)) AS id FROM damaged),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, id, copy) AS no FROM said),
judged AS (
  SELECT *, role[1:1] AS initial, CASE
      WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, id ORDER BY no) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault,
    coalesce(lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY no) || role[1:1] NOT IN ('su', 'ua', 'au'), FALSE) AS illegal
  FROM placed),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS no, {{'c': 0, 'a': '', 't': ''}} AS s0,
    CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR)) AS s1, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR)) AS s2,
    CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR)) AS s3
  FROM given
  UNION ALL
  SELECT conv_id, no, {{'c': s0.c + 2, 'a': s0.a || 'D', 't': s0.t}},
    list_min([CASE WHEN s1 IS NOT NULL THEN {{'c': s1.c + 2, 'a': s1.a || 'D', 't': s1.t}} END,
              CASE WHEN usable AND initial = 's' THEN {{'c': s0.c + more, 'a': s0.a || 'K', 't': concat(s0.t, chr(10), role, ':', text)}} END]),
    list_min([CASE WHEN s2 IS NOT NULL THEN {{'c': s2.c + 2, 'a': s2.a || 'D', 't': s2.t}} END,
              CASE WHEN usable THEN {{'c': other.c + more + CASE initial WHEN 'u' THEN 0 ELSE 1 END,
                'a': other.a || CASE initial WHEN 'u' THEN 'K' ELSE 'R' END,
                't': concat(other.t, chr(10), CASE initial WHEN 'u' THEN role ELSE 'user' END, ':', text)}} END]),
    list_min([CASE WHEN s3 IS NOT NULL THEN {{'c': s3.c + 2, 'a': s3.a || 'D', 't': s3.t}} END,
              CASE WHEN usable AND s2 IS NOT NULL THEN {{'c': s2.c + more + CASE initial WHEN 'a' THEN 0 ELSE 1 END,
                'a': s2.a || CASE initial WHEN 'a' THEN 'K' ELSE 'R' END,
                't': concat(s2.t, chr(10), CASE initial WHEN 'a' THEN role ELSE 'assistant' END, ':', text)}} END])
  FROM (
    SELECT j.conv_id, j.no, j.role, j.text, j.initial, w.s0, w.s1, w.s2, w.s3, list_min([w.s0, w.s1, w.s3]) AS other,
      coalesce(j.fault, '') NOT IN ('blank', 'duplicate') AS usable, CASE j.fault WHEN 'truncated' THEN 5 ELSE 0 END AS more
    FROM walk w JOIN judged j ON j.conv_id = w.conv_id AND j.no = w.no + 1)),
best AS (SELECT conv_id, list_min([arg_max(s0, no), arg_max(s3, no)]) AS b FROM walk GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE illegal) AS illegal
  FROM judged GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(b.c AS BIGINT) AS cost, b.a AS audit,
  sha256(b.t[2:]) AS repaired_sha256
FROM best LEFT JOIN counts USING (conv_id)"""


def checks() -> dict[str, str]:
    """SQL for the queries that SQL can express. The others use trained models, a
    tokenizer file, CRC-32 or hashes that SQL lacks; tests hold them against plain
    Python."""
    return {"op3_lines": OP3, "op11_prefix_trie": OP11, "op12_structure": OP12}
