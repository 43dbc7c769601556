"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import (chat, decontaminate, infill, line_dedup, near_dedup, packing, pii, quality_knn, quality_rules,
                           sharding, tokens, toxicity, vector_codes)
from eventmart.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _fold(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks, _ = tokens.token_files(spark, _texts(spark, sf_dir), tokenizer_path(), end_id=1)
    return tokens.read_documents(blocks)


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_texts(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_turns(table(spark, sf_dir, "conversations"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_texts(spark, sf_dir))


def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(_texts(spark, sf_dir))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_texts(spark, sf_dir), tokenizer_path(), size=2048, end_id=0)


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_texts(spark, sf_dir), percent=85)


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    space = quality_knn.fit(docs, table(spark, sf_dir, "labels").where(_fold(5) != 0))
    return quality_knn.score_documents(docs, space).select(
        "doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.byte_shards(_texts(spark, sf_dir), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels").where(_fold(4) != 2))
    return toxicity.score_documents(docs, lexicon).select(
        "doc_id", (_fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "n_terms", "n_words")


def vector_codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, codebook = vector_codes.vector_codes(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return vector_codes.with_label_error(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(vector_codes.codebooks_digest(codebook)).alias("codebooks_sha256"))


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_texts(spark, sf_dir), min_chars=20, min_docs=3).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return infill.infill(_texts(spark, sf_dir)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(infill.restore(F.col("form"), F.col("output"))).alias("restored_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_ids": token_ids,
        "op2_decontamination": contamination,
        "op3_chat_format": chat_format,
        "op4_pii": personal_data,
        "op5_quality_rules": quality_rules_query,
        "op6_best_fit_packing": best_fit_packing,
        "op7_near_duplicates": near_duplicates,
        "op8_quality_classifier": quality_classifier,
        "op9_shards": shards,
        "op10_toxicity": toxicity_query,
        "op11_vector_codes": vector_codes_query,
        "op12_line_dedup": line_dedup_query,
        "op13_infilling": infilling,
    }


# Conversations as lists of their distinct turns; one goes if its list starts a longer one, or equals that of a smaller id.
CHAT_SQL = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place,
         count(*) OVER (PARTITION BY conv_id) AS n_turns,
         '<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS rendered
  FROM turns),
prefixes AS (
  SELECT conv_id, place + 1 AS size, n_turns,
         string_agg(coalesce(role, '~') || chr(30) || coalesce(text, '~') || chr(31), '')
           OVER (PARTITION BY conv_id ORDER BY place) AS spelled
  FROM placed),
whole AS (SELECT size, spelled, min(conv_id) AS conv_id FROM prefixes WHERE size = n_turns GROUP BY size, spelled),
kept AS (
  SELECT conv_id FROM whole w
  WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.size < p.n_turns AND p.size = w.size AND p.spelled = w.spelled))
SELECT p.conv_id, p.place, p.n_turns, p.role,
       CAST(coalesce(sum(length(rendered)) OVER (PARTITION BY p.conv_id ORDER BY place
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, rendered
FROM placed p SEMI JOIN kept k ON p.conv_id = k.conv_id
"""

RULES_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
split AS (SELECT doc_id, r, text, regexp_extract_all(text, '[^ \t-\r]+') AS w FROM docs),
windows AS (
  SELECT r, i, list_slice(w, i, i + 7) AS win FROM split, unnest(generate_series(1, len(w) - 7)) AS g(i) WHERE len(w) >= 8),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, unnest(generate_series(0, 7)) AS g(k) GROUP BY r),
lines AS (
  SELECT r, count(*) FILTER (regexp_matches(line, '[^ \t-\r]'))
            - count(DISTINCT line) FILTER (regexp_matches(line, '[^ \t-\r]')) AS n_dup_lines, count(*) AS n_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs) GROUP BY r),
figures AS (
  SELECT doc_id, text, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[ \t-\r]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, n_lines,
         length(regexp_replace(text, '[^\p{L}]+', '', 'g')) AS letters,
         length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS upper
  FROM split LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_dup_lines > 3 * n_lines OR 10 * letters < 6 * word_chars OR 10 * upper > 3 * letters) AS kept
FROM judged
"""


# The components as rows, and each round as a join of all of them with all entries.
def _codes_sql() -> str:
    code = """,
near{i} AS (
  SELECT r, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.r, p.part, c.entry, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS d
    FROM parts p JOIN book{i} c ON p.part = c.part AND p.pos = c.pos GROUP BY p.r, p.part, c.entry)
  GROUP BY r, part)"""
    mean = """,
book{j} AS (
  SELECT c.part, c.entry, c.pos, coalesce(m.x, c.x) AS x FROM book{i} c LEFT JOIN (
    SELECT n.part, n.entry, p.pos, CAST(floor(CAST(sum(p.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
    FROM near{i} n JOIN parts p ON n.r = p.r AND n.part = p.part GROUP BY n.part, n.entry, p.pos) m
  ON c.part = m.part AND c.entry = m.entry AND c.pos = m.pos)"""
    return """
WITH kept AS (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, len(embedding) // 16 AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
flat AS (SELECT r, w, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS place FROM kept),
parts AS (SELECT r, place // w AS part, place % w AS pos, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM flat),
book0 AS (SELECT part, r - 1 AS entry, pos, x FROM parts WHERE r <= 64)""" + "".join(
        code.format(i=i) + (mean.format(i=i, j=i + 1) if i < 2 else "") for i in range(3)) + """,
coded AS (
  SELECT r, string_agg(format('{:02x}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near2 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book2) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""


LINES_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
split AS (SELECT r, doc_id, string_split(text, chr(10)) AS parts FROM docs),
lines AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM split),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[ \t-\r]+|[ \t-\r]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS last FROM (SELECT DISTINCT key, doc_id FROM keyed WHERE length(key) >= 20)
  GROUP BY key HAVING count(*) >= 3),
judged AS (
  SELECT k.*, s.key IS NOT NULL AND (k.doc_id IS NULL OR k.doc_id < s.last) AS dropped
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY r
"""

# The units as a list; prefix, middle and suffix are its slices, joined.
INFILL_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
units AS (
  SELECT *, regexp_extract_all(text, '[ 	-
]*[^ 	-
]+|[ 	-
]+') AS u,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM docs),
cuts AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
         greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM units),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(list_slice(u, 1, a), '') AS p,
         array_to_string(list_slice(u, a + 1, b), '') AS m, array_to_string(list_slice(u, b + 1, n), '') AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_format": CHAT_SQL, "op5_quality_rules": RULES_SQL, "op11_vector_codes": _codes_sql(),
            "op12_line_dedup": LINES_SQL, "op13_infilling": INFILL_SQL}
