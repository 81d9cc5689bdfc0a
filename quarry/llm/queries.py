"""Registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    conversation_repair, exact_dedup, hard_negatives, language_id, line_dedup, mixing, packing, pii, quality, repeats, sharding, shingle_join, topk_search,
)
from quarry.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


_OP1_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM texts WINDOW w AS (PARTITION BY t)
"""


@query("op1_exact_dedup", _OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.with_digest(exact_dedup.deduplicate(docs, exact_dedup.newer_half(docs)))


@query("op2_suffix_array_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False)
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


@query("op4_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.even_tree()
    return sharding.shard(table(spark, sf_dir, "documents"), tree, sharding.grown(tree))


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.spans_of(docs, pii.fit(docs), keep=["doc_id"])
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select("row.doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")


@query("op6_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return scored.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", "predicted")


@query("op7_shingle_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = shingle_join.join_similar(table(spark, sf_dir, "documents"))
    return joined.select("row.doc_id", "n_shingles", "component_id")


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


_OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 10
"""


@query("op9_exact_topk", _OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


_OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""


@query("op11_hard_negatives", _OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


# From a conversation's last row back: per state the least (cost, audit, lines) of what follows.
_OP12_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT)),
             lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 20 AS kind
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS again
  FROM keyed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER c AS i, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, again) > 1 AS seen,
         left(role, 1) AS ini, lag(left(role, 1)) OVER c AS before, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') AS unended
  FROM hurt WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again)
), judged AS (
  SELECT *, seen AND NOT blank AS dup, unended AND NOT seen AND NOT blank AS trunc FROM placed
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
         count(*) FILTER (trunc) AS truncated, count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), back AS (
  SELECT conv_id, max(n) AS i, {c: 0, a: '', l: []::VARCHAR[]} AS s0, {c: 6, a: 'II', l: ['user:', 'assistant:']} AS s1,
         {c: 3, a: 'I', l: ['assistant:']} AS s2, {c: 0, a: '', l: []::VARCHAR[]} AS s3
  FROM placed GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i - 1,
         list_min([h0, {c: 3 + p2.c, a: 'I' || p2.a, l: list_prepend('user:', p2.l)}]), list_min([h1, {c: 3 + p2.c, a: 'I' || p2.a, l: list_prepend('user:', p2.l)}]), p2, p3
  FROM (
    SELECT *, list_min([h2, {c: 3 + h3.c, a: 'I' || h3.a, l: list_prepend('assistant:', h3.l)}]) AS p2, list_min([h3, {c: 3 + h2.c, a: 'I' || h2.a, l: list_prepend('user:', h2.l)}]) AS p3
    FROM (
      SELECT conv_id, i,
             list_min([{c: 4 + s0.c, a: 'D' || s0.a, l: s0.l}, {c: CASE WHEN ini = 's' THEN keep ELSE 99999999 END + s1.c, a: 'K' || s1.a, l: list_prepend(own, s1.l)},
                       {c: CASE WHEN ini = 'u' THEN keep ELSE 99999999 END + s2.c, a: 'K' || s2.a, l: list_prepend(own, s2.l)}, {c: 3 + keep + s2.c, a: 'R' || s2.a, l: list_prepend('user:' || text, s2.l)}]) AS h0,
             list_min([{c: 4 + s1.c, a: 'D' || s1.a, l: s1.l},
                       {c: CASE WHEN ini = 'u' THEN keep ELSE 99999999 END + s2.c, a: 'K' || s2.a, l: list_prepend(own, s2.l)}, {c: 3 + keep + s2.c, a: 'R' || s2.a, l: list_prepend('user:' || text, s2.l)}]) AS h1,
             list_min([{c: 4 + s2.c, a: 'D' || s2.a, l: s2.l},
                       {c: CASE WHEN ini = 'a' THEN keep ELSE 99999999 END + s3.c, a: 'K' || s3.a, l: list_prepend(own, s3.l)}, {c: 3 + keep + s3.c, a: 'R' || s3.a, l: list_prepend('assistant:' || text, s3.l)}]) AS h2,
             list_min([{c: 4 + s3.c, a: 'D' || s3.a, l: s3.l},
                       {c: CASE WHEN ini = 'u' THEN keep ELSE 99999999 END + s2.c, a: 'K' || s2.a, l: list_prepend(own, s2.l)}, {c: 3 + keep + s2.c, a: 'R' || s2.a, l: list_prepend('user:' || text, s2.l)}]) AS h3
      FROM (
        SELECT b.*, j.ini, j.text, j.role || ':' || j.text AS own, CASE WHEN j.blank OR j.dup THEN 99999999 WHEN j.trunc THEN 3 ELSE 0 END AS keep
        FROM back b JOIN judged j ON b.conv_id IS NOT DISTINCT FROM j.conv_id AND b.i = j.i
      )
    )
  )
)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(s0.c, 0)::BIGINT AS cost, coalesce(s0.a, '') AS audit, sha256(coalesce(array_to_string(s0.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN back b ON b.conv_id IS NOT DISTINCT FROM ids.conv_id AND b.i = 0
"""


@query("op12_conversation_repair", _OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(table(spark, sf_dir, "conversations"))


_OP13_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.i, k.line, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op13_line_dedup", _OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
