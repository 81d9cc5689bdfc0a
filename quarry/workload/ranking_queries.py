"""E: scores, sorting, paging, totals, result shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import STANDARD
from quarry.operators import predicates as P
from quarry.operators import rank
from quarry.operators.compose import fold_scores
from quarry.operators.requests import live_searches, sub_searches, text_clauses
from quarry.plans.entity_search import find, match_rows, search
from quarry.scale import materialize
from quarry.workload import model as m
from quarry.workload.predicate_queries import (
    CUSTOMER_FIELDS, DOCUMENT_FIELDS, PART_FIELDS, SEGMENTS, linking_sets, simple,
)
from quarry.workload.registry import query
from quarry.workload.sql import BM25, CUSTOMER_TOK, DOC_SET, DOC_TOK, ELEMENTS, PART_SET, haversine, part_tok


def _documents(spark, sf_dir, term, **columns):
    searches = m.sets_of(spark, sf_dir, "documents", "source", "document").withColumns(columns)
    return m.requests(searches, DOCUMENT_FIELDS, constraints=[simple(term)])


@query("E1_relevance_score", f"""
    WITH {DOC_TOK}, {BM25} SELECT set_id AS search_id, doc_id, round(s, 6) AS score FROM sc JOIN {DOC_SET} USING (doc_id)
    WHERE property_id = 'text' AND term = 'the'""")
def relevance_score(spark, sf_dir):
    return find(_documents(spark, sf_dir, "the"), m.document_index(spark, sf_dir)).select("search_id", "doc_id", "score")


@query("E2_score_folds", f"""
    WITH {ELEMENTS}, {CUSTOMER_TOK}, {BM25}
    SELECT doc_id, round(sum(s), 6) AS total_score, round(max(s), 6) AS max_score, round(avg(s), 6) AS avg_score FROM sc
    WHERE property_id = 'segment' AND term = 'BUILDING' AND doc_id LIKE 'L%' GROUP BY doc_id""")
def score_folds(spark, sf_dir):
    """Element scores of linked documents, folded as sum, maximum and mean."""
    searches = m.local_table(spark, [("q", "linking", "customer", True)], m.T.StructType(
        [m.T.StructField(n, m.T.StringType()) for n in ("search_id", "entity_set_id", "entity_type_id")]
        + [m.T.StructField("linking", m.T.BooleanType())]))
    req = m.requests(searches, ["segment"], constraints=[simple("BUILDING")], linking=linking_sets(searches, *SEGMENTS))
    matches = match_rows(req, live_searches(req), m.customer_index(spark, sf_dir))
    matches = materialize(matches, "matches")
    folded = [fold_scores(matches, fold).withColumnRenamed("score", name)
              for fold, name in (("sum", "total_score"), ("max", "max_score"), ("mean", "avg_score"))]
    keys = ["search_id", "doc_id"]
    return folded[0].join(folded[1], keys).join(folded[2], keys).drop("search_id")


@query("E3_best_field", f"""
    WITH {part_tok(kind_standard=True)}, {BM25},
      f AS (SELECT doc_id, property_id, sum(s) AS s FROM sc WHERE term IN ('small', 'ring') GROUP BY ALL)
    SELECT set_id AS search_id, doc_id, round(max(s), 6) AS score FROM f JOIN {PART_SET} USING (doc_id) GROUP BY ALL""")
def best_field(spark, sf_dir):
    """Name and type both may hold "small"; the better field counts."""
    req = m.requests(m.sets_of(spark, sf_dir, "part", "p_brand", "part"), PART_FIELDS, constraints=[simple("small ring")])
    return find(req, m.part_index(spark, sf_dir, kind=STANDARD)).select("search_id", "doc_id", "score")


def _linked_sorted(spark, sf_dir, sort_type, property_id, lat=None, lon=None, size=1 << 30):
    """All linked documents of a pair of segments, ascending and descending."""
    types = m.T.StructType(
        [m.T.StructField(n, m.T.StringType()) for n in ("search_id", "entity_set_id", "entity_type_id", "sort_type", "sort_property_id")]
        + [m.T.StructField("linking", m.T.BooleanType()), m.T.StructField("descending", m.T.BooleanType()),
           m.T.StructField("max_hits", m.T.IntegerType()), m.T.StructField("sort_lat", m.T.DoubleType()),
           m.T.StructField("sort_lon", m.T.DoubleType())])
    searches = m.local_table(spark, [
        (name, "linking", "customer", sort_type, property_id, True, down, size, lat, lon)
        for name, down in (("ascending", False), ("descending", True))], types)
    req = m.requests(searches, CUSTOMER_FIELDS, groups=[], linking=linking_sets(searches, "BUILDING", "MACHINERY"))
    return search(req, m.customer_index(spark, sf_dir))


LINKED_DOCS = """d AS (SELECT * FROM el WHERE set_id IS NULL AND doc_id IN
      (SELECT doc_id FROM el WHERE set_id IS NULL AND eset IN ('BUILDING', 'MACHINERY')))"""


@query("E4_sort_by_property", f"""
    WITH {ELEMENTS}, {LINKED_DOCS}, k AS (SELECT doc_id, min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM d GROUP BY ALL)
    SELECT 'ascending' AS search_id, CAST(row_number() OVER (ORDER BY lo, doc_id) AS INT) AS rn, doc_id FROM k
    UNION ALL SELECT 'descending', CAST(row_number() OVER (ORDER BY hi DESC, doc_id) AS INT), doc_id FROM k""")
def sort_by_property(spark, sf_dir):
    """Documents with several balances: the least counts ascending, the greatest descending."""
    return _linked_sorted(spark, sf_dir, "field", "c_acctbal").select("search_id", "rn", "doc_id")


@query("E5_sort_by_distance", f"""
    WITH {ELEMENTS}, {LINKED_DOCS}, m AS (SELECT doc_id, round({haversine('lat', 'lon', '12.5', '33.25')}, 3) AS m FROM d),
      k AS (SELECT doc_id, min(m) AS lo, max(m) AS hi FROM m GROUP BY ALL)
    SELECT 'ascending' AS search_id, CAST(row_number() OVER (ORDER BY lo, doc_id) AS INT) AS rn, doc_id FROM k
    UNION ALL SELECT 'descending', CAST(row_number() OVER (ORDER BY hi DESC, doc_id) AS INT), doc_id FROM k""")
def sort_by_distance(spark, sf_dir):
    return _linked_sorted(spark, sf_dir, "geoDistance", "location", 12.5, 33.25).select("search_id", "rn", "doc_id")


@query("E6_sort_direction", f"""
    WITH {ELEMENTS}, {LINKED_DOCS}, k AS (SELECT doc_id, min(c_name) AS lo, max(c_name) AS hi FROM d GROUP BY ALL)
    SELECT 'ascending' AS search_id, CAST(row_number() OVER (ORDER BY lo, doc_id) AS INT) AS rn, doc_id FROM k
    UNION ALL SELECT 'descending', CAST(row_number() OVER (ORDER BY hi DESC, doc_id) AS INT), doc_id FROM k""")
def sort_direction(spark, sf_dir):
    """Text properties sort by their raw value, both ways."""
    return _linked_sorted(spark, sf_dir, "field", "c_name").select("search_id", "rn", "doc_id")


THE_RANKED = f"""
    {DOC_TOK}, {BM25}, h AS (SELECT set_id, doc_id, round(sum(s), 6) AS score FROM sc JOIN {DOC_SET} USING (doc_id)
      WHERE property_id = 'text' AND term IN ('the', 'que') GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY set_id ORDER BY score DESC, doc_id) AS rn, count(*) OVER (PARTITION BY set_id) AS total FROM h)"""


@query("E7_pages", f"""
    WITH {THE_RANKED} SELECT set_id AS search_id, CAST(rn AS INT) AS rn, doc_id, score FROM r WHERE rn > 3 AND rn <= 8""")
def pages(spark, sf_dir):
    req = _documents(spark, sf_dir, "the que", start=F.lit(3), max_hits=F.lit(5))
    return search(req, m.document_index(spark, sf_dir)).select("search_id", "rn", "doc_id", "score")


@query("E8_exact_totals", f"WITH {THE_RANKED} SELECT set_id AS search_id, count(*) AS total_hits FROM h GROUP BY ALL")
def exact_totals(spark, sf_dir):
    return rank.totals(find(_documents(spark, sf_dir, "the que"), m.document_index(spark, sf_dir)))


@query("E8_request_totals", f"""
    WITH {THE_RANKED}, t AS (SELECT DISTINCT source AS set_id FROM documents)
    SELECT CASE WHEN set_id IN ('src1', 'src2', 'src3') THEN 'some' ELSE 'rest' END AS request_id,
      CAST(sum((SELECT count(*) FROM h WHERE h.set_id = t.set_id)) AS BIGINT) AS total_hits FROM t GROUP BY 1
    UNION ALL SELECT 'nothing', 0""")
def request_totals(spark, sf_dir):
    """Sums per request: pages past the end keep their totals, a search without hits counts zero."""
    request = F.when(F.col("entity_set_id").isin("src1", "src2", "src3"), "some").otherwise("rest")
    searches = m.sets_of(spark, sf_dir, "documents", "source", "document").withColumns(
        {"request_id": request, "start": F.lit(2_000_000_000), "max_hits": F.lit(2_147_483_647)})
    nowhere = searches.limit(1).withColumns(
        {"search_id": F.lit("nowhere"), "entity_set_id": F.lit("nowhere"), "request_id": F.lit("nothing")})
    req = m.requests(searches.unionByName(nowhere), DOCUMENT_FIELDS, constraints=[simple("the que")])
    return rank.request_totals(find(req, m.document_index(spark, sf_dir)), req)


@query("E9_sub_searches", f"""
    WITH {THE_RANKED}, q AS (SELECT lang || '-readers' AS request_id, set_id,
        CAST(row_number() OVER (PARTITION BY lang ORDER BY set_id) - 1 AS INT) AS request_no
      FROM (SELECT DISTINCT lang, source AS set_id FROM documents))
    SELECT request_id, request_no, set_id AS entity_set_id, CAST(rn AS INT) AS rn, doc_id, total AS total_hits FROM q JOIN r USING (set_id) WHERE rn <= 2""")
def sub_search_pages(spark, sf_dir):
    """A request per language over the sources it occurs in; pages of the sets stay separate, in order."""
    documents = m.table(spark, sf_dir, "documents")
    asked = documents.select("lang", "source").distinct().groupBy(
        F.concat("lang", F.lit("-readers")).alias("request_id")).agg(F.sort_array(F.collect_set("source")).alias("entity_set_ids"))
    sets = documents.select(F.col("source").alias("entity_set_id")).distinct().withColumn("entity_type_id", F.lit("document"))
    searches = sub_searches(asked, sets).withColumn("max_hits", F.lit(2))
    req = m.requests(searches, DOCUMENT_FIELDS, constraints=[simple("the que")])
    return search(req, m.document_index(spark, sf_dir)).select(
        "request_id", "request_no", "entity_set_id", "rn", "doc_id", "total_hits")


@query("E10_id_only_result", f"""
    WITH {THE_RANKED} SELECT set_id AS entity_set_id, doc_id FROM r WHERE rn <= 10""")
def id_only_result(spark, sf_dir):
    return search(_documents(spark, sf_dir, "the que"), m.document_index(spark, sf_dir)).select("entity_set_id", "doc_id")


@query("E11_source_projection", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, 'order' || o_orderkey AS name, o_orderpriority AS title FROM orders""")
def source_projection(spark, sf_dir):
    """Entity-set documents without the nested property types, with their id put in."""
    sets = m.order_sets(spark, sf_dir).withColumn("id", F.col("entity_set_id"))
    return sets.drop("property_ids", "property_types").select("id", "name", "title")


@query("E12_keys_per_set", f"""
    WITH {THE_RANKED} SELECT set_id AS entity_set_id, count(*) AS n_keys, min(doc_id) AS first_key FROM h GROUP BY ALL""")
def keys_per_set(spark, sf_dir):
    hits = find(_documents(spark, sf_dir, "the que"), m.document_index(spark, sf_dir))
    keys = rank.by_entity_set(hits.withColumnRenamed("search_id", "entity_set_id"))
    return keys.groupBy("entity_set_id").agg(F.count(F.lit(1)).alias("n_keys"), F.min("doc_id").alias("first_key"))


@query("E13_explain", f"""
    WITH {DOC_TOK}, {BM25} SELECT set_id AS search_id, doc_id, term, tf, CAST(len AS INT) AS len, df, n AS n_elements, round(al, 6) AS avg_len,
      round(s, 6) AS score FROM sc JOIN {DOC_SET} USING (doc_id) WHERE property_id = 'text' AND term IN ('the', 'que')""")
def explain(spark, sf_dir):
    """What each matched term contributes to the score of a hit."""
    index = m.document_index(spark, sf_dir)
    req = _documents(spark, sf_dir, "the que")
    tokens = P.query_tokens(text_clauses(req, live_searches(req), index.property_types), index.phonetic)
    return P.term_matches(tokens, index, req.small, explain=True).select(
        "search_id", "doc_id", "term", "tf", "len", "df", "n_elements", F.round("avg_len", 6).alias("avg_len"),
        F.round("score", 6).alias("score"))
