"""A: typing. B: text analysis and index tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text
from quarry.functions.phonetic import metaphone_code
from quarry.operators import index as ix
from quarry.operators import typing_ops as ty
from quarry.operators.ingest import long_values
from quarry.workload import model as m
from quarry.workload.registry import query
from quarry.workload.sql import LAT, LINK, LON, letters, words

TYPED = [
    ("c_name", "Int64", None), ("c_acctbal", "Double", None), ("balance", "Decimal", None),
    ("c_nationkey", "SByte", None), ("rich", "Boolean", None), ("location", "GeographyPoint", None),
    ("since", "Date", None), ("segment", "Guid", None), ("photo", "Binary", None),
]


def _typed_customers(spark, sf_dir):
    cells = {
        "c_name": F.col("c_name"), "c_acctbal": F.col("c_acctbal"), "balance": F.col("c_acctbal"),
        "c_nationkey": F.col("c_nationkey"), "rich": F.col("c_acctbal") > 5000,
        "location": m.customer_cells()["location"],
        "since": F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey")),
        "segment": F.col("c_mktsegment"), "photo": F.col("c_name"),
    }
    values = long_values(m.table(spark, sf_dir, "customer"), cells, m.customer_keys())
    return ty.type_values(values, m.properties(spark, TYPED))


def _typed_sql(property_id, v_bool="NULL", v_long="NULL", v_double="NULL", v_decimal="NULL", v_date="NULL",
               v_lat="NULL", v_lon="NULL", searchable="true"):
    return (
        f"SELECT CAST(c_custkey AS VARCHAR) AS doc_id, '{property_id}' AS property_id, CAST({v_bool} AS BOOLEAN) AS v_bool,"
        f" CAST({v_long} AS BIGINT) AS v_long, CAST({v_double} AS DOUBLE) AS v_double, CAST({v_decimal} AS DOUBLE) AS v_decimal,"
        f" CAST({v_date} AS VARCHAR) AS v_date, CAST({v_lat} AS DOUBLE) AS v_lat, CAST({v_lon} AS DOUBLE) AS v_lon,"
        f" {searchable} AS searchable FROM customer"
    )


@query("A1_typed_values", " UNION ALL ".join([
    _typed_sql("c_name", v_long="TRY_CAST(c_name AS BIGINT)"),
    _typed_sql("c_acctbal", v_double="c_acctbal"), _typed_sql("balance", v_decimal="c_acctbal"),
    _typed_sql("c_nationkey", v_long="c_nationkey"), _typed_sql("rich", v_bool="c_acctbal > 5000"),
    _typed_sql("location", v_lat=LAT, v_lon=LON),
    _typed_sql("since", v_date="CAST(DATE '2020-01-01' + c_nationkey AS VARCHAR)"),
    _typed_sql("segment", searchable="false"), _typed_sql("photo", searchable="false"),
]))
def typed_values(spark, sf_dir):
    return _typed_customers(spark, sf_dir).select(
        "doc_id", "property_id", "v_bool", "v_long", "v_double", F.col("v_decimal").cast("double").alias("v_decimal"),
        F.col("v_date").cast("string").alias("v_date"), "v_lat", "v_lon", "searchable",
    )


@query("A2_wide_entities", f"""
    SELECT CAST(c_custkey AS VARCHAR) AS doc_id, c_mktsegment AS entity_set_id, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey,
      c_acctbal > 5000 AS rich, {LAT} AS location_lat, {LON} AS location_lon FROM customer""")
def wide_entities(spark, sf_dir):
    shown = [(p, p, k) for p, k, _ in TYPED if p in ("c_acctbal", "c_nationkey", "rich", "location", "photo")]
    wide = ty.wide_view(_typed_customers(spark, sf_dir), shown)
    return wide.select(
        "doc_id", "entity_set_id", *[F.get(c, 0).alias(c) for c in ("c_acctbal", "c_nationkey", "rich")],
        "location_lat", "location_lon",
    )


@query("A3_schema_evolution", """
    SELECT 'c' || c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL AS segment FROM customer
    UNION ALL SELECT 's' || s_suppkey, s_name, NULL, NULL FROM supplier
    UNION ALL SELECT 'c' || c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""")
def schema_evolution(spark, sf_dir):
    customer = m.table(spark, sf_dir, "customer")
    first = m.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_name").alias("name"))
    second = customer.select(
        F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return ty.evolve(first, second, second.join(
        customer.select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")), "id"))


@query("A4_types_with_data", f"""
    SELECT 'document' AS entity_type_id, count(*) AS n_docs FROM documents
    UNION ALL SELECT 'part', count(*) FROM part
    UNION ALL SELECT 'customer', count(*) + (SELECT count(DISTINCT {LINK}) FROM customer) FROM customer""")
def types_with_data(spark, sf_dir):
    return ty.types_with_data(
        m.document_values(spark, sf_dir), m.part_values(spark, sf_dir), m.customer_values(spark, sf_dir),
        m.customer_values(spark, sf_dir, linked=True))


def _counted(tokens):
    return tokens.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query("B1_standard_tokens", f"""
    SELECT term, count(*) AS n FROM (SELECT unnest({words('text')}) AS term FROM documents) GROUP BY term""")
def standard_tokens(spark, sf_dir):
    documents = m.table(spark, sf_dir, "documents")
    return _counted(documents.select(F.explode(text.standard_tokens(F.col("text"))).alias("term")))


@query("B2_whole_value_tokens", "SELECT p_type AS term, count(*) AS n FROM part GROUP BY p_type")
def whole_value_tokens(spark, sf_dir):
    return _counted(m.table(spark, sf_dir, "part").select(F.explode(text.keyword_token(F.col("p_type"))).alias("term")))


@query("B3_letter_tokens", f"""
    SELECT term, count(*) AS n FROM (SELECT unnest({letters('text')}) AS term FROM documents) GROUP BY term""")
def letter_tokens(spark, sf_dir):
    documents = m.table(spark, sf_dir, "documents")
    return _counted(documents.select(F.explode(text.letter_tokens(F.col("text"))).alias("term")))


@query("B4_shingles", f"""
    WITH t AS (SELECT conv_id, turn, {letters('text')} AS t FROM conversations),
      s AS (SELECT conv_id, turn, t, unnest(range(1, len(t) + 1)) AS i FROM t)
    SELECT conv_id, turn, CAST(i - 1 AS INT) AS pos, t[i] AS term FROM s
    UNION ALL SELECT conv_id, turn, CAST(i - 1 AS INT), t[i] || t[i + 1] FROM s WHERE i < len(t)""")
def shingles(spark, sf_dir):
    rows = m.table(spark, sf_dir, "conversations").withColumn("t", text.letter_tokens(F.col("text")))
    both = F.concat(text.positioned(F.col("t")), text.shingles(F.col("t")))
    return rows.select("conv_id", "turn", F.inline(both))


# Codes of the part name words and of their two-word shingles, worked out by hand.
CODES = {
    "red": "RT", "blue": "BL", "hot": "HT", "cold": "KLT", "new": "N", "old": "OLT", "small": "SML", "large": "LRJ",
    "widget": "WJT", "bolt": "BLT", "ring": "RNK", "gear": "JR", "plate": "PLT", "rod": "RT", "gizmo": "JSM",
    "anvil": "ANFL",
}
SHINGLE_CODES = {
    "red": "RTWJ RTBL RTRN RJR RTPL RTRT RJSM RTNF", "blue": "BLWJ BLBL BLRN BLJR BLPL BLRT BLJS BLNF",
    "hot": "HTWJ HTBL HTRN HTJR HTPL HTRT HTJS HTNF", "cold": "KLTW KLTB KLTR KLJR KLTP KLTR KLJS KLTN",
    "new": "NJT NBLT NRNK NJR NPLT NRT NJSM NWNF", "old": "OLTW OLTB OLTR OLJR OLTP OLTR OLJS OLTN",
    "small": "SMLW SMLB SMLR SMLJ SMLP SMLR SMLJ SMLN", "large": "LRJW LRJB LRJR LRJJ LRJP LRJR LRJJ LRJN",
}
NOUNS = ["widget", "bolt", "ring", "gear", "plate", "rod", "gizmo", "anvil"]


def _code_rows():
    rows = list(CODES.items())
    for first, codes in SHINGLE_CODES.items():
        rows += [(first + noun, code) for noun, code in zip(NOUNS, codes.split())]
    return ", ".join(f"('{w}', '{c}')" for w, c in rows)


CODE_TABLE = f"code(term, code) AS (VALUES {_code_rows()})"


@query("B5_phonetic_codes", f"""
    WITH {CODE_TABLE} SELECT DISTINCT term, code FROM (SELECT unnest({letters('p_name')}) AS term FROM part) JOIN code USING (term)""")
def phonetic_codes(spark, sf_dir):
    names = m.table(spark, sf_dir, "part")
    vocabulary = names.select(F.explode(text.letter_tokens(F.col("p_name"))).alias("term")).distinct()
    return vocabulary.withColumn("code", metaphone_code("term"))


PHONETIC_TOK = f"""
    w AS (SELECT CAST(p_partkey AS VARCHAR) AS doc_id, p_brand AS set_id, {letters('p_name')} AS t FROM part),
    i AS (SELECT doc_id, set_id, t, unnest(range(1, len(t) + 1)) AS i FROM w),
    said AS (SELECT doc_id, set_id, t[i] AS term FROM i UNION ALL SELECT doc_id, set_id, t[i] || t[i+1] FROM i WHERE i < len(t)),
    ptok AS (SELECT doc_id, set_id, term FROM said UNION ALL SELECT doc_id, set_id, code FROM said JOIN code USING (term))"""


@query("B6_phonetic_postings", f"""
    WITH {CODE_TABLE}, {PHONETIC_TOK} SELECT doc_id, term, count(*) AS tf FROM ptok GROUP BY ALL""")
def phonetic_postings(spark, sf_dir):
    postings = m.part_index(spark, sf_dir, name=text.METAPHONE).postings
    return postings.where("property_id = 'p_name'").select("doc_id", "term", "tf")


@query("B7_postings_and_statistics", f"""
    WITH tok AS (SELECT doc_id, unnest({words('text')}) AS term FROM documents),
      len AS (SELECT doc_id, count(*) AS len FROM tok GROUP BY ALL),
      tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL)
    SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS n, (SELECT count(*) FROM len) AS n_elements,
      (SELECT round(avg(len), 6) FROM len) AS avg_len FROM tf GROUP BY term""")
def postings_and_statistics(spark, sf_dir):
    rows, keys = m.document_rows(spark, sf_dir)
    props = m.properties(spark, m.DOCUMENT_PROPERTIES)
    values = ty.type_values(long_values(rows, {"text": F.col("text")}, keys), props)
    postings = ix.materialize(ix.build_postings(values), "postings")
    counts = postings.groupBy(*ix.FIELD, "term").agg(F.sum("tf").alias("n"))
    return ix.term_stats(postings).join(counts, [*ix.FIELD, "term"]).join(ix.field_stats(postings), ix.FIELD).select(
        "term", "df", "n", "n_elements", F.round("avg_len", 6).alias("avg_len"))


@query("B8_analyzer_per_property", f"""
    WITH tok AS (
      SELECT p_partkey, 'p_name' AS property_id, unnest({words('p_name')}) AS term FROM part
      UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
      UNION ALL SELECT p_partkey, 'p_brand', unnest(['brand', 'BRNT']) FROM part)
    SELECT property_id, term, count(DISTINCT p_partkey) AS df FROM tok GROUP BY ALL""")
def analyzer_per_property(spark, sf_dir):
    return m.part_index(spark, sf_dir).term_stats.select("property_id", "term", "df")
