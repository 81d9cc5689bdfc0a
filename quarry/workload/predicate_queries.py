"""D: predicates and their composition, for tables of searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text
from quarry.functions.text import STANDARD
from quarry.operators import predicates as P
from quarry.operators.fuzzy import expand
from quarry.operators.requests import live_searches, text_clauses
from quarry.plans.catalog_search import NAME_SEARCH, name_hits, only_allowed
from quarry.plans.entity_search import find
from quarry.scale import local_table, lookup_join, materialize
from quarry.workload import model as m
from quarry.workload.registry import query
from quarry.workload.sql import (
    BM25, DOC_SET, DOC_TOK, ELEMENTS, LAT, LON, PART_SET, auto, haversine, osa, part_tok, words,
)

DOCUMENT_FIELDS = ["text", "lang", "n_chars"]
PART_FIELDS = ["p_name", "p_type", "p_size"]
CUSTOMER_FIELDS = ["c_name", "c_acctbal", "c_nationkey", "segment", "location"]


def simple(term, group=0, number=0, fuzzy=False):
    return {"search_type": "simple", "search_term": term, "group_no": group, "constraint_no": number, "fuzzy": fuzzy}


def hits(req, index, scored=True):
    columns = ["search_id", "doc_id", "score"] if scored else ["search_id", "doc_id"]
    return find(req, index).select(*columns)


# --- text ---------------------------------------------------------------------


@query("D1_term_search", f"""
    WITH {DOC_TOK}, {BM25}
    SELECT set_id AS search_id, doc_id, round(sum(s), 6) AS score FROM sc JOIN {DOC_SET} USING (doc_id)
    WHERE property_id = 'text' AND term IN ('thing', 'que', 'estion') GROUP BY ALL""")
def term_search(spark, sf_dir):
    """In every source, documents with any of three words in any authorised field."""
    req = m.requests(m.sets_of(spark, sf_dir, "documents", "source", "document"), DOCUMENT_FIELDS,
                     constraints=[simple("Thing que, estion")])
    return hits(req, m.document_index(spark, sf_dir))


@query("D2_fuzzy_rewrite", """
    SELECT doc_id, list_aggregate(list_transform(string_split(rtrim(text, ' '), ' '),
      lambda t: CASE WHEN ends_with(t, '~') OR ends_with(t, '"') THEN t ELSE t || '~' END), 'string_agg', ' ') AS rewritten FROM documents""")
def fuzzy_rewrite(spark, sf_dir):
    return m.table(spark, sf_dir, "documents").select("doc_id", text.fuzzy_rewrite(F.col("text")).alias("rewritten"))


# The SQL engine counts edits in bytes, so accented letters get one-byte stand-ins
# (tokens are lowercase, capitals are free).
# An edit adds and removes at most one letter each: words further apart in their letter
# bits need no comparison.
LETTER_BITS = "list_reduce(list_transform(string_split({0}, ''), lambda c: CAST(1 AS BIGINT) << CAST(ascii(c) % 62 AS INT)), lambda p, q: p | q)"
ACCENTED, STAND_INS = "èéñßêçíöüóäàâîôûùïë’", "ABCDEFGHIJKLMNOPQRST"


@query("D3_fuzzy_terms", f"""
    WITH q AS (SELECT DISTINCT unnest({words('text')}) AS token FROM benchmark),
      v AS (SELECT DISTINCT unnest({words('text')}) AS term FROM documents),
      a AS MATERIALIZED (SELECT token, t, length(t) + d AS n, {auto('t')} AS k, {LETTER_BITS.format('t')} AS m FROM (SELECT token, translate(token, '{ACCENTED}', '{STAND_INS}') AS t FROM q),
        (SELECT unnest([-2, -1, 0, 1, 2]) AS d) WHERE abs(d) <= {auto('t')}),
      b AS MATERIALIZED (SELECT term, u, length(u) AS n, {LETTER_BITS.format('u')} AS w FROM (SELECT term, translate(term, '{ACCENTED}', '{STAND_INS}') AS u FROM v))
    SELECT token, term, distance FROM (SELECT token, term, CAST({osa('t', 'u')} AS INT) AS distance FROM a JOIN b
      USING (n) WHERE bit_count(xor(m, w)) <= 2 * k AND damerau_levenshtein(t, u) <= k)
    WHERE distance <= {auto('token')}""")
def fuzzy_terms(spark, sf_dir):
    """Every word of the benchmark texts against the whole vocabulary of the documents."""
    index = m.document_index(spark, sf_dir)
    tokens = m.table(spark, sf_dir, "benchmark").select(
        F.lit("document").alias("entity_type_id"), F.lit("text").alias("property_id"),
        F.explode(text.standard_tokens(F.col("text"))).alias("token"))
    return expand(tokens, index.signatures).select("token", "term", "distance")


@query("D4_phrase_search", f"""
    WITH {part_tok(kind=False)}, {BM25},
      w AS (SELECT CAST(p_partkey AS VARCHAR) AS doc_id, {words('p_name')} AS t FROM part),
      ph AS (SELECT doc_id, len(list_filter(range(1, len(t)), lambda i: t[i] = 'red' AND t[i+1] = 'widget')) AS f FROM w)
    SELECT set_id AS search_id, doc_id,
      round((SELECT sum(i) FROM (SELECT DISTINCT term, idf AS i FROM sc WHERE term IN ('red', 'widget')))
        * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len / (SELECT al FROM fs))), 6) AS score
    FROM ph JOIN len USING (doc_id) JOIN {PART_SET} USING (doc_id) WHERE f > 0""")
def phrase_search(spark, sf_dir):
    req = m.requests(m.sets_of(spark, sf_dir, "part", "p_brand", "part"), PART_FIELDS, constraints=[simple('"Red Widget"')])
    return hits(req, m.part_index(spark, sf_dir))


@query("D5_advanced_search", f"""
    WITH {part_tok(kind=False)}, {BM25}
    SELECT set_id AS search_id, doc_id, round(sum(s) FILTER (term IN ('red', 'widget', 'gear')), 6) AS score
    FROM sc JOIN {PART_SET} USING (doc_id) GROUP BY ALL HAVING count_if(term = 'red') > 0""")
def advanced_search(spark, sf_dir):
    """Name must hold "red"; "widget gear" only adds score; the unauthorised brand term is dropped."""
    req = m.requests(
        m.sets_of(spark, sf_dir, "part", "p_brand", "part"), PART_FIELDS, constraints=[{"search_type": "advanced"}],
        details=[(0, 0, 0, "p_name", "red", True), (0, 0, 1, "p_name", "widget gear", False), (0, 0, 2, "p_brand", "none", True)])
    return hits(req, m.part_index(spark, sf_dir))


def _field_tokens(index, searches, property_id, term):
    """Tokens of one term on one property, for every search."""
    req = m.requests(searches, [property_id], constraints=[simple(term)])
    clauses = materialize(text_clauses(req, live_searches(req), index.property_types), "clauses")
    return P.query_tokens(clauses, index.phonetic)


@query("D6_all_tokens", f"""
    WITH {DOC_TOK}, {BM25}
    SELECT set_id AS search_id, doc_id, round(sum(s), 6) AS score FROM sc JOIN {DOC_SET} USING (doc_id)
    WHERE property_id = 'text' AND term IN ('the', 'and') GROUP BY ALL HAVING count(*) = 2""")
def all_tokens(spark, sf_dir):
    index = m.document_index(spark, sf_dir)
    searches = m.sets_of(spark, sf_dir, "documents", "source", "document")
    tokens = _field_tokens(index, searches, "text", "and The")
    return P.all_tokens(P.term_matches(tokens, index, None), tokens, ["search_id"], None).select(
        "search_id", "doc_id", F.round("score", 6).alias("score"))


@query("D7_fuzzy_all_tokens", f"""
    WITH {part_tok(kind=False)}, {BM25}, q(token, k) AS (VALUES ('smal', 1), ('rign', 1)),
      m AS (SELECT doc_id, token, max(idf * (1 - (CASE WHEN term = token THEN 0 ELSE 1 END) / least(length(token), length(term))) * tfn) AS s
        FROM sc JOIN q ON damerau_levenshtein(token, term) <= k GROUP BY ALL)
    SELECT set_id AS search_id, doc_id, round(sum(s), 6) AS score FROM m JOIN {PART_SET} USING (doc_id)
    GROUP BY ALL HAVING count(*) = 2""")
def fuzzy_all_tokens(spark, sf_dir):
    index = m.part_index(spark, sf_dir)
    searches = m.sets_of(spark, sf_dir, "part", "p_brand", "part")
    tokens = _field_tokens(index, searches, "p_name", "smal rign").withColumnRenamed("term", "token")
    return P.all_tokens(P.fuzzy_matches(tokens, index, None), tokens, ["search_id"], None).select(
        "search_id", "doc_id", F.round("score", 6).alias("score"))


# --- geography and time -----------------------------------------------------------

SUPPLIER_LAT = "(CAST(s_suppkey * 53 % 1700 AS DOUBLE) / 10 - 85)"
SUPPLIER_LON = "(CAST(s_suppkey * 101 % 3400 AS DOUBLE) / 10 - 170)"


def _supplier_searches(spark, sf_dir):
    """A search per supplier and customer segment its nation's customers are in."""
    supplier = m.table(spark, sf_dir, "supplier")
    segments = m.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("s_nationkey"), F.col("c_mktsegment").alias("entity_set_id")).distinct()
    return supplier.join(segments, "s_nationkey").select(
        "*", F.concat_ws("/", F.col("s_suppkey").cast("string"), "entity_set_id").alias("search_id"),
        F.lit("customer").alias("entity_type_id"),
        F.expr(SUPPLIER_LAT).alias("s_lat"), F.expr(SUPPLIER_LON).alias("s_lon"))


SUPPLIER_SEARCH = f"""
    s AS (SELECT s_suppkey || '/' || entity_set_id AS search_id, entity_set_id, s_acctbal, {SUPPLIER_LAT} AS s_lat, {SUPPLIER_LON} AS s_lon
      FROM supplier JOIN (SELECT DISTINCT c_nationkey, c_mktsegment AS entity_set_id FROM customer) ON s_nationkey = c_nationkey)"""


def constraint_rows(searches, **columns):
    given = {"group_no": F.lit(0), "constraint_no": F.lit(0), "fuzzy": F.lit(False), "search_id": F.col("search_id"), **columns}
    return searches.select(*[
        (given[f.name] if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in m.schemas.CONSTRAINTS])


@query("D8_geo_distance", f"""
    WITH {SUPPLIER_SEARCH}, c AS (SELECT CAST(c_custkey AS VARCHAR) AS doc_id, c_mktsegment, {LAT} AS lat, {LON} AS lon FROM customer)
    SELECT search_id, doc_id FROM s JOIN c ON c_mktsegment = entity_set_id
    WHERE {haversine('lat', 'lon', 's_lat', 's_lon')} <= abs(s_acctbal) / 4 * 1609.344""")
def geo_distance(spark, sf_dir):
    """Customers within a quarter of the balance, in miles, of each supplier."""
    searches = _supplier_searches(spark, sf_dir)
    rows = constraint_rows(
        searches, search_type=F.lit("geoDistance"), property_id=F.lit("location"), lat=F.col("s_lat"), lon=F.col("s_lon"),
        radius=F.abs("s_acctbal") / 4, unit=F.lit("MILES"))
    req = m.requests(searches, CUSTOMER_FIELDS, constraint_rows=rows)
    return hits(req, m.customer_index(spark, sf_dir), scored=False)


def _zone():
    corners = [(-1.0, -0.5), (1.0, -0.3), (0.8, 1.0), (-0.6, 0.7)]
    return F.array(F.array(*[
        F.array(F.col("s_lon") + F.lit(x) * F.col("half"), F.col("s_lat") + F.lit(y) * F.col("half") / 2) for x, y in corners]))


@query("D9_geo_polygon", f"""
    WITH {SUPPLIER_SEARCH}, c AS (SELECT CAST(c_custkey AS VARCHAR) AS doc_id, c_mktsegment, {LAT} AS lat, {LON} AS lon FROM customer),
      h AS (SELECT *, 2 + abs(s_acctbal) / 500 AS half FROM s),
      z AS (SELECT search_id, entity_set_id, [s_lon - half, s_lon + half, s_lon + 0.8 * half, s_lon - 0.6 * half, s_lon - half] AS xs,
        [s_lat - 0.5 * half / 2, s_lat - 0.3 * half / 2, s_lat + half / 2, s_lat + 0.7 * half / 2, s_lat - 0.5 * half / 2] AS ys FROM h),
      e AS (SELECT search_id, entity_set_id, xs[i] AS x1, ys[i] AS y1, xs[i+1] AS x2, ys[i+1] AS y2 FROM (SELECT *, unnest([1,2,3,4]) AS i FROM z))
    SELECT search_id, doc_id FROM e JOIN c ON c_mktsegment = entity_set_id
    WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1""")
def geo_polygon(spark, sf_dir):
    """Customers inside a quadrilateral around each supplier."""
    searches = _supplier_searches(spark, sf_dir).withColumn("half", 2 + F.abs("s_acctbal") / 500)
    rows = constraint_rows(searches, search_type=F.lit("geoPolygon"), property_id=F.lit("location"), zones=_zone())
    req = m.requests(searches, CUSTOMER_FIELDS, constraint_rows=rows)
    return hits(req, m.customer_index(spark, sf_dir), scored=False)


@query("D10_write_time", """
    SELECT event_type AS search_id, CAST(event_id AS VARCHAR) AS doc_id FROM events
    WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20 12:00:00'""")
def write_time(spark, sf_dir):
    req = m.requests(
        m.sets_of(spark, sf_dir, "events", "event_type", "event"), ["value"],
        constraints=[{"search_type": "writeDateTimeFilter", "start_date": "2024-01-05T00:00:00", "end_date": "2024-01-20T12:00:00"}])
    return hits(req, m.event_index(spark, sf_dir), scored=False)


# --- presence and equality ----------------------------------------------------------


def _docs(spark, sf_dir):
    return m.customer_index(spark, sf_dir).elements.select("doc_id", "entity_set_id", "elem_entity_set_id")


@query("D11_exact_term", f"WITH {ELEMENTS} SELECT doc_id FROM el WHERE set_id = 'BUILDING'")
def exact_term(spark, sf_dir):
    return _docs(spark, sf_dir).where(F.col("entity_set_id") == "BUILDING").select("doc_id")


@query("D12_exists", f"WITH {ELEMENTS} SELECT doc_id FROM el WHERE set_id IS NOT NULL")
def exists(spark, sf_dir):
    return _docs(spark, sf_dir).where(F.col("entity_set_id").isNotNull()).select("doc_id")


@query("D13_not_exists", f"WITH {ELEMENTS} SELECT DISTINCT doc_id FROM el WHERE set_id IS NULL")
def not_exists(spark, sf_dir):
    return _docs(spark, sf_dir).where(F.col("entity_set_id").isNull()).select("doc_id").distinct()


# --- composition over linked customers ------------------------------------------------


def _linking_searches(spark, sf_dir):
    """A search per nation over the linking set of all segments."""
    nation = m.table(spark, sf_dir, "nation")
    return nation.select(
        F.col("n_nationkey").cast("string").alias("search_id"), F.lit("linking").alias("entity_set_id"),
        F.lit("customer").alias("entity_type_id"), F.lit(True).alias("linking"))


def linking_sets(searches, *sets):
    return searches.select("search_id", F.explode(F.array(*[F.lit(s) for s in sets])).alias("normal_entity_set_id"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _composed(spark, sf_dir, groups, placed, sets=SEGMENTS):
    """Advanced constraints (group, number, property, term); term None is the nation's number."""
    searches = _linking_searches(spark, sf_dir)
    details = searches.select("search_id", F.inline(F.array(*[
        F.struct(F.lit(g).alias("group_no"), F.lit(n).alias("constraint_no"), F.lit(0).alias("detail_no"),
                 F.lit(p).alias("property_id"), (F.col("search_id") if t is None else F.lit(t)).alias("search_term"),
                 F.lit(True).alias("exact_match")) for g, n, p, t in placed])))
    req = m.requests(
        searches, CUSTOMER_FIELDS, groups=groups,
        constraints=[{"search_type": "advanced", "group_no": g, "constraint_no": n} for g, n, *_ in placed],
        detail_rows=details, linking=linking_sets(searches, *sets))
    return hits(req, m.customer_index(spark, sf_dir), scored=False)


NATIONS = "(SELECT n_nationkey, CAST(n_nationkey AS VARCHAR) AS search_id FROM nation)"


@query("D14_same_element", f"""
    WITH {ELEMENTS} SELECT DISTINCT search_id, doc_id FROM el, {NATIONS}
    WHERE set_id IS NULL AND c_nationkey = n_nationkey AND eset = 'BUILDING'""")
def same_element(spark, sf_dir):
    return _composed(spark, sf_dir, [(0, 2)], [(0, 0, "c_nationkey", None), (0, 1, "segment", "BUILDING")])


@query("D15_minimum_matches", f"""
    WITH {ELEMENTS} SELECT DISTINCT search_id, doc_id FROM el, {NATIONS} WHERE set_id IS NULL
    AND CAST(c_nationkey = n_nationkey AS INT) + CAST(eset = 'BUILDING' AS INT) + CAST(c_nationkey = 7 AS INT) >= 2""")
def minimum_matches(spark, sf_dir):
    return _composed(spark, sf_dir, [(0, 2)], [
        (0, 0, "c_nationkey", None), (0, 1, "segment", "BUILDING"), (0, 2, "c_nationkey", "7")])


@query("D16_boolean_composition", f"""
    WITH {ELEMENTS} SELECT search_id, doc_id FROM el, {NATIONS} WHERE set_id IS NULL GROUP BY ALL
    HAVING count_if(c_nationkey = n_nationkey) > 0 AND count_if(eset = 'BUILDING' OR eset = 'MACHINERY') > 0""")
def boolean_composition(spark, sf_dir):
    """The nation in one element and one of two segments in any element."""
    return _composed(spark, sf_dir, [(0, 1), (1, 0)], [
        (0, 0, "c_nationkey", None), (1, 0, "segment", "BUILDING"), (1, 1, "segment", "MACHINERY")])


@query("D17_allowed_ids", """
    SELECT DISTINCT 'orders of ' || o_orderpriority AS search_id, CAST(c_custkey AS VARCHAR) AS doc_id
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'""")
def allowed_ids(spark, sf_dir):
    """Customers of one segment, cut to the ids each caller may see."""
    acl = m.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("orders of "), "o_orderpriority").alias("search_id"),
        F.array(F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("acl_key"))
    customers = m.table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    searches = acl.select("search_id").distinct().withColumn("c_mktsegment", F.lit("BUILDING"))
    found = lookup_join(customers, searches, ["c_mktsegment"], ["c_custkey"]).select(
        "search_id", F.col("c_custkey").cast("string").alias("doc_id"))
    return only_allowed(found, acl)


@query("D18_name_patterns", f"""
    SELECT q AS search_id, CAST(p_partkey AS VARCHAR) AS doc_id FROM part,
      (VALUES ('a', '13', 'wid|bol'), ('b', 'ran', 'gi.m'), ('c', 'Brand', 'red')) v(q, ns, nm)
    WHERE len(list_filter({words('p_brand')}, lambda t: regexp_full_match(t, '.*' || ns || '.*'))) > 0
      AND len(list_filter({words('p_name')}, lambda t: regexp_full_match(t, '.*' || nm || '.*'))) > 0""")
def name_patterns(spark, sf_dir):
    asked = local_table(spark, [("a", "part", "13", "wid|bol", 0, 10), ("b", "part", "ran", "gi.m", 0, 10),
                                ("c", "part", "Brand", "red", 0, 10), ("d", "part", "ran", "(", 0, 10)], NAME_SEARCH)
    names = m.table(spark, sf_dir, "part").select(
        F.lit("part").alias("kind"), F.col("p_partkey").cast("string").alias("doc_id"),
        F.col("p_brand").alias("namespace"), F.col("p_name").alias("name"))
    return name_hits(names, asked).select("search_id", "doc_id")


@query("D19_lenient_typed_match", f"""
    WITH t(term) AS (VALUES ('7'), ('2547.4'), ('building'), ('BUILDING'), ('1e1'))
    SELECT term || '/' || c_mktsegment AS search_id, CAST(c_custkey AS VARCHAR) AS doc_id FROM customer, t
    WHERE c_nationkey = TRY_CAST(regexp_extract(term, '^[0-9]+$') AS INT) OR c_acctbal = TRY_CAST(term AS DOUBLE) OR c_mktsegment = term""")
def lenient_typed_match(spark, sf_dir):
    """One text against text, number and point properties; what does not parse does not match."""
    searches = m.sets_of(spark, sf_dir, "customer", "c_mktsegment", "customer").withColumn(
        "term", F.explode(F.array(*[F.lit(t) for t in ("7", "2547.4", "building", "BUILDING", "1e1")]))
    ).withColumn("search_id", F.concat_ws("/", "term", "entity_set_id"))
    rows = constraint_rows(searches, search_type=F.lit("simple"), search_term=F.col("term"))
    return hits(m.requests(searches, CUSTOMER_FIELDS, constraint_rows=rows), m.customer_index(spark, sf_dir), scored=False)


@query("D20_property_authorisation", f"""
    WITH {part_tok(kind_standard=True)}
    SELECT DISTINCT set_id AS search_id, doc_id FROM tok JOIN {PART_SET} USING (doc_id)
    WHERE term = 'small' AND (property_id = 'p_name') = (set_id < 'Brand#2')""")
def property_authorisation(spark, sf_dir):
    """Names may be searched in some brands, types in the others."""
    searches = m.sets_of(spark, sf_dir, "part", "p_brand", "part")
    allowed = searches.select("search_id", F.when(F.col("search_id") < "Brand#2", "p_name").otherwise("p_type").alias("property_id"))
    req = m.requests(searches, allowed, constraints=[simple("small")])
    return hits(req, m.part_index(spark, sf_dir, kind=STANDARD), scored=False)


@query("D21_fail_closed", """
    SELECT c_mktsegment AS search_id, CAST(count_if(c_mktsegment IN ('BUILDING', 'FURNITURE') AND c_nationkey = 7) AS BIGINT) AS n_hits
    FROM customer GROUP BY ALL""")
def fail_closed(spark, sf_dir):
    """Some sets without authorised properties, some whose second group loses its only constraint."""
    searches = m.sets_of(spark, sf_dir, "customer", "c_mktsegment", "customer")
    fields = F.when(F.col("search_id") == "MACHINERY", F.array().cast("array<string>")).when(
        F.col("search_id").isin("BUILDING", "FURNITURE"), F.array(F.lit("c_nationkey"), F.lit("location"))
    ).otherwise(F.array(F.lit("c_nationkey")))
    allowed = searches.select("search_id", F.explode(fields).alias("property_id"))
    zone = [[-180.0, -90.5], [180.0, -90.5], [180.0, 90.0], [-180.0, 90.0]]
    req = m.requests(searches, allowed, groups=[(0, 1), (1, 1)], constraints=[
        simple("7"), {"search_type": "geoPolygon", "group_no": 1, "constraint_no": 1, "property_id": "location", "zones": [zone]}])
    found = find(req, m.customer_index(spark, sf_dir)).groupBy("search_id").agg(F.count(F.lit(1)).alias("n"))
    return searches.select("search_id").join(found, "search_id", "left").select(
        "search_id", F.coalesce("n", F.lit(0)).alias("n_hits"))


@query("D22_entity_set_scope", f"""
    WITH {ELEMENTS}
    SELECT DISTINCT 'linking' AS search_id, doc_id FROM el WHERE set_id IS NULL AND eset IN ('BUILDING', 'MACHINERY')
      AND doc_id IN (SELECT doc_id FROM el WHERE set_id IS NULL AND c_nationkey = 3)
    UNION ALL SELECT set_id, doc_id FROM el WHERE set_id IS NOT NULL AND c_nationkey = 3""")
def entity_set_scope(spark, sf_dir):
    """The same question to every normal set and to a linking set of two of them."""
    normal = m.sets_of(spark, sf_dir, "customer", "c_mktsegment", "customer").withColumn("linking", F.lit(False))
    linked = local_table(spark, [("linking", "linking", "customer", True)], m.T.StructType(
        [m.T.StructField(n, m.T.StringType()) for n in ("entity_set_id", "search_id", "entity_type_id")]
        + [m.T.StructField("linking", m.T.BooleanType())]))
    searches = normal.unionByName(linked)
    req = m.requests(searches, ["c_nationkey"], constraints=[simple("3")],
                     linking=linking_sets(linked, "BUILDING", "MACHINERY"))
    return hits(req, m.customer_index(spark, sf_dir), scored=False)


@query("D23_nested_ids", """
    WITH sets AS (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY ALL),
      asked AS (SELECT DISTINCT o_orderkey AS q, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        WHERE o_orderstatus = 'P' AND l_linenumber <= 2)
    SELECT CAST(q AS VARCHAR) AS search_id, CAST(l_orderkey AS VARCHAR) AS entity_set_id FROM asked JOIN sets USING (l_partkey)
    GROUP BY q, l_orderkey HAVING count(*) = (SELECT count(*) FROM asked a WHERE a.q = asked.q)""")
def nested_ids(spark, sf_dir):
    """For each pending order, the orders that list all of its first two parts."""
    sets = materialize(m.order_sets(spark, sf_dir), "order_sets").select("entity_set_id", "property_ids", "description")
    lines, orders = m.table(spark, sf_dir, "lineitem"), m.table(spark, sf_dir, "orders")
    asked = lines.where("l_linenumber <= 2").join(
        orders.where("o_orderstatus = 'P'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi"
    ).groupBy(F.col("l_orderkey").cast("string").alias("search_id")).agg(
        F.collect_set(F.col("l_partkey").cast("string")).alias("property_ids"))
    return P.lists_with_all(asked, sets)


@query("D24_whole_set", """
    SELECT c_mktsegment AS search_id, CAST(c_custkey AS VARCHAR) AS doc_id FROM customer""")
def whole_set(spark, sf_dir):
    req = m.requests(m.sets_of(spark, sf_dir, "customer", "c_mktsegment", "customer"), CUSTOMER_FIELDS, groups=[])
    return hits(req, m.customer_index(spark, sf_dir), scored=False)
