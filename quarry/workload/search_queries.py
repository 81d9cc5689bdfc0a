"""F: the searches a user calls. J: relational queries over property tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text
from quarry.functions.text import METAPHONE, STANDARD
from quarry.operators.ingest import long_values
from quarry.operators.typing_ops import type_values
from quarry.plans import catalog_search as cs
from quarry.plans import property_tables as pt
from quarry.plans.blocking import block
from quarry.plans.entity_search import explained, search
from quarry.scale import local_table, materialize, shared_path
from quarry.workload import model as m
from quarry.workload.ingesting import saved_objects
from quarry.workload.predicate_queries import (
    CUSTOMER_FIELDS, DOCUMENT_FIELDS, PART_FIELDS, SEGMENTS, constraint_rows, linking_sets, simple,
)
from quarry.workload.registry import query
from quarry.workload.sql import (
    BM25, CUSTOMER_TOK, DOC_SET, DOC_TOK, ELEMENTS, auto, haversine, letters, osa, part_tok, words,
)
from quarry.workload.typing_and_text import CODE_TABLE, PHONETIC_TOK


def _page(source: str, size: int, start: int = 0) -> str:
    return f"""
      r AS (SELECT *, row_number() OVER (PARTITION BY search_id ORDER BY score DESC, doc_id) AS rn,
        count(*) OVER (PARTITION BY search_id) AS total_hits FROM {source}),
      p AS (SELECT search_id, CAST(rn AS INT) AS rn, doc_id, score, total_hits FROM r WHERE rn > {start} AND rn <= {start + size})"""


# --- entity search ----------------------------------------------------------------


@query("F1_entity_search", f"""
    WITH {DOC_TOK}, {BM25},
      g0 AS (SELECT doc_id, sum(s) AS s FROM sc WHERE property_id = 'text' AND term IN ('the', 'que', 'und') GROUP BY ALL),
      w AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(list_contains({words('text')}, 'que') AS INT)
        + CAST(n_chars = 416 AS INT) + CAST(lang IN ('en', 'fr') AS INT) AS n FROM documents),
      l AS (SELECT doc_id, max(s) AS s FROM sc WHERE property_id = 'lang' AND term IN ('en', 'fr') GROUP BY ALL),
      q AS (SELECT doc_id, sum(s) AS s FROM sc WHERE property_id = 'text' AND term = 'que' GROUP BY ALL),
      h AS (SELECT set_id AS search_id, doc_id, round(g0.s + coalesce(l.s, 0) + coalesce(q.s, 0) + CAST(n_chars = 416 AS INT), 6) AS score
        FROM g0 JOIN {DOC_SET} USING (doc_id) JOIN w USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN q USING (doc_id) WHERE n >= 1),
      {_page('h', 7)}
    SELECT search_id, rn, doc_id, score, total_hits FROM p""")
def entity_search(spark, sf_dir):
    """Every source at once: some of three words, and a language, a length or a word."""
    req = m.requests(
        m.sets_of(spark, sf_dir, "documents", "source", "document").withColumn("max_hits", F.lit(7)),
        DOCUMENT_FIELDS, groups=[(0, 1), (1, 1)],
        constraints=[simple("the QUE und"), {"search_type": "advanced", "group_no": 1, "constraint_no": 0},
                     simple("416", 1, 1), {"search_type": "advanced", "group_no": 1, "constraint_no": 2}],
        details=[(1, 0, 0, "lang", "en", False), (1, 0, 1, "lang", "fr", False), (1, 2, 0, "text", "que", True)])
    return search(req, m.document_index(spark, sf_dir)).select("search_id", "rn", "doc_id", "score", "total_hits")


@query("E13_explain_search", f"""
    WITH {part_tok(kind_standard=True)}, {BM25},
      f AS (SELECT doc_id, property_id, sum(s) AS fs FROM sc WHERE term IN ('small', 'ring') GROUP BY ALL),
      b AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY fs DESC, property_id DESC) = 1),
      h AS (SELECT p_brand AS search_id, doc_id, round(fs, 6) AS score FROM b JOIN part ON CAST(p_partkey AS VARCHAR) = doc_id),
      {_page('h', 10)}
    SELECT search_id, rn, doc_id, score, property_id, term, CAST(tf AS BIGINT) AS tf, CAST(len AS BIGINT) AS len, CAST(df AS BIGINT) AS df,
      CAST(n AS BIGINT) AS n_elements, round(al, 6) AS avg_len, round(s, 6) AS contribution
    FROM p JOIN b USING (doc_id) JOIN sc USING (doc_id, property_id) WHERE term IN ('small', 'ring')""")
def explain_search(spark, sf_dir):
    """Why each hit of a page has its score: only the better of name and type counts."""
    searches = m.sets_of(spark, sf_dir, "part", "p_brand", "part").withColumn("max_hits", F.lit(10))
    req = m.requests(searches, PART_FIELDS, constraints=[simple("small ring")])
    return explained(req, m.part_index(spark, sf_dir, kind=STANDARD)).select(
        "search_id", "rn", "doc_id", "score", "property_id", "term", "tf", "len", "df", "n_elements",
        F.round("avg_len", 6).alias("avg_len"), F.round("contribution", 6).alias("contribution"))


NATION_ROWS = "(SELECT CAST(n_nationkey AS VARCHAR) AS search_id, n_nationkey FROM nation)"


@query("F1_linked_entity_search", f"""
    WITH {ELEMENTS}, {CUSTOMER_TOK}, {BM25},
      seg AS (SELECT doc_id, ord, s FROM sc WHERE property_id = 'segment' AND term = 'BUILDING'),
      e AS (SELECT el.*, search_id, CAST(c_nationkey = n_nationkey AS INT) AS a,
          CAST({haversine('lat', 'lon', '10.0', '20.0')} <= 6000000 AS INT) AS b, coalesce(seg.s, 0) AS s, CAST(seg.s IS NOT NULL AS INT) AS c
        FROM el LEFT JOIN seg USING (doc_id, ord), {NATION_ROWS} WHERE set_id IS NULL),
      g AS (SELECT search_id, doc_id, sum(a + b + s) FILTER (a + b + c >= 2) AS g0,
          sum(1) FILTER (last_write > TIMESTAMP '2024-01-01 00:05:00') AS g1 FROM e GROUP BY ALL),
      h AS (SELECT search_id, doc_id, round(g0 + g1, 6) AS score FROM g WHERE g0 IS NOT NULL AND g1 IS NOT NULL),
      {_page('h', 5)}
    SELECT search_id, rn, doc_id, score, total_hits FROM p""")
def linked_entity_search(spark, sf_dir):
    """Per nation: two of nation, circle and segment on one element; a recent element anywhere."""
    searches = m.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("search_id"), F.lit("linking").alias("entity_set_id"),
        F.lit("customer").alias("entity_type_id"), F.lit(True).alias("linking"), F.lit(5).alias("max_hits"))
    details = searches.select("search_id", F.inline(F.array(*[
        F.struct(F.lit(0).alias("group_no"), F.lit(n).alias("constraint_no"), F.lit(0).alias("detail_no"),
                 F.lit(p).alias("property_id"), t.alias("search_term"), F.lit(exact).alias("exact_match"))
        for n, p, t, exact in [(0, "c_nationkey", F.col("search_id"), True), (2, "segment", F.lit("BUILDING"), False)]])))
    req = m.requests(
        searches, CUSTOMER_FIELDS, groups=[(0, 2), (1, 1)], detail_rows=details, linking=linking_sets(searches, *SEGMENTS),
        constraints=[
            {"search_type": "advanced"},
            {"search_type": "geoDistance", "constraint_no": 1, "property_id": "location", "lat": 10.0, "lon": 20.0,
             "radius": 6000.0, "unit": "KILOMETERS"},
            {"search_type": "advanced", "constraint_no": 2},
            {"search_type": "writeDateTimeFilter", "group_no": 1, "constraint_no": 0, "start_date": "2024-01-01T00:05:00"}])
    return search(req, m.customer_index(spark, sf_dir)).select("search_id", "rn", "doc_id", "score", "total_hits")


@query("F1_phonetic_fuzzy_search", f"""
    WITH {CODE_TABLE}, {PHONETIC_TOK},
      tf AS (SELECT doc_id, set_id, term, count(*) AS tf FROM ptok GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
      fs AS (SELECT count(*) AS n, avg(len(t)) AS al FROM w WHERE len(t) > 0),
      sc AS (SELECT tf.doc_id, tf.set_id, term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf, tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / al)) AS tfn
        FROM tf JOIN w USING (doc_id) JOIN df USING (term), fs),
      -- Misspelt words meet all vocabulary within their edits; heard ones their words, pairs and codes.
      near AS (SELECT q AS tok, term, idf * (1 - d / least(length(q), length(term))) * tfn AS s, doc_id, set_id FROM
        (SELECT *, {osa('q', 'term')} AS d FROM sc, (VALUES ('rad'), ('wigit')) v(q) WHERE abs(length(q) - length(term)) <= 2) WHERE d <= {auto('q')}),
      heard AS (SELECT tok, term, idf * tfn AS s, doc_id, set_id FROM sc JOIN
        (VALUES ('0', 'bloo'), ('0', 'bloogere'), ('0', 'BL'), ('0', 'BLJR'), ('1', 'gere'), ('1', 'JR')) v(tok, term) USING (term)),
      m AS (SELECT doc_id, set_id, tok, max(s) AS s FROM (SELECT * FROM near UNION ALL SELECT * FROM heard) GROUP BY ALL),
      h AS (SELECT set_id AS search_id, doc_id, round(sum(s), 6) AS score FROM m GROUP BY ALL), {_page('h', 10)}
    SELECT * FROM p""")
def phonetic_fuzzy_search(spark, sf_dir):
    """Misspelt words against names indexed with their phonetic codes."""
    req = m.requests(m.sets_of(spark, sf_dir, "part", "p_brand", "part"), ["p_name"],
                     constraints=[simple("rad wigit", fuzzy=True), simple("bloo gere", 0, 1)])
    return search(req, m.part_index(spark, sf_dir, name=METAPHONE)).select("search_id", "rn", "doc_id", "score", "total_hits")


@query("F1_search_table", f"""
    WITH {DOC_TOK}, {BM25},
      q AS (SELECT DISTINCT item_id, 'src' || (item_id % 20) AS set_id, unnest({words('text')}) AS term FROM benchmark),
      h AS (SELECT item_id || '/' || term AS search_id, doc_id, round(s, 6) AS score FROM sc JOIN {DOC_SET} USING (doc_id)
        JOIN q USING (set_id, term) WHERE property_id = 'text'), {_page('h', 3)}
    SELECT search_id, rn, doc_id, score, total_hits FROM p""")
def search_table(spark, sf_dir):
    """Every benchmark text asks one source for each of its words: thousands of searches in one plan."""
    searches = m.table(spark, sf_dir, "benchmark").select(
        "item_id", F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string")).alias("entity_set_id"),
        F.explode(F.array_distinct(text.standard_tokens(F.col("text")))).alias("term"),
    ).select(
        F.concat_ws("/", F.col("item_id").cast("string"), "term").alias("search_id"), "entity_set_id",
        F.lit("document").alias("entity_type_id"), F.lit(3).alias("max_hits"), "term")
    rows = constraint_rows(searches, search_type=F.lit("simple"), search_term=F.col("term"))
    req = m.requests(searches, ["text"], constraint_rows=rows)
    return search(req, m.document_index(spark, sf_dir)).select("search_id", "rn", "doc_id", "score", "total_hits")


# --- blocking ------------------------------------------------------------------------


def _part_blocks(spark, sf_dir, analyzer):
    part = m.table(spark, sf_dir, "part")
    props = m.part_properties(spark, analyzer)
    values = long_values(part, {"p_name": F.col("p_name")}, m.normal_keys("part", F.col("p_partkey"), F.col("p_brand")))
    blocks = part.select(
        F.col("p_partkey").cast("string").alias("block_id"), F.lit("part").alias("entity_type_id"),
        F.lit("p_name").alias("property_id"), F.col("p_name").alias("term"))
    return blocks, type_values(values, props), props


@query("F2_blocking", f"""
    WITH {part_tok(kind=False)}, {BM25},
      q AS (SELECT p_name, unnest({words('p_name')}) AS token FROM (SELECT DISTINCT p_name FROM part)),
      v AS (SELECT DISTINCT term FROM sc), k AS (SELECT DISTINCT token FROM q),
      x AS (SELECT token, term, damerau_levenshtein(token, term) AS d FROM k JOIN v ON damerau_levenshtein(token, term) <=
        CASE WHEN length(token) < 3 THEN 0 WHEN length(token) <= 5 THEN 1 ELSE 2 END),
      t AS (SELECT q.p_name, doc_id, token, max(idf * (1 - d / least(length(token), length(term))) * tfn) AS s
        FROM q JOIN x USING (token) JOIN sc USING (term) GROUP BY ALL),
      n AS (SELECT p_name, count(*) AS n FROM q GROUP BY ALL),
      h AS (SELECT p_name, doc_id, round(sum(s), 6) AS score FROM t JOIN n USING (p_name) GROUP BY p_name, doc_id, n HAVING count(*) = n),
      r AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY score DESC, doc_id) AS rn FROM h)
    SELECT CAST(p.p_partkey AS VARCHAR) AS block_id, CAST(rn AS INT) AS rn, o.p_brand AS entity_set_id, doc_id, score
    FROM part p JOIN r USING (p_name) JOIN part o ON CAST(o.p_partkey AS VARCHAR) = doc_id WHERE rn <= 5""")
def blocking(spark, sf_dir):
    """Every part asks for the parts whose name holds all its words, misspelt or not; best five."""
    return block(*_part_blocks(spark, sf_dir, STANDARD), size=5)


@query("F2_blocking_phonetic", f"""
    WITH {CODE_TABLE}, {PHONETIC_TOK},
      len AS (SELECT doc_id, len(t) AS len FROM w), fs AS (SELECT count(*) AS n, avg(len) AS al FROM len WHERE len > 0),
      tf AS (SELECT doc_id, term, count(*) AS tf FROM ptok GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
      sc AS (SELECT doc_id, term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf, tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / al)) AS tfn
        FROM tf JOIN len USING (doc_id) JOIN df USING (term), fs),
      q AS (SELECT p_name, unnest({letters('p_name')}) AS token FROM (SELECT DISTINCT p_name FROM part)),
      k AS (SELECT DISTINCT token FROM q),
      x AS (SELECT token, term, min(d) AS d FROM (
          SELECT token, term, damerau_levenshtein(token, term) AS d FROM k, df WHERE damerau_levenshtein(token, term) <=
            CASE WHEN length(token) < 3 THEN 0 WHEN length(token) <= 5 THEN 1 ELSE 2 END
          UNION ALL SELECT token, code, 0 FROM k JOIN code ON code.term = token) GROUP BY ALL),
      t AS (SELECT q.p_name, doc_id, token, max(idf * (1 - d / least(length(token), length(term))) * tfn) AS s
        FROM q JOIN x USING (token) JOIN sc USING (term) GROUP BY ALL),
      n AS (SELECT p_name, count(*) AS n FROM q GROUP BY ALL),
      h AS (SELECT p_name, doc_id, round(sum(s), 6) AS score FROM t JOIN n USING (p_name) GROUP BY p_name, doc_id, n HAVING count(*) = n),
      r AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY score DESC, doc_id) AS rn FROM h)
    SELECT CAST(p.p_partkey AS VARCHAR) AS block_id, CAST(rn AS INT) AS rn, o.p_brand AS entity_set_id, doc_id, score
    FROM part p JOIN r USING (p_name) JOIN part o ON CAST(o.p_partkey AS VARCHAR) = doc_id WHERE rn <= 5""")
def blocking_phonetic(spark, sf_dir):
    return block(*_part_blocks(spark, sf_dir, METAPHONE), size=5)


@query("F2_blocking_customers", f"""
    WITH el AS (SELECT CAST(c_custkey AS VARCHAR) AS doc_id, '0' AS ord, c_name, c_mktsegment AS eset FROM customer), {CUSTOMER_TOK}, {BM25},
      h AS (SELECT c.c_custkey, sc.doc_id, round(sum(s), 6) AS score FROM customer c JOIN sc
          ON (property_id = 'segment' AND term = c_mktsegment) GROUP BY ALL),
      one AS (SELECT CAST(c_custkey AS VARCHAR) AS block_id, c_custkey, c_mktsegment FROM customer),
      r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY score DESC, doc_id) AS rn FROM h)
    SELECT block_id, CAST(rn AS INT) AS rn, o.c_mktsegment AS entity_set_id, r.doc_id, score
    FROM one JOIN r USING (c_custkey) JOIN customer o ON CAST(o.c_custkey AS VARCHAR) = r.doc_id WHERE rn <= 3""")
def blocking_customers(spark, sf_dir):
    """Every customer asks for its segment: five values held by a fifth of all rows each."""
    customer = m.table(spark, sf_dir, "customer")
    props = m.properties(spark, m.CUSTOMER_PROPERTIES)
    blocks = customer.select(
        F.col("c_custkey").cast("string").alias("block_id"), F.lit("customer").alias("entity_type_id"),
        F.lit("segment").alias("property_id"), F.col("c_mktsegment").alias("term"))
    return block(blocks, type_values(m.customer_values(spark, sf_dir), props), props, size=3)


@query("E13_explain_blocking", f"""
    WITH {part_tok(kind=False)}, {BM25},
      q AS (SELECT p_name, unnest({words('p_name')}) AS token FROM (SELECT DISTINCT p_name FROM part)),
      v AS (SELECT DISTINCT term FROM sc), k AS (SELECT DISTINCT token FROM q),
      x AS (SELECT token, term, damerau_levenshtein(token, term) AS d FROM k JOIN v ON damerau_levenshtein(token, term) <=
        CASE WHEN length(token) < 3 THEN 0 WHEN length(token) <= 5 THEN 1 ELSE 2 END),
      m AS (SELECT q.p_name, doc_id, token, term, d, tf, len, idf * (1 - d / least(length(token), length(term))) * tfn AS s
        FROM q JOIN x USING (token) JOIN sc USING (term)),
      t AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY p_name, doc_id, token ORDER BY s DESC, term DESC) = 1),
      n AS (SELECT p_name, count(*) AS n FROM q GROUP BY ALL),
      h AS (SELECT p_name, doc_id, round(sum(s), 6) AS score FROM t JOIN n USING (p_name) GROUP BY p_name, doc_id, n HAVING count(*) = n),
      r AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY score DESC, doc_id) AS rn FROM h)
    SELECT CAST(p.p_partkey AS VARCHAR) AS block_id, CAST(rn AS INT) AS rn, doc_id, score, token, term, CAST(d AS INT) AS distance,
      tf, CAST(len AS BIGINT) AS len, round(s, 6) AS contribution
    FROM part p JOIN r USING (p_name) JOIN t USING (p_name, doc_id) WHERE rn <= 5""")
def explain_blocking(spark, sf_dir):
    """Why each of the best five was found: the term that every word of the asked name met."""
    found = block(*_part_blocks(spark, sf_dir, STANDARD), size=5, explain=True)
    return found.select("block_id", "rn", "doc_id", "score", F.inline("why")).select(
        "block_id", "rn", "doc_id", "score", "token", "term", F.col("distance").cast("int").alias("distance"),
        F.col("tf").cast("long").alias("tf"), F.col("len").cast("long").alias("len"), F.round("contribution", 6).alias("contribution"))


# --- catalog --------------------------------------------------------------------------


def _objects(spark, sf_dir):
    return materialize(saved_objects(spark, sf_dir), "objects")


@query("F3_object_search", f"""
    WITH doc AS (SELECT CAST(p_partkey AS VARCHAR) AS doc_id, [CAST(p_partkey AS VARCHAR), p_name, p_type, p_name, p_brand] AS f FROM part),
      tok AS (SELECT doc_id, '0' AS ord, p AS property_id, unnest(regexp_extract_all(lower(v), '[a-z0-9]+')) AS term FROM
        (SELECT doc_id, unnest(f) AS v, unnest(['id', 'title', 'description', 'type.name', 'type.namespace']) AS p FROM doc)), {BM25},
      q(token, k) AS (VALUES ('widegt', 2), ('rde', 1)),
      x AS (SELECT token, doc_id, property_id, max(idf * (1 - damerau_levenshtein(token, term) / least(length(token), length(term))) * tfn) AS s
        FROM q JOIN sc ON damerau_levenshtein(token, term) <= k GROUP BY ALL),
      f AS (SELECT token, doc_id, max(s) AS s FROM x GROUP BY ALL),
      h AS (SELECT 'types' AS search_id, doc_id, round(sum(s), 6) AS score FROM f GROUP BY ALL), {_page('h', 20, 5)}
    SELECT search_id, rn, doc_id, score, total_hits, p_name AS title FROM p JOIN part ON CAST(p_partkey AS VARCHAR) = doc_id""")
def object_search(spark, sf_dir):
    """Entity types by misspelt words in any of their fields."""
    objects = _objects(spark, sf_dir)
    index = m.object_index(spark, sf_dir, lambda: objects)
    req = cs.object_requests(spark, [("types", "EntityType", "widegt rde", 5, 20)])
    return cs.object_search(req, index, objects).select(
        "search_id", "rn", "doc_id", "score", "total_hits", F.get_json_object("doc", "$.title").alias("title"))


# Objects of all other kinds, made of the smaller tables.
OTHER_OBJECTS = f"""
    doc AS (
      SELECT 'App' AS kind, c_mktsegment AS id, {{'id': [c_mktsegment], 'title': [max_by(c_name, c_custkey)], 'name': [c_mktsegment]}} AS f
        FROM customer WHERE c_acctbal >= 0 GROUP BY c_mktsegment),
    coll AS (
      SELECT 'EntityTypeCollection' AS kind, CAST(r_regionkey AS VARCHAR) AS id, r_name AS title, r_name AS type_name,
        list(CAST(n_nationkey AS VARCHAR)) AS t_id, list(n_name) AS t_name
        FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL),
    cell AS (
      SELECT kind, id, 'id' AS p, id AS v FROM doc UNION ALL SELECT kind, id, 'title', f.title[1] FROM doc UNION ALL SELECT kind, id, 'name', f.name[1] FROM doc
      UNION ALL SELECT kind, id, 'id', id FROM coll UNION ALL SELECT kind, id, 'title', title FROM coll UNION ALL SELECT kind, id, 'type.name', type_name FROM coll
      UNION ALL SELECT kind, id, 'template.id', unnest(t_id) FROM coll UNION ALL SELECT kind, id, 'template.name', unnest(t_name) FROM coll
      UNION ALL SELECT 'EntitySetCollection', CAST(n_nationkey AS VARCHAR), p, v FROM (SELECT n_nationkey,
        unnest(['id', 'name', 'contacts', 'contacts', 'organizationId']) AS p,
        unnest([CAST(n_nationkey AS VARCHAR), n_name, 'desk', r_name, CAST(r_regionkey AS VARCHAR)]) AS v
        FROM nation JOIN region ON n_regionkey = r_regionkey)),
    tok AS (SELECT kind || ' ' || id AS doc_id, '0' AS ord, kind || ' ' || p AS property_id, unnest({words('v')}) AS term FROM cell)"""


@query("F3_search_of_kinds", f"""
    WITH {OTHER_OBJECTS}, {BM25},
      q AS (SELECT DISTINCT 'App' AS kind, 'app ' || c_mktsegment AS search_id, lower(substr(c_mktsegment, 2)) AS token FROM customer
        UNION ALL SELECT kind, lower(kind) || ' ' || r_name, lower(split_part(substr(r_name, 2), ' ', 1)) FROM region,
          (VALUES ('EntityTypeCollection'), ('EntitySetCollection')) v(kind)
        UNION ALL SELECT 'EntityTypeCollection', 'nation ' || n_name, lower(split_part(n_name, ' ', 1)) FROM nation),
      x AS (SELECT search_id, doc_id, property_id, max(idf * (1 - damerau_levenshtein(token, term) / least(length(token), length(term))) * tfn) AS s
        FROM q JOIN sc ON starts_with(property_id, kind || ' ') AND damerau_levenshtein(token, term) <=
          CASE WHEN length(token) < 3 THEN 0 WHEN length(token) <= 5 THEN 1 ELSE 2 END GROUP BY ALL),
      h AS (SELECT search_id, split_part(doc_id, ' ', 2) AS doc_id, round(max(s), 6) AS score FROM x GROUP BY ALL), {_page('h', 4)}
    SELECT * FROM p""")
def search_of_kinds(spark, sf_dir):
    """Apps and collections, asked by a table of searches of several kinds at once."""
    region, nation = m.table(spark, sf_dir, "region"), m.table(spark, sf_dir, "nation")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    text_of = lambda c: F.col(c).cast("string")
    of_types = places.groupBy("r_regionkey", "r_name").agg(F.collect_list(
        F.struct(text_of("n_nationkey").alias("id"), F.col("n_name").alias("name"))).alias("template"))
    of_types = of_types.select(
        F.lit("EntityTypeCollection").alias("kind"), text_of("r_regionkey").alias("id"),
        F.to_json(F.struct(text_of("r_regionkey").alias("id"), F.col("r_name").alias("title"),
                           F.struct(F.col("r_name").alias("name")).alias("type"), "template")).alias("doc"))
    of_sets = places.select(
        F.lit("EntitySetCollection"), text_of("n_nationkey"),
        F.to_json(F.struct(text_of("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                           F.array(F.lit("desk"), "r_name").alias("contacts"), text_of("r_regionkey").alias("organizationId"))))
    apps = saved_objects(spark, sf_dir).where("kind = 'App'").select("kind", "id", "doc")
    objects = materialize(apps.union(of_types).union(of_sets), "objects_of_kinds")

    segments = m.table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    cut = F.split(F.substr(F.col("r_name"), F.lit(2)), " ")[0]
    asked = segments.select(
        F.concat(F.lit("app "), "c_mktsegment").alias("search_id"), F.lit("App").alias("kind"), F.expr("substr(c_mktsegment, 2)").alias("term"))
    for kind in ("EntityTypeCollection", "EntitySetCollection"):
        asked = asked.union(region.select(F.concat(F.lit(kind.lower() + " "), "r_name"), F.lit(kind), cut))
    asked = asked.union(nation.select(
        F.concat(F.lit("nation "), "n_name"), F.lit("EntityTypeCollection"), F.split("n_name", " ")[0]))
    req = cs.object_requests_of(asked.withColumns({"start": F.lit(0), "max_hits": F.lit(4)}))
    return cs.object_search(req, cs.catalog_index(objects), objects).select("search_id", "rn", "doc_id", "score", "total_hits")


@query("F4_name_search", f"""
    WITH h AS (SELECT q AS search_id, CAST(p_partkey AS VARCHAR) AS doc_id, 2.0 AS score FROM part, (VALUES ('a', '13', 'wid|bol'), ('b', 'ran', 'gi.m')) v(q, ns, nm)
      WHERE len(list_filter({words('p_brand')}, lambda t: regexp_full_match(t, '.*' || ns || '.*'))) > 0
        AND len(list_filter({words('p_name')}, lambda t: regexp_full_match(t, '.*' || nm || '.*'))) > 0), {_page('h', 10, 2)}
    SELECT search_id, rn, doc_id, total_hits FROM p""")
def name_search(spark, sf_dir):
    names = m.table(spark, sf_dir, "part").select(
        F.lit("EntityType").alias("kind"), F.col("p_partkey").cast("string").alias("doc_id"),
        F.col("p_brand").alias("namespace"), F.col("p_name").alias("name"))
    return cs.name_search(names, [("a", "EntityType", "13", "wid|bol", 2, 10), ("b", "EntityType", "ran", "gi.m", 2, 10)])


@query("F5_organization_search", f"""
    WITH tok AS (SELECT CAST(s_suppkey AS VARCHAR) AS doc_id, '0' AS ord, 'title' AS property_id, unnest(regexp_extract_all(lower(s_name), '[a-z0-9]+')) AS term FROM supplier
        UNION ALL SELECT CAST(s_suppkey AS VARCHAR), '0', 'description', unnest(regexp_extract_all('based in ' || lower(n_name), '[a-z0-9_]+'))
          FROM supplier JOIN nation ON s_nationkey = n_nationkey), {BM25},
      allowed AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS doc_id FROM lineitem WHERE l_discount > 0.09),
      m AS (SELECT doc_id, max(s * w) AS s, property_id, c FROM (
          SELECT *, 1.0 AS w, 'plain' AS c FROM sc WHERE term = 'based'
          UNION ALL SELECT *, 1 - damerau_levenshtein('suplier', term) / least(7, length(term)), 'fuzzy' FROM sc WHERE damerau_levenshtein('suplier', term) <= 2)
        GROUP BY ALL),
      h AS (SELECT 'q' AS search_id, doc_id, round(sum(s), 6) AS score FROM m JOIN allowed USING (doc_id) GROUP BY ALL), {_page('h', 25)}
    SELECT search_id, rn, doc_id AS id, score, total_hits, s_name AS title FROM p JOIN supplier ON CAST(s_suppkey AS VARCHAR) = doc_id""")
def organization_search(spark, sf_dir):
    """Suppliers with generous discounts, by title or description; only the marked word may be misspelt."""
    acl = m.table(spark, sf_dir, "lineitem").where("l_discount > 0.09").select(
        F.lit("q").alias("search_id"), F.array(F.col("l_suppkey").cast("string"), F.col("l_orderkey").cast("string")).alias("acl_key"))
    req = cs.organization_requests(spark, [("q", "based suplier~", 0, 25)])
    found = cs.organization_search(req, m.organization_index(spark, sf_dir), m.organizations(spark, sf_dir), acl)
    return found.select("search_id", "rn", "id", "score", "total_hits", "title")


FILTERS = m.T.StructType([
    m.T.StructField("search_id", m.T.StringType()), m.T.StructField("entity_type_id", m.T.StringType()),
    m.T.StructField("property_ids", m.T.ArrayType(m.T.StringType()))])


@query("F6_entity_set_search", f"""
    WITH s AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, CAST(o_custkey AS VARCHAR) AS t,
        [CAST(o_orderkey AS VARCHAR), 'order' || o_orderkey, o_orderpriority, 'status ' || o_orderstatus] AS f FROM orders),
      -- Pairs and sounds of the spoken fields do not count towards lengths, and none is near the term.
      tok AS (SELECT doc_id, '0' AS ord, p AS property_id, unnest(CASE WHEN p = 'id' THEN {words('v')} ELSE {letters('v')} END) AS term FROM
        (SELECT doc_id, unnest(f) AS v, unnest(['id', 'name', 'title', 'description']) AS p FROM s)), {BM25},
      m AS (SELECT doc_id, property_id, max(idf * (1 - damerau_levenshtein('urgnet', term) / least(6, length(term))) * tfn) AS s FROM sc
        WHERE damerau_levenshtein('urgnet', term) <= 2 GROUP BY ALL),
      term AS (SELECT doc_id, max(s) AS s FROM m GROUP BY ALL),
      h AS (SELECT 'by part' AS search_id, doc_id, round(s, 6) AS score FROM term WHERE doc_id IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_partkey = 7)
        UNION ALL SELECT 'by type', doc_id, round(s.s, 6) FROM term s JOIN (SELECT doc_id, t FROM s) USING (doc_id) WHERE t = '7'
        UNION ALL SELECT 'term', doc_id, round(s, 6) FROM term), {_page('h', 10)}
    SELECT search_id, rn, doc_id AS entity_set_id, score, total_hits FROM p""")
def entity_set_search(spark, sf_dir):
    """Orders as entity sets: a misspelt title, alone and with a type or a listed part; all ids allowed."""
    names = ["term", "by type", "by part"]
    sets = materialize(m.order_sets(spark, sf_dir), "order_sets")
    filters = local_table(spark, [("term", None, None), ("by type", "7", ["1"]), ("by part", None, ["7"])], FILTERS)
    acl = m.table(spark, sf_dir, "orders").select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias("search_id"), F.array(F.col("o_orderkey").cast("string")).alias("acl_key"))
    req = cs.object_requests(spark, [(n, "EntitySet", "urgnet", 0, 10) for n in names], fields=cs.ENTITY_SET_FIELDS)
    found = cs.entity_set_search(req, m.order_set_index(spark, sf_dir), sets, filters, acl, exclude_property_types=True)
    return found.select("search_id", "rn", "entity_set_id", "score", "total_hits")


# --- property tables ------------------------------------------------------------------


def _property_tables(spark, sf_dir):
    """Customers as one table per property, stored as Parquet."""
    customer = m.table(spark, sf_dir, "customer")
    tables = {}
    for name, column in {"dept": "c_mktsegment", "salary": "c_acctbal", "nation": "c_nationkey"}.items():
        path = shared_path(spark, f"property-{name}")
        customer.select(F.col("c_custkey").alias("entityid"), F.col(column).alias("value")).write.parquet(path)
        tables[name] = spark.read.parquet(path)
    return tables


@query("J1_scan_and_project", "SELECT c_custkey AS entityid FROM customer")
def scan_and_project(spark, sf_dir):
    return pt.entity_ids(_property_tables(spark, sf_dir)["dept"])


@query("J2_equality_filter", "SELECT c_custkey AS entityid, c_mktsegment AS value FROM customer WHERE c_mktsegment = 'BUILDING'")
def equality_filter(spark, sf_dir):
    return pt.with_value(_property_tables(spark, sf_dir)["dept"], "value = 'BUILDING'")


@query("J3_range_filter", "SELECT c_custkey AS entityid, c_acctbal AS value FROM customer WHERE c_acctbal > 8000")
def range_filter(spark, sf_dir):
    return pt.with_value(_property_tables(spark, sf_dir)["salary"], F.col("value") > 8000)


@query("J4_sql_over_view", "SELECT c_custkey AS entityid, c_acctbal AS value FROM customer WHERE c_acctbal > 8000")
def sql_over_view(spark, sf_dir):
    _property_tables(spark, sf_dir)["salary"].createOrReplaceTempView("salary")
    return spark.sql("SELECT * FROM salary WHERE value > 8000")


def _joined(spark, sf_dir):
    tables = _property_tables(spark, sf_dir)
    return pt.join_properties(tables["nation"], {"dept": tables["dept"], "salary": tables["salary"]})


@query("J5_join_chain", "SELECT c_custkey AS entityid, c_mktsegment AS dept, c_acctbal AS salary FROM customer")
def join_chain(spark, sf_dir):
    return _joined(spark, sf_dir)


@query("J6_filters_above_join", """
    SELECT 'above' AS side, c_custkey AS entityid, c_mktsegment AS dept, c_acctbal AS salary FROM customer WHERE c_acctbal > 8000 AND c_mktsegment = 'BUILDING'
    UNION ALL SELECT 'below', c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal < 1500 AND c_mktsegment = 'BUILDING'""")
def filters_above_join(spark, sf_dir):
    joined = _joined(spark, sf_dir)
    dept = F.col("dept") == "BUILDING"
    above = pt.where_all(joined, F.col("salary") > 8000, dept).withColumn("side", F.lit("above"))
    return above.unionByName(pt.where_all(joined, F.col("salary") < 1500, dept).withColumn("side", F.lit("below")))
