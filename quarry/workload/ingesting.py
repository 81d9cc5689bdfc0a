"""C: assembling, upserting, deleting, patching, rebuilding, streaming, exporting."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import ingest, metadata
from quarry.scale import lookup_join, shared_path
from quarry.sources.employees import read_employees
from quarry.sources.export import json_lines
from quarry.sources.store import DocumentStore
from quarry.streaming.upserts import upsert_stream
from quarry.workload import model as m
from quarry.workload.registry import query
from quarry.workload.sql import LINK


def _order_values(spark, sf_dir, status_only=False):
    """Customers as entities with sets of order statuses and priorities."""
    orders = m.table(spark, sf_dir, "orders")
    customers = m.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    cells = F.array(
        F.struct(F.lit("status").alias("property_id"), F.col("o_orderstatus").alias("value")),
        F.struct(F.lit("priority").alias("property_id"), F.col("o_orderpriority").alias("value")),
    )
    return lookup_join(orders, customers, ["o_custkey"], ["o_orderkey"]).select(
        F.lit("buyer").alias("entity_type_id"), F.col("o_custkey").cast("string").alias("doc_id"),
        F.col("c_mktsegment").alias("entity_set_id"), F.inline(cells),
    )


@query("C1_assemble_entities", """
    WITH v AS (SELECT DISTINCT o_custkey, c_mktsegment, p, v FROM (
        SELECT o_custkey, 'status' AS p, o_orderstatus AS v FROM orders
        UNION ALL SELECT o_custkey, 'priority', o_orderpriority FROM orders) JOIN customer ON c_custkey = o_custkey)
    SELECT CAST(o_custkey AS VARCHAR) AS doc_id, c_mktsegment AS entity_set_id, c_mktsegment AS entity_set_id_key,
      p AS property_id, string_agg(v, '|' ORDER BY v) AS property_values FROM v GROUP BY ALL""")
def assemble_entities(spark, sf_dir):
    return ingest.assemble(_order_values(spark, sf_dir)).select(
        "doc_id", "entity_set_id", "entity_set_id_key", F.explode("entity").alias("property_id", "v"),
    ).select("doc_id", "entity_set_id", "entity_set_id_key", "property_id", F.array_join("v", "|").alias("property_values"))


@query("C2_assemble_linked", f"""
    SELECT {LINK} AS doc_id, CAST(NULL AS VARCHAR) AS entity_set_id, c_mktsegment || '/' || c_custkey AS ord, CAST(c_custkey AS VARCHAR) AS id,
      c_mktsegment AS entity_set_id_key, p AS property_id, v AS property_values
    FROM (SELECT *, unnest(['c_name', 'c_nationkey']) AS p, unnest([c_name, CAST(c_nationkey AS VARCHAR)]) AS v FROM customer)""")
def assemble_linked(spark, sf_dir):
    linked = m.customer_values(spark, sf_dir, linked=True).where(F.col("property_id").isin("c_name", "c_nationkey"))
    rows = linked.select(
        "entity_type_id", F.col("doc_id").alias("linking_id"), F.col("elem_entity_set_id").alias("entity_set_id"),
        F.col("elem_entity_key_id").alias("entity_key_id"), "property_id", "value")
    return ingest.assemble_linked(rows).select(
        "doc_id", "entity_set_id", "ord", "id", "entity_set_id_key", F.explode("entity").alias("property_id", "v"),
    ).select("doc_id", "entity_set_id", "ord", "id", "entity_set_id_key", "property_id",
             F.array_join("v", "|").alias("property_values"))


def _customer_docs(spark, sf_dir):
    return m.table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("entity_type_id"), F.col("c_custkey").alias("doc_id"), "c_mktsegment", "c_acctbal")


def _order_batch(spark, sf_dir):
    """Every order rewrites its customer; the last order wins."""
    return m.table(spark, sf_dir, "orders").select(
        F.lit("customer").alias("entity_type_id"), F.col("o_custkey").alias("doc_id"),
        F.col("o_orderpriority").alias("c_mktsegment"), F.col("o_totalprice").alias("c_acctbal"),
        F.struct("o_orderdate", "o_orderkey").alias("seq"))


LAST_ORDER = """last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1)"""


@query("C3_upsert_entities", f"""
    WITH {LAST_ORDER}
    SELECT o_custkey AS doc_id, o_orderpriority AS c_mktsegment, o_totalprice AS c_acctbal FROM last
    UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def upsert_entities(spark, sf_dir):
    return ingest.upsert(
        _customer_docs(spark, sf_dir), _order_batch(spark, sf_dir), ingest.DOCUMENT, "seq"
    ).drop("entity_type_id")


@query("C4_upsert_linked", f"""
    WITH rich AS (SELECT DISTINCT {LINK} AS doc_id FROM customer WHERE c_acctbal > 9000)
    SELECT {LINK} AS doc_id, CAST(c_custkey AS VARCHAR) AS id, c_name AS value FROM customer
      WHERE {LINK} NOT IN (SELECT doc_id FROM rich)
    UNION ALL SELECT {LINK}, CAST(c_custkey AS VARCHAR), upper(c_name) FROM customer
      WHERE {LINK} IN (SELECT doc_id FROM rich) AND c_acctbal > 0""")
def upsert_linked(spark, sf_dir):
    linked = m.customer_values(spark, sf_dir, linked=True)
    names = linked.where("property_id = 'c_name'")
    balance = linked.where("property_id = 'c_acctbal'").select(
        "doc_id", "ord", F.col("value").try_cast("double").alias("balance"))
    rich = balance.where("balance > 9000").select("doc_id").distinct()
    # Linked entities with a rich member arrive again, without members in debt.
    batch = (
        names.join(rich, "doc_id", "left_semi")
        .join(balance.where("balance > 0"), ["doc_id", "ord"], "left_semi")
        .withColumn("value", F.upper("value")).select(names.columns)
    )
    # An older version of the same documents is in the batch as well.
    older = names.join(rich, "doc_id", "left_semi").withColumn("value", F.lit("outdated")).select(names.columns)
    versions = older.withColumn("seq", F.lit(1)).unionByName(batch.withColumn("seq", F.lit(2)))
    return ingest.upsert_values(names, versions, seq="seq").select("doc_id", F.col("elem_entity_key_id").alias("id"), "value")


@query("C5_delete_by_keys", """
    SELECT c_custkey AS doc_id, c_acctbal FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def delete_by_keys(spark, sf_dir):
    doomed = m.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(
        F.lit("customer").alias("entity_type_id"), F.col("o_custkey").alias("doc_id"))
    return ingest.delete(_customer_docs(spark, sf_dir), doomed, ingest.DOCUMENT).select("doc_id", "c_acctbal")


def _all_docs(spark, sf_dir):
    return m.customer_elements(spark, sf_dir).unionByName(m.customer_elements(spark, sf_dir, linked=True))


@query("C6_clear_entity_set", f"""
    SELECT 'kept' AS what, CAST(c_custkey AS VARCHAR) AS doc_id, c_mktsegment AS entity_set_id FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT DISTINCT 'kept', {LINK}, NULL FROM customer
    UNION ALL SELECT 'deleted', CAST(count(*) AS VARCHAR), NULL FROM customer WHERE c_mktsegment = 'BUILDING'""")
def clear_entity_set(spark, sf_dir):
    """Remaining documents, and one row with the number of deleted ones."""
    docs = _all_docs(spark, sf_dir)
    kept = ingest.clear_entity_set(docs, "BUILDING", "customer").select("doc_id", "entity_set_id").distinct()
    count = ingest.cleared_count(docs, "BUILDING", "customer")
    return kept.select(F.lit("kept").alias("what"), "doc_id", "entity_set_id").unionByName(
        count.select(F.lit("deleted").alias("what"), F.col("n_deleted").cast("string").alias("doc_id"),
                     F.lit(None).cast("string").alias("entity_set_id")))


@query("C7_delete_entity_set", f"""
    SELECT 'entity set' AS what, c_mktsegment AS id FROM (SELECT DISTINCT c_mktsegment FROM customer) WHERE c_mktsegment <> 'MACHINERY'
    UNION ALL SELECT 'document', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment <> 'MACHINERY'
    UNION ALL SELECT DISTINCT 'document', {LINK} FROM customer""")
def delete_entity_set(spark, sf_dir):
    catalog = m.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("entity_set_id")).distinct()
    sets, docs = ingest.delete_entity_set(catalog, _all_docs(spark, sf_dir), "MACHINERY", "customer")
    return sets.select(F.lit("entity set").alias("what"), F.col("entity_set_id").alias("id")).unionByName(
        docs.select(F.lit("document").alias("what"), F.col("doc_id").alias("id")).distinct())


@query("C8_partial_update", """
    WITH lead AS (SELECT * FROM (SELECT s_suppkey AS k, c_name, c_mktsegment, c_acctbal,
          row_number() OVER (PARTITION BY s_suppkey ORDER BY c_custkey DESC) AS r
        FROM customer JOIN supplier ON s_name = replace(c_name, 'Customer', 'Supplier') WHERE c_acctbal > 0) WHERE r = 1),
      descr AS (SELECT s_suppkey AS k, c_mktsegment FROM customer
        JOIN supplier ON s_name = replace(c_name, 'Customer', 'Supplier') WHERE c_mktsegment <> 'BUILDING')
    SELECT 'patched' AS outcome, CAST(s_suppkey AS VARCHAR) AS id, coalesce(lead.c_name, s_name) AS title,
      coalesce(descr.c_mktsegment, 'based in ' || n_name) AS description
    FROM supplier JOIN nation ON n_nationkey = s_nationkey LEFT JOIN lead ON lead.k = s_suppkey LEFT JOIN descr ON descr.k = s_suppkey
    UNION ALL SELECT 'unknown id', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment FROM customer
      WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def partial_update(spark, sf_dir):
    """Customers patch the organization with their number; most are unknown there."""
    patches = m.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_custkey").alias("seq"),
        F.col("c_name").alias("title"), (F.col("c_acctbal") > 0).alias("has_title"),
        F.col("c_mktsegment").alias("description"), (F.col("c_mktsegment") != "BUILDING").alias("has_description"))
    patched, rejected = metadata.patch(
        m.organizations(spark, sf_dir).drop("s_nationkey"), patches, "id", ["title", "description"])
    return patched.select(F.lit("patched").alias("outcome"), "id", "title", "description").unionByName(
        rejected.select(F.col("reason").alias("outcome"), "id", "title", "description"))


@query("C8_entity_set_patch", """
    WITH t AS (SELECT l_orderkey AS k, l_returnflag AS title FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_linenumber DESC, l_partkey DESC, l_returnflag DESC) AS r FROM lineitem WHERE l_returnflag <> 'N') WHERE r = 1),
      p AS (SELECT l_orderkey AS k, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_linenumber DESC, l_partkey DESC) AS r FROM lineitem WHERE l_returnflag = 'R') WHERE r = 1),
      old AS (SELECT l_orderkey AS k, l_partkey,
          row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) - 1 AS pos FROM lineitem),
      listed AS (SELECT k, pos, l_partkey FROM old WHERE k NOT IN (SELECT k FROM p)
        UNION ALL SELECT k, 0, l_partkey FROM p UNION ALL SELECT k, 1, NULL FROM p)
    SELECT CAST(o_orderkey AS VARCHAR) AS entity_set_id, coalesce(title, o_orderpriority) AS title, CAST(pos AS INT) AS pos, p_name AS name
    FROM orders LEFT JOIN t ON t.k = o_orderkey LEFT JOIN listed ON listed.k = o_orderkey
      LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') ON p_partkey = l_partkey""")
def entity_set_patch(spark, sf_dir):
    """Every line patches its order: flagged lines its title, returned ones its list of property types, last line last."""
    patches = m.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("entity_set_id"), F.struct("l_linenumber", "l_partkey", "l_returnflag").alias("seq"),
        F.col("l_returnflag").alias("title"), (F.col("l_returnflag") != "N").alias("has_title"),
        F.array(F.col("l_partkey").cast("string"), F.lit("no such type")).alias("property_ids"), (F.col("l_returnflag") == "R").alias("has_property_ids"))
    sets, _ = metadata.patch_entity_sets(m.order_sets(spark, sf_dir), patches)
    catalog = metadata.entity_set_catalog(sets, m.part_types(spark, sf_dir))
    return catalog.select("entity_set_id", "title", F.posexplode_outer("property_types").alias("pos", "p")).select(
        "entity_set_id", "title", "pos", F.col("p.name").alias("name"))


SAVED = """
    SELECT 'EntityType' AS kind, CAST(p_partkey AS VARCHAR) AS id, p_name AS title FROM part
    UNION ALL SELECT 'AssociationType', 'a' || s_suppkey, s_name FROM supplier WHERE s_acctbal >= 0
    UNION ALL SELECT 'App', c_mktsegment, max_by(c_name, c_custkey) FROM customer WHERE c_acctbal >= 0 GROUP BY c_mktsegment"""
REFUSED = """
    SELECT 'association without entity type' AS kind, CAST(s_suppkey AS VARCHAR) AS id, s_name AS title FROM supplier WHERE s_acctbal < 0
    UNION ALL SELECT 'unknown kind', r_name, NULL FROM region
    UNION ALL SELECT 'no id', NULL, c_name FROM customer WHERE c_acctbal < 0"""


def _titles(objects, kind):
    return objects.select(
        F.col(kind).alias("kind"), F.get_json_object("doc", "$.id").alias("doc_id"), "id",
        F.get_json_object("doc", "$.title").alias("title"))


def _empty_catalog(spark):
    return m.local_table(spark, [], m.schemas.METADATA_OBJECTS)


@query("C9_save_objects", f"{SAVED} UNION ALL {REFUSED}")
def save_objects(spark, sf_dir):
    saved, rejected = metadata.save_objects(_empty_catalog(spark), m.catalog_batch(spark, sf_dir))
    refused = _titles(rejected, "reason").withColumn("id", F.col("doc_id"))
    return _titles(saved, "kind").drop("doc_id").unionByName(refused.drop("doc_id"))


def saved_objects(spark, sf_dir):
    return metadata.save_objects(_empty_catalog(spark), m.catalog_batch(spark, sf_dir))[0]


@query("C10_delete_objects", f"""
    WITH o AS ({SAVED}), gone AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id FROM lineitem WHERE l_discount >= 0.1)
    SELECT 'object' AS what, kind, id FROM o WHERE NOT (kind = 'EntityType' AND id IN (SELECT id FROM gone))
    UNION ALL SELECT 'document', 'EntityType', CAST(l_partkey AS VARCHAR) FROM lineitem WHERE CAST(l_partkey AS VARCHAR) NOT IN (SELECT id FROM gone)""")
def delete_objects(spark, sf_dir):
    """Parts ever sold at a tenth off leave the catalog, and their line items with them."""
    lines = m.table(spark, sf_dir, "lineitem")
    values = lines.select(F.col("l_partkey").cast("string").alias("entity_type_id"), "l_orderkey")
    doomed = lines.where("l_discount >= 0.1").select(
        F.lit("EntityType").alias("kind"), F.col("l_partkey").cast("string").alias("id"))
    objects, kept = metadata.delete_objects(saved_objects(spark, sf_dir), values, doomed)
    return objects.select(F.lit("object").alias("what"), "kind", "id").unionByName(
        kept.select(F.lit("document").alias("what"), F.lit("EntityType").alias("kind"), F.col("entity_type_id").alias("id")))


@query("C11_rebuild_table", f"""
    WITH {LAST_ORDER} SELECT o_custkey AS doc_id, o_orderpriority AS c_mktsegment, o_totalprice AS c_acctbal FROM last""")
def rebuild_table(spark, sf_dir):
    batch = _order_batch(spark, sf_dir)
    store = DocumentStore(spark, shared_path(spark, "rebuild"), batch.schema, ingest.DOCUMENT, "seq")
    store.write(batch.where("c_acctbal < 0"), 0)
    store.rebuild(batch, 0)
    return store.read().select("doc_id", "c_mktsegment", "c_acctbal")


@query("C12_rebuild_entity_set_catalog", """
    SELECT CAST(l_orderkey AS VARCHAR) AS entity_set_id,
      CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) - 1 AS INT) AS pos, p_name AS name
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') ON p_partkey = l_partkey""")
def rebuild_entity_set_catalog(spark, sf_dir):
    catalog = metadata.entity_set_catalog(m.order_sets(spark, sf_dir), m.part_types(spark, sf_dir))
    return catalog.select("entity_set_id", F.posexplode("property_types").alias("pos", "p")).select(
        "entity_set_id", "pos", F.col("p.name").alias("name"))


@query("C13_rebuild_organizations", """
    SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS title, 'based in ' || n_name AS description
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def rebuild_organizations(spark, sf_dir):
    docs = metadata.organization_docs(m.organizations(spark, sf_dir)).withColumn("seq", F.lit(0).cast("bigint"))
    store = DocumentStore(spark, shared_path(spark, "organizations"), docs.schema, ["id"], "seq")
    store.rebuild(docs, 0)
    return store.read().drop("seq")


@query("C14_rebuild_objects_of_kind", f"""
    SELECT kind, id, title FROM ({SAVED}) WHERE kind = 'AssociationType'
    UNION ALL SELECT kind, id, title FROM ({REFUSED}) WHERE kind = 'association without entity type'""")
def rebuild_objects_of_kind(spark, sf_dir):
    objects, rejected = metadata.rebuild_objects(m.catalog_batch(spark, sf_dir), "AssociationType")
    refused = _titles(rejected, "reason").withColumn("id", F.col("doc_id"))
    return _titles(objects, "kind").drop("doc_id").unionByName(refused.drop("doc_id"))


@query("C15_ingest_outcome", f"""
    SELECT 'accepted' AS reason, (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier WHERE s_acctbal >= 0)
      + (SELECT count(*) FROM customer WHERE c_acctbal >= 0) AS n_rows
    UNION ALL SELECT kind, count(*) FROM ({REFUSED}) GROUP BY kind""")
def ingest_outcome(spark, sf_dir):
    return ingest.outcome(*metadata.identify(m.catalog_batch(spark, sf_dir)))


@query("C16_continuous_upsert", """
    SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
      FROM events) WHERE r = 1 AND event_type <> 'error'""")
def continuous_upsert(spark, sf_dir):
    """Events as versions of their user; an error event deletes the user."""
    arriving = shared_path(spark, "arriving")
    events = m.table(spark, sf_dir, "events")
    events.repartition(3).write.parquet(arriving)
    versions = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arriving).select(
        "user_id", "event_id", "event_type", "value", F.struct("ts", "event_id").alias("seq"),
        (F.col("event_type") == "error").alias("gone"))
    schema = m.T.StructType([f for f in versions.schema if f.name != "gone"])
    store = DocumentStore(spark, shared_path(spark, "users"), schema, ["user_id"], "seq")
    stream = upsert_stream(versions, store, shared_path(spark, "stream-state"), deletes="gone")
    stream.awaitTermination()
    # All events arrive once more, as late old versions: nothing may change.
    late = events.select("user_id", "event_id", "event_type", "value", F.struct("ts", "event_id").alias("seq"),
                         (F.col("event_type") == "error").alias("deleted"))
    store.append(late, 1_000_000)
    return store.read().drop("seq")


@query("C17_export_json_lines", """
    SELECT '{"event_id":' || event_id || ',"day":"' || strftime(ts, '%Y-%m-%d') || '","ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
      || '","event_type":"' || event_type || '","user_id":' || user_id || '}' AS value FROM events""")
def export_json_lines(spark, sf_dir):
    events = m.table(spark, sf_dir, "events")
    return json_lines(events.select("event_id", F.col("ts").cast("date").alias("day"), "ts", "event_type", "user_id"))


@query("C18_employee_csv", """
    SELECT c_name || ', ' || c_custkey AS name, c_mktsegment AS title, CAST(c_nationkey AS VARCHAR) AS dept,
      CASE WHEN c_acctbal < 0 THEN 0 ELSE CAST(trunc(c_acctbal) AS INT) END AS salary FROM customer""")
def employee_csv(spark, sf_dir):
    path = shared_path(spark, "employees")
    m.table(spark, sf_dir, "customer").select(
        F.concat_ws(", ", "c_name", F.col("c_custkey").cast("string")), "c_mktsegment",
        F.col("c_nationkey").cast("string"), F.concat(F.lit("$"), F.format_number("c_acctbal", 2)),
    ).write.csv(path)
    return read_employees(spark, path)
