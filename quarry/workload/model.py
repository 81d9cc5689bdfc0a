"""The supplied tables seen as typed entities, entity sets, linked entities and a catalog."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas
from quarry.functions.text import METAPHONE, NOT_ANALYZED, STANDARD
from quarry.operators.index import Index, build_index
from quarry.operators.ingest import long_values
from quarry.operators.requests import Requests
from quarry.operators.typing_ops import evolve, type_values
from quarry.plans.catalog_search import catalog_index, entity_set_index, index_of, organization_values
from quarry.scale import local_table, settle, spread_rows

ELEMENTS_PER_LINK = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def properties(spark: SparkSession, rows: list[tuple[str, str, str | None]]) -> DataFrame:
    return local_table(spark, [(p, "data", p, p, kind, an) for p, kind, an in rows], schemas.PROPERTY_TYPES)


def normal_keys(entity_type: str, doc_id: Column, entity_set: Column) -> dict[str, Column]:
    doc_id = doc_id.cast("string")
    return {
        "entity_type_id": F.lit(entity_type), "doc_id": doc_id, "entity_set_id": entity_set,
        "ord": F.lit("0"), "elem_entity_key_id": doc_id, "elem_entity_set_id": entity_set,
    }


def elements(rows: DataFrame, keys: dict[str, Column], last_write: Column) -> DataFrame:
    named = [c.alias(k) for k, c in keys.items() if k != "elem_entity_key_id"]
    return rows.select(*named, last_write.alias("last_write"))



# --- documents: text (standard), lang (not analyzed), n_chars -----------------

DOCUMENT_PROPERTIES = [("text", "String", STANDARD), ("lang", "String", NOT_ANALYZED), ("n_chars", "Int64", None)]


def document_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, Column]]:
    return table(spark, sf_dir, "documents"), normal_keys("document", F.col("doc_id"), F.col("source"))


def document_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, keys = document_rows(spark, sf_dir)
    return long_values(rows, {p: F.col(p) for p, _, _ in DOCUMENT_PROPERTIES}, keys)


def document_index(spark: SparkSession, sf_dir: str) -> Index:
    def build() -> Index:
        rows, keys = document_rows(spark, sf_dir)
        props = properties(spark, DOCUMENT_PROPERTIES)
        written = F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,cast(doc_id as int))")
        return build_index(
            type_values(document_values(spark, sf_dir), props), elements(rows, keys, written), props
        )

    return kept(spark, sf_dir, "documents", build)


# --- customers, alone and linked in groups -------------------------------------

CUSTOMER_PROPERTIES = [
    ("c_name", "String", STANDARD), ("c_acctbal", "Double", None), ("c_nationkey", "Int32", None),
    ("segment", "String", NOT_ANALYZED), ("location", "GeographyPoint", None),
]
LAT, LON = "cast(c_custkey * 37 % 1800 as double) / 10 - 90", "cast(c_custkey * 91 % 3600 as double) / 10 - 180"
CUSTOMER_TIME = "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,cast(c_custkey as int))"


def customer_cells() -> dict[str, Column]:
    return {
        "c_name": F.col("c_name"), "c_acctbal": F.col("c_acctbal"), "c_nationkey": F.col("c_nationkey"),
        "segment": F.col("c_mktsegment"), "location": F.expr(f"concat({LAT}, ',', {LON})"),
    }


def customer_keys(entity_set: Column | None = None) -> dict[str, Column]:
    return normal_keys("customer", F.col("c_custkey"), F.col("c_mktsegment") if entity_set is None else entity_set)


def linked_keys() -> dict[str, Column]:
    """Linked documents of five neighbouring customers; an element is named by set and key."""
    link = F.floor(F.col("c_custkey") / ELEMENTS_PER_LINK).cast("string")
    return {
        "entity_type_id": F.lit("customer"), "doc_id": F.concat(F.lit("L"), link),
        "entity_set_id": F.lit(None).cast("string"),
        "ord": F.concat_ws("/", "c_mktsegment", F.col("c_custkey").cast("string")),
        "elem_entity_key_id": F.col("c_custkey").cast("string"), "elem_entity_set_id": F.col("c_mktsegment"),
    }


def customer_values(spark: SparkSession, sf_dir: str, linked: bool = False) -> DataFrame:
    keys = linked_keys() if linked else customer_keys()
    return long_values(spread_rows(table(spark, sf_dir, "customer")), customer_cells(), keys)


def customer_elements(spark: SparkSession, sf_dir: str, linked: bool = False) -> DataFrame:
    keys = linked_keys() if linked else customer_keys()
    return elements(table(spark, sf_dir, "customer"), keys, F.expr(CUSTOMER_TIME))


def customer_index(spark: SparkSession, sf_dir: str) -> Index:
    """Normal and linked customers in one entity type."""

    def build() -> Index:
        props = properties(spark, CUSTOMER_PROPERTIES)
        values = evolve(customer_values(spark, sf_dir), customer_values(spark, sf_dir, linked=True))
        rows = evolve(customer_elements(spark, sf_dir), customer_elements(spark, sf_dir, linked=True))
        return build_index(type_values(values, props), rows, props)

    return kept(spark, sf_dir, "customers", build)


# --- parts ------------------------------------------------------------------------


def part_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = {name: F.col(name) for name in ("p_name", "p_type", "p_brand", "p_size")}
    return long_values(
        spread_rows(table(spark, sf_dir, "part")), cells, normal_keys("part", F.col("p_partkey"), F.col("p_brand"))
    )


def part_properties(spark: SparkSession, name: str = STANDARD, kind: str = NOT_ANALYZED) -> DataFrame:
    return properties(
        spark,
        [("p_name", "String", name), ("p_type", "String", kind), ("p_brand", "String", METAPHONE),
         ("p_size", "Int32", None)],
    )


def part_index(spark: SparkSession, sf_dir: str, name: str = STANDARD, kind: str = NOT_ANALYZED) -> Index:
    def build() -> Index:
        props = part_properties(spark, name, kind)
        keys = normal_keys("part", F.col("p_partkey"), F.col("p_brand"))
        rows = elements(table(spark, sf_dir, "part"), keys, F.lit(None).cast("timestamp_ntz"))
        return build_index(type_values(part_values(spark, sf_dir), props), rows, props)

    return kept(spark, sf_dir, f"parts-{name}-{kind}", build)


# --- events -----------------------------------------------------------------------


def event_index(spark: SparkSession, sf_dir: str) -> Index:
    def build() -> Index:
        events = table(spark, sf_dir, "events")
        keys = normal_keys("event", F.col("event_id"), F.col("event_type"))
        props = properties(spark, [("value", "Double", None), ("user_id", "Int64", None)])
        values = long_values(events, {"value": F.col("value"), "user_id": F.col("user_id")}, keys)
        return build_index(type_values(values, props), elements(events, keys, F.col("ts")), props)

    return kept(spark, sf_dir, "events", build)


# --- catalog ----------------------------------------------------------------------


def catalog_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects as they arrive: parts as entity types, suppliers as associations, and rows to refuse."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    region, customer = table(spark, sf_dir, "region"), table(spark, sf_dir, "customer")

    def doc(**fields: Column) -> Column:
        return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))

    def named(namespace: str, name: str) -> Column:
        return F.struct(F.col(namespace).alias("namespace"), F.col(name).alias("name"))

    entity_types = part.select(
        F.lit("EntityType").alias("kind"), F.col("p_partkey").alias("seq"),
        doc(id=F.col("p_partkey").cast("string"), title=F.col("p_name"), description=F.col("p_type"),
            type=named("p_brand", "p_name")).alias("doc"),
    )
    # Suppliers in debt come without an entity type.
    entity_type = F.struct(F.concat(F.lit("a"), "s_suppkey").alias("id"), named("s_nationkey", "s_name").alias("type"))
    associations = supplier.select(
        F.lit("AssociationType"), F.col("s_suppkey"),
        doc(id=F.col("s_suppkey").cast("string"), title=F.col("s_name"),
            entityType=F.when(F.col("s_acctbal") >= 0, entity_type)),
    )
    unknown = region.select(F.lit("Continent"), F.col("r_regionkey").cast("bigint"), doc(id=F.col("r_name")))
    nameless = customer.where("c_acctbal < 0").select(F.lit("App"), F.col("c_custkey"), doc(title=F.col("c_name")))
    apps = customer.where("c_acctbal >= 0").select(
        F.lit("App"), F.col("c_custkey"),
        doc(id=F.col("c_mktsegment"), title=F.col("c_name"), name=F.col("c_mktsegment")),
    )
    batch = entity_types
    for more in (associations, unknown, nameless, apps):
        batch = batch.union(more)
    return batch


def organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("title"),
        F.concat(F.lit("based in "), "n_name").alias("description"), "s_nationkey",
    )


def order_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as entity sets: their line parts, by line number, are the listed property types."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_partkey").cast("string").alias("p")))).alias("l")
    ).select(F.col("l_orderkey").alias("o_orderkey"), F.transform("l", lambda x: x.getField("p")).alias("property_ids"))
    return spread_rows(table(spark, sf_dir, "orders")).join(lines, "o_orderkey", "left").select(
        F.col("o_orderkey").cast("string").alias("entity_set_id"), F.col("o_custkey").cast("string").alias("entity_type_id"),
        F.concat(F.lit("order"), F.col("o_orderkey")).alias("name"), F.col("o_orderpriority").alias("title"),
        F.concat(F.lit("status "), "o_orderstatus").alias("description"),
        F.coalesce("property_ids", F.array().cast("array<string>")).alias("property_ids"),
    )


def part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts still sold as property types; promotional ones left the catalog."""
    return table(spark, sf_dir, "part").where("p_type <> 'PROMO'").select(
        F.col("p_partkey").cast("string").alias("property_id"), F.col("p_name").alias("name")
    )


def object_index(spark: SparkSession, sf_dir: str, objects: Callable[[], DataFrame]) -> Index:
    return kept(spark, sf_dir, "objects", lambda: catalog_index(objects()))


def organization_index(spark: SparkSession, sf_dir: str) -> Index:
    return kept(
        spark, sf_dir, "organizations", lambda: index_of(organization_values(organizations(spark, sf_dir)))
    )


def order_set_index(spark: SparkSession, sf_dir: str) -> Index:
    return kept(spark, sf_dir, "order_sets", lambda: entity_set_index(order_sets(spark, sf_dir)))


# --- shared -----------------------------------------------------------------------

_KEPT: dict[tuple, Index] = {}


def kept(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], Index]) -> Index:
    """An index is written once per application and read by every search on it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def requests(
    searches: DataFrame,
    allowed: list[str] | DataFrame,
    groups: list[tuple[int, int]] = ((0, 1),),
    constraints: list[dict] = (),
    details: list[tuple] = (),
    linking: DataFrame | None = None,
    constraint_rows: DataFrame | None = None,
    detail_rows: DataFrame | None = None,
) -> Requests:
    """Request tables in which every search of ``searches`` asks the same questions.

    Absent page and sort columns get defaults. ``constraint_rows`` / ``detail_rows``
    give questions that differ per search.
    """
    spark = searches.sparkSession
    defaults = {
        "request_id": F.col("search_id"), "request_no": F.lit(0), "linking": F.lit(False), "start": F.lit(0),
        "max_hits": F.lit(10), "sort_type": F.lit("score"), "sort_property_id": F.lit(None).cast("string"),
        "sort_lat": F.lit(None).cast("double"), "sort_lon": F.lit(None).cast("double"), "descending": F.lit(True),
    }
    full = searches.select(
        "*", *[c.alias(n) for n, c in defaults.items() if n not in searches.columns]
    ).select(schemas.SEARCHES.fieldNames())
    full, _ = settle(full, "searches")
    ids = full.select("search_id")

    def every(rows: list[tuple], schema) -> DataFrame:
        rest = T.StructType(schema.fields[1:])
        given = json.dumps([dict(zip(rest.fieldNames(), r)) for r in rows])
        return ids.select("search_id", F.inline(F.from_json(F.lit(given), T.ArrayType(rest))))

    names = schemas.CONSTRAINTS.fieldNames()[1:]
    common = [
        tuple({"group_no": 0, "constraint_no": n, "fuzzy": False, **c}.get(k) for k in names)
        for n, c in enumerate(constraints)
    ]
    return Requests.of(
        spark,
        searches=full,
        authorized=every([(p,) for p in allowed], schemas.AUTHORIZED) if isinstance(allowed, list) else allowed,
        groups=every(list(groups), schemas.SEARCH_GROUPS),
        constraints=every(common, schemas.CONSTRAINTS) if constraint_rows is None else constraint_rows,
        details=every(list(details), schemas.DETAILS) if detail_rows is None else detail_rows,
        linking=linking,
    )


def sets_of(spark: SparkSession, sf_dir: str, name: str, column: str, entity_type: str) -> DataFrame:
    """A search per entity set found in the data."""
    return table(spark, sf_dir, name).select(F.col(column).alias("entity_set_id")).distinct().withColumns(
        {"search_id": F.col("entity_set_id"), "entity_type_id": F.lit(entity_type)}
    )
