"""Sorting, paging, totals and result shapes, per search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions import geo
from quarry.operators.index import Index
from quarry.operators.requests import Requests
from quarry.operators.typing_ops import decimal_order
from quarry.scale import lookup_join, materialize

SORT_KEYS = ["k_long", "k_double", "k_text_asc", "k_text_desc"]
# Ranks up to this are found by windows that keep few rows per input partition; deeper pages are
# cut out of one sort over all partitions.
SHALLOW_RANK = 10_000


def score_keys(hits: DataFrame) -> DataFrame:
    """Sort keys of score-sorted searches; ``hits`` carries ``descending``."""
    return hits.withColumn(
        "k_double", F.when(F.col("descending"), -F.col("score")).otherwise(F.col("score"))
    )


def sorted_by(table: DataFrame, req: Requests) -> DataFrame:
    """Rows of the properties some search sorts by, under the name ``sort_property_id``."""
    asked = req.searches.where(F.col("sort_property_id").isNotNull()).select(
        "entity_type_id", F.col("sort_property_id").alias("property_id")
    ).distinct()
    rows = lookup_join(table, asked, ["entity_type_id", "property_id"], ["doc_id"], req.small, "left_semi")
    return rows.withColumnRenamed("property_id", "sort_property_id")


def property_keys(hits: DataFrame, req: Requests, index: Index) -> DataFrame:
    """Sort keys from a property: min of its values ascending, max descending.

    ``hits`` carries entity_type_id, sort_property_id, descending.
    """
    long_value = F.coalesce(
        "v_long", F.col("v_bool").cast("bigint"), F.unix_micros(F.col("v_ts").cast("timestamp")),
        F.unix_date("v_date").cast("bigint"),
    )
    values = sorted_by(index.values, req).select(
        "entity_type_id", "doc_id", "sort_property_id",
        long_value.alias("s_long"), F.col("v_double").alias("s_double"),
        F.when(F.col("datatype") == "String", F.col("value"))
        .when(F.col("datatype") == "Decimal", decimal_order(F.col("value"))).alias("s_text"),
    )
    ends = []
    for name in ("s_long", "s_double", "s_text"):
        ends += [F.min(name).alias(f"{name}_min"), F.max(name).alias(f"{name}_max")]
    keyed = (
        hits.join(values, ["entity_type_id", "doc_id", "sort_property_id"], "left")
        .groupBy("search_id", "doc_id", "score", "descending")
        .agg(*ends)
    )
    down = F.col("descending")

    def number(name: str):
        return F.when(down, -F.col(f"{name}_max")).otherwise(F.col(f"{name}_min"))

    return keyed.select(
        "search_id", "doc_id", "score",
        number("s_long").alias("k_long"), number("s_double").alias("k_double"),
        F.when(~down, F.col("s_text_min")).alias("k_text_asc"),
        F.when(down, F.col("s_text_max")).alias("k_text_desc"),
    )


def distance_keys(hits: DataFrame, req: Requests, index: Index) -> DataFrame:
    """Sort keys from the distance between a point property and the search's point."""
    points = sorted_by(index.points, req).select("entity_type_id", "doc_id", "sort_property_id", "lat", "lon")
    metres = geo.haversine(F.col("lat"), F.col("lon"), F.col("sort_lat"), F.col("sort_lon"))
    keyed = (
        hits.join(points, ["entity_type_id", "doc_id", "sort_property_id"], "left")
        # A document without a point counts as infinitely far away.
        .withColumn("metres", F.when(F.col("lat").isNull(), float("inf")).otherwise(F.round(metres, 3)))
        .groupBy("search_id", "doc_id", "score", "descending")
        .agg(F.min("metres").alias("near"), F.max("metres").alias("far"))
    )
    return keyed.withColumn(
        "k_double", F.when(F.col("descending"), -F.col("far")).otherwise(F.col("near"))
    ).drop("near", "far")


_KEY_TYPES = {
    "k_long": "bigint", "k_double": "double", "k_text_asc": "string", "k_text_desc": "string",
}


def _complete(keyed: DataFrame) -> DataFrame:
    return keyed.select(
        "search_id", "doc_id", "score",
        *[
            (F.col(k) if k in keyed.columns else F.lit(None)).cast(_KEY_TYPES[k]).alias(k)
            for k in SORT_KEYS
        ],
    )


def sort_keys(hits: DataFrame, req: Requests, index: Index) -> DataFrame:
    """Hits with comparable sort keys; only the sorts in use are planned."""
    how = req.searches.select(
        "search_id", "entity_type_id", F.coalesce("sort_type", F.lit("score")).alias("sort_type"),
        "sort_property_id", "sort_lat", "sort_lon",
        F.coalesce("descending", F.lit(True)).alias("descending"),
    )
    hits = lookup_join(hits, how, ["search_id"], ["doc_id"], small_fits=req.small)
    by_field, by_distance = "sort:field" in req.features, "sort:geoDistance" in req.features
    if not (by_field or by_distance):
        return _complete(score_keys(hits))
    parts = [_complete(score_keys(hits.where(~F.col("sort_type").isin("field", "geoDistance"))))]
    if by_field:
        parts.append(_complete(property_keys(hits.where("sort_type = 'field'"), req, index)))
    if by_distance:
        parts.append(_complete(distance_keys(hits.where("sort_type = 'geoDistance'"), req, index)))
    keyed = parts[0]
    for part in parts[1:]:
        keyed = keyed.unionByName(part)
    return keyed


def _order() -> list:
    missing = F.when(F.coalesce(*[F.col(k).cast("string") for k in SORT_KEYS]).isNull(), 1).otherwise(0)
    return [
        missing.asc(), *[F.col(k).asc_nulls_last() for k in SORT_KEYS if k != "k_text_desc"],
        F.col("k_text_desc").desc_nulls_last(), F.col("doc_id").asc(),
    ]


def _sorted_ranks(keyed: DataFrame) -> DataFrame:
    """Ranks of whole results: one sort over all partitions, numbered by its partitions' starts.

    A search that hits a third of all documents is spread over many tasks; one row per
    (search, partition) is all that is gathered.
    """
    ordered = keyed.orderBy("search_id", *_order()).withColumn("_place", F.monotonically_increasing_id())
    ordered = materialize(ordered, "ordered").withColumn("_part", F.shiftright("_place", 33))
    parts = ordered.groupBy("search_id", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    before = W.partitionBy("search_id").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return (
        ordered.join(starts, ["search_id", "_part"])
        .withColumn("rn", F.col("_before") + F.col("_place") - F.col("_first") + 1)
        .drop("_place", "_part", "_before", "_first")
    )


def page(keyed: DataFrame, req: Requests) -> DataFrame:
    """Rows ``start < rank <= start + max_hits`` of each search.

    For shallow pages a literal bound on the rank lets Spark keep only the top rows of each
    input partition before the exchange by search; one deep page does not lift it for others.
    """
    last = F.col("start").cast("bigint") + F.col("max_hits").cast("bigint")
    pages = req.searches.select(
        "search_id", "request_id", "request_no", "entity_set_id", F.col("start").cast("bigint").alias("start"), last.alias("last")
    )
    placed = lookup_join(keyed, pages, ["search_id"], ["doc_id"], small_fits=req.small)
    ranked = placed.where(F.col("last") <= SHALLOW_RANK).withColumn(
        "rn", F.row_number().over(W.partitionBy("search_id").orderBy(*_order()))
    ).where(F.col("rn") <= min(req.max_rank, SHALLOW_RANK))
    if req.max_rank > SHALLOW_RANK:
        ranked = ranked.unionByName(_sorted_ranks(placed.where(F.col("last") > SHALLOW_RANK)))
    return ranked.where((F.col("rn") > F.col("start")) & (F.col("rn") <= F.col("last"))).select(
        "search_id", "request_id", "request_no", F.col("rn").cast("int").alias("rn"), "entity_set_id", "doc_id", "score"
    )


def totals(hits: DataFrame) -> DataFrame:
    """Exact number of hits per search that has any, counted before paging."""
    return hits.groupBy("search_id").agg(F.count("score").alias("total_hits"))


def all_totals(hits: DataFrame, req: Requests) -> DataFrame:
    """Exact totals of every search: also of those without hits, or with a page past the end."""
    counts = totals(hits)
    return req.searches.select("search_id", "request_id").join(counts, "search_id", "left").withColumn(
        "total_hits", F.coalesce("total_hits", F.lit(0).cast("bigint"))
    )


def request_totals(hits: DataFrame, req: Requests) -> DataFrame:
    """Totals of the sub-searches summed per request; requests without hits count zero."""
    return all_totals(hits, req).groupBy("request_id").agg(F.sum("total_hits").alias("total_hits"))


def by_entity_set(hits: DataFrame) -> DataFrame:
    """Keys per entity set in long form: sets have no size limit, so no row holds one whole."""
    return hits.select("entity_set_id", "doc_id").distinct()


def keys_of_page(rows: DataFrame) -> DataFrame:
    """Keys per entity set as arrays, for paged results (bounded by the page size)."""
    return rows.groupBy("search_id", "entity_set_id").agg(F.sort_array(F.collect_set("doc_id")).alias("doc_ids"))
