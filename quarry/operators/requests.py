"""Tables of searches: expansion per entity set, authorisation, clauses of search text."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas
from quarry.functions import text
from quarry.operators.index import LINKED
from quarry.scale import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, local_table, shuffled

CONSTRAINT = ["search_id", "group_no", "constraint_no"]
CLAUSE = [*CONSTRAINT, "detail_no", "exact", "n_exact", "item_no"]
SCOPE = ["entity_type_id", "scope"]


@dataclass
class Requests:
    """Request tables (see ``quarry.schemas``) and what their plan needs."""

    searches: DataFrame
    groups: DataFrame
    constraints: DataFrame
    details: DataFrame
    authorized: DataFrame
    linking: DataFrame
    small: bool = False
    small_pages: bool = False
    max_rank: int = 0
    features: set[str] = field(default_factory=set)

    @classmethod
    def of(cls, spark: SparkSession, searches: DataFrame, authorized: DataFrame, **tables) -> Requests:
        """Bundle request tables; absent ones are empty. One small job profiles them."""

        def table(name: str, schema) -> DataFrame:
            given = tables.get(name)
            return local_table(spark, [], schema) if given is None else given

        requests = cls(
            searches=searches,
            groups=table("groups", schemas.SEARCH_GROUPS),
            constraints=table("constraints", schemas.CONSTRAINTS),
            details=table("details", schemas.DETAILS),
            authorized=authorized.select("search_id", "property_id").distinct(),
            linking=table("linking", schemas.LINKING),
        )
        requests._profile()
        return requests

    def _profile(self) -> None:
        """Row and byte counts of the request tables, deepest page, features in use."""
        none = F.lit(None).cast("string")

        def measure(df: DataFrame, features=none, rank=F.lit(0), rows=F.lit(0)) -> DataFrame:
            size = F.octet_length(F.to_json(F.struct("*")))
            return df.select(
                size.alias("bytes"), features.alias("feature"), rank.alias("rank"), rows.alias("page_rows")
            )

        term = F.coalesce(F.col("search_term"), F.lit(""))
        marks = F.concat_ws(
            "",
            F.when(term.contains('"'), " phrase"),
            F.when(F.col("fuzzy") | term.contains("~"), " fuzzy"),
        )
        detail_marks = F.concat_ws(
            "",
            F.lit("advanced"),
            F.when(term.contains('"'), " phrase"),
            F.when(term.contains("~"), " fuzzy"),
        )
        parts = [
            measure(
                self.searches,
                F.concat_ws(
                    " ", F.concat(F.lit("sort:"), F.col("sort_type")),
                    F.when(F.col("linking"), "linking"),
                ),
                F.col("start").cast("bigint") + F.col("max_hits").cast("bigint"),
                F.col("max_hits").cast("bigint"),
            ),
            measure(self.groups, F.lit("groups")),
            measure(self.constraints, F.concat(F.col("search_type"), marks)),
            measure(self.details, detail_marks),
            measure(self.authorized),
            measure(self.linking),
            self.searches.join(self.groups, "search_id", "left_anti").select(
                F.lit(0).alias("bytes"), F.lit("open").alias("feature"), F.lit(0).cast("bigint").alias("rank"), F.lit(0).cast("bigint").alias("page_rows"),
            ),
        ]
        measured = (
            reduce(DataFrame.unionByName, parts)
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum("bytes").alias("bytes"),
                F.max("rank").alias("rank"),
                F.sum("page_rows").alias("page_rows"),
                F.collect_set("feature").alias("features"),
            )
            .first()
        )
        self.small = (
            measured["n"] <= BROADCAST_MAX_ROWS and (measured["bytes"] or 0) <= BROADCAST_MAX_BYTES
        )
        self.max_rank = measured["rank"] or 0
        if not self.small:
            # Rows unfolded per search are far more than Spark guesses from the searches' files.
            for name in ("searches", "groups", "constraints", "details", "authorized", "linking"):
                setattr(self, name, self.sized(getattr(self, name)))
        # Pages cannot hold more rows than were asked for.
        self.small_pages = self.small and (measured["page_rows"] or 0) <= BROADCAST_MAX_ROWS
        self.features = {word for mix in measured["features"] for word in mix.split()}

    def sized(self, df: DataFrame) -> DataFrame:
        """A table made of the request tables: never broadcast where those are large."""
        return df if self.small else shuffled(df)


def sub_searches(requests: DataFrame, entity_types: DataFrame) -> DataFrame:
    """One search per entity set of a request, numbered in request order.

    ``requests`` has request_id, entity_set_ids (array) and the page and sort
    columns; ``entity_types`` maps entity_set_id to entity_type_id and says
    whether the set is a linking one.
    """
    exploded = requests.select(
        "*", F.posexplode("entity_set_ids").alias("request_no", "entity_set_id")
    ).drop("entity_set_ids")
    return exploded.join(entity_types, "entity_set_id").withColumn(
        "search_id", F.concat_ws("/", "request_id", "request_no")
    )


def spread_constraints(searches: DataFrame, table: DataFrame) -> DataFrame:
    """Copy rows given per request to each sub-search of the request."""
    return searches.select("search_id", "request_id").join(table, "request_id").drop("request_id")


def scopes(searches: DataFrame) -> DataFrame:
    """Where each search looks: its entity type, and its set or the linked documents."""
    return searches.select(
        "search_id", "entity_type_id",
        F.when(F.col("linking"), F.lit(LINKED)).otherwise(F.col("entity_set_id")).alias("scope"),
    )


def authorised_details(req: Requests) -> DataFrame:
    """Per-property terms of advanced constraints, unauthorised ones dropped."""
    return req.details.join(req.authorized, ["search_id", "property_id"], "left_semi")


def usable_constraints(req: Requests) -> DataFrame:
    """Constraints that keep at least one clause after authorisation.

    A simple or a write-time constraint always does; an advanced one needs an
    authorised term, a geographic one an authorised property (and a polygon a zone).
    """
    searchable = req.constraints.join(req.authorized.select("search_id"), "search_id", "left_semi")
    by_property = searchable.where(
        (F.col("search_type") == "geoDistance")
        | ((F.col("search_type") == "geoPolygon") & (F.size("zones") > 0))
    ).join(req.authorized, ["search_id", "property_id"], "left_semi")
    always = searchable.where(F.col("search_type").isin("simple", "writeDateTimeFilter"))
    usable = always.unionByName(by_property.select(always.columns))
    if "advanced" in req.features:
        advanced = searchable.where(F.col("search_type") == "advanced").join(
            authorised_details(req).select(*CONSTRAINT), CONSTRAINT, "left_semi"
        )
        usable = usable.unionByName(advanced.select(always.columns))
    return usable


def live_searches(req: Requests) -> DataFrame:
    """Searches that may return something, with their number of groups.

    No authorised property, or one group without a usable constraint, makes the
    whole search return nothing.
    """
    allowed = req.searches.join(req.authorized.select("search_id"), "search_id", "left_semi")
    if "groups" not in req.features:
        return allowed.withColumn("n_groups", F.lit(0).cast("bigint"))
    alive = usable_constraints(req).select("search_id", "group_no")
    dead = req.groups.join(alive, ["search_id", "group_no"], "left_anti").select("search_id")
    counts = req.groups.groupBy("search_id").agg(F.size(F.collect_set("group_no")).cast("bigint").alias("n_groups"))
    return (
        allowed.join(req.sized(dead), "search_id", "left_anti")
        .join(counts, "search_id", "left")
        .withColumn("n_groups", F.coalesce("n_groups", F.lit(0).cast("bigint")))
    )


def text_clauses(req: Requests, live: DataFrame, property_types: DataFrame) -> DataFrame:
    """Clauses of the search text of live searches, one row per searched property.

    A simple constraint searches every authorised property, a detail its own.
    """
    simple = (
        req.constraints.where(F.col("search_type") == "simple")
        .join(req.authorized, "search_id")
        .select(
            *CONSTRAINT,
            F.lit(-1).alias("detail_no"), F.lit(0).alias("exact"), F.lit(0).cast("bigint").alias("n_exact"),
            req.authorized.property_id,
            F.when(F.col("fuzzy"), text.fuzzy_rewrite(F.col("search_term")))
            .otherwise(F.col("search_term")).alias("query"),
        )
    )
    queries = simple
    if "advanced" in req.features:
        mine = authorised_details(req)
        needed = mine.groupBy(*CONSTRAINT).agg(F.count_if("exact_match").alias("n_exact"))
        details = (
            req.constraints.where(F.col("search_type") == "advanced").select(*CONSTRAINT)
            .join(mine, CONSTRAINT).join(req.sized(needed), CONSTRAINT)
            .select(
                *CONSTRAINT, "detail_no", F.col("exact_match").cast("int").alias("exact"), "n_exact",
                "property_id", F.col("search_term").alias("query"),
            )
        )
        queries = simple.unionByName(details)
    return (
        queries.join(scopes(live), "search_id")
        .join(property_types.select("property_id", "datatype", "analyzer"), "property_id")
        .select(
            *[c for c in CLAUSE if c != "item_no"], *SCOPE, "property_id", "datatype", "analyzer",
            F.inline(text.query_items(F.col("query"))),
        )
    )
