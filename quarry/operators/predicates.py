"""Predicates of many searches at once: each yields (clause, document, element, score) rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import geo, text
from quarry.functions.phonetic import metaphone_code
from quarry.functions.score import edit_boost, idf, tf_norm
from quarry.operators.fuzzy import expand
from quarry.operators.index import FIELD, Index, scope_of
from quarry.operators.requests import CLAUSE, CONSTRAINT, SCOPE, Requests, scopes
from quarry.operators.typing_ops import typed_key
from quarry.scale import fits, lookup_join, materialize, pushed_values, settle, shuffled, spread_join

MATCH = [*CLAUSE, "property_id", "token_no", "doc_id", "ord", "score"]
EXPLAIN = ["term", "tf", "len", "df", "n_elements", "avg_len"]


# --- tokens of search text -------------------------------------------------


def query_tokens(clauses: DataFrame, phonetic: bool) -> DataFrame:
    """Tokens of plain and phrase clauses under the analyzer of each property."""
    strings = clauses.where(F.col("datatype") == "String")
    tokens = text.analyze(F.col("text"), F.col("analyzer"))
    base = strings.select("*", F.posexplode(tokens).alias("token_no", "term"))
    if not phonetic:
        return base
    spoken = F.col("analyzer") == text.METAPHONE
    pairs = (
        strings.where(spoken & (F.col("kind") == "plain"))
        .select("*", F.inline(text.shingles(tokens)))
        .withColumnRenamed("pos", "token_no")
    )
    words = base.unionByName(pairs)
    heard = words.where(spoken & (F.col("kind") == "plain"))
    coded = heard.withColumn("code", metaphone_code("term")).where(
        "code <> '' and code <> term"
    ).drop("term").withColumnRenamed("code", "term")
    # Codes count as further tokens of the search, after the spoken ones.
    return words.unionByName(coded.select(words.columns))


def scan_filter(tokens: DataFrame, small: bool | None) -> Column:
    """Few searched terms are pushed into the scans of the tables sorted by term."""
    pushed = pushed_values(tokens, [*FIELD, "term"]) if small else None
    return F.lit(True) if pushed is None else pushed


def with_statistics(tokens: DataFrame, index: Index, pushed: Column, small: bool | None) -> DataFrame:
    """Attach document frequency and field statistics to tokens; unknown terms drop out."""
    known = lookup_join(index.term_stats.where(pushed), tokens, [*FIELD, "term"], ["term"], small_fits=small)
    return known.join(index.field_stats, FIELD)


# --- text predicates -------------------------------------------------------


def term_matches(tokens: DataFrame, index: Index, small: bool | None, explain: bool = False) -> DataFrame:
    """Exact token matches with their BM25 score."""
    pushed = scan_filter(tokens, small)
    weighted = with_statistics(tokens, index, pushed, small)
    hits = lookup_join(
        index.postings.where(pushed).drop("positions"), weighted,
        [*SCOPE, "property_id", "term"], ["doc_id", "ord"], small_fits=small,
    )
    score = idf(F.col("n_elements"), F.col("df")) * tf_norm(F.col("tf"), F.col("len"), F.col("avg_len"))
    return hits.withColumn("score", score).select(*MATCH, *(EXPLAIN if explain else []))


def normalized(clauses: DataFrame) -> DataFrame:
    """A term marked with ~ is one token: lowercased unless its property is not analyzed."""
    return clauses.where("kind = 'fuzzy' and datatype = 'String'").select(
        "*",
        F.lit(0).alias("token_no"),
        F.when(F.col("analyzer") == text.NOT_ANALYZED, F.col("text"))
        .otherwise(F.lower("text")).alias("token"),
    )


def fuzzy_matches(tokens: DataFrame, index: Index, small: bool | None, explain: bool = False) -> DataFrame:
    """Matches of every vocabulary term within the allowed edits of a token.

    A match weighs its BM25 score by one minus its edits per character.
    """
    expanded = expand(tokens, index.signatures)
    weighted = (
        lookup_join(expanded, tokens, [*FIELD, "token"], ["term"], small_fits=small)
        .join(index.field_stats, FIELD)
        .withColumn(
            "weight",
            idf(F.col("n_elements"), F.col("df"))
            * edit_boost(F.col("distance"), F.col("token"), F.col("term")),
        )
    )
    # The number of expansions follows the vocabulary, so it is measured before use.
    weighted = materialize(weighted, "expansions")
    small = fits(weighted)
    hits = lookup_join(
        index.postings.where(scan_filter(weighted, small)).drop("positions"), weighted,
        [*SCOPE, "property_id", "term"], ["doc_id", "ord"], small_fits=small,
    )
    score = F.col("weight") * tf_norm(F.col("tf"), F.col("len"), F.col("avg_len"))
    return hits.withColumn("score", score).select(*MATCH, *(EXPLAIN if explain else []))


def phrase_matches(tokens: DataFrame, index: Index, small: bool | None) -> DataFrame:
    """All tokens of a quoted phrase, adjacent and in order, within one value."""
    pushed = scan_filter(tokens, small)
    weighted = with_statistics(tokens, index, pushed, small).withColumn(
        "weight", idf(F.col("n_elements"), F.col("df"))
    )
    sizes = tokens.groupBy(*CLAUSE, "property_id").agg(F.count(F.lit(1)).alias("n_tokens"))
    weighted = lookup_join(weighted, sizes, [*CLAUSE, "property_id"], ["term"], small_fits=small)
    occurrence = [*CLAUSE, "property_id", "doc_id", "ord", "len", "avg_len", "n_tokens"]
    begins = F.transform("positions", lambda p: p - F.col("token_no"))
    placed = lookup_join(
        index.postings.where(pushed), weighted, [*SCOPE, "property_id", "term"], ["doc_id", "ord"], small_fits=small
    ).select(*occurrence, "weight", F.struct(F.size("positions").alias("n"), "token_no", begins.alias("begins")).alias("word"))
    # Positions stay in their lists; those of the rarest word lead, so a common word's are only looked up.
    words = placed.groupBy(*occurrence).agg(F.sort_array(F.collect_list("word")).alias("words"), F.sum("weight").alias("weight"))
    lists = F.transform(F.col("words"), lambda w: w.getField("begins"))
    shared = F.aggregate(F.slice(lists, 2, F.col("n_tokens").cast("int")), F.element_at(lists, 1), lambda left, x: F.array_intersect(left, x))
    whole = words.where(F.size("words") == F.col("n_tokens")).select(*occurrence, "weight", F.explode(shared).alias("begin"))
    return (
        whole.groupBy(*occurrence)
        .agg(F.count(F.lit(1)).alias("tf"), F.max("weight").alias("weight"))
        .withColumn("token_no", F.lit(0))
        .withColumn("score", F.col("weight") * tf_norm(F.col("tf"), F.col("len"), F.col("avg_len")))
        .select(*MATCH)
    )


def typed_matches(clauses: DataFrame, index: Index, small: bool | None) -> DataFrame:
    """Search text that parses as the kind of a non-text property, by equality."""
    keys = (
        clauses.where("kind <> 'fuzzy' and datatype <> 'String'")
        .withColumn("term", typed_key(F.col("text"), F.col("datatype")))
        .where(F.col("term").isNotNull())
        .withColumn("token_no", F.lit(0))
    )
    hits = lookup_join(
        index.typed_terms.where(scan_filter(keys, small)), keys, [*SCOPE, "property_id", "term"], ["doc_id", "ord"], small_fits=small
    )
    return hits.withColumn("score", F.lit(1.0)).select(*MATCH)


def all_tokens(matches: DataFrame, tokens: DataFrame, keys: list[str], small: bool | None) -> DataFrame:
    """Keep elements in which every token of the clause matched; sum the token scores.

    ``keys`` identify a clause, ``matches`` has keys, token_no, doc_id, ord, score.
    """
    sizes = tokens.groupBy(*keys).agg(F.count_distinct("token_no").alias("n_tokens"))
    best = matches.groupBy(*keys, "doc_id", "ord", "token_no").agg(F.max("score").alias("score"))
    found = best.groupBy(*keys, "doc_id", "ord").agg(
        F.count(F.lit(1)).alias("n_found"), F.sum("score").alias("score")
    )
    return lookup_join(found, sizes, keys, ["doc_id"], small_fits=small).where("n_found = n_tokens")


# --- geography -------------------------------------------------------------


def _shape_cells(shapes: DataFrame, box: dict[str, Column]) -> DataFrame:
    """A row per cell; a shape uses the finest level at which it touches few."""
    sides = [F.col(c) for c in ("south", "north", "west", "east")]
    levelled = shapes.withColumns(box).withColumn("level", geo.level_of_box(*sides))
    return levelled.withColumn("cell", F.explode(geo.cells_of_box(*sides, F.col("level"))))


def _at_points(shapes: DataFrame, index_points: DataFrame, small: bool | None) -> DataFrame:
    """Points inside the bounding box of each shape, by an equi-join on cells of several levels.

    A point has one cell per level and a shape uses one level, so a pair meets at most once; only
    levels that some shape uses are looked at.
    """
    lat, lon = F.col("lat"), F.col("lon")
    levels = sorted(r.level for r in shapes.select("level").distinct().where("level is not null").collect())
    cells = geo.cells_of_point(lat, lon, levels) if levels else F.lit(None).cast("array<struct<level:int,row:int,col:int>>")
    gridded = index_points.withColumn("cell", F.explode(cells))
    keys, element = [*SCOPE, "property_id", "cell"], ["doc_id", "ord"]
    # A cell is a key of few points, so large tables of shapes are not repeated for all of them.
    met = lookup_join(gridded, shapes, keys, element, small_fits=True) if small else spread_join(gridded, shapes, keys, element)
    return met.where(geo.in_box(lat, lon))


def _constraints(req: Requests, search_type: str, alone: DataFrame | None) -> DataFrame:
    """Authorised constraints of a kind with their scopes; ``alone`` says which are all their search asks."""
    rows = (
        req.constraints.where(F.col("search_type") == search_type)
        .join(req.authorized, ["search_id", "property_id"], "left_semi")
        .join(scopes(req.searches), "search_id")
    )
    if alone is None:
        return rows.withColumn("alone", F.lit(False))
    marked = rows.join(req.sized(alone.withColumn("alone", F.lit(True))), "search_id", "left")
    return marked.withColumn("alone", F.coalesce("alone", F.lit(False)))


def _circles(req: Requests, alone: DataFrame | None = None) -> tuple[DataFrame, bool]:
    c_lat, c_lon, radius_m = F.col("c_lat"), F.col("c_lon"), F.col("radius_m")
    circles = _constraints(req, "geoDistance", alone).select(
        *CONSTRAINT, *SCOPE, "property_id", "alone",
        F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"),
        geo.metres(F.col("radius"), F.col("unit")).alias("radius_m"),
    )
    measured = circles.withColumns(geo.unit_vector(c_lat, c_lon, "c_") | {"least_cosine": geo.radius_cosine(radius_m)})
    return settle(_shape_cells(measured, geo.circle_box(c_lat, c_lon, radius_m)), "circles")


def _in_circle(shapes: DataFrame, points: DataFrame, small: bool) -> DataFrame:
    placed = points.withColumns(geo.unit_vector(F.col("lat"), F.col("lon"), "p_"))
    cosine = sum((F.col(f"c_{a}") * F.col(f"p_{a}") for a in "yz"), F.col("c_x") * F.col("p_x"))
    return _at_points(shapes, placed, small).where(geo.within(
        F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon"), F.col("radius_m"), cosine, F.col("least_cosine")
    ))


def _zones(req: Requests, alone: DataFrame | None = None) -> tuple[DataFrame, bool]:
    zones = _constraints(req, "geoPolygon", alone).select(
        *CONSTRAINT, *SCOPE, "property_id", (F.col("alone") & (F.size("zones") == 1)).alias("alone"), F.explode("zones").alias("zone")
    ).where(F.size("zone") >= 3)
    zone = F.col("zone")
    boxed = _shape_cells(zones.withColumn("ring", zone), geo.zone_box(F.col("ring"))).withColumns(geo.ring_columns(F.col("ring")))
    return settle(boxed.drop("ring"), "zones")


def _in_zone(shapes: DataFrame, points: DataFrame, small: bool) -> DataFrame:
    return _at_points(shapes, points, small).where(geo.point_in_ring(F.col("lat"), F.col("lon")))


GEOGRAPHY = {"geoDistance": (_circles, _in_circle), "geoPolygon": (_zones, _in_zone)}


def distance_matches(req: Requests, index: Index) -> DataFrame:
    """Points within a radius (inclusive)."""
    shapes, few = _circles(req)
    return _constant(_in_circle(shapes, index.points, few))


def polygon_matches(req: Requests, index: Index) -> DataFrame:
    """Points inside any zone of a constraint; a zone is a ring of [lon, lat] pairs."""
    shapes, few = _zones(req)
    return _constant(_in_zone(shapes, index.points, few))


def alone(req: Requests, live: DataFrame) -> DataFrame:
    """Live searches (search_id) of one constraint in one group that needs no more than one match."""
    rows = reduce(DataFrame.unionByName, [
        table.select(
            "search_id", *[F.lit(int(n == name)).alias(n) for n in ("live", "groups", "constraints")],
            (F.col("n_groups") if name == "live" else F.lit(1)).cast("bigint").alias("n_groups"),
            (F.col("minimum_matches") if name == "groups" else F.lit(1)).alias("minimum"),
        ) for name, table in (("live", live), ("groups", req.groups), ("constraints", req.constraints))
    ])
    counted = rows.groupBy("search_id").agg(*[F.sum(n).alias(n) for n in ("live", "groups", "constraints")], F.max("n_groups").alias("n_groups"), F.max("minimum").alias("minimum"))
    return counted.where("live = 1 and groups = 1 and constraints = 1 and n_groups = 1 and minimum <= 1").select("search_id")


def geo_hits(req: Requests, live: DataFrame, index: Index) -> tuple[list[DataFrame], list[DataFrame]]:
    """Hits (search_id, doc_id, score) of geographic constraints that need no composition, and matches of all others.

    A search that asks for one shape alone meets a document with a single point at most once, so
    such a pair is a hit as it is: the rows of the largest searches are not exchanged by search and document to
    find out. Documents of several points, and searches that ask for more, are matched as ever.
    """
    field, lone = [*SCOPE, "property_id"], materialize(alone(req, live), "alone")
    hits, matches = [], []
    for kind, (shapes_of, test) in GEOGRAPHY.items():
        if kind not in req.features:
            continue
        shapes, few = shapes_of(req, lone)
        asked = lookup_join(index.points, shapes.select(*field).distinct(), field, ["doc_id"], how="left_semi")
        # One point of a document is its smallest: places are kept without a list that could be long.
        counts = materialize(asked.groupBy(*field, "doc_id").agg(
            F.count(F.lit(1)).alias("n"), F.min("lat").alias("lat"), F.min("lon").alias("lon")), "places")
        single = (F.col("n") == 1) & F.col("doc_id").isNotNull()
        if not shapes.where("alone").isEmpty():
            met = test(shapes.where("alone"), counts.where(single).select(*field, "doc_id", F.lit("").alias("ord"), "lat", "lon"), few)
            hits.append(met.select("search_id", "doc_id", F.lit(1.0).alias("score")))
            several = counts.where(~single)
            if not several.isEmpty():
                named = lookup_join(asked.where("doc_id is not null"), several.select(*field, "doc_id"), [*field, "doc_id"], ["ord"], how="left_semi")
                rest = named.unionByName(asked.where("doc_id is null").select(named.columns))
                matches.append(_constant(test(shapes.where("alone"), materialize(rest, "several"), few)))
        if not shapes.where("not alone").isEmpty():
            matches.append(_constant(test(shapes.where("not alone"), asked, few)))
    return hits, matches


# --- nested id lists -------------------------------------------------------


def lists_with_all(asked: DataFrame, lists: DataFrame) -> DataFrame:
    """(search_id, entity_set_id) where the set's nested ids contain every id asked for.

    ``asked`` has search_id, property_ids; ``lists`` has entity_set_id, property_ids. A search
    enters by the one of its ids that the fewest sets hold; only those sets are then tested for the
    rest. An id that every set holds thus pairs no search with all sets, unless it asks for nothing rarer.
    """
    wanted = asked.select("search_id", F.array_distinct("property_ids").alias("ids")).where(F.size("ids") > 0)
    wanted = materialize(wanted, "asked_ids")
    lists = lists.select("entity_set_id", F.array_distinct("property_ids").alias("listed"))
    held = lists.select("entity_set_id", F.explode("listed").alias("property_id"))
    each = wanted.select("search_id", F.explode("ids").alias("property_id"))
    asked_ids = materialize(each.select("property_id").distinct(), "ids")
    few = fits(asked_ids)
    # Counts are partial before they are exchanged, so a hot id is one row per task.
    counts = lookup_join(held, asked_ids, ["property_id"], ["entity_set_id"], few, "left_semi").groupBy("property_id").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "id_counts")
    rarest = lookup_join(each, counts, ["property_id"], ["search_id"], few, "left").groupBy("search_id").agg(
        F.min_by("property_id", F.struct(F.coalesce("n", F.lit(0)), "property_id")).alias("property_id"), F.min(F.coalesce("n", F.lit(0))).alias("n")
    )
    entry = materialize(rarest.where("n > 0").join(shuffled(wanted), "search_id").select("search_id", "property_id", "ids"), "entries")
    met = lookup_join(held, entry, ["property_id"], ["entity_set_id"]).select("search_id", "entity_set_id", "ids")
    alone = met.where(F.size("ids") == 1).select("search_id", "entity_set_id")
    more = met.where(F.size("ids") > 1).join(shuffled(lists), "entity_set_id")
    return alone.unionByName(more.where(F.size(F.array_except("ids", "listed")) == 0).select("search_id", "entity_set_id")).distinct()


# --- write time ------------------------------------------------------------


def written_between(last_write: Column, start: Column, end: Column) -> Column:
    """Half-open window (start, end]; an absent bound does not restrict."""
    return (
        last_write.isNotNull()
        & (start.isNull() | (last_write > start))
        & (end.isNull() | (last_write <= end))
    )


def _any_window(windows: DataFrame) -> Column:
    """The span of all windows as literals, so that the scan of elements (stored by set and write
    time) skips what lies outside every one of them."""
    span = windows.agg(
        F.min("start_date").alias("low"), F.max("end_date").alias("high"),
        F.count_if(F.col("start_date").isNull()).alias("open_low"), F.count_if(F.col("end_date").isNull()).alias("open_high"),
    ).first()
    condition = F.col("last_write").isNotNull()
    if span["low"] is not None and not span["open_low"]:
        condition = condition & (F.col("last_write") > F.lit(span["low"]).cast("timestamp_ntz"))
    if span["high"] is not None and not span["open_high"]:
        condition = condition & (F.col("last_write") <= F.lit(span["high"]).cast("timestamp_ntz"))
    return condition


# Seconds of the buckets of time: an hour, and eight times more at each level.
BUCKETS = [3600 * 8**level for level in range(9)]
WINDOW_BUCKETS = 9


def _bucketed(windows: DataFrame, first: Column, last: Column) -> DataFrame:
    """Windows by the buckets of time they touch: each uses the finest level at which it touches few.

    Bounds are held to the times elements have (``first``, ``last``, in seconds), so an open
    window touches few buckets as well. What a bucket holds beside the window is a small share
    of it, and the exact test follows.
    """
    start = F.greatest(F.coalesce(F.unix_seconds(F.col("start_date").cast("timestamp")), first), first)
    end = F.least(F.coalesce(F.unix_seconds(F.col("end_date").cast("timestamp")), last), last)
    level = F.lit(len(BUCKETS) - 1)
    for n in range(len(BUCKETS) - 2, -1, -1):
        touched = F.floor(end / BUCKETS[n]) - F.floor(start / BUCKETS[n]) + 1
        level = F.when(touched <= WINDOW_BUCKETS, F.lit(n)).otherwise(level)
    size = F.element_at(F.array(*[F.lit(b).cast("bigint") for b in BUCKETS]), F.col("level") + 1)
    buckets = F.sequence(F.floor(start / size), F.floor(end / size))
    return windows.where(start <= end).withColumn("level", level).withColumn("bucket", F.explode(buckets))


def write_time_matches(req: Requests, index: Index) -> DataFrame:
    """Elements written within a window, by an equi-join on buckets of time and the exact test.

    An element has one bucket per level and a window uses one level, so they meet at most once.
    """
    windows = (
        req.constraints.where(F.col("search_type") == "writeDateTimeFilter")
        .join(scopes(req.searches), "search_id")
        .select(*CONSTRAINT, *SCOPE, "start_date", "end_date")
    )
    seconds = F.unix_seconds(F.col("last_write").cast("timestamp"))
    times = index.elements.agg(F.min(seconds).alias("first"), F.max(seconds).alias("last")).first()
    if times["first"] is None:
        bucketed = windows.where("false").withColumns({"level": F.lit(0), "bucket": F.lit(0).cast("bigint")})
    else:
        bucketed = _bucketed(windows, F.lit(times["first"]), F.lit(times["last"]))
    bucketed, few = settle(bucketed, "windows")
    levels = sorted(r.level for r in bucketed.select("level").distinct().collect())
    own = F.array(*[F.struct(F.lit(n).alias("level"), F.floor(seconds / BUCKETS[n]).alias("bucket")) for n in levels])
    elements = index.elements.where(_any_window(windows)).withColumn("scope", scope_of(F.col("entity_set_id")))
    placed = elements.select("*", F.inline(own)) if levels else elements.where("false").withColumns({"level": F.lit(0), "bucket": F.lit(0).cast("bigint")})
    written = lookup_join(placed, bucketed, [*SCOPE, "level", "bucket"], ["doc_id", "ord"], small_fits=few).where(
        written_between(F.col("last_write"), F.col("start_date"), F.col("end_date"))
    )
    return _constant(written)


def _constant(rows: DataFrame) -> DataFrame:
    """Rows of an unscored predicate as matches of weight one."""
    return rows.select(
        *CONSTRAINT,
        F.lit(-1).alias("detail_no"), F.lit(0).alias("exact"), F.lit(0).cast("bigint").alias("n_exact"),
        F.lit(0).alias("item_no"), F.lit("").alias("property_id"), F.lit(0).alias("token_no"),
        "doc_id", "ord", F.lit(1.0).alias("score"),
    )
