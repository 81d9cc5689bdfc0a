"""From match rows to hits: same-element groups, minimum matches, AND of groups, scoping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.index import Index, scope_of
from quarry.operators.requests import CONSTRAINT, SCOPE, Requests, scopes
from quarry.scale import lookup_join, materialize, shuffled


# What a reason tells: where a match was found, and what its score is made of.
REASON = ["group_no", "constraint_no", "property_id", "ord", "term", "tf", "len", "df", "n_elements", "avg_len"]
_NONE = "array<struct<group_no int, constraint_no int, property_id string, ord string, term string, tf bigint, len bigint, df bigint, n_elements bigint, avg_len double, contribution double>>"


def _all(explain: bool) -> list[Column]:
    """Reasons of rows whose scores add up."""
    return [F.flatten(F.collect_list("why")).alias("why")] if explain else []


def _why(explain: bool) -> list[str]:
    return ["why"] if explain else []


def _best(explain: bool, *ties: str) -> list[Column]:
    """Reasons of the row with the best score."""
    return [F.max_by("why", F.struct("score", *ties)).alias("why")] if explain else []


def clause_scores(matches: DataFrame, explain: bool = False) -> DataFrame:
    """Fold match rows to one row per (constraint, element).

    Best vocabulary term per token, sum over the tokens of a clause, best property
    per clause, sum over the clauses. An advanced constraint needs all its exact
    terms; without exact terms, any of its terms.
    """
    element = ["doc_id", "ord"]
    detail = [*CONSTRAINT, "detail_no", "exact", "n_exact"]
    clause = [*detail, "item_no"]
    if explain:
        reason = F.struct(*REASON, F.col("score").alias("contribution"))
        matches = matches.withColumn("why", F.array(reason).cast(_NONE))
    tokens = matches.groupBy(*clause, "property_id", "token_no", *element).agg(
        F.max("score").alias("score"), *_best(explain, *(["term"] if explain else [])))
    fields = tokens.groupBy(*clause, "property_id", *element).agg(F.sum("score").alias("score"), *_all(explain))
    best = fields.groupBy(*clause, *element).agg(F.max("score").alias("score"), *_best(explain, "property_id"))
    details = best.groupBy(*detail, *element).agg(F.sum("score").alias("score"), *_all(explain))
    return (
        details.groupBy(*CONSTRAINT, "n_exact", *element)
        .agg(F.sum("exact").alias("n_met"), F.sum("score").alias("score"), *_all(explain))
        .where("n_met >= n_exact")
        .select(*CONSTRAINT, *element, "score", *_why(explain))
    )


def group_hits(scored: DataFrame, groups: DataFrame, small: bool | None, explain: bool = False) -> DataFrame:
    """Elements that meet enough constraints of one group, folded to documents.

    All counted constraints hold on the same element. At least one is needed even
    when the minimum is zero. Scores of the elements add up.
    """
    elements = scored.groupBy("search_id", "group_no", "doc_id", "ord").agg(
        F.count_distinct("constraint_no").alias("n_met"), F.sum("score").alias("score"), *_all(explain)
    )
    enough = lookup_join(
        elements, groups, ["search_id", "group_no"], ["doc_id"], small_fits=small
    ).where(F.col("n_met") >= F.greatest("minimum_matches", F.lit(1)))
    return enough.groupBy("search_id", "group_no", "doc_id").agg(F.sum("score").alias("score"), *_all(explain))


FOLDS = {"sum": F.sum, "max": F.max, "mean": F.avg}


def fold_scores(matches: DataFrame, fold: str = "sum") -> DataFrame:
    """Scores of a document's elements folded to one: their sum, the best or the mean."""
    return matches.groupBy("search_id", "doc_id").agg(F.round(FOLDS[fold]("score"), 6).alias("score"))


def search_hits(grouped: DataFrame, live: DataFrame, small: bool | None, explain: bool = False) -> DataFrame:
    """Documents that every group of a live search accepts, possibly on different elements."""
    docs = grouped.groupBy("search_id", "doc_id").agg(
        F.count(F.lit(1)).alias("n_met"), F.sum("score").alias("score"), *_all(explain)
    )
    wanted = live.where("n_groups > 0").select("search_id", "n_groups")
    return (
        lookup_join(docs, wanted, ["search_id"], ["doc_id"], small_fits=small)
        .where("n_met = n_groups")
        .select("search_id", "doc_id", "score", *_why(explain))
    )


def all_of_set(live: DataFrame, index: Index, small: bool | None) -> DataFrame:
    """Searches without groups: every document of the scope."""
    open_searches = live.where("n_groups = 0").select("search_id")
    docs = index.elements.select("entity_type_id", scope_of(F.col("entity_set_id")).alias("scope"), "doc_id")
    where = scopes(live).join(open_searches, "search_id", "left_semi")
    # Only linked documents have several elements; the scope is cut before they are merged.
    found = lookup_join(docs, where, SCOPE, ["doc_id"], small_fits=small).select("search_id", "doc_id").distinct()
    return found.withColumn("score", F.lit(0.0))


def within_linking(hits: DataFrame, req: Requests, index: Index) -> DataFrame:
    """Linked documents count only if an element comes from a normal set of the search."""
    hits = materialize(hits, "unscoped_hits")
    linking = req.searches.where("linking").select("search_id", "entity_type_id")
    normal = lookup_join(hits, linking.select("search_id"), ["search_id"], ["doc_id"], req.small, "left_anti")
    linked = lookup_join(hits, linking, ["search_id"], ["doc_id"], small_fits=req.small)
    # Sets per document are combined on the map side: a document of very many elements stays one small row.
    sources = (
        index.elements.where(F.col("entity_set_id").isNull())
        .groupBy("entity_type_id", "doc_id")
        .agg(F.collect_set("elem_entity_set_id").alias("sets"))
    )
    # They grow with the elements, whose stored file says little of their size.
    within = linked.join(shuffled(sources), ["entity_type_id", "doc_id"]).select(
        *hits.columns, F.explode("sets").alias("normal_entity_set_id")
    )
    kept = (
        lookup_join(
            within, req.linking, ["search_id", "normal_entity_set_id"], ["doc_id"], small_fits=req.small, how="left_semi"
        )
        .select(*hits.columns)
        .distinct()
    )
    return normal.unionByName(kept)


def compose(
    matches: DataFrame | None, req: Requests, live: DataFrame, index: Index, explain: bool = False, hits: list[DataFrame] = ()
) -> DataFrame:
    """Hits (search_id, doc_id, score) of all searches; with ``explain`` also ``why``, the matches that made the score.

    The match rows are exchanged once, by search and document; every grouping
    above them reuses that partitioning. ``hits`` are those that needed no composition.
    """
    parts = list(hits)
    if matches is not None:
        if explain:  # searches without any text clause have no statistics
            matches = matches.withColumns({c: F.lit(None) for c in REASON if c not in matches.columns})
        placed = matches.repartition("search_id", "doc_id")
        grouped = group_hits(clause_scores(placed, explain), req.groups, req.small, explain)
        parts.append(search_hits(grouped, live, req.small, explain))
    if (matches is None and not parts) or "open" in req.features:
        whole = all_of_set(live, index, req.small)
        parts.append(whole.withColumn("why", F.array().cast(_NONE)) if explain else whole)
    hits = reduce(DataFrame.unionByName, parts)
    if "linking" in req.features:
        hits = within_linking(hits, req, index)
    return hits.withColumn("score", F.round("score", 6))
