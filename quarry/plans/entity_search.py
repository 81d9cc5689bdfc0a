"""Entity search: many constrained, authorised searches answered by one plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import predicates as P
from quarry.operators.compose import compose
from quarry.operators.index import Index
from quarry.operators.rank import page, sort_keys, totals
from quarry.operators.requests import Requests, live_searches, text_clauses
from quarry.scale import materialize, settle


def text_match_rows(req: Requests, live: DataFrame, index: Index, explain: bool = False) -> list[DataFrame]:
    """Match rows of the text constraints, one DataFrame per kind of clause in use."""
    clauses, small = settle(text_clauses(req, live, index.property_types), "clauses")
    # Texts become many tokens, so those are measured themselves.
    tokens, few = settle(P.query_tokens(clauses, index.phonetic), "tokens")
    parts = [
        P.term_matches(tokens.where("kind = 'plain'"), index, few, explain),
        P.typed_matches(clauses, index, small),
    ]
    if "phrase" in req.features:
        parts.append(P.phrase_matches(tokens.where("kind = 'phrase'"), index, few))
    if "fuzzy" in req.features:
        parts.append(P.fuzzy_matches(P.normalized(clauses), index, small, explain))
    return parts


def match_rows(
    req: Requests, live: DataFrame, index: Index, explain: bool = False, places: list[DataFrame] | None = None
) -> DataFrame | None:
    """Match rows of every constraint; only the predicates in use are planned.

    With ``explain`` they carry the term and its statistics, null where a predicate has none. ``places``
    are those of the geographic constraints where they are known (see ``predicates.geo_hits``).
    """
    parts: list[DataFrame] = list(places or [])
    if {"simple", "advanced"} & req.features:
        parts += text_match_rows(req, live, index, explain)
    if "geoDistance" in req.features and places is None:
        parts.append(P.distance_matches(req, index))
    if "geoPolygon" in req.features and places is None:
        parts.append(P.polygon_matches(req, index))
    if "writeDateTimeFilter" in req.features:
        parts.append(P.write_time_matches(req, index))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=explain), parts) if parts else None


def find(req: Requests, index: Index, explain: bool = False) -> DataFrame:
    """All hits (search_id, doc_id, score), unpaged; with ``explain`` also the reasons ``why``."""
    live, _ = settle(live_searches(req), "live")
    if explain or not set(P.GEOGRAPHY) & req.features:
        return compose(match_rows(req, live, index, explain), req, live, index, explain)
    hits, places = P.geo_hits(req, live, index)
    return compose(match_rows(req, live, index, places=places), req, live, index, hits=hits)


def search(req: Requests, index: Index) -> DataFrame:
    """Pages of all searches with exact totals, in request order.

    One row per returned key: search_id, request_id, request_no, rn, entity_set_id,
    doc_id, score, total_hits.
    """
    # Pages and totals both read the hits: they are written once.
    hits = materialize(find(req, index), "hits")
    return page(sort_keys(hits, req, index), req).join(totals(hits), "search_id")


def explained(req: Requests, index: Index) -> DataFrame:
    """The pages of all searches with the reasons of each hit, a row per contribution to its score.

    search_id, rn, doc_id, score, then group_no, constraint_no, property_id, ord and, for text, term, tf, len, df,
    n_elements and avg_len. The unrounded contributions of a hit add up to its score. Matches that
    a better term or property outdoes contribute nothing and are left out; a hit of a search
    without groups has one row without reasons.
    """
    hits = materialize(find(req, index, explain=True), "explained_hits")
    pages = materialize(page(sort_keys(hits.drop("why"), req, index), req), "pages")
    return hits.select("search_id", "doc_id", "why").join(
        pages.select("search_id", "rn", "doc_id", "score"), ["search_id", "doc_id"]
    ).select("search_id", "rn", "doc_id", "score", F.inline_outer("why"))
