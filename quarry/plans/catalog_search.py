"""Searches over the catalog, answered by the entity search plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas
from quarry.functions import text
from quarry.operators.index import Index, build_index
from quarry.operators.metadata import field_values, searched_fields, searched_fields_of
from quarry.operators.rank import page, sort_keys, totals
from quarry.operators.requests import Requests
from quarry.operators.typing_ops import type_values
from quarry.plans.entity_search import find
from quarry.scale import fits, local_table, lookup_join, materialize

ENTITY_SET_FIELDS = ["id", "name", "title", "description"]
# Names of entity sets are written with underscores, so they are heard letter by letter: runs of
# letters, pairs of them and their sounds.
ENTITY_SET_SPOKEN = ["name", "title", "description"]
ORGANIZATION_FIELDS = ["title", "description"]


def _elements(values: DataFrame) -> DataFrame:
    return values.select(
        "entity_type_id", "doc_id", "entity_set_id", "ord", "elem_entity_set_id",
        F.lit(None).cast("timestamp_ntz").alias("last_write"),
    ).distinct()


def index_of(values: DataFrame, spoken: list[str] = ()) -> Index:
    """Index of catalog values; every field is plain text but for the ``spoken`` ones."""
    fields = sorted({f for kind in ["EntitySet", "Organization", "App", "AssociationType",
                                    "EntityTypeCollection", "EntitySetCollection", "EntityType"]
                     for f in searched_fields(kind)} | set(ENTITY_SET_FIELDS))
    properties = local_table(
        values.sparkSession,
        [(f, "catalog", f, f, "String", text.METAPHONE if f in spoken else text.STANDARD) for f in fields],
        schemas.PROPERTY_TYPES,
    )
    return build_index(type_values(values, properties), _elements(values), properties)


def catalog_index(objects: DataFrame) -> Index:
    """Index of catalog objects (kind, id, doc)."""
    return index_of(field_values(objects))


def _searches(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return local_table(
        spark,
        [
            (sid, sid, n, kind, kind, False, start, size, "score", None, None, None, True)
            for n, (sid, kind, start, size) in enumerate(rows)
        ],
        schemas.SEARCHES,
    )


def _constraint(sid: str, number: int, search_type: str, term: str | None, fuzzy: bool) -> tuple:
    given = {
        "search_id": sid, "group_no": 0, "constraint_no": number, "search_type": search_type,
        "search_term": term, "fuzzy": fuzzy,
    }
    return tuple(given.get(name) for name in schemas.CONSTRAINTS.fieldNames())


OBJECT_SEARCH = T.StructType(
    [
        T.StructField("search_id", T.StringType()), T.StructField("kind", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("start", T.IntegerType()), T.StructField("max_hits", T.IntegerType()),
    ]
)


def _filled(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, null where ``df`` has none."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def object_requests_of(asked: DataFrame, fields: list[str] | None = None) -> Requests:
    """A table of searches (``OBJECT_SEARCH``), any kinds together: the marked term in any field of its kind."""
    allowed = F.array(*map(F.lit, fields)) if fields else searched_fields_of(F.col("kind"))
    group = asked.select("search_id", F.lit(0).alias("group_no"), F.lit(1).alias("minimum_matches"))
    terms = asked.select(
        "search_id", F.col("term").alias("search_term"), F.lit(0).alias("group_no"), F.lit(0).alias("constraint_no"),
        F.lit("simple").alias("search_type"), F.lit(True).alias("fuzzy"))
    searches = asked.withColumns({
        "request_id": F.col("search_id"), "request_no": F.lit(0), "entity_set_id": F.col("kind"), "entity_type_id": F.col("kind"),
        "linking": F.lit(False), "sort_type": F.lit("score"), "descending": F.lit(True),
    })
    return Requests.of(
        asked.sparkSession,
        searches=_filled(searches, schemas.SEARCHES),
        authorized=asked.select("search_id", F.explode(allowed).alias("property_id")),
        groups=group,
        constraints=_filled(terms, schemas.CONSTRAINTS),
    )


def object_requests(spark: SparkSession, asked: list[tuple[str, str, str, int, int]], fields=None) -> Requests:
    """(search id, kind, term, start, size) searches: the marked term in any field of the kind."""
    return object_requests_of(local_table(spark, asked, OBJECT_SEARCH), fields)


def _with_documents(hits: DataFrame, req: Requests, index: Index | None, docs: DataFrame) -> DataFrame:
    """Pages joined to the documents they name (``docs`` has doc_id and source columns)."""
    hits = materialize(hits, "hits")
    rows = page(sort_keys(hits, req, index), req)
    found = rows.select("search_id", "rn", "doc_id", "score").join(totals(hits), "search_id")
    return lookup_join(docs, found, ["doc_id"], ["doc_id"], small_fits=req.small_pages)


def object_search(req: Requests, index: Index, objects: DataFrame) -> DataFrame:
    """Catalog objects of a kind by a fuzzy term over the fields of the kind."""
    hits = materialize(find(req, index), "hits")
    rows = page(sort_keys(hits, req, index), req)
    docs = objects.select(F.col("id").alias("doc_id"), F.col("kind").alias("entity_set_id"), "doc")
    found = rows.select("search_id", "rn", "entity_set_id", "doc_id", "score").join(totals(hits), "search_id")
    return lookup_join(docs, found, ["entity_set_id", "doc_id"], ["doc_id"], small_fits=req.small_pages)


NAME_SEARCH = T.StructType(
    [
        T.StructField("search_id", T.StringType()), T.StructField("kind", T.StringType()),
        T.StructField("namespace", T.StringType()), T.StructField("name", T.StringType()),
        T.StructField("start", T.IntegerType()), T.StructField("max_hits", T.IntegerType()),
    ]
)


def _whole(pattern):
    """The input anywhere in a token; the group keeps alternatives inside the anchors."""
    return F.concat(F.lit("^(?:.*"), pattern, F.lit(".*)$"))


def _valid(pattern):
    return F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), _whole(pattern)).isNotNull()


def rejected_names(asked: DataFrame) -> DataFrame:
    """Name searches whose input is no pattern: search_id and the reason."""
    valid = F.coalesce(_valid(F.col("namespace")) & _valid(F.col("name")), F.lit(False))
    return asked.where(~valid).select("search_id", F.lit("invalid pattern").alias("reason"))


GRAM = 3
# A pattern with alternatives, groups, classes or escapes may do without any of its letters.
_UNCLEAR = r"[|()\[\]\\]"
# A letter that may be absent: one before ?, * or a count.
_OPTIONAL = r".(?:[?*]|\{[^}]*\}?)[?+]?"
_RUN = r"[\p{L}\p{N}_]{3,}"


def _grams(value: Column) -> Column:
    """Every run of three characters of ``value``."""
    n = F.length(value) - (GRAM - 1)
    starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(value, i, F.lit(GRAM))))


def required_grams(pattern: Column) -> Column:
    """Grams that every token the pattern matches must hold; none where that is not plain to see."""
    sure = F.regexp_replace(pattern, _OPTIONAL, ".")
    runs = F.regexp_extract_all(sure, F.lit(_RUN), F.lit(0))
    grams = F.array_distinct(F.flatten(F.transform(runs, _grams)))
    return F.when(pattern.rlike(_UNCLEAR), F.array().cast("array<string>")).otherwise(grams)


def pattern_tokens(tokens: DataFrame, patterns: DataFrame) -> DataFrame:
    """(kind, field, token, pattern) where the pattern matches somewhere in the token.

    ``tokens`` has kind, field, token and ``patterns`` kind, field, pattern, both distinct. A
    pattern enters by the one of its required grams that the fewest tokens hold, and is tried on
    those tokens only. Patterns without such a gram (shorter literals, alternatives, groups,
    classes, escapes) are tried on every token of their kind and field: there is no exact way
    round it.
    """
    place = ["kind", "field"]
    patterns = materialize(patterns.withColumn("grams", required_grams(F.col("pattern"))), "patterns")
    open_ones = patterns.where(F.size("grams") == 0).select(*place, "pattern")
    each = materialize(patterns.select(*place, "pattern", F.explode("grams").alias("gram")), "grams")
    asked = materialize(each.select(*place, "gram").distinct(), "asked_grams")
    few = fits(asked)
    held = lookup_join(tokens.select(*place, "token", F.explode(_grams(F.col("token"))).alias("gram")), asked, [*place, "gram"], ["token"], few, "left_semi")
    held = materialize(held, "held_grams")
    counts = held.groupBy(*place, "gram").agg(F.count(F.lit(1)).alias("n"))
    # A gram that no token holds leaves its pattern without any match.
    known = each.join(counts, [*place, "gram"], "left").groupBy(*place, "pattern").agg(
        F.min(F.coalesce("n", F.lit(0))).alias("n"), F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram")
    )
    entry = known.where("n > 0").select(*place, "gram", "pattern")
    by_gram = lookup_join(held, entry, [*place, "gram"], ["token"]).select(*place, "token", "pattern")
    by_all = lookup_join(tokens, open_ones, place, ["token"]).select(*place, "token", "pattern")
    return by_gram.unionByName(by_all).where(F.rlike("token", _whole(F.col("pattern"))))


def name_hits(names: DataFrame, asked: DataFrame) -> DataFrame:
    """Objects with a namespace token and a name token that the input matches as a whole, ``.*``
    before and after it.

    ``names`` has kind, doc_id, namespace, name. The input is a pattern and is not lowercased;
    tokens are. Searches with an invalid pattern find nothing (``rejected_names``). Patterns meet
    distinct tokens (``pattern_tokens``); documents and searches meet by equality afterwards.
    """
    asked = asked.join(rejected_names(asked), "search_id", "left_anti")
    fields = ["namespace", "name"]
    tokens = reduce(DataFrame.unionByName, [
        names.select("kind", F.lit(f).alias("field"), F.explode(text.standard_tokens(F.col(f))).alias("token")) for f in fields
    ]).distinct()
    patterns = reduce(DataFrame.unionByName, [
        asked.select("kind", F.lit(f).alias("field"), F.col(f).alias("pattern")) for f in fields
    ]).distinct()
    met = materialize(pattern_tokens(materialize(tokens, "tokens"), patterns), "matched_tokens")

    def matching(field: str) -> DataFrame:
        """(search_id, doc_id) by one field; distinct, as several tokens may match."""
        held = names.select("kind", "doc_id", F.explode(text.standard_tokens(F.col(field))).alias("token"))
        found = lookup_join(held, met.where(F.col("field") == field).drop("field"), ["kind", "token"], ["doc_id"])
        wanted = asked.select("search_id", "kind", F.col(field).alias("pattern"))
        return lookup_join(found, wanted, ["kind", "pattern"], ["doc_id"]).select("search_id", "doc_id").distinct()

    both = matching("namespace").join(matching("name"), ["search_id", "doc_id"])
    return both.select("search_id", "doc_id", F.lit(2.0).alias("score"))


def name_search(names: DataFrame, asked: list[tuple] | DataFrame) -> DataFrame:
    """Pages and totals of fully-qualified-name searches, given as rows or as a table."""
    spark = names.sparkSession
    requests = asked if isinstance(asked, DataFrame) else local_table(spark, asked, NAME_SEARCH)
    hits = materialize(name_hits(names, requests), "hits")
    none = F.lit(None).cast("string")
    searches = requests.select(
        "search_id", F.col("search_id").alias("request_id"), F.lit(0).alias("request_no"), F.col("kind").alias("entity_set_id"),
        F.col("kind").alias("entity_type_id"), F.lit(False).alias("linking"), "start", "max_hits", F.lit("score").alias("sort_type"),
        none.alias("sort_property_id"), none.cast("double").alias("sort_lat"), none.cast("double").alias("sort_lon"),
        F.lit(True).alias("descending"),
    )
    authorized = requests.select("search_id", F.lit("id").alias("property_id"))
    req = Requests.of(spark, searches=searches, authorized=authorized)
    keyed = hits.withColumns(
        {"k_long": F.lit(0).cast("bigint"), "k_double": none.cast("double"), "k_text_asc": none, "k_text_desc": none}
    )
    return page(keyed, req).select("search_id", "rn", "doc_id").join(totals(hits), "search_id")


def allowed_ids(acl_keys: DataFrame) -> DataFrame:
    """Ids a caller may see: the first element of each ACL key."""
    return acl_keys.select("search_id", F.get("acl_key", 0).alias("doc_id")).distinct()


def only_allowed(hits: DataFrame, acl_keys: DataFrame) -> DataFrame:
    """Hits on allowed ids; an empty list allows nothing."""
    return hits.join(allowed_ids(acl_keys), ["search_id", "doc_id"], "left_semi")


def organization_requests(spark: SparkSession, asked: list[tuple[str, str, int, int]]) -> Requests:
    """(search id, term, start, size): title or description; only terms marked ~ are fuzzy."""
    return Requests.of(
        spark,
        searches=_searches(spark, [(s, "Organization", b, n) for s, _, b, n in asked]),
        authorized=local_table(
            spark, [(s, f) for s, *_ in asked for f in ORGANIZATION_FIELDS], schemas.AUTHORIZED
        ),
        groups=local_table(spark, [(s, 0, 1) for s, *_ in asked], schemas.SEARCH_GROUPS),
        constraints=local_table(
            spark,
            [_constraint(s, n, "advanced", None, False) for s, *_ in asked for n in range(len(ORGANIZATION_FIELDS))],
            schemas.CONSTRAINTS,
        ),
        details=local_table(
            spark,
            [(s, 0, n, 0, f, t, False) for s, t, *_ in asked for n, f in enumerate(ORGANIZATION_FIELDS)],
            schemas.DETAILS,
        ),
    )


def organization_search(
    req: Requests, index: Index, organizations: DataFrame, acl_keys: DataFrame
) -> DataFrame:
    """Organizations by title or description among the allowed ids, id included."""
    hits = only_allowed(find(req, index), acl_keys)
    docs = organizations.select(F.col("id").alias("doc_id"), "title", "description")
    return _with_documents(hits, req, index, docs).withColumnRenamed("doc_id", "id")


def organization_values(organizations: DataFrame) -> DataFrame:
    """Organizations as long-form values of the kind ``Organization``."""
    return _flat_values(organizations, "Organization", "id", ["id", "title", "description"])


def entity_set_values(entity_sets: DataFrame) -> DataFrame:
    """Entity sets as long-form values of the kind ``EntitySet``."""
    named = entity_sets.withColumn("id", F.col("entity_set_id"))
    return _flat_values(named, "EntitySet", "entity_set_id", ENTITY_SET_FIELDS)


def entity_set_index(entity_sets: DataFrame) -> Index:
    return index_of(entity_set_values(entity_sets), ENTITY_SET_SPOKEN)


def _flat_values(rows: DataFrame, kind: str, key: str, fields: list[str]) -> DataFrame:
    cells = F.array(
        *[F.struct(F.lit(f).alias("property_id"), F.col(f).cast("string").alias("value")) for f in fields]
    )
    return rows.select(
        F.lit(kind).alias("entity_type_id"), F.col(key).alias("doc_id"), F.lit(kind).alias("entity_set_id"),
        F.lit("0").alias("ord"), F.col(key).alias("elem_entity_key_id"), F.lit(kind).alias("elem_entity_set_id"),
        F.inline(cells),
    ).withColumn("value_no", F.lit(0)).where(F.col("value").isNotNull())


def has_all(listed, wanted):
    """Every wanted id is in the nested list."""
    return F.size(F.array_except(wanted, listed)) == 0


def entity_set_hits(
    hits: DataFrame | None, entity_sets: DataFrame, filters: DataFrame, acl_keys: DataFrame
) -> DataFrame:
    """Entity sets that pass the filters of each search and are allowed.

    ``filters`` has search_id, entity_type_id, property_ids (both optional). A given
    entity type takes precedence over property types. ``hits`` are the term hits;
    searches without a term start from every allowed set.
    """
    allowed = allowed_ids(acl_keys)
    if hits is None:
        hits = allowed.join(
            entity_sets.select(F.col("entity_set_id").alias("doc_id")), "doc_id", "left_semi"
        ).select("search_id", "doc_id", F.lit(0.0).alias("score"))
    else:
        hits = hits.join(allowed, ["search_id", "doc_id"], "left_semi")
    sets = entity_sets.select(
        F.col("entity_set_id").alias("doc_id"), F.col("entity_type_id").alias("set_type"),
        F.col("property_ids").alias("set_properties"),
    )
    met = lookup_join(hits.join(sets, "doc_id"), filters, ["search_id"], ["doc_id"]).where(
        F.when(F.col("entity_type_id").isNotNull(), F.col("set_type") == F.col("entity_type_id"))
        .when(F.col("property_ids").isNotNull(), has_all(F.col("set_properties"), F.col("property_ids")))
        .otherwise(True)
    )
    return met.select("search_id", "doc_id", "score")


def entity_set_search(
    req: Requests, index: Index | None, entity_sets: DataFrame, filters: DataFrame, acl_keys: DataFrame,
    exclude_property_types: bool = False,
) -> DataFrame:
    """Entity-set metadata search: optional fuzzy term, type or property filter, allowed ids."""
    term_hits = None if index is None else find(req, index)
    hits = entity_set_hits(term_hits, entity_sets, filters, acl_keys)
    docs = entity_sets.withColumnRenamed("entity_set_id", "doc_id")
    if exclude_property_types:
        docs = docs.drop("property_ids", "property_types")
    return _with_documents(hits, req, index, docs).withColumnRenamed("doc_id", "entity_set_id")
