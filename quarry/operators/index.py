"""Token, posting and statistics tables built from long-form entity values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text
from quarry.functions.phonetic import metaphone_code
from quarry.operators.fuzzy import FIELD, signature_table
from quarry.operators.typing_ops import stored_key
from quarry.scale import lookup_join, materialize

LINKED = "(linked)"
ELEMENT = ["entity_type_id", "scope", "doc_id", "ord"]
# Positions of different values of one property are far apart: phrases never span values.
VALUE_GAP = 1 << 31


def scope_of(entity_set_id: Column) -> Column:
    """Entity set of a normal document, a common marker for linked documents."""
    return F.coalesce(entity_set_id, F.lit(LINKED))


@dataclass
class Index:
    """Search tables of a set of entity types.

    ``postings``    entity_type_id, scope, property_id, term, doc_id, ord, tf, len, positions
    ``typed_terms`` entity_type_id, scope, property_id, term, doc_id, ord
    ``term_stats``  entity_type_id, property_id, term, df
    ``signatures``  entity_type_id, property_id, sig, term, df (fuzzy expansion)
    ``field_stats`` entity_type_id, property_id, n_elements, avg_len
    ``points``      entity_type_id, scope, property_id, doc_id, ord, lat, lon
    ``values``      typed long-form values (sorting)
    ``elements``    one row per element (scoping, write times)
    """

    values: DataFrame
    elements: DataFrame
    property_types: DataFrame
    postings: DataFrame
    typed_terms: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    points: DataFrame
    signatures: DataFrame
    phonetic: bool = False


def base_tokens(values: DataFrame, phonetic: bool) -> DataFrame:
    """Base tokens (and, for phonetic properties, shingles) of each text value."""
    tokens = text.analyze(F.col("value"), F.col("analyzer"))
    rows = values.where(F.col("datatype") == "String").withColumn("tokens", tokens)
    terms = text.positioned(F.col("tokens"))
    if phonetic:
        terms = F.when(
            F.col("analyzer") == text.METAPHONE,
            F.concat(terms, text.shingles(F.col("tokens"))),
        ).otherwise(terms)
    return rows.withColumn("terms", terms)


def with_codes(postings: DataFrame, phonetic_properties: DataFrame, tasks: int | None = None) -> DataFrame:
    """Add the phonetic code of every term of a phonetic property, keeping the term.

    Codes are computed once per distinct term, not per occurrence. With ``tasks`` the postings
    are written first, as they are read three times, and those with a code are dealt over that many
    tasks; what is returned is then stored.
    """
    if tasks:
        postings = materialize(postings, "unsorted")
    spoken = lookup_join(postings, phonetic_properties, ["property_id"], ["doc_id"], how="left_semi")
    # Distinct terms are stored before they are coded: Spark would move the test of the codes, and with it
    # the coding, in front of the grouping.
    terms = materialize(spoken.select("term").distinct(), "spoken_terms")
    codes = terms.withColumn("code", metaphone_code("term")).where("code is not null and code <> '' and code <> term")
    codes = materialize(codes, "codes")
    heard = lookup_join(spoken, codes, ["term"], ["doc_id", "ord"])
    coded = (
        (heard.repartition(tasks, "doc_id", "ord") if tasks else heard)
        .groupBy(*ELEMENT, "property_id", "len", "code")
        .agg(
            F.sum("tf").alias("tf"),
            F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions"),
        )
        .withColumnRenamed("code", "term")
    )
    return postings.unionByName(materialize(coded, "coded") if tasks else coded)


# Text and values of one task while postings are built: tokens take many times the room of their text.
TASK_BYTES, TASK_VALUES = 4 << 20, 100_000


def posting_tasks(typed_values: DataFrame) -> int:
    """Over how many tasks the stored values are dealt, so that none gets more the more there are."""
    measured = typed_values.where(F.col("datatype") == "String").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes")
    ).first()
    cores = typed_values.sparkSession.sparkContext.defaultParallelism
    return max(cores, -(-measured["bytes"] // TASK_BYTES), -(-measured["n"] // TASK_VALUES))


def build_postings(
    typed_values: DataFrame, phonetic_properties: DataFrame | None = None, tasks: int | None = None
) -> DataFrame:
    """Postings of all text properties.

    The raw values are exchanged once, by element; lengths, term counts and
    positions are then computed inside the partitions without another shuffle
    and without a row per token.
    ``tasks`` (see ``posting_tasks``) bounds what a partition holds: left to its bytes it would
    grow with the table, and its tokens would be sorted on disk. With it and phonetic properties
    the result is stored (see ``with_codes``).
    """
    values = (
        typed_values.where(F.col("datatype") == "String")
        .select(
            "entity_type_id", scope_of(F.col("entity_set_id")).alias("scope"), "doc_id", "ord",
            "property_id", "value_no", "value", "datatype", "analyzer",
        )
        .repartition(*([tasks] if tasks else []), "doc_id", "ord")
    )
    tokens = base_tokens(values, phonetic_properties is not None)
    at = F.col("value_no") * F.lit(VALUE_GAP)
    placed = F.transform(
        "terms",
        lambda t: F.named_struct(
            F.lit("term"), t.getField("term"), F.lit("pos"), at + t.getField("pos")
        ),
    )
    fields = tokens.groupBy(*ELEMENT, "property_id").agg(
        F.sum(F.size("tokens")).cast("int").alias("len"),
        F.sort_array(F.flatten(F.collect_list(placed))).alias("placed"),
    )
    # An element's tokens are sorted in its own list and cut where the term changes: no row per token is grouped.
    first = F.filter(
        F.sequence(F.lit(1), F.size("placed")),
        lambda i: (i == 1) | ~F.get("placed", i - 1).getField("term").eqNullSafe(F.get("placed", i - 2).getField("term")),
    )
    cut = fields.where(F.size("placed") > 0).withColumn("first", first)

    def word(i: Column, n: Column) -> Column:
        tf = F.coalesce(F.get("first", n + 1), F.size("placed") + 1) - i
        return F.named_struct(
            F.lit("term"), F.get("placed", i - 1).getField("term"), F.lit("tf"), tf.cast("bigint"),
            F.lit("positions"), F.slice("placed", i, tf).getField("pos"),
        )

    postings = cut.select(*ELEMENT, "property_id", "len", F.inline(F.transform("first", word)))
    if phonetic_properties is None:
        return postings
    return with_codes(postings, phonetic_properties, tasks)


def term_stats(postings: DataFrame) -> DataFrame:
    """Elements per (field, term); partial counts keep hot terms cheap."""
    return postings.groupBy(*FIELD, "term").agg(F.count(F.lit(1)).alias("df"))


def field_stats(postings: DataFrame) -> DataFrame:
    """Elements with text and their mean length, per field."""
    lengths = postings.groupBy(*ELEMENT, "property_id").agg(F.max("len").alias("len"))
    return lengths.groupBy(*FIELD).agg(
        F.count(F.lit(1)).alias("n_elements"), F.avg("len").alias("avg_len")
    )


def typed_terms(typed_values: DataFrame) -> DataFrame:
    """Canonical keys of non-text values, for equality with parsed search text."""
    return (
        typed_values.where("datatype <> 'String'").withColumn("term", stored_key())
        .where(F.col("term").isNotNull())
        .select(
            "entity_type_id", scope_of(F.col("entity_set_id")).alias("scope"), "property_id",
            "term", "doc_id", "ord",
        )
    )


def points(typed_values: DataFrame) -> DataFrame:
    return typed_values.where(F.col("v_lat").isNotNull()).select(
        "entity_type_id", scope_of(F.col("entity_set_id")).alias("scope"), "property_id",
        "doc_id", "ord", F.col("v_lat").alias("lat"), F.col("v_lon").alias("lon"),
    )


# What searches ask each table for, in this order. Terms come first: they say most, and rows that differ
# in their first letters are sorted without comparing the columns that are the same in all of them.
CLUSTER_KEYS = {
    "postings": ["term", "property_id", "entity_type_id", "doc_id"],
    "typed_terms": ["term", "property_id", "entity_type_id", "doc_id"],
    "term_stats": ["term", "property_id", "entity_type_id"],
    "points": ["entity_type_id", "property_id", "lat", "lon"],
    "elements": ["entity_type_id", "entity_set_id", "last_write", "doc_id"],
    "values": ["entity_type_id", "property_id", "doc_id"],
}


def clustered(table: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``table`` range-partitioned and sorted by what searches ask it for.

    Row groups and pages of a searched term, point, write time or property are found by their
    minimum and maximum; a hot value spreads over files because a further column is part of the range.
    """
    if name == "signatures":
        # Some fifty rows a term, so files are sorted each for itself: their pages' minima and maxima need no exchange.
        return table.sortWithinPartitions("sig")
    if name not in CLUSTER_KEYS:
        return table
    keys = CLUSTER_KEYS[name]
    return table.repartitionByRange(*([files] if files else []), *keys).sortWithinPartitions(*keys)


# Rows and text of one task while a table is sorted for searches: what it cannot hold is sorted on disk.
SORT_ROWS, SORT_BYTES = 500_000, 64 << 20


def sort_files(table: DataFrame) -> int | None:
    """Over how many files a written table is sorted; None leaves a small one to Spark."""
    text_bytes = F.coalesce(F.sum(F.octet_length("value")), F.lit(0)) if "value" in table.columns else F.lit(0)
    measured = table.agg(F.count(F.lit(1)).alias("n"), text_bytes.alias("bytes")).first()
    files = max(-(-measured["n"] // SORT_ROWS), -(-measured["bytes"] // SORT_BYTES))
    return None if files <= 1 else max(files, table.sparkSession.sparkContext.defaultParallelism)


def stored(table: DataFrame, name: str) -> DataFrame:
    """``table`` written as it is computed and again ``clustered``: ranges are found by looking at a table
    twice, and it is not computed twice for that."""
    unsorted = materialize(table, f"unsorted_{name}")
    return materialize(clustered(unsorted, name, sort_files(unsorted)), name)


# Terms of one task while signatures are built and sorted: each has some fifty.
TASK_TERMS = 20_000


def _spread(vocabulary: DataFrame) -> DataFrame:
    """Terms over tasks of bounded number, at least one a core: read by its few bytes the table would be one
    task, and over a fixed number of tasks the signatures would be sorted on disk."""
    cores = vocabulary.sparkSession.sparkContext.defaultParallelism
    return vocabulary.repartition(max(cores, -(-vocabulary.count() // TASK_TERMS)))


def build_index(
    typed_values: DataFrame,
    elements: DataFrame,
    property_types: DataFrame,
    keep: bool = True,
) -> Index:
    """All search tables of ``typed_values``.

    With ``keep`` they are written to the shared folder, clustered, so that no search goes back
    to the raw values (a search for a number never reads text) or reads terms it did not ask for.
    """
    spoken = property_types.where(F.col("analyzer") == text.METAPHONE).select("property_id")
    phonetic = not spoken.isEmpty()
    if keep:
        # Typed once; every other table reads the stored values.
        typed_values = stored(typed_values, "values")
        elements = materialize(clustered(elements, "elements"), "elements")
    postings = build_postings(typed_values, spoken if phonetic else None, posting_tasks(typed_values) if keep else None)
    tables = {"typed_terms": typed_terms(typed_values), "points": points(typed_values)}
    if keep:
        by_element = postings if phonetic else materialize(postings, "unsorted")
        postings = materialize(clustered(by_element, "postings", sort_files(by_element)), "postings")
        tables = {name: stored(table, name) for name, table in tables.items()}
    stats = term_stats(postings)
    if keep:
        stats = stored(stats, "term_stats")
    tables |= {"postings": postings, "term_stats": stats, "field_stats": field_stats(by_element if keep else postings), "signatures": signature_table(_spread(stats) if keep else stats)}
    if keep:
        # Sorted numbers are stored by their differences, which the second version of the format allows.
        tables["signatures"] = materialize(clustered(tables["signatures"], "signatures"), "signatures", **{"parquet.writer.version": "v2"})
        tables["field_stats"] = materialize(tables["field_stats"], "field_stats")
    return Index(values=typed_values, elements=elements, property_types=property_types, phonetic=phonetic, **tables)
