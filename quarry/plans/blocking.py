"""Blocking: candidate matches for a whole table of records, best ``size`` per record.

A block asks, per property, for documents whose value holds all tokens of a term
within the allowed edits. Equal questions are answered once and equal documents are
matched once, so a value shared by a third of all records costs one comparison, and
a question only meets documents that hold one of its rarest token. Nothing is capped:
the cuts below keep every row that can be among the best ``size``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions import text
from quarry.functions.phonetic import metaphone_code
from quarry.functions.score import edit_boost, idf, tf_norm
from quarry.operators.fuzzy import expand, signature_table
from quarry.operators.index import FIELD, build_postings
from quarry.scale import lookup_join, materialize

QUESTION = ["entity_type_id", "property_id", "question"]


def profiles(typed_values: DataFrame, fields: DataFrame) -> DataFrame:
    """Normal documents with the values the blocks ask for, and a key of that content."""
    asked = lookup_join(
        typed_values.where(F.col("entity_set_id").isNotNull() & (F.col("datatype") == "String")),
        fields, FIELD, ["doc_id"], how="left_semi",
    )
    docs = asked.groupBy("entity_type_id", "doc_id", "entity_set_id").agg(
        F.array_sort(F.collect_set(F.struct("property_id", "value", "datatype", "analyzer"))).alias("content")
    )
    return docs.withColumn("profile", F.md5(F.to_json("content")))


def distinct_profiles(docs: DataFrame) -> DataFrame:
    """One row per content: how many documents share it and the least of their ids."""
    return docs.groupBy("entity_type_id", "profile").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"), F.first("content").alias("content")
    )


def content_postings(shared: DataFrame, phonetic_properties: DataFrame | None) -> DataFrame:
    """Postings of distinct contents; ``n_docs`` weighs them."""
    values = shared.select(
        "entity_type_id", "profile", F.posexplode("content").alias("value_no", "v")
    ).select(
        "entity_type_id", F.col("profile").alias("doc_id"), F.lit("profile").alias("entity_set_id"),
        F.lit("0").alias("ord"), "value_no", "v.*",
    )
    postings = build_postings(values, phonetic_properties).drop("positions", "scope", "ord")
    sizes = shared.select("entity_type_id", F.col("profile").alias("doc_id"), "n_docs")
    return postings.join(sizes, ["entity_type_id", "doc_id"]).withColumnRenamed("doc_id", "profile")


def question_expansions(questions: DataFrame, terms: DataFrame, fields: DataFrame, phonetic: bool) -> DataFrame:
    """(question, token) → vocabulary terms with weight; ``cost`` is the documents a token reaches.

    ``questions`` has entity_type_id, property_id, question, term, analyzer.
    """
    tokens = questions.select(
        *QUESTION, "analyzer",
        F.posexplode(text.analyze(F.col("term"), F.col("analyzer"))).alias("token_no", "token"),
    )
    sizes = tokens.groupBy(*QUESTION).agg(F.count(F.lit(1)).alias("n_tokens"))
    near = expand(tokens, signature_table(terms))
    if phonetic:
        heard = (
            tokens.where(F.col("analyzer") == text.METAPHONE).select(*FIELD, "token").distinct()
            .withColumn("term", metaphone_code("token"))
        )
        near = near.unionByName(
            heard.join(terms, [*FIELD, "term"]).withColumn("distance", F.lit(0)).select(near.columns)
        ).groupBy(*FIELD, "token", "term", "df").agg(F.min("distance").alias("distance"))
    weighted = near.join(fields, FIELD).withColumn(
        "weight",
        idf(F.col("n_elements"), F.col("df")) * edit_boost(F.col("distance"), F.col("token"), F.col("term")),
    )
    weighted = materialize(weighted, "blocking_terms")
    cost = weighted.groupBy(*FIELD, "token").agg(F.sum("df").alias("cost"))
    # A token that reaches nothing leaves its question without an answer.
    reachable = lookup_join(tokens, cost, [*FIELD, "token"], ["question"])
    rarest = reachable.groupBy(*QUESTION).agg(
        F.count(F.lit(1)).alias("n_reached"), F.min_by("token_no", F.struct("cost", "token_no")).alias("rarest")
    ).join(sizes, QUESTION).where("n_reached = n_tokens")
    return (
        lookup_join(reachable.drop("analyzer", "cost"), weighted, [*FIELD, "token"], ["question"])
        .join(rarest.select(*QUESTION, "rarest", "n_tokens"), QUESTION)
    )


def _why(explain: bool) -> list[str]:
    return ["why"] if explain else []


def _reasons(explain: bool) -> list[Column]:
    return [F.flatten(F.collect_list("why")).alias("why")] if explain else []


def question_matches(expanded: DataFrame, postings: DataFrame, explain: bool = False) -> DataFrame:
    """(question, profile, score) for contents that hold all tokens of a question; with ``explain`` also ``why``."""
    entry = expanded.where("token_no = rarest").select(*QUESTION, "term", "n_tokens")
    candidates = (
        lookup_join(
            postings.select(*FIELD, "term", "profile"), entry, [*FIELD, "term"], ["profile"]
        )
        .select(*QUESTION, "n_tokens", "profile")
        .distinct()
    )
    words = candidates.join(postings, [*FIELD, "profile"]).select(
        *QUESTION, "n_tokens", "profile", "term", "tf", "len"
    )
    weights = expanded.select(*QUESTION, "term", "token_no", "token", "distance", "weight", "avg_len")
    reason = F.struct("property_id", "token", "term", "distance", "tf", "len", F.col("score").alias("contribution"))
    best = F.max_by(F.array(reason), F.struct("score", "term")).alias("why")
    tokens = (
        words.join(weights, [*QUESTION, "term"])
        .withColumn("score", F.col("weight") * tf_norm(F.col("tf"), F.col("len"), F.col("avg_len")))
        .groupBy(*QUESTION, "n_tokens", "profile", "token_no")
        .agg(F.max("score").alias("score"), *([best] if explain else []))
    )
    return (
        tokens.groupBy(*QUESTION, "n_tokens", "profile")
        .agg(F.count(F.lit(1)).alias("n_found"), F.sum("score").alias("score"), *_reasons(explain))
        .where("n_found = n_tokens")
        .select(*QUESTION, "profile", "score", *_why(explain))
    )


def block(blocks: DataFrame, typed_values: DataFrame, property_types: DataFrame, size: int, explain: bool = False) -> DataFrame:
    """Best ``size`` documents of each block.

    ``blocks`` has block_id, entity_type_id, property_id, term, any number of rows
    per block: terms and properties are alternatives and their scores add up. Blocks
    without a term find nothing. Result: block_id, rn, entity_set_id, doc_id, score; with
    ``explain`` also ``why``: property, token, the term it matched, edits, tf, len and
    contribution of every match that made the score.
    """
    kinds = property_types.where(F.col("datatype") == "String").select("property_id", "analyzer")
    spoken = kinds.where(F.col("analyzer") == text.METAPHONE).select("property_id")
    phonetic = not spoken.isEmpty()

    asked = lookup_join(blocks, kinds, ["property_id"], ["block_id"]).where(F.col("term").isNotNull())
    asked = materialize(
        asked.groupBy("block_id", "entity_type_id").agg(
            F.array_sort(F.collect_set(F.struct("property_id", "term", "analyzer"))).alias("asks")
        ).withColumn("questionnaire", F.md5(F.to_json("asks"))),
        "blocks",
    )
    forms = (
        asked.groupBy("entity_type_id", "questionnaire").agg(F.first("asks").alias("asks"))
        .select("entity_type_id", "questionnaire", F.inline("asks"))
        .withColumn("question", F.md5(F.concat_ws("\u0001", "entity_type_id", "property_id", "term")))
    )
    forms = materialize(forms, "forms")
    questions = forms.select(*QUESTION, "term", "analyzer").distinct()

    docs = materialize(profiles(typed_values, forms.select(*FIELD).distinct()), "profiles")
    shared = materialize(distinct_profiles(docs), "contents")
    postings = materialize(content_postings(shared, spoken if phonetic else None), "content_postings")
    terms = materialize(
        postings.groupBy(*FIELD, "term").agg(F.sum("n_docs").alias("df")), "content_terms"
    )
    fields = (
        postings.groupBy(*FIELD, "profile").agg(F.max("len").alias("len"), F.max("n_docs").alias("n"))
        .groupBy(*FIELD)
        .agg(F.sum("n").alias("n_elements"), (F.sum(F.col("len") * F.col("n")) / F.sum("n")).alias("avg_len"))
    )
    expanded = materialize(question_expansions(questions, terms, fields, phonetic), "question_terms")
    matched = question_matches(expanded, postings, explain)

    answered = (
        matched.join(forms.select("questionnaire", *QUESTION), QUESTION)
        .groupBy("entity_type_id", "questionnaire", "profile")
        .agg(F.round(F.sum("score"), 6).alias("score"), *_reasons(explain))
    )
    # A content beyond rank ``size`` has that many better contents, each with a better document.
    best = W.partitionBy("entity_type_id", "questionnaire").orderBy(F.desc("score"), "first_doc")
    ranked = (
        answered.join(shared.select("entity_type_id", "profile", "first_doc"), ["entity_type_id", "profile"])
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= size)
        .select("entity_type_id", "questionnaire", "profile", "score", *_why(explain))
    )
    # Within one content only its first ``size`` documents can be returned.
    first = W.partitionBy("entity_type_id", "profile").orderBy("doc_id")
    members = (
        docs.select("entity_type_id", "profile", "doc_id", "entity_set_id")
        .withColumn("nth", F.row_number().over(first))
        .where(F.col("nth") <= size)
        .drop("nth")
    )
    top = W.partitionBy("entity_type_id", "questionnaire").orderBy(F.desc("score"), "doc_id")
    answers = (
        ranked.join(members, ["entity_type_id", "profile"])
        .withColumn("rn", F.row_number().over(top))
        .where(F.col("rn") <= size)
        .select("entity_type_id", "questionnaire", "rn", "entity_set_id", "doc_id", "score", *_why(explain))
    )
    answers = materialize(answers, "answers")
    return lookup_join(
        asked.select("block_id", "entity_type_id", "questionnaire"), answers,
        ["entity_type_id", "questionnaire"], ["block_id"],
    ).select("block_id", "rn", "entity_set_id", "doc_id", "score", *_why(explain))


def per_entity_set(found: DataFrame) -> DataFrame:
    """Answer of a block grouped by entity set; at most ``size`` keys per block."""
    return found.groupBy("block_id", "entity_set_id").agg(F.sort_array(F.collect_set("doc_id")).alias("doc_ids"))
