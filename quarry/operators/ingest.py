"""Writing entities: assembly, upsert, delete, outcome reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.scale import lookup_join

DOCUMENT = ["entity_type_id", "doc_id"]


def assemble(values: DataFrame) -> DataFrame:
    """Normal documents: a property map of value sets, and the entity set twice.

    ``values`` has entity_type_id, doc_id, entity_set_id, property_id, value. Sets
    are combined on the map side; a group is one property of one entity.
    """
    sets = values.groupBy(*DOCUMENT, "entity_set_id", "property_id").agg(
        F.sort_array(F.collect_set("value")).alias("values")
    )
    return sets.groupBy(*DOCUMENT, "entity_set_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("property_id", "values")))).alias("entity"),
    ).withColumn("entity_set_id_key", F.col("entity_set_id"))


def assemble_linked(linked: DataFrame) -> DataFrame:
    """Elements of linked documents, one row per source entity.

    ``linked`` has entity_type_id, linking_id, entity_set_id, entity_key_id,
    property_id, value. The document has no entity set of its own; an element is
    named by its source set and key, so no document is gathered in one place.
    """
    source = ["entity_type_id", "linking_id", "entity_set_id", "entity_key_id"]
    sets = linked.groupBy(*source, "property_id").agg(F.sort_array(F.collect_set("value")).alias("values"))
    elements = sets.groupBy(*source).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("property_id", "values")))).alias("entity")
    )
    return elements.select(
        "entity_type_id", F.col("linking_id").alias("doc_id"), F.lit(None).cast("string").alias("entity_set_id"),
        F.concat_ws("/", "entity_set_id", "entity_key_id").alias("ord"),
        F.col("entity_key_id").alias("id"), F.col("entity_set_id").alias("entity_set_id_key"), "entity",
    )


def long_values(wide: DataFrame, properties: dict[str, Column], keys: dict[str, Column]) -> DataFrame:
    """Long-form values of a wide table in one pass: one row per present property."""
    cells = [
        F.struct(F.lit(name).alias("property_id"), value.cast("string").alias("value"))
        for name, value in properties.items()
    ]
    rows = wide.select(
        *[column.alias(name) for name, column in keys.items()], F.inline(F.array(*cells))
    ).where(F.col("value").isNotNull())
    return rows.withColumn("value_no", F.lit(0))


def latest(batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Last version of each key; partial maxima absorb keys with very many versions."""
    rest = [c for c in batch.columns if c not in keys]
    return batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("v")).select(*keys, "v.*")


def upsert(current: DataFrame, batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Full replacement by key; the last version in the batch wins, an empty batch changes nothing."""
    newest = latest(batch, keys, seq).drop(seq)
    return current.join(newest.select(*keys), keys, "left_anti").unionByName(newest.select(current.columns))


def upsert_values(
    current: DataFrame, batch: DataFrame, keys: list[str] = DOCUMENT, seq: str | None = None
) -> DataFrame:
    """Replace whole documents held in long form by the rows of ``batch``.

    With ``seq`` the batch may hold several versions of a document; the rows of the last one count.
    """
    if seq is not None:
        newest = batch.groupBy(*keys).agg(F.max(seq).alias(seq))
        batch = batch.join(newest, [*keys, seq], "left_semi").drop(seq)
    return current.join(batch.select(*keys).distinct(), keys, "left_anti").unionByName(batch.select(current.columns))


def delete(current: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """Remove rows by key; unknown keys are ignored."""
    return lookup_join(current, doomed.select(*keys).distinct(), keys, keys, how="left_anti")


def in_set(entity_set_id: str, entity_type_id: str) -> Column:
    """Null-safe: documents without a top-level set never belong to one."""
    return (F.col("entity_type_id") == entity_type_id) & F.col("entity_set_id").eqNullSafe(entity_set_id)


def clear_entity_set(
    current: DataFrame, entity_set_id: str, entity_type_id: str, cascade_linked: bool = False
) -> DataFrame:
    """Drop the documents of one entity set. Linked documents stay unless asked for."""
    doomed = in_set(entity_set_id, entity_type_id)
    if cascade_linked:
        doomed = doomed | (
            (F.col("entity_type_id") == entity_type_id) & F.col("elem_entity_set_id").eqNullSafe(entity_set_id)
        )
    return current.where(~doomed)


def cleared_count(current: DataFrame, entity_set_id: str, entity_type_id: str) -> DataFrame:
    """How many documents clearing would remove."""
    return current.where(in_set(entity_set_id, entity_type_id)).agg(
        F.count_distinct("doc_id").alias("n_deleted")
    )


def delete_entity_set(
    entity_sets: DataFrame, current: DataFrame, entity_set_id: str, entity_type_id: str
) -> tuple[DataFrame, DataFrame]:
    """Remove the catalog row of a set and its documents."""
    return (
        entity_sets.where(~F.col("entity_set_id").eqNullSafe(entity_set_id)),
        clear_entity_set(current, entity_set_id, entity_type_id),
    )


def split_rejects(batch: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the first rule they break.

    ``rules`` maps a reason to the condition under which a row is refused.
    """
    reason = reduce(
        lambda rest, rule: F.when(F.coalesce(rule[1], F.lit(False)), rule[0]).otherwise(rest),
        reversed(list(rules.items())),
        F.lit(None).cast("string"),
    )
    judged = batch.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def outcome(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """Row counts per outcome; a batch succeeded when only ``accepted`` appears."""
    both = accepted.select(F.lit("accepted").alias("reason")).unionByName(rejected.select("reason"))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
