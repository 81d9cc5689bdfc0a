"""The catalog: types, entity sets, organizations and other named objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ingest import latest, split_rejects, upsert
from quarry.scale import lookup_join

# Object kinds that have a table.
KINDS = [
    "EntityType", "AssociationType", "PropertyTypeInEntitySet", "App", "Organization",
    "EntityTypeCollection", "EntitySetCollection", "EntitySet",
]
DATA_KINDS = ["EntityType", "AssociationType"]

_NAMES = "struct<namespace:string,name:string>"
_TYPE = f"struct<id:string,type:{_NAMES},title:string,description:string>"
DOC = (
    f"struct<id:string,title:string,description:string,type:{_NAMES},name:string,url:string,"
    f"entityType:{_TYPE},contacts:array<string>,organizationId:string,entityTypeCollectionId:string,"
    "template:array<struct<id:string,name:string,title:string,description:string>>>"
)


def parsed(doc: Column) -> Column:
    """JSON text read leniently under the fields the catalog searches."""
    return F.from_json(doc, DOC)


def object_id(kind: Column, doc: Column) -> Column:
    """An association is known by its entity type's id, everything else by its own."""
    return F.when(kind == "AssociationType", doc.getField("entityType").getField("id")).otherwise(
        doc.getField("id")
    )


def identify(objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give each (kind, doc, …) row its id; refuse unknown kinds and objects without id."""
    keyed = objects.withColumn("_doc", parsed(F.col("doc"))).withColumn(
        "id", object_id(F.col("kind"), F.col("_doc"))
    )
    accepted, rejected = split_rejects(
        keyed,
        {
            "unknown kind": ~F.col("kind").isin(KINDS) | F.col("kind").isNull(),
            "association without entity type": (F.col("kind") == "AssociationType")
            & F.col("_doc.entityType").isNull(),
            "no id": F.col("id").isNull(),
        },
    )
    return accepted.drop("_doc"), rejected.drop("_doc")


def save_objects(current: DataFrame, batch: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Upsert catalog objects by (kind, id); also returns the refused rows."""
    accepted, rejected = identify(batch)
    return upsert(current, accepted, ["kind", "id"], seq), rejected


def delete_objects(
    objects: DataFrame, values: DataFrame, doomed: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Remove objects by (kind, id); entity and association types lose their data too."""
    kept = objects.join(doomed.select("kind", "id").distinct(), ["kind", "id"], "left_anti")
    types = doomed.where(F.col("kind").isin(DATA_KINDS)).select(F.col("id").alias("entity_type_id")).distinct()
    rest = [c for c in values.columns if c != "entity_type_id"]
    return kept, lookup_join(values, types, ["entity_type_id"], rest, how="left_anti")


def patch(
    current: DataFrame, patches: DataFrame, key: str, fields: list[str], seq: str = "seq"
) -> tuple[DataFrame, DataFrame]:
    """Partial update: a field changes only where its ``has_<field>`` flag is set.

    Several patches of one row apply in ``seq`` order. Patches of unknown rows are
    returned as rejected.
    """
    merged = patches.groupBy(key).agg(
        *[
            F.max_by(F.struct(F.col(f)), F.when(F.col(f"has_{f}"), F.col(seq))).alias(f"new_{f}")
            for f in fields
        ]
    )
    joined = current.join(merged, key, "left")
    patched = joined.select(
        *[
            (
                F.when(F.col(f"new_{c}").isNotNull(), F.col(f"new_{c}.{c}")).otherwise(F.col(c)).alias(c)
                if c in fields else F.col(c)
            )
            for c in current.columns
        ]
    )
    rejected = patches.join(current.select(key), key, "left_anti").withColumn("reason", F.lit("unknown id"))
    return patched, rejected


ENTITY_SET_FIELDS = ["title", "description", "property_ids"]


def patch_entity_sets(entity_sets: DataFrame, patches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Patch title, description and the list of property types, which is replaced as a whole.

    ``patches`` has entity_set_id, seq and for each field it may change the field and its flag
    ``has_<field>``. A list set to null becomes empty. Patches of unknown sets are rejected.
    """
    fields = [f for f in ENTITY_SET_FIELDS if f"has_{f}" in patches.columns]
    patched, rejected = patch(entity_sets, patches, "entity_set_id", fields)
    return patched.withColumn("property_ids", F.coalesce("property_ids", F.array().cast("array<string>"))), rejected


def entity_set_catalog(entity_sets: DataFrame, property_types: DataFrame) -> DataFrame:
    """Entity sets with their property types in list order; an unknown id keeps a null place."""
    wanted = entity_sets.select("entity_set_id", F.posexplode("property_ids").alias("pos", "property_id"))
    known = property_types.select("property_id", F.struct(property_types.columns).alias("property_type"))
    listed = (
        lookup_join(wanted, known, ["property_id"], ["entity_set_id"], how="left")
        .groupBy("entity_set_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "property_type"))).alias("listed"))
    )
    return entity_sets.join(listed, "entity_set_id", "left").select(
        *entity_sets.columns,
        F.coalesce(F.transform("listed", lambda x: x.getField("property_type")), F.array()).alias("property_types"),
    )


def organization_docs(organizations: DataFrame) -> DataFrame:
    """Searchable part of an organization."""
    return organizations.select("id", "title", "description")


def rebuild_objects(objects: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """All objects of one kind under the id rule; the last of equal ids stays."""
    accepted, rejected = identify(objects.where(F.col("kind") == kind))
    return latest(accepted, ["kind", "id"], "seq").drop("seq"), rejected


def field_values(objects: DataFrame) -> DataFrame:
    """Searchable fields of catalog objects as long-form values.

    A kind plays the part of an entity type and of an entity set, a field path the
    part of a property, so catalog search uses the entity search engine.
    """
    doc = F.col("_doc")

    def one(*path: str) -> Column:
        column = doc
        for name in path:
            column = column.getField(name)
        return F.array(column)

    def each(part: str) -> Column:
        return F.transform(doc.getField("template"), lambda t: t.getField(part))

    fields = {
        "id": one("id"), "title": one("title"), "description": one("description"),
        "name": one("name"), "url": one("url"),
        "type.name": one("type", "name"), "type.namespace": one("type", "namespace"),
        "entityType.type.name": one("entityType", "type", "name"),
        "entityType.type.namespace": one("entityType", "type", "namespace"),
        "entityTypeCollectionId": one("entityTypeCollectionId"),
        "organizationId": one("organizationId"), "contacts": doc.getField("contacts"),
        "template.id": each("id"), "template.name": each("name"),
        "template.title": each("title"), "template.description": each("description"),
    }
    cells = F.array(
        *[F.struct(F.lit(k).alias("property_id"), v.alias("values")) for k, v in fields.items()]
    )
    rows = objects.withColumn("_doc", parsed(F.col("doc"))).select(
        F.col("kind").alias("entity_type_id"), F.col("id").alias("doc_id"),
        F.col("kind").alias("entity_set_id"), F.lit("0").alias("ord"),
        F.col("id").alias("elem_entity_key_id"), F.col("kind").alias("elem_entity_set_id"),
        F.inline(cells),
    )
    return rows.select(
        *[c for c in rows.columns if c != "values"], F.posexplode("values").alias("value_no", "value")
    ).where(F.col("value").isNotNull())


# Fields searched per kind.
COMMON_FIELDS = ["id", "title", "description"]
KIND_FIELDS = {
    "AssociationType": ["entityType.type.name", "entityType.type.namespace"],
    "App": ["name", "url"],
    "EntityTypeCollection": [
        "type.name", "type.namespace", "template.id", "template.name", "template.title", "template.description",
    ],
    "EntitySetCollection": ["entityTypeCollectionId", "name", "contacts", "organizationId"],
}
OTHER_FIELDS = ["type.name", "type.namespace"]


def searched_fields(kind: str) -> list[str]:
    return COMMON_FIELDS + KIND_FIELDS.get(kind, OTHER_FIELDS)


def searched_fields_of(kind: Column) -> Column:
    """``searched_fields`` of a column of kinds."""
    fields = {k: F.array(*map(F.lit, searched_fields(k))) for k in KIND_FIELDS}
    chosen = F.array(*map(F.lit, COMMON_FIELDS + OTHER_FIELDS))
    for k, named in fields.items():
        chosen = F.when(kind == k, named).otherwise(chosen)
    return chosen
