"""Search tables on disk, laid out so that a search reads little."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry.operators.index import Index, clustered

TABLES = ["values", "elements", "property_types", "postings", "typed_terms", "term_stats", "signatures", "field_stats", "points"]


def write_index(index: Index, path: str, files_per_table: int | None = None) -> None:
    """Write all tables by entity type, each sorted by what searches ask for (see ``clustered``)."""
    for name in TABLES:
        table = clustered(getattr(index, name), name, files_per_table)
        writer = table.write.mode("overwrite")
        if "entity_type_id" in table.columns:
            writer = writer.partitionBy("entity_type_id")
        writer.parquet(f"{path}/{name}")


def read_index(spark: SparkSession, path: str) -> Index:
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in TABLES}
    for name, table in tables.items():
        if "entity_type_id" in table.columns:
            # Partition values that look like numbers are read back as text.
            tables[name] = table.withColumn("entity_type_id", F.col("entity_type_id").cast("string"))
    phonetic = not tables["property_types"].where("analyzer = 'METAPHONE'").isEmpty()
    return Index(**tables, phonetic=phonetic)
