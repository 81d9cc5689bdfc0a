"""Stored entity documents: one Parquet partition per batch, the last version of a key counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.ingest import latest, split_rejects

_PARTITIONS = ["batch_id", "rebuilt"]


class DocumentStore:
    """Documents by key under a folder.

    Every batch is a partition of one Parquet table, overwritten when the batch is written again,
    so a replay changes nothing. Readers take the version with the greatest sequence value of every
    key, deletions included, so a late old version never hides a newer one. A rebuild is a partition
    that hides all batches up to its own; readers skip their files.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], seq: str):
        self.spark, self.path, self.schema, self.keys, self.seq = spark, path, schema, keys, seq
        extra = [T.StructField("deleted", T.BooleanType()), T.StructField("batch_id", T.LongType()), T.StructField("rebuilt", T.BooleanType())]
        self._stored = T.StructType(schema.fields + extra)
        spark.createDataFrame([], self._stored).write.mode("append").partitionBy(*_PARTITIONS).parquet(path)

    def _put(self, rows: DataFrame, batch_id: int, rebuilt: bool) -> None:
        named = rows.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("rebuilt", F.lit(rebuilt))
        named.select(self._stored.fieldNames()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *_PARTITIONS).parquet(self.path)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Add or replace documents."""
        self.append(batch.withColumn("deleted", F.lit(False)), batch_id)

    def remove(self, doomed: DataFrame, batch_id: int) -> None:
        """Delete by key; ``doomed`` has the keys and the sequence column."""
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema if f.name not in doomed.columns]
        self.append(doomed.select("*", *empty).withColumn("deleted", F.lit(True)), batch_id)

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Versions with a column ``deleted``."""
        self._put(rows, batch_id, rebuilt=False)

    def read(self) -> DataFrame:
        """Current documents."""
        versions = self.spark.read.schema(self._stored).parquet(self.path)
        # One number, as a literal, so that files of earlier batches are not read.
        through = versions.where("rebuilt").agg(F.max("batch_id")).first()[0]
        if through is not None:
            versions = versions.where((F.col("batch_id") > through) | (F.col("rebuilt") & (F.col("batch_id") == through)))
        newest = latest(versions.drop(*_PARTITIONS), self.keys, self.seq)
        return newest.where("not deleted").select(self.schema.fieldNames())

    def rebuild(self, documents: DataFrame, through: int) -> DataFrame:
        """Replace everything up to batch ``through`` by ``documents`` (last version per key).

        Returns the rows that could not be stored, with the reason.
        """
        rules = {f"no {c}": F.col(c).isNull() for c in [*self.keys, self.seq]}
        accepted, rejected = split_rejects(documents, rules)
        kept = latest(accepted, self.keys, self.seq).withColumn("deleted", F.lit(False))
        # A deleted row without a key marks the rebuild even where no document is left.
        marker = self.spark.range(1).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema], F.lit(True).alias("deleted"))
        self._put(kept.unionByName(marker), through, rebuilt=True)
        return rejected
