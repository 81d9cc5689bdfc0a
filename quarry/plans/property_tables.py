"""Relational queries over one table per property (entity id, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entity_ids(table: DataFrame) -> DataFrame:
    return table.select("entityid")


def with_value(table: DataFrame, condition: Column | str) -> DataFrame:
    """Rows whose value passes; the condition reaches the Parquet scan."""
    return table.where(condition)


def join_properties(entities: DataFrame, properties: dict[str, DataFrame]) -> DataFrame:
    """Inner join of property tables on the entity id, each value under its property's name."""
    named = [t.withColumnRenamed("value", name) for name, t in properties.items()]
    return reduce(lambda left, right: left.join(right, "entityid"), named, entities.select("entityid"))


def where_all(table: DataFrame, *conditions: Column) -> DataFrame:
    """Filters above a join; the optimizer moves each to its side."""
    return table.where(reduce(lambda a, b: a & b, conditions, F.lit(True)))
