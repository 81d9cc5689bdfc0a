"""Employee CSV: fixed columns, salary as a currency string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.schemas import EMPLOYEE_CSV


def currency_to_int(salary: Column) -> Column:
    """``$108,534.00`` → 108534; anything without a leading ``$`` and digits → 0."""
    digits = F.regexp_replace(F.regexp_extract(salary, r"^\$([0-9,]+)", 1), ",", "")
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def read_employees(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    rows = spark.read.schema(EMPLOYEE_CSV).csv(path, header=header)
    return rows.withColumn("salary", currency_to_int(F.col("salary")))
