"""Assembled entities as JSON lines with ISO dates and times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iso_date(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def iso_datetime(value: Column) -> Column:
    """UTC date-time with offset and microseconds."""
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def iso_time(value: Column) -> Column:
    return F.date_format(value, "HH:mm:ss.SSSSSS")


def json_lines(documents: DataFrame) -> DataFrame:
    """One JSON text per document; date and time columns are rendered as ISO strings."""
    rendered = []
    for field in documents.schema:
        kind, column = field.dataType.typeName(), F.col(field.name)
        if kind == "date":
            column = iso_date(column)
        elif kind == "timestamp":
            # An instant: shown on the UTC clock whatever the session's zone.
            column = iso_datetime(F.convert_timezone(F.current_timezone(), F.lit("UTC"), column.cast("timestamp_ntz")))
        elif kind == "timestamp_ntz":
            column = iso_datetime(column)
        elif kind.startswith("time"):
            column = iso_time(F.concat(F.lit("1970-01-01 "), column.cast("string")).cast("timestamp_ntz"))
        rendered.append(column.alias(field.name))
    return documents.select(F.to_json(F.struct(*rendered)).alias("value"))


def write_json_lines(documents: DataFrame, path: str) -> None:
    json_lines(documents).write.mode("overwrite").text(path)
