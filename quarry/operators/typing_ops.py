"""Typed property values, wide entity views, schema evolution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.scale import lookup_join

# Property kinds by how they are stored and searched.
INTEGER_RANGES = {
    "SByte": (-128, 127),
    "Byte": (0, 255),
    "Int16": (-32768, 32767),
    "Int32": (-2147483648, 2147483647),
    "Int64": (-9223372036854775808, 9223372036854775807),
}
FLOATING = ["Double", "Single"]
SEARCHABLE = [
    "Boolean", *INTEGER_RANGES, "Decimal", *FLOATING, "String", "Date", "DateTimeOffset",
    "GeographyPoint",
]
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INTEGER = r"^[+-]?[0-9]+$"
_COORDINATE = r"([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
_POINT = rf"^\s*{_COORDINATE}\s*,\s*{_COORDINATE}\s*$"
_PARTS = r"^([+-]?)([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?$"
_WITH_ZONE = r"[0-9]{1,2}:[0-9]{2}.*(Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2}){0,2}|[A-Za-z]+/[A-Za-z_]+)\s*$"
_EXPONENT_SHIFT = 5_000_000_000

TYPED_COLUMNS = ["v_bool", "v_long", "v_double", "v_decimal", "v_date", "v_ts", "v_lat", "v_lon"]


def instant(value: Column) -> Column:
    """A date-time as its UTC wall clock, whatever offset it is written with; without one it is UTC."""
    micros = F.unix_micros(value.try_cast("timestamp"))
    seconds = (micros.cast("decimal(38,0)") / F.lit(1_000_000).cast("decimal(38,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    moved = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
    return F.when(F.rlike(value, F.lit(_WITH_ZONE)), moved).otherwise(value.try_cast("timestamp_ntz"))


def _decimal(value: Column) -> tuple[Column, Column, Column]:
    """Sign, significant digits (empty for zero) and power of ten of a number of any length."""
    part = lambda n: F.regexp_extract(value, _PARTS, n)
    digits = F.regexp_replace(F.concat(part(2), part(3)), "^0+", "")
    trimmed = F.regexp_replace(digits, "0+$", "")
    written = F.when(part(4) == "", F.lit(0).cast("bigint")).otherwise(part(4).try_cast("bigint"))
    power = written - F.length(part(3)) + F.length(digits) - F.length(trimmed)
    return part(1), trimmed, power


def decimal_key(value: Column) -> Column:
    """Canonical text of a decimal: equal numbers have equal texts, whatever their length."""
    number = F.when(F.rlike(value, F.lit(_NUMBER)), value)
    sign, digits, power = _decimal(number)
    text = F.concat(F.when(sign == "-", "-").otherwise(""), digits, F.lit("E"), power.cast("string"))
    return F.when(digits == "", F.lit("0")).otherwise(text)


def decimal_order(value: Column) -> Column:
    """A text that sorts as the decimal does, for numbers of any length."""
    number = F.when(F.rlike(value, F.lit(_NUMBER)), value)
    sign, digits, power = _decimal(number)
    size = power + F.length(digits)  # below a power of ten of this size
    place = lambda n: F.lpad((n + F.lit(_EXPONENT_SHIFT)).cast("string"), 11, "0")
    turned = F.concat(F.translate(digits, "0123456789", "9876543210"), F.lit(":"))
    return (
        F.when(number.isNull() | size.isNull(), None).when(digits == "", F.lit("1"))
        .when(sign == "-", F.concat(F.lit("0"), place(-size), turned)).otherwise(F.concat(F.lit("2"), place(size), digits))
    )


def typed(value: Column, datatype: Column) -> dict[str, Column]:
    """One column per storage type; a value that does not parse stays NULL everywhere.

    ``v_decimal`` holds what fits into 20 + 18 digits; equality and order of decimals use
    ``decimal_key`` and ``decimal_order``, which have no such limit.
    """
    number = F.when(F.rlike(value, F.lit(_NUMBER)), value)
    whole = F.when(F.rlike(value, F.lit(_INTEGER)), value).try_cast("bigint")
    in_range = F.lit(False)
    for kind, (low, high) in INTEGER_RANGES.items():
        in_range = F.when(datatype == kind, whole.between(low, high)).otherwise(in_range)
    lat = F.regexp_extract(value, _POINT, 1).try_cast("double")
    lon = F.regexp_extract(value, _POINT, 2).try_cast("double")
    is_point = (datatype == "GeographyPoint") & lat.between(-90, 90) & lon.between(-180, 180)
    return {
        "v_bool": F.when((datatype == "Boolean") & value.isin("true", "false"), value == "true"),
        "v_long": F.when(in_range, whole),
        "v_double": F.when(datatype.isin(FLOATING), number.try_cast("double")),
        "v_decimal": F.when(datatype == "Decimal", number.try_cast("decimal(38,18)")),
        "v_date": F.when(datatype == "Date", value.try_cast("date")),
        "v_ts": F.when(datatype == "DateTimeOffset", instant(value)),
        "v_lat": F.when(is_point, lat),
        "v_lon": F.when(is_point, lon),
    }


def typed_row(value: Column, datatype: Column) -> Column:
    """``typed`` as one struct, null for text, which no other kind takes.

    As a lambda over one value it stays out of the generated code around it: the reading of all kinds makes a
    method that the JVM does not compile, and every row then runs it step by step.
    """
    given = F.array(F.struct(value.alias("value"), datatype.alias("datatype")))
    read = F.transform(given, lambda v: F.struct(*[
        column.alias(name) for name, column in typed(v.getField("value"), v.getField("datatype")).items()
    ]))
    return F.when(datatype != "String", F.get(read, 0))


def stored_key() -> Column:
    """``typed_key`` of a typed row, from its columns."""
    decimal = F.get(F.transform(F.array("value"), decimal_key), 0)
    return F.when(F.col("datatype") == "Decimal", decimal).otherwise(
        F.coalesce(*[F.col(c).cast("string") for c in ("v_bool", "v_long", "v_double", "v_date", "v_ts")])
    )


def typed_key(value: Column, datatype: Column) -> Column:
    """Canonical text of a typed value, so that equal values have equal keys.

    NULL for text, points and anything that does not parse.
    """
    t = typed(value, datatype)
    return F.when(datatype == "Decimal", decimal_key(value)).otherwise(F.coalesce(
        t["v_bool"].cast("string"),
        t["v_long"].cast("string"),
        t["v_double"].cast("string"),
        t["v_date"].cast("string"),
        t["v_ts"].cast("string"),
    ))


def type_values(values: DataFrame, property_types: DataFrame) -> DataFrame:
    """Read every value under the kind its property declares.

    Values of unknown properties keep a NULL kind and are not searchable.
    """
    kinds = property_types.select("property_id", "datatype", "analyzer")
    joined = lookup_join(values, kinds, ["property_id"], ["doc_id"], how="left")
    read = joined.withColumn("_typed", typed_row(F.col("value"), F.col("datatype")))
    return read.select(*joined.columns, *[F.col("_typed").getField(c).alias(c) for c in TYPED_COLUMNS]).withColumn(
        "searchable", F.coalesce(F.col("datatype").isin(SEARCHABLE), F.lit(False))
    )


_STORED = {
    "Boolean": "v_bool", "Decimal": "v_decimal", "Date": "v_date", "DateTimeOffset": "v_ts",
    **{kind: "v_long" for kind in INTEGER_RANGES}, **{kind: "v_double" for kind in FLOATING},
}


def wide_view(typed_values: DataFrame, properties: list[tuple[str, str, str]]) -> DataFrame:
    """One row per element: a column per declared property plus the system fields.

    ``properties`` lists (property id, column name, kind). Binary properties are
    left out. The list is given, so no pass over the data discovers columns, and
    the aggregation combines on the map side.
    """
    columns = []
    for property_id, name, kind in properties:
        if kind == "Binary":
            continue
        mine = F.col("property_id") == property_id
        if kind == "GeographyPoint":
            point = F.when(mine & F.col("v_lat").isNotNull(), F.struct("v_lat", "v_lon"))
            columns += [
                F.max(point).getField("v_lat").alias(f"{name}_lat"),
                F.max(point).getField("v_lon").alias(f"{name}_lon"),
            ]
        else:
            stored = F.col(_STORED.get(kind, "value"))
            columns.append(F.sort_array(F.collect_set(F.when(mine, stored))).alias(name))
    keys = ["entity_type_id", "doc_id", "entity_set_id", "ord", "elem_entity_set_id"]
    return typed_values.groupBy(*keys).agg(*columns)


def evolve(*versions: DataFrame) -> DataFrame:
    """Stack tables whose columns were added over time; missing columns read as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), versions)


def types_with_data(*tables: DataFrame) -> DataFrame:
    """Entity types that have documents, with their document counts."""
    docs = evolve(*[t.select("entity_type_id", "doc_id") for t in tables])
    return docs.distinct().groupBy("entity_type_id").agg(F.count(F.lit(1)).alias("n_docs"))
