"""Declared schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

_s, _i, _l, _d, _b = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


PROPERTY_TYPES = _struct(
    property_id=_s, namespace=_s, name=_s, title=_s, datatype=_s, analyzer=_s
)

ENTITY_SETS = _struct(
    entity_set_id=_s, entity_type_id=_s, name=_s, title=_s, description=_s,
    contacts=T.ArrayType(_s), property_ids=T.ArrayType(_s),
)

# One row per (document, element, property, value). A linked document has no
# top-level entity_set_id; each of its elements keeps the set it came from.
# ``ord`` names the element within its document: "0" in a normal document,
# set and key of the source entity in a linked one.
ENTITY_VALUES = _struct(
    entity_type_id=_s, doc_id=_s, entity_set_id=_s, ord=_s, elem_entity_key_id=_s,
    elem_entity_set_id=_s, property_id=_s, value_no=_i, value=_s,
)

ELEMENTS = _struct(
    entity_type_id=_s, doc_id=_s, entity_set_id=_s, ord=_s, elem_entity_set_id=_s,
    last_write=T.TimestampNTZType(),
)

# A row per sub-search: one entity set of one request, in request order.
SEARCHES = _struct(
    search_id=_s, request_id=_s, request_no=_i, entity_set_id=_s, entity_type_id=_s,
    linking=_b, start=_i, max_hits=_i, sort_type=_s, sort_property_id=_s,
    sort_lat=_d, sort_lon=_d, descending=_b,
)

SEARCH_GROUPS = _struct(search_id=_s, group_no=_i, minimum_matches=_i)

CONSTRAINTS = _struct(
    search_id=_s, group_no=_i, constraint_no=_i, search_type=_s, search_term=_s, fuzzy=_b,
    property_id=_s, lat=_d, lon=_d, radius=_d, unit=_s,
    zones=T.ArrayType(T.ArrayType(T.ArrayType(_d))),
    start_date=T.TimestampNTZType(), end_date=T.TimestampNTZType(),
)

DETAILS = _struct(
    search_id=_s, group_no=_i, constraint_no=_i, detail_no=_i, property_id=_s,
    search_term=_s, exact_match=_b,
)

AUTHORIZED = _struct(search_id=_s, property_id=_s)

LINKING = _struct(search_id=_s, normal_entity_set_id=_s)

METADATA_OBJECTS = _struct(kind=_s, id=_s, doc=_s)

EMPLOYEE_CSV = _struct(name=_s, title=_s, dept=_s, salary=_s)
