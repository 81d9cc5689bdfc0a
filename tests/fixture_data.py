"""Four employees in two entity sets, and one linked document made of two of them."""

from quarry import schemas
from quarry.operators.index import build_index
from quarry.operators.typing_ops import type_values
from quarry.scale import local_table

TYPE = "employee"
SET1, SET2 = "bergen_employees", "night_shift"
PROPERTIES = [
    ("name", "String", "STANDARD"), ("title", "String", "STANDARD"), ("dept", "String", "STANDARD"),
    ("salary", "Int64", None), ("id", "Int64", None), ("home", "GeographyPoint", None),
]
ENTITIES = {
    "e1": (SET1, dict(name="KORVANTIS,  THEOBALDO M", title="DEPUTY LEAD HARBOUR SURVEYOR",
                      dept="SHIPPING", salary="207431", id="12345", home="41.8,-87.6")),
    "e2": (SET1, dict(name="OSTROVA,  LINDEN", title="POLICE OFFICER", dept="POLICE",
                      salary="61775", id="12346", home="41.9,-87.7")),
    "e3": (SET1, dict(name="BRECHT,  GWENDOLA A", title="POLICE OFFICER", dept="POLICE",
                      salary="72460", id="12347")),
    "e4": (SET2, dict(dept="POLICE", id="12347")),
}
ALL = [p for p, _, _ in PROPERTIES]


def property_types(spark):
    rows = [(p, "test", p, p, kind, analyzer) for p, kind, analyzer in PROPERTIES]
    return local_table(spark, rows, schemas.PROPERTY_TYPES)


def values(spark):
    rows = [
        (TYPE, key, es, "0", key, es, prop, 0, value)
        for key, (es, props) in ENTITIES.items() for prop, value in props.items()
    ]
    for n, key in enumerate(["e1", "e4"]):
        es, props = ENTITIES[key]
        rows += [(TYPE, "L", None, str(n), key, es, prop, 0, value) for prop, value in props.items()]
    return local_table(spark, rows, schemas.ENTITY_VALUES)


def elements(vals):
    return vals.selectExpr(
        "entity_type_id", "doc_id", "entity_set_id", "ord", "elem_entity_set_id",
        "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0,0,0,0,cast(ord as int)) as last_write",
    ).distinct()


def index_of_values(spark, vals):
    props = property_types(spark)
    return build_index(type_values(vals, props), elements(vals), props)


def index(spark):
    return index_of_values(spark, values(spark))


def request(spark, constraints, sets=((SET1, False),), allowed=ALL, groups=((0, 1),), details=(),
            linking=(), start=0, max_hits=50, sort=("score", None, None, None), descending=True):
    """Request tables of one request over some sets, as the search expects them."""
    from quarry.operators.requests import Requests

    ids = [f"r/{n}" for n in range(len(sets))]
    searches = [
        (sid, "r", n, es, TYPE, is_linking, start, max_hits, *sort, descending)
        for n, (sid, (es, is_linking)) in enumerate(zip(ids, sets))
    ]
    names = schemas.CONSTRAINTS.fieldNames()
    rows = [tuple({"group_no": 0, "constraint_no": n, "fuzzy": False, **c, "search_id": sid}.get(k) for k in names)
            for sid in ids for n, c in enumerate(constraints)]
    return Requests.of(
        spark,
        searches=local_table(spark, searches, schemas.SEARCHES),
        authorized=local_table(spark, [(s, p) for s in ids for p in allowed], schemas.AUTHORIZED),
        groups=local_table(spark, [(s, g, m) for s in ids for g, m in groups], schemas.SEARCH_GROUPS),
        constraints=local_table(spark, rows, schemas.CONSTRAINTS),
        details=local_table(spark, [(s, *d) for s in ids for d in details], schemas.DETAILS),
        linking=local_table(spark, [(s, n) for s in ids for n in linking], schemas.LINKING),
    )


def simple(term, group=0, fuzzy=False):
    return {"search_type": "simple", "search_term": term, "group_no": group, "fuzzy": fuzzy}
