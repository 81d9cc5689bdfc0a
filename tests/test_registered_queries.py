"""Registered queries agree with their SQL on the smallest supplied data."""

import os

import duckdb
import pytest

from quarry.workload.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents benchmark conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied data not present")
# One of each family; all of them are compared by the driver.
SAMPLE = ["A1_typed_values", "B4_shingles", "B8_analyzer_per_property", "C3_upsert_entities", "C12_rebuild_entity_set_catalog",
          "D4_phrase_search", "D9_geo_polygon", "D16_boolean_composition", "E5_sort_by_distance", "E9_sub_searches", "E13_explain_search",
          "F1_linked_entity_search", "F2_blocking", "J6_filters_above_join"]
IDS = ([f"A{n}" for n in range(1, 5)] + [f"B{n}" for n in range(1, 9)] + [f"C{n}" for n in range(1, 19)]
       + [f"D{n}" for n in range(1, 25)] + [f"E{n}" for n in range(1, 14)] + [f"F{n}" for n in range(1, 7)]
       + [f"J{n}" for n in range(1, 7)])


def test_every_operator_is_registered():
    assert {key.split("_")[0] for key in QUERIES} == set(IDS)
    assert set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def normal(value):
    return "NULL" if value is None else f"{value:.6g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("key", SAMPLE)
def test_agrees_with_sql(spark, database, key):
    result = QUERIES[key](spark, SF).toArrow()
    names = sorted(result.column_names)
    got = sorted(tuple(map(normal, r)) for r in zip(*[result.column(c).to_pylist() for c in names]))
    cursor = database.execute(ORACLES[key])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    order = [columns.index(n) for n in names]
    assert got == sorted(tuple(normal(r[i]) for i in order) for r in cursor.fetchall())
