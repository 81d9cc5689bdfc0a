import random

import pytest
from pyspark.sql import functions as F

from fixture_data import SET1, SET2, TYPE, property_types, values
from test_text import osa

from quarry import schemas
from quarry.operators.typing_ops import type_values
from quarry.plans import catalog_search as cs
from quarry.plans.blocking import block, per_entity_set
from quarry.scale import local_table

SETS = [
    (SET1, TYPE, "bergen_employees", "Bergen Employees", "people paid in bergen", [], ["dept", "id"]),
    (SET2, TYPE, "night_shift", "NightShift", "crews working after dark", [], ["dept", "name"]),
]
FILTERS = "search_id string, entity_type_id string, property_ids array<string>"
ACL = "search_id string, acl_key array<string>"


@pytest.fixture(scope="module")
def sets(spark):
    return local_table(spark, SETS, schemas.ENTITY_SETS)


@pytest.fixture(scope="module")
def set_index(sets):
    return cs.entity_set_index(sets)


def found(df):
    return sorted((r.search_id, r.entity_set_id, r.total_hits) for r in df.collect())


def test_entity_set_search_by_term_and_type(spark, sets, set_index):
    req = cs.object_requests(spark, [("q", "EntitySet", "Employees", 0, 50), ("none", "EntitySet", "Employees", 0, 50)],
                             fields=cs.ENTITY_SET_FIELDS)
    filters = spark.createDataFrame([("q", TYPE, None), ("none", "other", None)], FILTERS)
    acl = spark.createDataFrame([("q", [SET1, "x"]), ("none", [SET1])], ACL)
    result = cs.entity_set_search(req, set_index, sets, filters, acl, exclude_property_types=True)
    assert found(result) == [("q", SET1, 1)] and "property_ids" not in result.columns


def test_entity_set_is_found_by_one_word_of_its_name(spark):
    sets = local_table(spark, [("s1", TYPE, "harbor_crane_logs", "x", "y", [], []), ("s2", TYPE, "payroll", "x", "y", [], [])], schemas.ENTITY_SETS)
    req = cs.object_requests(spark, [("q", "EntitySet", "crane", 0, 5)], fields=cs.ENTITY_SET_FIELDS)
    filters = spark.createDataFrame([("q", None, None)], FILTERS)
    acl = spark.createDataFrame([("q", ["s1"]), ("q", ["s2"])], ACL)
    assert found(cs.entity_set_search(req, cs.entity_set_index(sets), sets, filters, acl)) == [("q", "s1", 1)]


def test_name_patterns_match_whole_tokens(spark):
    names = spark.createDataFrame([("App", "1", "ns", "widget"), ("App", "2", "ns", "bolts"), ("App", "3", "ns", "midwid")],
                                  "kind string, doc_id string, namespace string, name string")
    asked = local_table(spark, [("a", "App", "ns", "wid|bol", 0, 9), ("b", "App", "n", "(", 0, 9), ("c", "App", "s", "o.t", 0, 9)], cs.NAME_SEARCH)
    # ".*wid" or "bol.*" as a whole: "widget" has neither form.
    assert {(r.search_id, r.doc_id) for r in cs.name_hits(names, asked).collect()} == {("a", "2"), ("a", "3"), ("c", "2")}
    assert [tuple(r) for r in cs.rejected_names(asked).collect()] == [("b", "invalid pattern")]
    pages = cs.name_search(names, asked).collect()
    assert {(r.search_id, r.doc_id, r.total_hits) for r in pages} == {("a", "2", 2), ("a", "3", 2), ("c", "2", 1)}


def test_entity_set_search_without_term(spark, sets, set_index):
    names = ["all", "type first", "both ids", "unlisted", "denied"]
    req = cs.object_requests(spark, [(n, "EntitySet", "", 0, 50) for n in names], fields=cs.ENTITY_SET_FIELDS)
    filters = spark.createDataFrame([
        ("all", None, None), ("type first", TYPE, ["nothing"]), ("both ids", None, ["dept", "id"]),
        ("unlisted", None, ["zzz"]), ("denied", None, None)], FILTERS)
    acl = spark.createDataFrame([(n, [s]) for n in names[:-1] for s in (SET1, SET2)] + [("denied", [])], ACL)
    assert found(cs.entity_set_search(req, None, sets, filters, acl)) == [
        ("all", SET1, 2), ("all", SET2, 2), ("both ids", SET1, 1), ("type first", SET1, 2), ("type first", SET2, 2)]


def test_organization_search(spark):
    orgs = spark.createDataFrame([("o1", "Acme Employees", "people that work at acme"), ("o2", "Other", "nobody")],
                                 "id string, title string, description string")
    index = cs.index_of(cs.organization_values(orgs))
    req = cs.organization_requests(spark, [("plain", "acme", 0, 5), ("typo", "acmee", 0, 5), ("marked", "acmee~", 0, 5),
                                           ("denied", "acme", 0, 5)])
    acl = spark.createDataFrame([(q, ["o1"]) for q in ("plain", "typo", "marked")], ACL)
    result = cs.organization_search(req, index, orgs, acl).collect()
    assert sorted((r.search_id, r.id, r.title) for r in result) == [
        ("marked", "o1", "Acme Employees"), ("plain", "o1", "Acme Employees")]


def test_object_search_uses_the_fields_of_the_kind(spark):
    docs = [("App", "1", '{"id":"1","title":"T","url":"http://sample"}'),
            ("EntityType", "2", '{"id":"2","title":"T","url":"sample"}'),
            ("EntityTypeCollection", "3", '{"id":"3","template":[{"id":"x","title":"first"},{"title":"sample"}]}'),
            ("AssociationType", "4", '{"entityType":{"id":"4","type":{"namespace":"sample","name":"n"}}}')]
    objects = local_table(spark, docs, schemas.METADATA_OBJECTS)
    index = cs.catalog_index(objects)
    req = cs.object_requests(spark, [(k, k, "sampel", 0, 9) for k, *_ in docs])
    result = cs.object_search(req, index, objects).collect()
    assert sorted((r.search_id, r.doc_id) for r in result) == [
        ("App", "1"), ("AssociationType", "4"), ("EntityTypeCollection", "3")]


# --- blocking -----------------------------------------------------------------------


def employee_blocks(spark, rows):
    blocks = spark.createDataFrame(rows, "block_id string, property_id string, term string").withColumn(
        "entity_type_id", F.lit(TYPE))
    props = property_types(spark)
    return block(blocks, type_values(values(spark), props), props, size=10)


def test_blocking_on_the_fixture(spark):
    rows = [("exact", "dept", "POLICE"), ("typo", "dept", "POLCIE"), ("both", "dept", "POLICE"), ("both", "name", "theobaldo"),
            ("none", "dept", "FIRE"), ("partly", "title", "POLICE LEAD"), ("number", "id", "12347")]
    got = {}
    for r in per_entity_set(employee_blocks(spark, rows)).collect():
        got.setdefault(r.block_id, {})[r.entity_set_id] = r.doc_ids
    police = {SET1: ["e2", "e3"], SET2: ["e4"]}
    # Linked documents are never returned; all words of a term are needed.
    assert got == {"exact": police, "typo": police, "both": {SET1: ["e1", "e2", "e3"], SET2: ["e4"]}}


def test_blocking_matches_brute_force_under_skew(spark):
    rng = random.Random(5)
    words = ["alpha", "alhpa", "beta", "betta", "gamma", "delta", "omega", "omego", "of"]
    names = ["alpha of"] * 60 + [" ".join(rng.choices(words, k=rng.choice([1, 2, 3]))) for _ in range(120)]
    ids = [f"d{n:03d}" for n in range(len(names))]
    rows = [(TYPE, i, "s", "0", i, "s", "name", 0, v) for i, v in zip(ids, names)]
    props = property_types(spark)
    typed = type_values(local_table(spark, rows, schemas.ENTITY_VALUES), props)
    blocks = spark.createDataFrame([(i, TYPE, "name", v) for i, v in zip(ids, names)],
                                   "block_id string, entity_type_id string, property_id string, term string")
    size = 7
    got = {}
    for r in block(blocks, typed, props, size).collect():
        got.setdefault(r.block_id, {})[r.rn] = (r.doc_id, r.score)

    def edits(t):
        return 0 if len(t) < 3 else 1 if len(t) <= 5 else 2

    def hit(q, d):
        return all(any(osa(t, w) <= edits(t) for w in d.split()) for t in q.split())

    for i, q in zip(ids, names):
        matching = [j for j, d in zip(ids, names) if hit(q, d)]
        ranked = [got[i][n] for n in sorted(got[i])]
        assert sorted(got[i]) == list(range(1, min(size, len(matching)) + 1))
        assert {d for d, _ in ranked} <= set(matching)
        assert ranked == sorted(ranked, key=lambda x: (-x[1], x[0]))
        if len(matching) <= size:
            assert {d for d, _ in ranked} == set(matching)
    # Equal questions get equal answers.
    assert len({tuple(got[i].items()) for i, q in zip(ids, names) if q == "alpha of"}) == 1
