"""Hand-derived expectations on the employee fixture."""

import pytest
from fixture_data import SET1, SET2, index, request, simple

from quarry.plans.entity_search import explained, find, search


@pytest.fixture(scope="module")
def idx(spark):
    return index(spark)


def keys(df):
    rows = df.orderBy("request_no", "rn").collect()
    return [(r.entity_set_id, r.doc_id) for r in rows], sum({r.search_id: r.total_hits for r in rows}.values())


def docs(req, idx):
    return {r.doc_id for r in find(req, idx).collect()}


def test_term_in_any_authorised_property(spark, idx):
    found, total = keys(search(request(spark, [simple("police")]), idx))
    assert sorted(found) == [(SET1, "e2"), (SET1, "e3")] and total == 2


def test_two_sets_in_request_order_with_one_property(spark, idx):
    req = request(spark, [simple("12347")], sets=((SET1, False), (SET2, False)), allowed=["id"])
    assert keys(search(req, idx)) == ([(SET1, "e3"), (SET2, "e4")], 2)


def test_no_authorised_property_finds_nothing(spark, idx):
    assert docs(request(spark, [simple("police")], allowed=[]), idx) == set()


@pytest.mark.parametrize("term,expected", [
    ("polcie", {"e2", "e3"}), ("ostrvoa", {"e2"}), ("zzz", set()), ("survyeor", {"e1"}),
])
def test_fuzzy(spark, idx, term, expected):
    assert docs(request(spark, [simple(term, fuzzy=True)]), idx) == expected


def test_phrase_needs_order(spark, idx):
    assert docs(request(spark, [simple('"police officer"')]), idx) == {"e2", "e3"}
    assert docs(request(spark, [simple('"officer police"')]), idx) == set()
    assert docs(request(spark, [simple('"lead harbour"')]), idx) == {"e1"}


def advanced(*details):
    return [(0, 0, n, prop, term, exact) for n, (prop, term, exact) in enumerate(details)]


@pytest.mark.parametrize("details,expected", [
    ([("dept", "police", True), ("title", "surveyor", False)], {"e2", "e3"}),
    ([("dept", "shipping", False), ("title", "officer", False)], {"e1", "e2", "e3"}),
    ([("dept", "police", True), ("name", "brecht", True)], {"e3"}),
])
def test_advanced(spark, idx, details, expected):
    req = request(spark, [{"search_type": "advanced"}], details=advanced(*details))
    assert docs(req, idx) == expected


def test_unauthorised_detail_is_dropped(spark, idx):
    req = request(spark, [{"search_type": "advanced"}], allowed=["title"],
                  details=advanced(("dept", "shipping", True), ("title", "officer", False)))
    assert docs(req, idx) == {"e2", "e3"}
    req = request(spark, [{"search_type": "advanced"}], allowed=["title"],
                  details=advanced(("dept", "shipping", True)))
    assert docs(req, idx) == set()


GEO = {"search_type": "geoDistance", "property_id": "home", "lat": 41.8, "lon": -87.6,
       "radius": 1.0, "unit": "kilometers"}


def test_geo(spark, idx):
    assert docs(request(spark, [GEO]), idx) == {"e1"}
    assert docs(request(spark, [dict(GEO, radius=20.0, unit="miles")]), idx) == {"e1", "e2"}
    assert docs(request(spark, [GEO], allowed=["dept"]), idx) == set()
    zone = [[-88.0, 41.0], [-87.0, 41.0], [-87.0, 41.85], [-88.0, 41.85]]
    poly = {"search_type": "geoPolygon", "property_id": "home", "zones": [zone]}
    assert docs(request(spark, [poly]), idx) == {"e1"}


def test_unauthorised_geo_kills_only_its_group(spark, idx):
    both = [dict(GEO, group_no=0), simple("police", 0)]
    assert docs(request(spark, both, allowed=["dept"]), idx) == {"e2", "e3"}
    two = [dict(GEO, group_no=0), simple("police", 1)]
    assert docs(request(spark, two, allowed=["dept"], groups=((0, 1), (1, 1))), idx) == set()
    # A dropped constraint does not lower the minimum.
    assert docs(request(spark, both, allowed=["dept"], groups=((0, 2),)), idx) == set()


LINKED = dict(sets=(("linking", True),), linking=[SET1, SET2])


def test_same_element(spark, idx):
    one = [simple("theobaldo"), simple("shipping")]
    assert docs(request(spark, one, groups=((0, 2),), **LINKED), idx) == {"L"}
    across = [simple("theobaldo"), simple("police")]
    assert docs(request(spark, across, groups=((0, 2),), **LINKED), idx) == set()
    split = [simple("theobaldo", 0), simple("police", 1)]
    assert docs(request(spark, split, groups=((0, 1), (1, 1)), **LINKED), idx) == {"L"}


def test_linking_needs_a_source_set(spark, idx):
    req = request(spark, [simple("police")], sets=(("linking", True),), linking=["other"])
    assert docs(req, idx) == set()


def test_no_groups_returns_the_set(spark, idx):
    assert docs(request(spark, [], groups=()), idx) == {"e1", "e2", "e3"}
    assert docs(request(spark, [], groups=(), **LINKED), idx) == {"L"}


def test_sorts(spark, idx):
    def order(**kw):
        return [d for _, d in keys(search(request(spark, [], groups=(), **kw), idx))[0]]

    assert order(sort=("field", "salary", None, None), descending=True) == ["e1", "e3", "e2"]
    assert order(sort=("field", "salary", None, None), descending=False) == ["e2", "e3", "e1"]
    assert order(sort=("field", "name", None, None), descending=False) == ["e3", "e1", "e2"]
    assert order(sort=("field", "name", None, None), descending=True) == ["e2", "e1", "e3"]
    assert order(sort=("geoDistance", "home", 41.9, -87.7), descending=False) == ["e2", "e1", "e3"]
    assert order(sort=("geoDistance", "home", 41.9, -87.7), descending=True) == ["e3", "e1", "e2"]


def test_pages_partition_the_ranking(spark, idx):
    whole, total = keys(search(request(spark, [simple("police shipping")]), idx))
    assert total == 3
    pages = []
    for start in range(0, 4, 2):
        found, _ = keys(search(request(spark, [simple("police shipping")], start=start, max_hits=2), idx))
        pages += found
    assert pages == whole


def test_write_time(spark, idx):
    import datetime as dt

    when = dt.datetime(2024, 1, 1)
    after = {"search_type": "writeDateTimeFilter", "start_date": when}
    assert docs(request(spark, [after]), idx) == set()
    until = {"search_type": "writeDateTimeFilter", "end_date": when}
    assert docs(request(spark, [until]), idx) == {"e1", "e2", "e3"}
    assert docs(request(spark, [{"search_type": "writeDateTimeFilter"}]), idx) == {"e1", "e2", "e3"}


def test_large_request_tables_give_the_same_hits(spark, idx):
    req = request(spark, [simple("police"), simple("alvraez", fuzzy=True), GEO])
    expected = docs(req, idx)
    req.small = False
    assert docs(req, idx) == expected == {"e1", "e2", "e3"}


@pytest.mark.parametrize("constraints", [
    [simple("polcie", fuzzy=True)], [GEO], [simple('police "police officer"'), {**GEO, "constraint_no": 1}], [],
])
def test_reasons_add_up_to_the_score(spark, idx, constraints):
    req = request(spark, constraints, groups=((0, 1),) if constraints else ())
    pages, rows = search(req, idx).collect(), explained(req, idx).collect()
    assert {(r.search_id, r.rn, r.doc_id, r.score) for r in rows} == {(r.search_id, r.rn, r.doc_id, r.score) for r in pages}
    for hit in pages:
        parts = [r.contribution or 0.0 for r in rows if (r.search_id, r.doc_id) == (hit.search_id, hit.doc_id)]
        assert sum(parts) == pytest.approx(hit.score, abs=1e-6)
