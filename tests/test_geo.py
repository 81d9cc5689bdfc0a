import math
import random

from pyspark.sql import functions as F

from quarry import schemas
from quarry.functions import geo
from quarry.operators import predicates as P
from quarry.operators.requests import Requests
from quarry.scale import local_table


class Points:
    """Just the part of an index the geographic predicates read."""

    def __init__(self, points):
        self.points = points


def metres(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_M * math.asin(math.sqrt(min(1, h)))


def inside(lat, lon, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def requests(spark, rows):
    names = schemas.CONSTRAINTS.fieldNames()
    searches = [(str(n), "r", n, "s", "t", False, 0, 10, "score", None, None, None, True) for n in range(len(rows))]
    full = [tuple({"search_id": str(n), "group_no": 0, "constraint_no": 0, "property_id": "p", **r}.get(k) for k in names)
            for n, r in enumerate(rows)]
    return Requests.of(
        spark, searches=local_table(spark, searches, schemas.SEARCHES),
        authorized=local_table(spark, [(str(n), "p") for n in range(len(rows))], schemas.AUTHORIZED),
        groups=local_table(spark, [(str(n), 0, 1) for n in range(len(rows))], schemas.SEARCH_GROUPS),
        constraints=local_table(spark, full, schemas.CONSTRAINTS))


def setup(spark):
    rng = random.Random(3)
    pts = [(str(i), rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(1500)]
    pts += [("np", 90.0, 0.0), ("dl", 0.0, 180.0), ("dm", 0.0, -180.0)]
    df = spark.createDataFrame([("t", "s", "p", i, "0", la, lo) for i, la, lo in pts],
                               "entity_type_id string, scope string, property_id string, doc_id string, ord string, lat double, lon double")
    return rng, pts, Points(df)


def test_circles_match_brute_force(spark):
    rng, pts, index = setup(spark)
    circles = [(rng.uniform(-90, 90), rng.uniform(-180, 180), rng.choice([5, 50, 500, 5000, 15000])) for _ in range(40)]
    circles += [(89.5, 10.0, 300), (0.0, 179.9, 900), (-90.0, 0.0, 4000), (0.0, 180.0, 0)]
    rows = [{"search_type": "geoDistance", "lat": a, "lon": b, "radius": float(r), "unit": "KILOMETERS"} for a, b, r in circles]
    found = P.distance_matches(requests(spark, rows), index).select("search_id", "doc_id").collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == {
        (str(n), i) for n, (a, b, r) in enumerate(circles) for i, la, lo in pts if metres(la, lo, a, b) <= r * 1000}


def test_polygons_match_brute_force(spark):
    rng, pts, index = setup(spark)
    rings = []
    for _ in range(40):
        cx, cy, w = rng.uniform(-150, 150), rng.uniform(-60, 60), rng.choice([0.5, 3, 20])
        rings.append([[cx + w * rng.uniform(0.2, 1) * math.cos(t), cy + w * rng.uniform(0.2, 1) * math.sin(t)]
                      for t in (0, 1.2, 2.5, 4, 5.2)])
    rings.append([[-180.0, -89.0], [179.0, -89.0], [179.0, 80.0], [-180.0, 80.0]])
    rows = [{"search_type": "geoPolygon", "zones": [r, [[0.0, 0.0], [1.0, 1.0]]]} for r in rings]
    found = P.polygon_matches(requests(spark, rows), index).select("search_id", "doc_id").collect()
    assert {tuple(r) for r in found} == {
        (str(n), i) for n, ring in enumerate(rings) for i, la, lo in pts if inside(la, lo, ring)}


def test_units(spark):
    row = spark.sql("select 2d r").select(*[geo.metres(F.col("r"), F.lit(u.upper())).alias(u) for u in geo.UNIT_METRES]).first()
    assert row.asDict() == {u: 2 * m for u, m in geo.UNIT_METRES.items()}


def test_small_circles_meet_only_points_of_their_cells(spark, monkeypatch):
    rng = random.Random(8)
    pts = [(str(i), rng.uniform(47, 49), rng.choice([rng.uniform(10, 12), rng.uniform(179, 180), rng.uniform(-180, -179)])) for i in range(6000)]
    df = spark.createDataFrame([("t", "s", "p", i, "0", la, lo) for i, la, lo in pts],
                               "entity_type_id string, scope string, property_id string, doc_id string, ord string, lat double, lon double")
    circles = [(rng.uniform(47, 49), rng.choice([rng.uniform(10, 12), 179.999, -179.99])) for _ in range(60)]
    rows = [{"search_type": "geoDistance", "lat": a, "lon": b, "radius": 1.0, "unit": "KILOMETERS"} for a, b in circles]
    met = []
    plain = P.lookup_join
    monkeypatch.setattr(P, "lookup_join", lambda *a, **k: met.append(plain(*a, **k)) or met[-1])
    found = {tuple(r) for r in P.distance_matches(requests(spark, rows), Points(df)).select("search_id", "doc_id").collect()}
    assert found == {(str(n), i) for n, (a, b) in enumerate(circles) for i, la, lo in pts if metres(la, lo, a, b) <= 1000}
    # A circle of 1 km lies in at most a dozen cells of some two kilometres: less than a fiftieth of the points each.
    assert met[-1].count() < 60 * len(pts) / 50


def test_large_tables_of_shapes_are_sliced_for_hot_keys_only(spark, monkeypatch):
    from quarry import scale

    rng, pts, index = setup(spark)
    circles = [(rng.uniform(-80, 80), rng.uniform(-180, 180), rng.choice([5, 300, 2500])) for _ in range(40)]
    rows = [{"search_type": "geoDistance", "lat": a, "lon": b, "radius": float(r), "unit": "KILOMETERS"} for a, b, r in circles]
    monkeypatch.setattr(scale.fits, "__defaults__", (4, scale.BROADCAST_MAX_BYTES))
    for share in (1 << 30, 3):
        monkeypatch.setattr(scale, "HOT_ROWS", share)
        found = P.distance_matches(requests(spark, rows), index).select("search_id", "doc_id")
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text
        got = found.collect()
        assert len(got) == len(set(got)) and {tuple(r) for r in got} == {
            (str(n), i) for n, (a, b, r) in enumerate(circles) for i, la, lo in pts if metres(la, lo, a, b) <= r * 1000}


def test_spread_join_repeats_no_row_of_a_plain_key(spark, monkeypatch):
    from quarry import scale

    monkeypatch.setattr(scale, "HOT_ROWS", 100)
    big = spark.range(1000).selectExpr("id", "case when id % 2 = 0 then 'hot' when id % 5 = 0 then null else cast(id % 50 as string) end k")
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("7", 3), ("gone", 4), (None, 5)], "k string, v int")
    joined = scale.spread_join(big, lookup, ["k"], ["id"])
    assert joined.columns == ["k", "id", "v"]
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, big.join(lookup, "k").collect()))
    assert joined.count() == 2 * 500 + 20


def mixed_requests(spark, kind):
    """Searches of one shape, of two in a group or in two groups, asked twice, needing two matches, of two zones."""
    rng = random.Random(11)
    names, ask, groups, rows = schemas.CONSTRAINTS.fieldNames(), [], [], []

    def shape():
        lat, lon, r = rng.uniform(-50, 50), rng.uniform(-140, 140), rng.choice([2000.0, 6000.0, 11000.0])
        ring = [[lon - 30, lat - 20], [lon + 30, lat - 15], [lon + 20, lat + 25], [lon - 25, lat + 20]]
        return {"lat": lat, "lon": lon, "radius": r, "unit": "KILOMETERS"} if kind == "geoDistance" else {"zones": [ring]}

    def add(sid, constraints, given, times=1):
        for _ in range(times):
            ask.append((sid, "r", 0, "s", "t", False, 0, 10, "score", None, None, None, True))
            groups.extend((sid, g, m) for g, m in given)
            rows.extend(tuple({"search_id": sid, "constraint_no": 0, "search_type": kind, "property_id": "p", **c}.get(k) for k in names)
                        for c in constraints)

    for n in range(12):
        add(f"one{n}", [{"group_no": 0, **shape()}], [(0, n % 2)])
    add("both", [{"group_no": 0, **shape()}, {"group_no": 0, **shape(), "constraint_no": 1}], [(0, 1)])
    add("groups", [{"group_no": 0, **shape()}, {"group_no": 1, **shape()}], [(0, 1), (1, 1)])
    add("twice", [{"group_no": 0, **shape()}], [(0, 1)], times=2)
    add("needs two", [{"group_no": 0, **shape()}], [(0, 2)])
    if kind == "geoPolygon":
        add("two zones", [{"group_no": 0, "zones": shape()["zones"] + shape()["zones"]}], [(0, 1)])
        far = [[50 * math.cos(t), 40 * math.sin(t)] for t in (x * 0.5 for x in range(12))]
        add("many corners", [{"group_no": 0, "zones": [far]}], [(0, 1)])
    return Requests.of(
        spark, searches=local_table(spark, ask, schemas.SEARCHES),
        authorized=local_table(spark, [(a[0], "p") for a in ask], schemas.AUTHORIZED),
        groups=local_table(spark, groups, schemas.SEARCH_GROUPS), constraints=local_table(spark, rows, schemas.CONSTRAINTS))


def several_points(spark):
    """Documents of one point, of several elements, of a row given twice, and without a name."""
    rng = random.Random(5)
    rows = [("t", "s", "p", str(i), "0", rng.uniform(-80, 80), rng.uniform(-179, 179)) for i in range(1200)]
    rows += [("t", "s", "p", str(i % 40), str(1 + i // 40), rng.uniform(-80, 80), rng.uniform(-179, 179)) for i in range(120)]
    rows += rows[500:560] + [("t", "s", "p", None, "0", a, b) for a, b in ((0.0, 0.0), (10.0, 10.0))]
    rows += [("t", "other", "p", "x", "0", 0.0, 0.0)]
    return Points(spark.createDataFrame(rows, "entity_type_id string, scope string, property_id string, doc_id string, ord string, lat double, lon double"))


def found_and_composed(req, index):
    from quarry.operators.compose import compose
    from quarry.operators.requests import live_searches
    from quarry.plans.entity_search import find, match_rows

    live = live_searches(req)
    key = lambda r: tuple(map(str, r))
    got = find(req, index).select("search_id", "doc_id", "score")
    wanted = compose(match_rows(req, live, index), req, live, index).select("search_id", "doc_id", "score")
    return sorted(map(key, got.collect())), sorted(map(key, wanted.collect()))


def test_circles_alone_are_found_without_an_exchange_by_document(spark):
    from quarry.plans.entity_search import find

    rng, pts, index = setup(spark)
    rows = [{"search_type": "geoDistance", "lat": a, "lon": 10.0 * a, "radius": 3000.0, "unit": "KILOMETERS"} for a in (-15.0, 0.0, 12.0)]
    found = find(requests(spark, rows), index)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "search_id" in plan and "hashpartitioning(search_id" not in plan
    assert sorted((r.search_id, r.doc_id, r.score) for r in found.collect()) == sorted(
        (str(n), i, 1.0) for n, a in enumerate((-15.0, 0.0, 12.0)) for i, la, lo in pts if metres(la, lo, a, 10 * a) <= 3e6)


def test_circles_of_any_search_are_composed_as_before(spark):
    got, wanted = found_and_composed(mixed_requests(spark, "geoDistance"), several_points(spark))
    assert len(wanted) > 200 and got == wanted
    assert {"both", "groups", "twice", "one1"} <= {r[0] for r in got} and ("needs two" not in {r[0] for r in got})


def test_radii_at_a_point_are_decided_by_the_measured_distance(spark):
    """Where the cosine is too close to tell, the distance is measured; radii that reach round the earth hold all."""
    pts = [("a", 0.0, 0.0), ("b", 0.0, 0.001), ("c", 0.0, 180.0), ("d", 45.0, 90.0)]
    index = Points(spark.createDataFrame([("t", "s", "p", i, "0", la, lo) for i, la, lo in pts],
                                         "entity_type_id string, scope string, property_id string, doc_id string, ord string, lat double, lon double"))
    radii = [0.0, metres(0, 0, 0, 0.001), metres(0, 0, 0, 0.001) - 1e-6, metres(0, 0, 45, 90), metres(0, 0, 45, 90) - 1e-3, 2.1e7, 4e7]
    rows = [{"search_type": "geoDistance", "lat": 0.0, "lon": 0.0, "radius": r, "unit": "METERS"} for r in radii]
    found = {tuple(r) for r in P.distance_matches(requests(spark, rows), index).select("search_id", "doc_id").collect()}
    assert found == {(str(n), i) for n, r in enumerate(radii) for i, la, lo in pts if metres(0, 0, la, lo) <= r}


def test_zones_alone_are_found_without_an_exchange_by_document(spark):
    from quarry.plans.entity_search import find

    rng, pts, index = setup(spark)
    rings = [[[-10.0 - n, -20.0], [30.0, -12.0 * n], [25.0, 28.0], [-15.0, 22.0]][:3 + n % 2] for n in range(4)]
    rings.append([[60 * math.cos(t / 2), 50 * math.sin(t / 2)] for t in range(12)])
    found = find(requests(spark, [{"search_type": "geoPolygon", "zones": [r]} for r in rings]), index)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "search_id" in plan and "hashpartitioning(search_id" not in plan
    assert sorted((r.search_id, r.doc_id, r.score) for r in found.collect()) == sorted(
        (str(n), i, 1.0) for n, ring in enumerate(rings) for i, la, lo in pts if inside(la, lo, ring))


def test_zones_of_any_search_are_composed_as_before(spark):
    got, wanted = found_and_composed(mixed_requests(spark, "geoPolygon"), several_points(spark))
    assert len(wanted) > 100 and got == wanted
    assert {"two zones", "many corners"} <= {r[0] for r in got}
