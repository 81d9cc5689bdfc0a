import math
import random

import pytest
from pyspark.sql import functions as F

from quarry.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, uid string, part string"


def brute(rows):
    usable = [(n, r.vec_id, r.label, [math.floor(256 * float(x)) for x in r.embedding]) for n, r in enumerate(rows)
              if None not in (r.vec_id, r.label, r.embedding) and all(x is not None and math.isfinite(256 * x) for x in r.embedding)]
    out = []
    for n, a, label, q in usable:
        if a % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, m, own) for m, i, own, v in usable if m != n)
        for p, i, _, _ in [s for s in scored if s[3] == label][:5]:
            fits = [s for s in scored if s[3] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(a, i, rank + 1, s[1], -p, -s[0]) for rank, s in enumerate(fits)]
    return sorted(out)


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = hn.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(df.collect())


@pytest.mark.parametrize("options", [{}, {"part_rows": 40, "codewords": 4}, {"part_rows": 7, "sample_rows": 20}])
def test_equals_brute_force(spark, options):
    rng = random.Random(5)
    centres = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(240):
        c = centres[i % 4]
        rows.append((i, [x + rng.uniform(-0.3, 0.3) for x in c], rng.randrange(3), "u", "p"))
    rows += [(300 + i, rows[7][1], i % 3, "u", "p") for i in range(90)]  # a cell of equal vectors, many ties
    check(spark, rows, **options)


def test_awkward_vectors(spark):
    rows = [(0, [0.5, 0.25, 0.1], 1, None, None), (10, None, 1, "u", "p"), (20, [None, 1.0], 1, "u", "p"), (30, [float("nan")], 2, "u", "p"),
            (40, [float("inf")], 1, "u", "p"), (50, [], 1, "u", "p"), (60, [0.4], 2, "u", "p"), (1, [0.45, 0.2], 1, "u", "p"), (2, [0.5, 0.2], 2, "u", "p"),
            (None, [1.0], 1, "u", "p"), (3, [1.0], None, "u", "p"), (70, [-0.9, 0.3, 2.0], 2, "u", "p"), (4, [0.44, 0.2], 2, "u", "p"), (4, [0.44, 0.2], 2, "u", "p")]
    check(spark, rows)
    check(spark, rows[:1])
    huge = [(i * 5, [1e6 * (i + 1), -3e5 * i, 7e5], i % 2, "u", "p") for i in range(8)]  # sums beyond what doubles hold exactly
    check(spark, huge)
    assert hn.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0, F.col("label")).count() == 0


def test_cells_come_by_falling_bound():
    import numpy as np

    rng = np.random.default_rng(1)
    first, second = rng.normal(size=7), rng.normal(size=5)
    seen = list(hn.cells_by_bound(first, second))
    assert len({(a, b) for _, a, b in seen}) == 35
    assert all(x[0] >= y[0] for x, y in zip(seen, seen[1:]))


def test_bounds_hold_and_leave_cells_unvisited():
    import numpy as np

    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(size=(6, 8)).repeat(50, 0) * 200 + rng.normal(size=(300, 8)) * 5)
    books = hn.Codebooks([hn.fit_half(vectors[:, :4], 6), hn.fit_half(vectors[:, 4:], 6)], [np.zeros(6), np.zeros(6)])
    near = books.nearest(vectors)
    for i, (code, apart) in enumerate(near):
        np.maximum.at(books.radii[i], code, apart)
    query = vectors[0]
    first, second = books.bounds(query)
    bounds = first[near[0][0]] + second[near[1][0]]
    scores = vectors @ query
    assert (scores <= bounds).all()
    assert (bounds < np.sort(scores)[-5]).sum() >= 200
