import math
import random

from pyspark.sql import functions as F

from quarry.llm import topk_search as tk

SCHEMA = "vec_id long, embedding array<float>, rank int"


def brute(rows, k):
    """(query, rank, candidate, score) by evaluating everything."""
    usable = [(n, r.vec_id, [math.floor(1024 * float(x)) for x in r.embedding]) for n, r in enumerate(rows)
              if r.vec_id is not None and r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding)]
    out = []
    for n, q, a in usable:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for m, c, b in usable if m != n)[:k]
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scored)]
    return sorted(out)


def check(spark, rows, k=10, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = tk.top_k(df, F.col("vec_id") % 20 == 0, k, **options).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(df.collect(), k)


def test_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(16)], 0) for i in range(400)]
    rows += [(400 + i, rows[i][1], 0) for i in range(30)]  # ties
    check(spark, rows)
    check(spark, rows, block=64, query_block=7, pivots=5)


def test_awkward_vectors(spark):
    rows = [(0, [0.5, 0.25], 0), (20, None, 0), (40, [None, 1.0], 0), (60, [float("nan"), 1.0], 0), (80, [float("inf"), 1.0], 0),
            (100, [], 0), (120, [0.5, 0.25, -0.75], 0), (1, [-0.1, 0.9], 0), (None, [1.0, 1.0], 0), (2, [1e6, -1e6], 0)]
    check(spark, rows)
    check(spark, rows[:1])
    assert tk.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
