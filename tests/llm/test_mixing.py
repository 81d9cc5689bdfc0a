from collections import Counter, defaultdict

import numpy as np
from corpus_data import COLUMNS, awkward, empty, words

from quarry.llm import mixing as mx


def plain_targets(sizes):
    """Targets by repeated sharing among sources below their cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mx.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, left = {}, 1.5 * sum(sizes.values())
    free = list(order)
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def check(docs, **options):
    rows = mx.mix_sources(docs, **options).select("row.doc_id", "row.source", "row.text", "size", "source_size", "target", "copies").collect()
    sizes = defaultdict(int)
    for r in rows:
        assert r["size"] == len((r.text or "").split())
        sizes[r.source] += r["size"]
    want = plain_targets(sizes)
    taken, biggest = Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r["size"]
        biggest[r.source] = max(biggest[r.source], r["size"])
    return rows, taken, want, biggest


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows, taken, want, biggest = check(docs)
    assert len(rows) == docs.count()
    assert all(abs(taken[s] - want[s]) <= biggest[s] for s in want)
    assert mx.mix_sources(empty(spark)).count() == 0
    assert mx.mixed(docs).columns == COLUMNS.replace(" long", "").replace(" string", "").split(", ")


def test_totals_are_near_and_reruns_agree(spark):
    import random

    rng = random.Random(9)
    rows = [(i, words(rng, rng.randrange(1, 80)), None, "hot" if i % 3 == 0 else f"s{i % 7}", None, None, None) for i in range(3000)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(4)
    _, taken, want, _ = check(docs, block_rows=200)  # several rounds
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] for s in want)
    pick = lambda df: sorted((r.doc_id, r.copies) for r in mx.mix_sources(df).select("row.doc_id", "copies").collect())
    assert pick(docs) == pick(docs.repartition(2))


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    size, prob = rng.integers(1, 500, 300).astype(float), np.full(300, 0.37)
    draw = rng.integers(-(2**62), 2**62, 300)
    p = mx.flight(size, prob, draw)
    assert abs(p.sum() - prob.sum()) < 1e-6 and abs((p * size).sum() - (prob * size).sum()) < 1e-3
    assert ((p > 0) & (p < 1)).sum() <= 2
    landed = mx.landing(size, prob, p)
    assert set(landed) <= {0.0, 1.0} and abs((landed * size).sum() - (prob * size).sum()) <= 5


def test_long_documents_are_made_good_beside_a_larger_source(spark):
    import random

    rng = random.Random(4)
    rows = []
    for source, n, most in (("s1", 450, 60), ("s2", 450, 60), ("hot", 4000, 20)):  # none at its cap
        rows += [(len(rows) + i, words(rng, rng.randrange(1, most)), None, source, None, None, None) for i in range(n)]
        rows += [(len(rows) + i, words(rng, 1001 + 700 * i), None, source, None, None, None) for i in range(3)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(4)
    _, taken, want, _ = check(docs, block_rows=500)
    assert all(want[s] / sum(len(r[1].split()) for r in rows if r[3] == s) % 1 > 0.1 for s in want)
    assert all(abs(taken[s] - want[s]) <= 3 for s in want), {s: (taken[s], want[s]) for s in want}
