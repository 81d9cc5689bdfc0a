import hashlib
import random

import numpy as np
from corpus_data import COLUMNS, awkward, empty

from quarry.llm import repeats as rp

L = rp.LENGTH


def brute(texts):
    """Kept bytes and number of removed runs of every text."""
    seen = {}
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        for i in range(len(raw) - L + 1):
            seen[raw[i : i + L]] = seen.get(raw[i : i + L], 0) + 1
    out = []
    for raw in raws:
        hit = np.zeros(len(raw), bool)
        for i in range(len(raw) - L + 1):
            if seen[raw[i : i + L]] > 1:
                hit[i : i + L] = True
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        out.append((len(raw), int(hit.sum()), runs, bytes(np.frombuffer(raw, np.uint8)[~hit])))
    return out


def check(spark, docs):
    rows = rp.remove_repeats(docs).select("row.text", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256").collect()
    want = brute([r.text for r in rows])
    for r, (size, removed, runs, kept) in zip(rows, want):
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (size, removed, runs, kept)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    return rows


def test_awkward_rows(spark):
    assert len(check(spark, awkward(spark))) == awkward(spark).count()
    assert rp.remove_repeats(empty(spark)).count() == 0


def test_planted_repeats(spark):
    """Passages around the length, next to each other, inside one text, periodic texts, wide letters."""
    rng = random.Random(5)
    fresh = lambda n: "".join(rng.choice("abcdefghij klmnopéß") for _ in range(n))
    passages = [fresh(n) for n in (150, 190, 200, 230, 320, 900)]
    texts = []
    for _ in range(25):
        parts = [fresh(rng.randrange(300))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            cut = rng.randrange(30)
            parts += [p[cut : len(p) - rng.randrange(30)], fresh(rng.randrange(60))]
        texts.append("".join(parts))
    texts += ["x" * 450, "x" * 210, "x" * 199, "ab" * 400, passages[5], passages[5] + passages[5], "=" * 260 + passages[4]]
    docs = spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in enumerate(texts)], COLUMNS)
    check(spark, docs.repartition(4))


def test_boundaries_depend_on_content_only():
    rng = np.random.default_rng(3)
    shared = rng.integers(97, 123, 700).astype(np.uint8)
    a = np.concatenate([rng.integers(97, 123, 310).astype(np.uint8), shared])
    b = np.concatenate([rng.integers(97, 123, 55).astype(np.uint8), shared])
    inner = lambda x, at: {int(c) - at for c in rp.boundaries(x) if at < c <= at + len(shared) - L}
    assert inner(a, 310) == inner(b, 55) and len(inner(a, 310)) > 3
