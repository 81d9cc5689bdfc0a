import zlib
from collections import Counter

from corpus_data import awkward, empty

from quarry.llm import sharding as sh


def shards(docs, tree=None):
    tree = tree or sh.even_tree()
    return sh.shard(docs, tree, sh.grown(tree))


def test_contract_on_awkward_rows(spark):
    docs = awkward(spark)
    got = shards(docs).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert all(r.law == "key" and 0 <= r.shard < 40 for r in got)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})
    assert shards(empty(spark)).count() == 0


def test_growth_moves_rows_only_into_the_new_shard(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "'x' as text")
    got = shards(docs).collect()
    moved = [r for r in got if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {40} and 80 < len(moved) < 220
    counts = Counter(r.shard for r in got)
    assert len(counts) == 40 and min(counts.values()) > 100 and max(counts.values()) < 210


def test_weights_hold_and_only_their_subtrees_give_or_take(spark):
    tree = sh.even_tree(8, 2, 2)
    heavier = {r: {k: dict(s) for k, s in racks.items()} for r, racks in tree.items()}
    heavier["region0"]["rack0"][0] = 3.0
    docs = spark.range(8000).selectExpr("id as doc_id", "'x' as text")
    before, after = ({r.doc_id: r.shard for r in sh.shard(docs, t).collect()} for t in (tree, heavier))
    region = {s: r for r, racks in tree.items() for shards_ in racks.values() for s in shards_}
    # Rows only enter the heavier region, and leave no shard for one of the other region.
    assert all(region[after[d]] == "region0" for d in before if before[d] != after[d])
    share = sh.shares(heavier)
    got = Counter(after.values())
    assert all(abs(got[s] / 8000 - share[s]) < 0.02 for s in share)


def test_no_python_in_the_plan(spark):
    text = shards(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
