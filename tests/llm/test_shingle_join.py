import random
import re

from corpus_data import COLUMNS, awkward, empty

from quarry.llm import shingle_join as sj
from quarry.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(rows):
    """Set sizes and component names by comparing all pairs."""
    sets = [shingle_set(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(find(i), []).append(r.doc_id)
    name = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return sorted(((r.doc_id, len(sets[i]), name[find(i)]) for i, r in enumerate(rows)), key=str), len(ids)


def check(docs):
    got = sj.join_similar(docs).select("row.doc_id", "n_shingles", "component_id", "kept").collect()
    want, groups = brute(docs.collect())
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert sum(r.kept for r in got) == groups


def test_awkward_rows(spark):
    check(awkward(spark))
    assert sj.join_similar(empty(spark)).count() == 0
    assert sj.representatives(awkward(spark)).columns == COLUMNS.replace(" long", "").replace(" string", "").split(", ")


def test_near_copies_of_all_sizes(spark):
    """Chains of small edits, pairs around the threshold, shared boilerplate, tiny texts."""
    rng = random.Random(11)
    boiler = " ".join(f"b{i}" for i in range(40))
    texts = []
    for size in (3, 5, 6, 8, 9, 15, 16, 40, 63, 64, 200, 255, 256, 1100):
        for _ in range(2):
            base = [f"t{rng.randrange(10**6)}" for _ in range(size)]
            texts.append(" ".join(base))
            for _ in range(4):  # a chain: each copy edits the one before
                for _ in range(max(1, size // 60)):
                    base[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
                texts.append(" ".join(base))
            texts.append(" ".join(base[: size - size // 5]) + " " + boiler)
    texts += [boiler, boiler + " end", "A b C d E f", "a B c D e F", "x"]
    docs = spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in enumerate(texts)], COLUMNS)
    check(docs.repartition(3))


def test_rows_in_many_cells_still_meet(spark):
    """One block shared by many texts of several groups, cut into cells of a few rows and folded sketches, must link all."""
    rng = random.Random(4)
    common = [f"c{i}" for i in range(20)]
    texts = []
    for g in range(6):
        own = [f"g{g}w{i}" for i in range(30)]
        for _ in range(4):
            edited = list(own)
            edited[rng.randrange(30)] = f"z{rng.randrange(10**6)}"
            texts.append(" ".join(common + edited))
    docs = spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in enumerate(texts)], COLUMNS)
    kept = sj.LARGE_BLOCK, sj.CELL_ROWS, sj.CELL_WORDS
    for own in ((4, 3, 1), (1000, 5, 2)):
        sj.LARGE_BLOCK, sj.CELL_ROWS, sj.CELL_WORDS = own
        try:
            check(docs)
        finally:
            sj.LARGE_BLOCK, sj.CELL_ROWS, sj.CELL_WORDS = kept


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_few_short_texts_a_partition(spark):
    for texts in (["one two"], ["x"], ["a b", "a b", "b a", "", None]):
        rows = [(i, t, None, None, None, None, None) for i, t in enumerate(texts)]
        check(spark.createDataFrame(rows, COLUMNS).repartition(5))


def test_words_that_a_polynomial_confuses_are_different(spark):
    thue = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    swapped = thue.translate(str.maketrans("ab", "ba"))
    rows = [(i, t, None, None, None, None, None) for i, t in enumerate([thue, swapped, f"{thue} b c d e f", f"{swapped} b c d e f"])]
    check(spark.createDataFrame(rows, COLUMNS))


def test_sets_are_dropped_once_their_pairs_are_verified(spark):
    """Verifying moves every set twice; the sets of one part must be gone before the next part's are made."""
    import os

    from quarry.scale import materialize, shared_dir

    texts = materialize(spark.range(12).selectExpr("id as uid", "concat('one two three four five six seven eight ', id div 4) as text"), "texts")
    near = spark.range(11).selectExpr("id as a", "id + 1 as b")
    scratch = lambda: sorted(d for d in os.listdir(f"{shared_dir(spark)}/tables") if d.split("-")[0] in ("sets", "ends", "near"))
    before = scratch()
    links = sj._linked(near, texts, 75)
    # Texts of one group are equal; those of neighbouring groups share 4 of 6 shingles.
    assert sorted(r.a for r in links.collect()) == [0, 1, 2, 4, 5, 6, 8, 9, 10]
    assert scratch() == before


def test_texts_meet_only_the_rows_that_go(spark):
    docs = awkward(spark)
    kept = sj.join_similar(docs).filter("kept").select("row.*")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = sj.representatives(docs)
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, found.collect())) == sorted(map(str, kept.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
