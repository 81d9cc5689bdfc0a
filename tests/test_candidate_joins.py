"""Joins that must meet candidates by equality, never everything of a kind or a set."""

import datetime as dt
import random
import re
from itertools import combinations

import pytest
from fixture_data import index, request
from pyspark.sql import functions as F

from quarry.operators import predicates as P
from quarry.operators.fuzzy import expand, signature_table
from quarry.plans.catalog_search import pattern_tokens, required_grams


@pytest.fixture(scope="module")
def idx(spark):
    return index(spark)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fuzzy_search_reads_stored_signatures(spark, idx):
    tokens = spark.createDataFrame([("employee", "title", "survyeor"), ("employee", "dept", "polcie")], "entity_type_id string, property_id string, token string")
    found = expand(tokens, idx.signatures)
    text = executed(found)
    assert "Generate" not in text and re.search(r"In\(sig|EqualTo\(sig|Or\(", text)
    assert {(r.token, r.term) for r in found.collect()} == {("survyeor", "surveyor"), ("polcie", "police")}


def test_signatures_of_a_word_are_all_it_can_be_left_as(spark):
    words = ["", "a", "aa", "abab", "aaaa", "banana", "mississippi", "éè’ö", "abcabcabcabcabca", "abcabcabcabcabcab", "x" * 20]

    def left(word, gone):
        return {"".join(c for i, c in enumerate(word) if i not in places) for n in range(gone + 1) for places in combinations(range(len(word)), n)}

    def expected(word):
        n = len(word)
        if n > 16:
            return 5
        return (n <= 2) + (len(left(word, 1)) if 2 <= n <= 6 else 0) + (len(left(word, 2)) if n >= 4 else 0)

    vocabulary = spark.createDataFrame([("t", "p", w, 1) for w in [*words, None]], "entity_type_id string, property_id string, term string, df long")
    table = signature_table(vocabulary)
    found = {r.term: (r.n, r.d) for r in table.groupBy("term").agg(F.count("*").alias("n"), F.countDistinct("sig").alias("d")).collect()}
    assert found == {w: (expected(w), expected(w)) for w in words}
    # Nothing is evaluated signature by signature in a lambda, and half a hash is stored.
    assert "lambda" not in executed(table) and table.schema["sig"].dataType.simpleString() == "int"


# --- name patterns -----------------------------------------------------------------------

PATTERNS = ["widget", "wid|bol", "gi.m", "abc?d", "colou?rful", "wid.*get", "x{0,2}yzzy", "(red)", "[rR]ed", r"re\w", "Red", "^small$", "ab", "small+", "nosuchliteral", "dget.+", "é.tat"]


def test_required_grams_are_in_every_match(spark):
    rng = random.Random(1)
    letters = "abcdégilmostuvwxyzr0_"
    tokens = ["widget", "small", "smalll", "colorful", "colourful", "bolt", "yzzy", "xxyzzy", "widxget", "widgets", "état", "red", "rew"]
    tokens += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    grams = {r.p: r.g for r in spark.createDataFrame([(p,) for p in PATTERNS], "p string").select("p", required_grams(F.col("p")).alias("g")).collect()}
    for p in PATTERNS:
        for t in tokens:
            if re.fullmatch(f"(?:.*{p}.*)", t):
                assert all(g in t for g in grams[p]), (p, t)
    assert "wid" in grams["widget"] and not grams["wid|bol"] and not grams["(red)"] and not grams["ab"]
    # A letter that may be absent is in none.
    assert grams["abc?d"] == [] and set(grams["colou?rful"]) == {"col", "olo", "rfu", "ful"}


def test_patterns_meet_only_tokens_with_their_gram(spark):
    tokens = spark.range(400).selectExpr("'part' kind", "'name' field", "case when id % 100 = 7 then concat('widget', id) else concat('common', id) end token")
    patterns = spark.createDataFrame([("part", "name", p) for p in ("widget1", "dget.*7", "common3$", "nosuch", "on|et")], "kind string, field string, pattern string")
    got = {(r.pattern, r.token) for r in pattern_tokens(tokens, patterns).collect()}
    want = {(p, t.token) for t in tokens.collect() for p in ("widget1", "dget.*7", "common3$", "nosuch", "on|et") if re.fullmatch(f"(?:.*{p}.*)", t.token)}
    assert got == want
    literal = patterns.where("pattern <> 'on|et'")
    met = pattern_tokens(tokens, literal).withColumn("one", F.lit(1))
    assert "[kind, field, gram]" in re.sub(r"#\d+", "", executed(met)).replace("coalesce", "")


# --- write times -------------------------------------------------------------------------

def test_windows_meet_only_elements_near_them(spark, monkeypatch):
    begin = dt.datetime(2020, 1, 1)
    rng = random.Random(3)
    windows = []
    for n in range(600):
        a = begin + dt.timedelta(minutes=rng.randrange(4_000_000))
        windows.append((n, a, a + dt.timedelta(minutes=rng.choice([5, 90, 2000, 40_000, 500_000]))))
    windows += [(600, None, begin + dt.timedelta(days=3)), (601, begin + dt.timedelta(days=2600), None), (602, None, None), (603, begin, begin), (604, dt.datetime(1900, 1, 1), dt.datetime(1950, 1, 1))]
    asked = spark.createDataFrame(windows, "n int, start_date timestamp_ntz, end_date timestamp_ntz")
    elements = spark.range(3000).selectExpr("id", f"timestamp_ntz '2020-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(pmod(id * 7919, 4000000) as int)) as last_write")
    seconds = F.unix_seconds(F.col("last_write").cast("timestamp"))
    first, last = elements.agg(F.min(seconds), F.max(seconds)).first()
    bucketed = P._bucketed(asked, F.lit(first), F.lit(last))
    assert bucketed.groupBy("n").count().agg(F.max("count")).first()[0] <= P.WINDOW_BUCKETS
    own = F.array(*[F.struct(F.lit(i).alias("level"), F.floor(seconds / b).alias("bucket")) for i, b in enumerate(P.BUCKETS)])
    met = elements.select("*", F.inline(own)).join(bucketed, ["level", "bucket"])
    exact = met.where(P.written_between(F.col("last_write"), F.col("start_date"), F.col("end_date")))
    times = [(r.id, r.last_write) for r in elements.collect()]
    want = {(i, n) for i, t in times for n, a, b in windows if (a is None or t > a) and (b is None or t <= b)}
    got = [(r.id, r.n) for r in exact.select("id", "n").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert met.count() <= 1.5 * len(want) + 9 * len(windows)


def test_write_time_search_without_elements_or_windows(spark, idx):
    window = {"search_type": "writeDateTimeFilter", "start_date": None, "end_date": None}
    assert P.write_time_matches(request(spark, [window]), idx).count() > 0
    idx_empty = type(idx)(**{**idx.__dict__, "elements": idx.elements.where("false")})
    assert P.write_time_matches(request(spark, [window]), idx_empty).count() == 0


# --- nested ids --------------------------------------------------------------------------

def test_an_id_in_every_set_pairs_no_search_with_all_sets(spark):
    rng = random.Random(4)
    lists = [(f"s{i}", ["everywhere"] + [f"p{rng.randrange(60)}" for _ in range(5)]) for i in range(300)] + [("none", None), ("empty", [])]
    asked = [(f"q{i}", ["everywhere", f"p{rng.randrange(60)}"] + [f"p{rng.randrange(60)}"] * 2) for i in range(100)] + [("all", ["everywhere"]), ("x", ["absent", "everywhere"]), ("y", []), ("z", None)]
    got = P.lists_with_all(spark.createDataFrame(asked, "search_id string, property_ids array<string>"), spark.createDataFrame(lists, "entity_set_id string, property_ids array<string>"))
    want = {(q, s) for q, ids in asked for s, listed in lists if ids and set(ids) <= set(listed or [])}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_only_sets_with_the_rarest_id_are_tested(spark, monkeypatch):
    lists = spark.range(500).selectExpr("cast(id as string) entity_set_id", "array('everywhere', concat('p', id % 50)) property_ids")
    asked = spark.range(100).selectExpr("cast(id as string) search_id", "array('everywhere', concat('p', id % 70)) property_ids")
    joined = []
    plain = P.lookup_join
    monkeypatch.setattr(P, "lookup_join", lambda *a, **k: joined.append(plain(*a, **k)) or joined[-1])
    assert P.lists_with_all(asked, lists).count() == 80 * 10
    assert joined[-1].count() == 80 * 10
