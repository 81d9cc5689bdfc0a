import random

import pytest
from pyspark.sql import functions as F

from quarry import schemas
from quarry.functions import text
from quarry.functions.phonetic import metaphone_code
from quarry.operators.fuzzy import expand, signature_table
from quarry.scale import local_table


def osa(a, b):
    """Brute force optimal string alignment distance."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def mutated(word, rng):
    w = list(word)
    for _ in range(rng.choice([0, 1, 1, 2, 2, 3])):
        i, how = rng.randrange(len(w) + 1), rng.random()
        if how < 0.3:
            w.insert(i, rng.choice("abcé"))
        elif i < len(w) and how < 0.6:
            del w[i]
        elif i < len(w) and how < 0.8:
            w[i] = rng.choice("abc")
        elif i + 1 < len(w):
            w[i], w[i + 1] = w[i + 1], w[i]
    return "".join(w)


@pytest.mark.parametrize("small", [True, False])
def test_fuzzy_expansion_misses_nothing(spark, small):
    rng = random.Random(7)
    vocabulary, tokens = set(), set()
    for _ in range(300):
        base = "".join(rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 14, 15, 16, 17, 18, 19, 30])))
        vocabulary |= {base, mutated(base, rng)}
        tokens.add(mutated(base, rng))
    vocabulary.discard("")
    tokens.discard("")
    expected = {}
    for t in tokens:
        k = 0 if len(t) < 3 else 1 if len(t) <= 5 else 2
        for v in vocabulary:
            if abs(len(t) - len(v)) <= k and osa(t, v) <= k:
                expected[t, v] = osa(t, v)
    terms = spark.createDataFrame(
        [("t", "p", v, 1) for v in vocabulary], "entity_type_id string, property_id string, term string, df long")
    asked = spark.createDataFrame([("t", "p", t) for t in tokens], "entity_type_id string, property_id string, token string")
    found = {(r.token, r.term): r.distance for r in expand(asked, signature_table(terms)).collect()}
    assert found == expected


@pytest.mark.parametrize("query,rewritten", [
    ("foo bar", "foo~ bar~"), ("foo~ bar", "foo~ bar~"), ('"foo bar"', '"foo~ bar"'), ("a  b", "a~ ~ b~"),
    ("a b  ", "a~ b~"), ("", "~"), ("   ", ""),
])
def test_fuzzy_rewrite(spark, query, rewritten):
    row = spark.createDataFrame([(query,)], "q string").select(text.fuzzy_rewrite(F.col("q"))).first()
    assert row[0] == rewritten


def test_query_items(spark):
    df = spark.createDataFrame([('foo bar~ "x y" baz qux ~ "a~ b"',)], "q string")
    items = [(i.kind, i.text) for i in df.select(text.query_items(F.col("q"))).first()[0]]
    assert items == [("plain", "foo"), ("fuzzy", "bar"), ("phrase", "x y"), ("plain", "baz qux"), ("phrase", "a~ b")]


def test_tokens(spark):
    df = spark.createDataFrame([("Don't pay $3.14, U.S.A. is O2!",)], "v string").select(
        text.standard_tokens(F.col("v")).alias("s"), text.letter_tokens(F.col("v")).alias("l"))
    row = df.first()
    assert row.s == ["don't", "pay", "3.14", "u.s.a", "is", "o2"]
    assert row.l == ["don", "t", "pay", "u", "s", "a", "is", "o"]


# Codes that follow from the published rules.
@pytest.mark.parametrize("word,code", [
    ("metaphone", "MTFN"), ("which", "WX"), ("science", "SNS"), ("school", "SKL"), ("knight", "NT"), ("thumb", "0M"),
    ("judge", "JJ"), ("xavier", "SFR"), ("nation", "NXN"), ("match", "MX"), ("physics", "FSKS"), ("white", "WT"),
    ("wright", "RT"), ("christmas", "KRST"), ("sign", "SN"), ("bigger", "BKR"), ("quick", "KK"), ("aeon", "EN"), ("a", "A"),
])
def test_metaphone(spark, word, code):
    words = spark.createDataFrame([(word,)], "w string")
    assert words.select(metaphone_code("w")).first()[0] == code


def test_metaphone_of_awkward_words(spark):
    words = [None, "", "123", "é", "x", "dge", "ddge", "o'hara", "signed", "catherinegn", "Knightsbridge"]
    coded = spark.createDataFrame([(w,) for w in words], "w string").select("w", metaphone_code("w").alias("c"), metaphone_code("w", 8).alias("long"))
    assert [r.c for r in coded.collect()] == [None, "", "", "", "X", "J", "TJ", "OHR", "SNT", "K0RN", "NTSB"]
    assert coded.where("w = 'Knightsbridge'").first().long == "NTSBRJ"
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_values_of_one_property_do_not_join_into_phrases(spark):
    from fixture_data import index_of_values, request, simple

    rows = [("employee", "x", "s", "0", "x", "s", "name", n, v) for n, v in enumerate(["red blue", "green red"])]
    idx = index_of_values(spark, local_table(spark, rows, schemas.ENTITY_VALUES))
    from quarry.plans.entity_search import find

    def docs(q):
        return [r.doc_id for r in find(request(spark, [simple(q)], sets=(("s", False),)), idx).collect()]

    assert docs('"blue green"') == [] and docs('"green red"') == ["x"]
