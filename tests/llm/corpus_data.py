"""Small corpora with the awkward cases every operator must define."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, row string, uid string, digest string"


def words(rng, n, vocabulary=200):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(spark, seed=1):
    """Nulls in every column, empty, blank and long texts, copies, repeated rows, clashing extra columns."""
    rng = random.Random(seed)
    base = [words(rng, 120, 4000) for _ in range(12)]
    texts = [None, "", " \t\n", "one", "One  TWO\nthree", "one two three four five", words(rng, 9000, 50000)]
    texts += base + [base[0], base[0].replace(" ", "\n "), base[1] + " tail", "start " + base[2], base[3][:400] + " x " + base[3][400:]]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3], "r", "u", "d") for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, base[0], None, None, None, None, None), (None, None, None, "b", None, None, None)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)
