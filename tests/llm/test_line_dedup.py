import hashlib
import random

from corpus_data import awkward, empty
from pyspark.sql import functions as F

from quarry.llm import line_dedup as ld

WHITE = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(WHITE).translate(UPPER)
            if len(key) >= 20:
                holders.setdefault(key, set()).add(doc)
    out = []
    order = lambda d: (d is not None, d or 0)
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(line.strip(WHITE).translate(UPPER), ())
            if len(held) < 3 or max(held, key=order) == doc:
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = ld.drop_repeated_lines(df)
    digest = got.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256))
    assert sorted(map(tuple, digest.collect()), key=str) == brute(rows)
    assert got.select("row.*").columns == df.columns


def lines_table(spark):
    rng = random.Random(4)
    common = ["This line is in a great many documents.", "  this LINE is in a great many documents.\t", "twenty points here!!", "nineteen points her", "ÄÖÜ äöü is not changed by lower case", "äöü äöü is not changed by lower case"]
    rows = []
    for d in range(120):
        n = rng.choice([1, 3, 70, 200])
        lines = [rng.choice(common) if rng.random() < 0.4 else f"a line of document {d} numbered {rng.randrange(9)}" for _ in range(n)]
        rows.append((d if rng.random() < 0.9 else None, "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, common[0] + "\r\n" + common[0]), (503, common[2] + "\nother"), (504, " " * 100_000 + "x\n" + "y" * 100_000), rows[3], rows[3]]
    return spark.createDataFrame([(d, t, "l", "t", 1) for d, t in rows], "doc_id long, text string, hash string, twin string, slice int").repartition(3)


def test_equals_brute_force(spark):
    check(spark, lines_table(spark))
    check(spark, awkward(spark))
    check(spark, empty(spark))


def test_cut_keys_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(ld, "FREQUENT", 3)
    check(spark, lines_table(spark))


def test_no_python_runs(spark):
    plan = ld.drop_repeated_lines(lines_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_keep_marks_kept_lines(spark):
    rows = [(d, "short\n" + "a line that is repeated over and over\n" * 70 + "end") for d in range(3)]
    got = {r.row.doc_id: r for r in ld.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2].keep is None and got[2].n_dropped == 0
    assert [w.word for w in got[0].keep] == [0, 1] and got[0].kept_text == "short\nend"
    assert got[0].keep[0].lines == 1 and got[0].keep[1].lines & 0b1111111 == 0
