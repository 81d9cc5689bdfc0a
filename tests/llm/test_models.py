"""Language identification and quality: held-out accuracy, contracts, awkward rows."""

import os

import pytest
from corpus_data import awkward, empty
from pyspark.sql import functions as F

from quarry.llm import language_id, quality
from quarry.llm.common import held_out
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied data not present")


@needs_data
def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op3_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


@needs_data
def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op6_quality"](spark, SF).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in got)
    assert len(got) > 50 and right / len(got) > 0.95
    assert all(r.predicted == (r.score >= quality.THRESHOLD) for r in got)


def test_languages_of_awkward_rows(spark):
    docs = awkward(spark)
    got = language_id.identify(docs).select("row.text", "row.uid", "lang_pred", "score").collect()
    assert len(got) == docs.count()
    for r in got:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "de")
    assert language_id.identify(empty(spark)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_prediction_reads_text_only(spark):
    docs = awkward(spark).where("doc_id is not null")
    model = language_id.fit(docs)
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    pick = lambda df: sorted(tuple(r) for r in language_id.predict(df, model).select("row.doc_id", "lang_pred", "score").collect())
    assert pick(docs) == pick(changed)


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).select("row.text", "score", "predicted").collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if not (r.text or "").strip()} == {model.prior}
    assert {r.score for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}
    assert quality.score(empty(spark), model).count() == 0
    assert quality.passed(docs, labels).columns == docs.columns


def test_held_out_rows(spark):
    import zlib

    ids = [*range(50), None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", held_out(F.col("doc_id"))).collect()
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, h in got)
