"""The registered queries against their SQL, and the pipeline's stages one after the other."""

import os

import duckdb
import pytest
from corpus_data import awkward

import __spark_entry__
import corpus_pipeline
from quarry.llm import quality
from quarry.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied data not present")


def test_all_are_registered():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


@needs_data
@pytest.mark.parametrize("key", sorted(ORACLES))
def test_agrees_with_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[key](spark, SF).toPandas()
    want = con.execute(ORACLES[key]).df()
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    rows = lambda df: sorted(map(str, df[names].astype(str).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


@needs_data
def test_stages_keep_the_columns_and_shrink(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0
    texts = [r.text for r in docs.select("text").collect()]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.where("piece = 0").count() == len(texts)
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


@needs_data
def test_stages_take_awkward_rows(spark):
    docs = awkward(spark).withColumnRenamed("row", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() >= 0


def test_without_usable_labels_no_document_is_dropped(spark):
    docs = awkward(spark)
    rows = lambda df: sorted(map(str, df.collect()))
    for labels in ([], [(None, 1), (3, None), (4, 7)]):
        kept = quality.passed(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert kept.columns == docs.columns and rows(kept) == rows(docs)
