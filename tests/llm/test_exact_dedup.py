import re

import numpy as np
from corpus_data import awkward, empty
from pyspark.sql import functions as F

from quarry.llm import exact_dedup as ed
from quarry.llm.common import mix


def expected(rows):
    """Group sizes and smallest ids by normalised text."""
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), []).append(r.doc_id)
    return {t: (min((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def check(result, rows):
    want = expected(rows)
    got = result.select("row.text", "keep_id", "group_size", "kept").collect()
    assert len(got) == len(rows)
    kept = {}
    for r in got:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        assert (r.keep_id, r.group_size) == want[text]
        kept[text] = kept.get(text, 0) + r.kept
    assert set(kept.values()) == {1} and len(kept) == len(want)


def test_filters_have_no_false_negatives():
    for n in (0, 1, 2, 3, 50, 3000):
        keys = mix(np.arange(n, dtype=np.uint64))
        made = ed.fuse_filter(keys)
        assert ed.may_hold(keys, *made).all()
        others = mix(np.arange(10**6, 10**6 + 5000, dtype=np.uint64))
        assert ed.may_hold(others, *made).mean() < 0.02


def test_awkward_rows(spark):
    docs = awkward(spark)
    for is_new in (None, F.col("doc_id") > 9, F.col("doc_id") % 2 == 0, F.lit(False)):
        check(ed.deduplicate(docs, is_new, bucket_keys=5), docs.collect())


def test_lying_digests_are_split_by_text(spark):
    docs = awkward(spark)
    weak = lambda text: (F.crc32(text) % 3).cast("string")
    check(ed.deduplicate(docs, F.col("doc_id") > 9, digest=weak), docs.collect())


def test_empty_and_query_columns(spark):
    assert ed.deduplicate(empty(spark)).count() == 0
    assert ed.newer_half(empty(spark)) is not None
    docs = awkward(spark)
    assert ed.unique(docs).columns == docs.columns
    assert ed.unique(docs).count() == len(expected(docs.collect()))
    assert ed.with_digest(ed.deduplicate(docs)).select("text_sha256").distinct().count() == len(expected(docs.collect()))
