"""What the physical plans must and must not contain."""

import pytest
from fixture_data import SET1, index, request, simple
from pyspark.sql import functions as F

from quarry import schemas
from quarry.operators.rank import page, sort_keys
from quarry.plans import property_tables as pt
from quarry.plans.entity_search import find, search
from quarry.scale import fits, local_table, lookup_join, materialize, shared_path
from quarry.sources.index_store import read_index, write_index


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def idx(spark):
    return index(spark)


def test_search_has_one_exchange_and_no_cartesian(spark, idx):
    text = plan(find(request(spark, [simple("police officer")]), idx))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_pages_cut_before_the_exchange(spark, idx):
    req = request(spark, [simple("police")], max_hits=5)
    hits = materialize(find(req, idx), "hits")
    text = plan(page(sort_keys(hits, req, idx), req))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")


def test_id_results_read_few_columns(spark, idx):
    text = plan(find(request(spark, [simple("police")]), idx))
    assert "positions" not in text


def test_filters_reach_the_scan(spark):
    tables = {}
    for name, value in {"dept": "'FIRE'", "salary": "id * 1000"}.items():
        path = shared_path(spark, name)
        spark.range(200).selectExpr("id as entityid", f"{value} as value").write.parquet(path)
        tables[name] = spark.read.parquet(path)
    assert "EqualTo(value,FIRE)" in plan(pt.with_value(tables["dept"], "value = 'FIRE'"))
    assert "GreaterThan(value,80000)" in plan(pt.with_value(tables["salary"], F.col("value") > 80000))
    joined = pt.where_all(pt.join_properties(tables["dept"], tables), F.col("salary") > 80000, F.col("dept") == "FIRE")
    text = plan(joined)
    assert "GreaterThan(value,80000)" in text and "EqualTo(value,FIRE)" in text


def test_write_time_window_reaches_the_scan(spark):
    import datetime as dt

    from quarry.operators.predicates import written_between

    path = shared_path(spark, "elements")
    spark.sql("select timestamp_ntz '2024-01-01 00:00:00' as last_write").write.parquet(path)
    lo, hi = (F.lit(dt.datetime(2024, m, 1)).cast("timestamp_ntz") for m in (1, 2))
    text = plan(spark.read.parquet(path).where(written_between(F.col("last_write"), lo, hi)))
    assert "GreaterThan(last_write" in text and "LessThanOrEqual(last_write" in text


def test_write_time_search_prunes_stored_elements(spark, idx):
    import datetime as dt

    from quarry.operators.predicates import write_time_matches

    path = shared_path(spark, "index")
    write_index(idx, path)
    window = {"search_type": "writeDateTimeFilter", "start_date": dt.datetime(2023, 12, 1), "end_date": dt.datetime(2024, 1, 1, 0, 0)}
    text = plan(write_time_matches(request(spark, [window]), read_index(spark, path)))
    assert "GreaterThan(last_write" in text and "LessThanOrEqual(last_write" in text


def test_deep_pages_need_no_one_task_sort(spark, idx):
    deep = request(spark, [simple("police")], start=0, max_hits=2**31 - 1)
    shallow = request(spark, [simple("police")], start=0, max_hits=50)
    rows = [sorted((r.rn, r.doc_id) for r in search(req, idx).collect()) for req in (deep, shallow)]
    assert rows[0] == rows[1] and len(rows[0]) > 1
    past = request(spark, [simple("police")], start=2**31 - 2, max_hits=2**31 - 1)
    assert search(past, idx).count() == 0


def test_many_shapes_from_few_requests_are_measured_after_the_explode(spark, monkeypatch):
    """Beyond the bound a lookup is joined by shuffle and the rows stay the same."""
    from quarry import scale

    big = spark.range(300).selectExpr("id", "cast(id % 7 as string) k")
    few = spark.createDataFrame([("1", 5), ("2", 3)], "k string, n int").selectExpr("k", "explode(sequence(1, n)) v")
    expected = sorted(map(tuple, lookup_join(big, few, ["k"], ["id"]).collect()))
    monkeypatch.setattr(scale.fits, "__defaults__", (4, scale.BROADCAST_MAX_BYTES))
    joined = lookup_join(big, few, ["k"], ["id"])
    assert "_slice" in joined._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, joined.collect())) == expected


def test_lookup_join_is_the_same_either_way(spark):
    big = spark.range(500).selectExpr("id", "case when id % 3 = 0 then 'hot' else cast(id % 11 as string) end k")
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("4", 3), ("none", 4)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = lookup_join(big, small, ["k"], ["id"], small_fits=True, how=how)
        b = lookup_join(big, small, ["k"], ["id"], small_fits=False, how=how)
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_size_check_is_bounded(spark):
    rows = spark.range(1000)
    assert fits(rows) and not fits(rows, max_rows=999) and not fits(rows, max_bytes=100)


def test_stored_index_answers_alike(spark, idx):
    path = shared_path(spark, "index")
    write_index(idx, path)
    stored = read_index(spark, path)
    req = request(spark, [simple('police "lead harbour" 12345', fuzzy=False)])
    assert sorted(map(tuple, search(req, stored).collect())) == sorted(map(tuple, search(req, idx).collect()))
    assert "PartitionFilters" in plan(stored.postings.where(F.col("entity_type_id") == "employee"))


def test_searched_terms_reach_the_scan(spark, idx):
    path = shared_path(spark, "index")
    write_index(idx, path)
    text = plan(find(request(spark, [simple("police officer")]), read_index(spark, path)))
    assert "In(term, [officer,police])" in text
    assert "entity_type_id" in text[text.index("PartitionFilters"):]


def test_many_searches_with_different_questions(spark, idx):
    from quarry.operators.requests import Requests

    terms = {"a": "police", "b": "shipping", "c": "nobody", "d": "linden gwendola"}
    names = schemas.CONSTRAINTS.fieldNames()
    req = Requests.of(
        spark,
        searches=local_table(spark, [(s, s, 0, SET1, "employee", False, 0, 1, "score", None, None, None, True) for s in terms],
                             schemas.SEARCHES),
        authorized=local_table(spark, [(s, p) for s in terms for p in ("dept", "name")], schemas.AUTHORIZED),
        groups=local_table(spark, [(s, 0, 1) for s in terms], schemas.SEARCH_GROUPS),
        constraints=local_table(spark, [
            tuple({"search_id": s, "group_no": 0, "constraint_no": 0, "search_type": "simple", "search_term": t, "fuzzy": False}.get(n)
                  for n in names) for s, t in terms.items()], schemas.CONSTRAINTS))
    got = {r.search_id: (r.doc_id, r.total_hits) for r in search(req, idx).collect()}
    assert got["a"] == ("e2", 2) and got["b"] == ("e1", 1) and got["d"][1] == 2 and "c" not in got


@pytest.mark.parametrize("spread_by", [["n"], ["k"]])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_lookup_measured_as_large_is_never_broadcast(spark, spread_by, how):
    # Spark guesses both files to be far below its own bound, slices or not.
    big = materialize(spark.range(400).selectExpr("id % 40 as k", "id as n"), "big")
    small = materialize(spark.range(30).selectExpr("id as k"), "small")
    joined = lookup_join(big, small, ["k"], spread_by, small_fits=False, how=how)
    assert "Broadcast" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert joined.count() == {"inner": 300, "left": 400, "left_semi": 300, "left_anti": 100}[how]


def test_large_request_tables_are_not_broadcast(spark, idx, monkeypatch):
    from quarry.operators import requests

    monkeypatch.setattr(requests, "BROADCAST_MAX_ROWS", 0)
    req = request(spark, [simple("police officer")])
    assert "Broadcast" not in plan(requests.live_searches(req))
    # Property types are a small table of their own.
    assert plan(requests.text_clauses(req, req.searches, idx.property_types)).count("BroadcastHashJoin") == 1


def test_tasks_of_the_index_build_follow_the_text(spark, monkeypatch):
    from quarry.operators import index as ix

    keys = {"entity_type_id": "'t'", "entity_set_id": "'s'", "ord": "'0'", "property_id": "'p'", "datatype": "'String'", "analyzer": f"'{ix.text.STANDARD}'"}
    values = materialize(spark.range(600).selectExpr(
        "cast(id as string) as doc_id", "0 as value_no", "concat('word', id, ' of many') as value", *[f"{v} as {k}" for k, v in keys.items()]), "values")
    monkeypatch.setattr(ix, "TASK_VALUES", 20)
    tasks = ix.posting_tasks(values)
    assert tasks == max(30, spark.sparkContext.defaultParallelism)
    built = ix.build_postings(values, tasks=tasks)
    assert built.rdd.getNumPartitions() == tasks
    assert built.exceptAll(ix.build_postings(values)).isEmpty() and built.count() == 1800


def test_sorted_tables_and_signatures_are_dealt_by_what_they_hold(spark, monkeypatch):
    from quarry.operators import index as ix

    monkeypatch.setattr(ix, "SORT_ROWS", 100)
    monkeypatch.setattr(ix, "TASK_TERMS", 30)
    terms = spark.range(1200).selectExpr("'t' as entity_type_id", "'p' as property_id", "cast(id as string) as term", "id as df")
    kept = ix.stored(terms, "term_stats")
    assert len(kept.inputFiles()) == 12 and kept.exceptAll(terms).isEmpty() and kept.count() == 1200
    assert ix._spread(kept).rdd.getNumPartitions() == 40
    few = ix.stored(terms.limit(90), "term_stats")
    assert ix.sort_files(few) is None and few.count() == 90


def test_values_are_computed_once_before_they_are_sorted(spark):
    from quarry.operators import index as ix

    seen = spark.sparkContext.accumulator(0)
    typed = spark.range(2000).selectExpr("'t' as entity_type_id", "'p' as property_id", "cast(id as string) as term", "id as df")
    counted = typed.rdd.map(lambda r: seen.add(1) or r).toDF(typed.schema)
    assert ix.stored(counted, "term_stats").count() == 2000 and seen.value == 2000


def test_postings_group_no_row_per_token(spark):
    from quarry.operators import index as ix

    values = spark.createDataFrame(
        [("d", 0, "to be or not to be"), ("d", 1, "be"), ("e", 0, "..."), ("f", 0, "To")], "doc_id string, value_no int, value string",
    ).selectExpr("*", "'t' as entity_type_id", "'s' as entity_set_id", "'0' as ord", "'p' as property_id", "'String' as datatype", f"'{ix.text.STANDARD}' as analyzer")
    built = ix.build_postings(values)
    gap = ix.VALUE_GAP
    assert sorted((r.doc_id, r.term, r.tf, r.len, r.positions) for r in built.collect()) == [
        ("d", "be", 3, 7, [1, 5, gap]), ("d", "not", 1, 7, [3]), ("d", "or", 1, 7, [2]), ("d", "to", 2, 7, [0, 4]), ("f", "to", 1, 1, [0])]
    # Values are grouped by element once; the tokens are not grouped again.
    text = built._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate") == 1


def test_values_are_tokenised_once_where_codes_are_added(spark):
    from quarry.operators import index as ix

    seen = spark.sparkContext.accumulator(0)
    rows = spark.range(300).selectExpr(
        "cast(id % 200 as string) as doc_id", "cast(id div 200 as int) as value_no", "concat('knight ', if(id % 2 = 0, 'night', 'smith'), ' schmidt') as value",
        "'t' as entity_type_id", "'s' as entity_set_id", "'0' as ord", "'p' as property_id", "'String' as datatype", f"'{ix.text.METAPHONE}' as analyzer")
    counted = rows.rdd.map(lambda r: seen.add(1) or r).toDF(rows.schema)
    spoken = spark.createDataFrame([("p",)], "property_id string")
    built = ix.build_postings(counted, spoken, tasks=5)
    assert built.exceptAll(ix.build_postings(rows, spoken)).isEmpty() and built.count() == ix.build_postings(rows, spoken).count()
    assert built.where("term = 'NFT' or term = 'NT' or term = 'SM0'").count() > 0
    assert seen.value == 300


def test_typing_is_generated_in_methods_the_jvm_compiles(spark):
    """A method of more than 8,000 bytes runs uncompiled, row by row."""
    import re

    from quarry.operators.index import typed_terms
    from quarry.operators.typing_ops import type_values

    given = [("p", "Double", "1.50"), ("q", "Decimal", "007.10"), ("s", "String", "7"), ("g", "GeographyPoint", "1,2"), ("d", "DateTimeOffset", "2024-01-01T00:00:00Z"),
             ("i", "Int32", "3"), ("b", "Boolean", "true"), ("x", None, "4")]
    props = local_table(spark, [(p, "n", p, p, kind, None) for p, kind, _ in given if kind], schemas.PROPERTY_TYPES)
    values = local_table(spark, [("t", p, "s", "0", p, "s", p, 0, v) for p, _, v in given], schemas.ENTITY_VALUES)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        typed = type_values(values, props)
        stored = materialize(typed, "typed")
        for df in (typed, typed_terms(stored)):
            code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(df._jdf.queryExecution().executedPlan())
            assert all(int(n) <= 8000 for n in re.findall(r"maxMethodCodeSize:(\d+)", code))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert {(r.property_id, r.term) for r in typed_terms(stored).collect()} == {
        ("p", "1.5"), ("q", "71E-1"), ("d", "2024-01-01 00:00:00"), ("i", "3"), ("b", "true")}


def test_small_files_of_many_rows_are_spread_over_the_cores(spark, monkeypatch):
    from quarry import scale

    path = shared_path(spark, "rows")
    spark.range(5000).coalesce(1).write.parquet(path)
    rows = spark.read.parquet(path)
    assert scale.spread_rows(rows) is rows
    monkeypatch.setattr(scale, "SPREAD_ROWS", 1000)
    spread = scale.spread_rows(rows)
    assert spread.rdd.getNumPartitions() >= 4 and spread.count() == 5000 and spread.distinct().count() == 5000
