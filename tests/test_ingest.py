import json

from pyspark.sql import functions as F

from quarry.operators import ingest, metadata
from quarry.operators.typing_ops import type_values, wide_view
from quarry.scale import shared_path
from quarry.sources.employees import currency_to_int, read_employees
from quarry.sources.export import iso_time, json_lines, write_json_lines
from quarry.sources.store import DocumentStore
from quarry.streaming.upserts import upsert_stream

from fixture_data import ENTITIES, SET1, TYPE, property_types, values


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_upsert_is_idempotent_and_last_wins(spark):
    current = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("b", 5, 1), ("b", 6, 2), ("c", 7, 1)], "k string, v int, seq int")
    once = ingest.upsert(current, batch, ["k"], "seq")
    assert as_set(once) == {("a", 1), ("b", 6), ("c", 7)}
    assert as_set(ingest.upsert(once, batch, ["k"], "seq")) == as_set(once)
    assert as_set(ingest.upsert(current, batch.limit(0), ["k"], "seq")) == as_set(current)


def test_clear_keeps_linked_documents(spark):
    kept = ingest.clear_entity_set(values(spark), SET1, TYPE)
    assert {r.doc_id for r in kept.collect()} == {"e4", "L"}
    assert ingest.cleared_count(values(spark), SET1, TYPE).first()[0] == 3
    cascade = ingest.clear_entity_set(values(spark), SET1, TYPE, cascade_linked=True)
    assert {(r.doc_id, r.elem_entity_key_id) for r in cascade.collect()} == {("e4", "e4"), ("L", "e4")}


def test_assemble_deduplicates_values(spark):
    rows = spark.createDataFrame(
        [("t", "d", "s", "p", v) for v in ("x", "y", "x")],
        "entity_type_id string, doc_id string, entity_set_id string, property_id string, value string")
    assert ingest.assemble(rows).first().entity == {"p": ["x", "y"]}


def test_wide_view(spark):
    typed = type_values(values(spark), property_types(spark))
    wide = wide_view(typed, [("salary", "salary", "Int64"), ("home", "home", "GeographyPoint"), ("dept", "dept", "Binary")])
    row = wide.where("doc_id = 'e1'").first()
    assert row.salary == [207431] and row.home_lat == 41.8 and "dept" not in wide.columns


def test_partial_update(spark):
    orgs = spark.createDataFrame([("o", "Employees", "people")], "id string, title string, description string")
    patches = spark.createDataFrame(
        [("o", 1, None, False, "this is a new description", True), ("x", 1, "t", True, None, False)],
        "id string, seq int, title string, has_title boolean, description string, has_description boolean")
    patched, rejected = metadata.patch(orgs, patches, "id", ["title", "description"])
    assert as_set(patched) == {("o", "Employees", "this is a new description")}
    assert [r.id for r in rejected.collect()] == ["x"]
    # A present null overwrites; later patches win.
    again = spark.createDataFrame([("o", 1, "a", True, "d", False), ("o", 2, None, True, "e", False)], patches.schema)
    assert as_set(metadata.patch(orgs, again, "id", ["title", "description"])[0]) == {("o", None, "people")}


def test_catalog_rebuild_keeps_unknown_property_in_place(spark):
    sets = spark.createDataFrame([("s", ["p", "?", "q"]), ("t", [])], "entity_set_id string, property_ids array<string>")
    props = spark.createDataFrame([("p", "P"), ("q", "Q")], "property_id string, name string")
    rows = {r.entity_set_id: r.property_types for r in metadata.entity_set_catalog(sets, props).collect()}
    assert [p and p.name for p in rows["s"]] == ["P", None, "Q"] and rows["t"] == []


def test_objects_are_keyed_by_kind(spark):
    docs = [("EntityType", {"id": "1"}), ("AssociationType", {"id": "2", "entityType": {"id": "9"}}),
            ("AssociationType", {"id": "3"}), ("Nothing", {"id": "4"}), ("App", {"title": "no id"})]
    batch = spark.createDataFrame([(k, json.dumps(d), n) for n, (k, d) in enumerate(docs)], "kind string, doc string, seq int")
    empty = spark.createDataFrame([], "kind string, id string, doc string")
    saved, rejected = metadata.save_objects(empty, batch)
    assert {(r.kind, r.id) for r in saved.collect()} == {("EntityType", "1"), ("AssociationType", "9")}
    assert as_set(ingest.outcome(saved, rejected)) == {
        ("accepted", 2), ("association without entity type", 1), ("unknown kind", 1), ("no id", 1)}


def test_entity_set_patches_replace_whole_lists(spark):
    sets = spark.createDataFrame(
        [(i, "old", "d", ["a", "b"]) for i in ("s1", "s2", "s3", "s4")], "entity_set_id string, title string, description string, property_ids array<string>")
    patches = spark.createDataFrame(
        [("s1", 1, ["x"], True, "t", False), ("s1", 2, ["c", "a"], True, "new", True), ("s1", 3, ["z"], False, "late", False),
         ("s2", 1, [], True, None, False), ("s3", 1, None, True, None, True), ("zzz", 1, ["q"], True, "t", True)],
        "entity_set_id string, seq int, property_ids array<string>, has_property_ids boolean, title string, has_title boolean")
    patched, rejected = metadata.patch_entity_sets(sets, patches)
    got = {r.entity_set_id: (r.title, r.description, r.property_ids) for r in patched.collect()}
    assert got == {"s1": ("new", "d", ["c", "a"]), "s2": ("old", "d", []), "s3": (None, "d", []), "s4": ("old", "d", ["a", "b"])}
    assert [(r.entity_set_id, r.reason) for r in rejected.collect()] == [("zzz", "unknown id")]
    types = spark.createDataFrame([("a", "A"), ("c", "C")], "property_id string, name string")
    listed = {r.entity_set_id: [p and p.name for p in r.property_types] for r in metadata.entity_set_catalog(patched, types).collect()}
    assert listed["s1"] == ["C", "A"] and listed["s2"] == [] and listed["s4"] == ["A", None]


def store(spark):
    schema = spark.createDataFrame([], "k string, v int, seq int").schema
    return DocumentStore(spark, shared_path(spark, "store"), schema, ["k"], "seq")


def test_store_replays_deletes_and_rebuilds(spark):
    s = store(spark)
    batch = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], s.schema)
    s.write(batch, 0)
    s.write(batch, 0)
    s.write(spark.createDataFrame([("a", 2, 2), ("c", 1, 2)], s.schema), 1)
    expected = {("a", 2, 2), ("b", 1, 1), ("c", 1, 2)}
    assert as_set(s.read()) == expected
    s.remove(spark.createDataFrame([("b", 3), ("zzz", 3)], "k string, seq int"), 2)
    assert as_set(s.read()) == expected - {("b", 1, 1)}
    s.rebuild(spark.createDataFrame([("n", 1, 1), ("n", 2, 2)], s.schema), 2)
    assert as_set(s.read()) == {("n", 2, 2)}
    s.write(spark.createDataFrame([("n", 0, 1), ("p", 1, 1)], s.schema), 3)  # "n" comes too late
    assert as_set(s.read()) == {("n", 2, 2), ("p", 1, 1)}
    s.rebuild(spark.createDataFrame([], s.schema), 2)  # batch 3 is newer than the rebuild
    assert as_set(s.read()) == {("n", 0, 1), ("p", 1, 1)}
    s.rebuild(spark.createDataFrame([], s.schema), 3)
    assert as_set(s.read()) == set()


def test_read_skips_batches_before_a_rebuild(spark):
    s = store(spark)
    s.write(spark.createDataFrame([("a", 1, 1)], s.schema), 0)
    s.rebuild(spark.createDataFrame([("b", 1, 1)], s.schema), 1)
    s.write(spark.createDataFrame([("c", 1, 1)], s.schema), 2)
    read = s.read()
    assert as_set(read) == {("b", 1, 1), ("c", 1, 1)}
    scan = next(line for line in read._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "batch_id" in scan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]


def test_late_versions_stay_hidden(spark):
    s = store(spark)
    s.write(spark.createDataFrame([("a", 2, 2), ("b", 2, 2)], s.schema), 0)
    s.remove(spark.createDataFrame([("c", 5)], "k string, seq int"), 1)
    s.write(spark.createDataFrame([("a", 1, 1), ("c", 4, 4), ("b", 3, 3)], s.schema), 2)
    assert as_set(s.read()) == {("a", 2, 2), ("b", 3, 3)}
    s.remove(spark.createDataFrame([("b", 2)], "k string, seq int"), 3)  # a late delete
    assert as_set(s.read()) == {("a", 2, 2), ("b", 3, 3)}
    rejected = s.rebuild(spark.createDataFrame([("z", 1, 1), (None, 1, 1), ("y", 1, None)], s.schema), 3)
    assert as_set(s.read()) == {("z", 1, 1)} and {r.reason for r in rejected.collect()} == {"no k", "no seq"}


def test_last_version_of_a_linked_document_wins(spark):
    current = spark.createDataFrame([("d", "1", "old"), ("e", "1", "kept")], "doc_id string, ord string, value string")
    batch = spark.createDataFrame([("d", "1", "first", 1), ("d", "2", "first", 1), ("d", "1", "second", 2)],
                                  "doc_id string, ord string, value string, seq int")
    assert as_set(ingest.upsert_values(current, batch, ["doc_id"], "seq")) == {("d", "1", "second"), ("e", "1", "kept")}


def test_typed_values_of_all_spellings(spark):
    from quarry.operators.typing_ops import decimal_order, typed, typed_key

    rows = [("DateTimeOffset", "2024-05-01T10:00:00+02:00"), ("DateTimeOffset", "2024-05-01T08:00:00Z"), ("DateTimeOffset", "2024-05-01 08:00:00"),
            ("Decimal", "123456789012345678901234.50"), ("Decimal", "123456789012345678901234.5"), ("Decimal", "1.2345678901234567890123450E23"),
            ("Decimal", "-0.0"), ("Decimal", "0"), ("GeographyPoint", "1.0E-4,+5.0"), ("GeographyPoint", "91,0"), ("Decimal", "x")]
    df = spark.createDataFrame(rows, "datatype string, value string")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = df.select("value", typed_key(F.col("value"), F.col("datatype")).alias("key"),
                            *[c.alias(n) for n, c in typed(F.col("value"), F.col("datatype")).items()]).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        keys = [r.key for r in got]
        assert keys[0] == keys[1] == keys[2] == "2024-05-01 08:00:00"
        assert keys[3] == keys[4] == keys[5] != keys[6] and keys[6] == keys[7] == "0" and keys[10] is None
        assert (got[8].v_lat, got[8].v_lon) == (0.0001, 5.0) and got[9].v_lat is None
    numbers = ["-1e30", "-123456789012345678901234", "-10", "-1.5", "-1", "-0.001", "0", "0.001", "1", "1.05", "1.5", "2", "10",
               "123456789012345678901234", "123456789012345678901235", "1e30"]
    ordered = spark.createDataFrame([(n,) for n in reversed(numbers)], "n string").orderBy(decimal_order(F.col("n"))).collect()
    assert [r.n for r in ordered] == numbers


def test_stream_equals_batch(spark):
    s, arriving = store(spark), shared_path(spark, "arriving")
    rows = [(f"k{i % 7}", i, i) for i in range(60)]
    spark.createDataFrame(rows, s.schema).repartition(5).write.parquet(arriving)
    stream = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    state = shared_path(spark, "state")
    upsert_stream(stream, s, state).awaitTermination()
    assert {(r.k, r.v) for r in s.read().collect()} == {(f"k{i % 7}", i) for i in range(53, 60)}
    # Restarting on the same state adds nothing.
    upsert_stream(stream, s, state).awaitTermination()
    assert s.read().count() == 7


def test_iso_rendering(spark):
    df = spark.sql("select date '2020-02-29' d, timestamp_ntz '2020-01-02 03:04:05.25' t, 7 n")
    assert json.loads(json_lines(df).first().value) == {"d": "2020-02-29", "t": "2020-01-02T03:04:05.250000Z", "n": 7}
    assert df.select(iso_time(F.col("t"))).first()[0] == "03:04:05.250000"
    path = shared_path(spark, "lines")
    write_json_lines(df, path)
    assert spark.read.json(path).count() == 1


def test_iso_rendering_is_utc_in_any_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.sql("select timestamp '2020-01-02 03:04:05+00:00' t")
        assert json.loads(json_lines(df).first().value) == {"t": "2020-01-02T03:04:05.000000Z"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_employee_csv(spark):
    salaries = spark.createDataFrame([("$207,431.00",), ("12",), ("abc",), (None,), ("$",)], "s string")
    assert [r[0] for r in salaries.select(currency_to_int(F.col("s"))).collect()] == [207431, 0, 0, 0, 0]
    path = shared_path(spark, "csv")
    spark.createDataFrame([('"A, B",T,D,"$1,000.50"',)], "v string").write.text(path)
    assert tuple(read_employees(spark, path).first()) == ("A, B", "T", "D", 1000)


def test_lenient_typing(spark):
    rows = [("i", "Int32", v) for v in ("1", "x", "3000000000", "1.5")] + [("f", "Double", v) for v in ("1d", "2.5", "1e3")] + [
        ("b", "Boolean", v) for v in ("true", "TRUE")] + [("u", "Byte", v) for v in ("255", "256")]
    vals = spark.createDataFrame([(p, v, v) for p, _, v in rows], "property_id string, value string, doc_id string")
    props = spark.createDataFrame([(p, k, None) for p, k, _ in dict.fromkeys((p, k, 0) for p, k, _ in rows)],
                                  "property_id string, datatype string, analyzer string")
    out = {(r.property_id, r.value): (r.v_bool, r.v_long, r.v_double) for r in type_values(vals, props).collect()}
    assert out["i", "1"] == (None, 1, None) and out["u", "255"] == (None, 255, None) and out["b", "true"] == (True, None, None)
    assert out["f", "2.5"] == (None, None, 2.5) and out["f", "1e3"] == (None, None, 1000.0)
    for bad in [("i", "x"), ("i", "3000000000"), ("i", "1.5"), ("f", "1d"), ("b", "TRUE"), ("u", "256")]:
        assert out[bad] == (None, None, None)


def test_fixture_covers_all_entities(spark):
    assert {r.doc_id for r in values(spark).collect()} == {*ENTITIES, "L"}
