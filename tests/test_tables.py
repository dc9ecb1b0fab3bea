import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.operators.upsert import upsert
from marquee.sinks.tables import upsert_table
from marquee.sources import tables


def test_upsert_inserts_and_keeps_what_is_not_given(spark, rows):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, s string")
    updates = spark.createDataFrame([("b", None, "z"), ("c", 3, None)], "k string, n int, s string")
    assert rows(upsert(base, updates, "k")) == [("a", 1, "x"), ("b", 2, "z"), ("c", 3, None)]


def test_upsert_merges_families_and_takes_whole_rows(spark, rows):
    base = spark.createDataFrame([("a", ("n", 1)), ("b", None)], "k string, f struct<name:string,year:int>")
    updates = spark.createDataFrame(
        [("a", (None, 5), 1), ("a", (None, 4), 2), ("b", ("m", None), None)],
        "k string, f struct<name:string,year:int>, extra int")
    out = upsert(base, updates, "k").select("k", "f.*", "extra")
    assert rows(out) == [("a", "n", 5, 1), ("b", "m", None, None)]


def test_shorter_array_replaces_the_whole_array(spark, rows):
    base = spark.createDataFrame([("a", ["x", "y"])], "k string, g array<string>")
    assert rows(upsert(base, spark.createDataFrame([("a", ["z"])], base.schema), "k")) == [("a", ["z"])]


def test_table_is_created_once_merged_and_dropped_once(spark, rows):
    name = f"people_{uuid.uuid4().hex}"
    assert tables.create_table(spark, name, tables.PERSON_TABLE)
    assert not tables.create_table(spark, name, tables.PERSON_TABLE)
    details = spark.createDataFrame([("p1", ("Ann", 1950, None))], "person_id string, details struct<name:string,birth:int,death:int>")
    summary = spark.createDataFrame([("p1", (2, ["A"])), ("p2", (1, ["B"]))], "person_id string, movies struct<total:int,top3:array<string>>")
    old = upsert_table(spark, name, details, "person_id")
    held = spark.read.parquet(old)
    upsert_table(spark, name, summary, "person_id")
    assert rows(tables.scan_family(spark.table(name), "person_id", "movies")) == [("p1", 2, ["A"]), ("p2", 1, ["B"])]
    assert rows(tables.scan_family(spark.table(name), "person_id", "details")) == [("p1", "Ann", 1950, None), ("p2", None, None, None)]
    assert held.count() == 1
    assert tables.drop_table(spark, name)
    assert not tables.drop_table(spark, name)


def numbers(spark, tmp_path):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("person_id"), F.struct(F.col("id").alias("a")).alias("x"),
        F.struct(F.col("id").alias("b")).alias("y"))
    name = f"numbers_{uuid.uuid4().hex}"
    tables.create_table(spark, name, df.schema)
    folder = upsert_table(spark, name, df, "person_id")
    return name, folder


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_reads_one_bucket_and_one_family(spark, tmp_path):
    name, _ = numbers(spark, tmp_path)
    found = tables.scan_family(tables.lookup(spark.table(name), "person_id", "77"), "person_id", "x")
    assert [tuple(r) for r in found.collect()] == [("77", 77)]
    assert "EqualTo(person_id,77)" in plan(found)
    assert "ReadSchema: struct<person_id:string,x:struct<a:bigint>>" in plan(found)
    assert tables.lookup(spark.table(name), "person_id", "none").count() == 0
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        assert "SelectedBucketsCount: 1 out of 4" in plan(tables.lookup(spark.table(name), "person_id", "77"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_merge_moves_only_the_updates_and_writes_a_file_per_bucket(spark, tmp_path):
    name, folder = numbers(spark, tmp_path)
    updates = spark.range(990, 1100).select(F.col("id").cast("string").alias("person_id"), F.struct(F.lit(-1).cast("long").alias("a")).alias("x"))
    merged = plan(upsert(spark.table(name), updates, "person_id"))
    assert merged.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in merged
    folder = upsert_table(spark, name, updates, "person_id")
    files = [p for p in spark.read.parquet(folder).inputFiles()]
    assert len(files) == 4
    table = spark.table(name)
    assert table.count() == 1100 and table.where("x.a = -1").count() == 110 and table.where("y.b >= 990").count() == 10
    assert spark.sql(f"SHOW TABLES LIKE '{name}_*'").count() == 0


def test_no_row_is_put_together_from_two(spark, rows):
    base = spark.createDataFrame([], "k string, name string, year int")
    updates = spark.createDataFrame([("a", "Ada", 1990, 2), ("a", "Zoe", 1950, 1)], "k string, name string, year int, at int")
    assert rows(upsert(base, updates.drop("at"), "k")) == [("a", "Zoe", 1950)]
    assert rows(upsert(base, updates, "k", "at")) == [("a", "Ada", 1990)]


def test_two_writers_on_one_row_both_survive(spark, rows, monkeypatch):
    """A second merge finishes between the first one's read and its switch."""
    from marquee.sinks import tables as sink
    from marquee.sources import tables

    schema = StructType.fromDDL("k string, a int, b int")
    tables.create_table(spark, "two_writers", schema, buckets=2)
    first = spark.createDataFrame([("x", 1)], "k string, a int")
    second = spark.createDataFrame([("x", 2)], "k string, b int")
    add, calls = tables.add_version, []

    def late(*args):
        if not calls:
            calls.append(1)
            sink.upsert_table(spark, "two_writers", second, "k")
        return add(*args)

    monkeypatch.setattr(tables, "add_version", late)
    sink.upsert_table(spark, "two_writers", first, "k")
    assert rows(spark.table("two_writers")) == [("x", 1, 2)]
    folder = tables.table_folder(spark, "two_writers")
    assert [n for n, _, _ in tables.versions(spark, folder)] == [0, 1, 2]
    assert tables.clean_versions(spark, "two_writers", keep=1) == 2
    assert rows(spark.table("two_writers")) == [("x", 1, 2)]
    assert tables.drop_table(spark, "two_writers", delete=True) and tables.versions(spark, folder) == []
    assert not tables.drop_table(spark, "two_writers")
