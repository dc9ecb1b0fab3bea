import os
import uuid

import pytest
from pyspark.sql import functions as F

from marquee.operators.upsert import upsert
from marquee.plans import jobs
from marquee.sinks import puts
from marquee.sinks.tables import compact, upsert_table
from marquee.sources import tables

FAMILIES = "person_id string, details struct<name:string,birth:int>, movies struct<total:int,top3:array<string>>, note string"


@pytest.fixture
def people(spark):
    """A stored table of 2,000 people."""
    name = f"people_{uuid.uuid4().hex}"
    df = spark.range(2000).select(
        F.format_string("p%06d", "id").alias("person_id"),
        F.struct(F.concat(F.lit("Name "), F.col("id")).alias("name"), F.col("id").cast("int").alias("birth")).alias("details"),
        F.lit(None).cast("struct<total:int,top3:array<string>>").alias("movies"), F.lit("old").alias("note"))
    tables.create_table(spark, name, df.schema)
    upsert_table(spark, name, df, "person_id")
    yield name
    tables.drop_table(spark, name, delete=True)


def summaries(spark, ids, total):
    return spark.createDataFrame([(f"p{n:06}", (total, ["A", "B"])) for n in ids], "person_id string, movies struct<total:int,top3:array<string>>")


def size(folder):
    folder = folder.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reading_puts_equals_merging_them(spark, people, rows):
    changes = [
        summaries(spark, range(10), 1),
        spark.createDataFrame([("p000003", (None, 77), None), ("p000004", ("New", None), "x"), ("q", ("Q", 5), None)],
                              "person_id string, details struct<name:string,birth:int>, note string"),
        summaries(spark, [3, 5000], 2),
        spark.createDataFrame([("p000003", "a"), ("p000003", "b"), ("z", None)], "person_id string, note string"),
    ]
    want = spark.table(people)
    for number, change in enumerate(changes, 1):
        assert puts.put_rows(spark, people, change, "person_id") == number
        want = upsert(want, change, "person_id")
        assert rows(puts.read_table(spark, people, "person_id")) == rows(want)
    assert spark.table(people).count() == 2000  # nothing stored was changed
    compact(spark, people, "person_id")
    assert rows(spark.table(people)) == rows(want) == rows(puts.read_table(spark, people, "person_id"))
    assert compact(spark, people, "person_id") is None


def test_a_put_writes_only_its_rows(spark, people):
    folder = tables.table_folder(spark, people)
    before = size(folder)
    puts.put_rows(spark, people, summaries(spark, [7], 1), "person_id")
    one = size(f"{folder}/puts")
    assert size(folder) - before == one < before / 5
    plan_of_read = plan(puts.read_table(spark, people, "person_id"))
    assert "Exchange hashpartitioning" not in plan_of_read  # bucket by bucket


def selected(spark, df):
    """Buckets that each scan of a plan opens."""
    return [line.partition("SelectedBucketsCount: ")[2].split(",")[0].strip() for line in plan(df).splitlines()
            if "SelectedBucketsCount" in line]


@pytest.fixture
def bucketed_scan(spark):
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    yield
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_a_lookup_opens_one_bucket_of_the_table_and_of_the_puts(spark, people, rows, bucketed_scan):
    puts.put_rows(spark, people, summaries(spark, range(50), 1), "person_id")
    puts.put_rows(spark, people, summaries(spark, range(20), 2), "person_id")
    found = puts.get_row(spark, people, "person_id", "p000007")
    assert [s.split()[0] for s in selected(spark, found)] == ["1", "1"]
    assert rows(found) == [("p000007", ("Name 7", 7), (2, ["A", "B"]), "old")]
    assert puts.get_row(spark, people, "person_id", "nobody").count() == 0


def bucket_of(spark, ids, buckets):
    found = spark.createDataFrame([(i,) for i in ids], "k string").select("k", F.pmod(F.hash("k"), F.lit(buckets)).alias("b"))
    return {r.k: r.b for r in found.collect()}


def test_a_thousand_ids_open_only_their_buckets(spark, rows, bucketed_scan):
    name = f"wide_{uuid.uuid4().hex}"
    df = spark.range(20_000).select(F.format_string("p%06d", "id").alias("k"), F.col("id").alias("n"))
    tables.create_table(spark, name, df.schema, buckets=16)
    upsert_table(spark, name, df, "k")
    bucket = bucket_of(spark, [f"p{n:06}" for n in range(30_000)], 16)
    chosen = [k for k, b in bucket.items() if b in (3, 11)][:1000]
    found = puts.get_rows(spark, name, "k", chosen * 2)
    assert [s.split()[:4] for s in selected(spark, found)] == [["2", "out", "of", "16"]]
    assert rows(found) == sorted((k, int(k[1:])) for k in chosen if int(k[1:]) < 20_000)
    assert puts.get_rows(spark, name, "k", ["x", "y"]).count() == 0
    assert puts.get_rows(spark, name, "k", []).count() == 0
    tables.drop_table(spark, name, delete=True)


def test_files_carry_bloom_filters(spark, people):
    import pyarrow.parquet as pq

    folder = tables.versions(spark, tables.table_folder(spark, people))[-1][2].removeprefix("file:")
    part = next(os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet"))
    with open(part, "rb") as file:
        raw = file.read()
    column = pq.ParquetFile(part).metadata.row_group(0).column(0)
    # The filter lies between the pages and the footer; a file without filters has no room there.
    end = max((c.dictionary_page_offset or c.data_page_offset) + c.total_compressed_size
              for c in (pq.ParquetFile(part).metadata.row_group(0).column(n) for n in range(6)))
    assert column.path_in_schema == "person_id" and len(raw) - end > 1_500


def test_versions_name_the_puts_they_hold_and_cleaning_takes_those(spark, people, rows):
    folder = tables.table_folder(spark, people)
    for n in range(3):
        puts.put_rows(spark, people, summaries(spark, [n], n), "person_id")
    assert tables.puts_after(spark, folder) == [1, 2, 3]
    upsert_table(spark, people, summaries(spark, [0], 9), "person_id")  # later than all puts
    assert tables.merged_puts(spark, folder) == 3 and tables.puts_after(spark, folder) == []
    assert puts.get_row(spark, people, "person_id", "p000000").first().movies.total == 9
    assert puts.put_rows(spark, people, summaries(spark, [0], 10), "person_id") == 4
    assert puts.get_row(spark, people, "person_id", "p000000").first().movies.total == 10
    compact(spark, people, "person_id")
    assert tables.clean_versions(spark, people, keep=1) == 3
    assert tables.put_numbers(spark, folder) == []
    assert puts.put_rows(spark, people, summaries(spark, [0], 11), "person_id") == 5
    assert {r.movies.total for r in puts.get_rows(spark, people, "person_id", ["p000000", "p000002"]).collect()} == {11, 2}


def test_a_put_during_a_compaction_stays(spark, people, monkeypatch):
    add, calls = tables.add_version, []

    def late(*args):
        if not calls:
            calls.append(puts.put_rows(spark, people, summaries(spark, [1], 5), "person_id"))
        return add(*args)

    puts.put_rows(spark, people, summaries(spark, [1], 4), "person_id")
    monkeypatch.setattr(tables, "add_version", late)
    compact(spark, people, "person_id")
    assert tables.puts_after(spark, tables.table_folder(spark, people)) == [2]
    assert spark.table(people).where("person_id = 'p000001'").first().movies.total == 4
    assert puts.get_row(spark, people, "person_id", "p000001").first().movies.total == 5


def test_unknown_columns_are_refused_and_no_rows_are_a_put(spark, people, rows):
    with pytest.raises(ValueError):
        puts.put_rows(spark, people, spark.createDataFrame([("a", 1)], "person_id string, other int"), "person_id")
    before = rows(puts.read_table(spark, people, "person_id"))
    puts.put_rows(spark, people, summaries(spark, [0], 1).where("false"), "person_id")
    assert rows(puts.read_table(spark, people, "person_id")) == before


def test_jobs_put_and_get(spark, tmp_path):
    names = {k: f"{k}_{uuid.uuid4().hex}" for k in ("titles", "people")}
    jobs.create_tables(spark, **names)
    (tmp_path / "people.tsv").write_text("nconst\tprimaryName\tbirthYear\tdeathYear\tp\tk\nn1\tAnn\t1950\t\\N\t\\N\t\\N\nn2\tBen\t1960\t\\N\t\\N\t\\N\n")
    jobs.load_people(spark, str(tmp_path / "people.tsv"), names["people"], put=True)
    assert {r.name for r in jobs.pages(spark, ["n1", "n2", "n3"], names["people"]).collect()} == {"Ann", "Ben"}
    jobs.compact_tables(spark, **names, keep=1)
    assert jobs.page(spark, "n1", names["people"]).first().name == "Ann"
    jobs.drop_tables(spark, **names, delete=True)
