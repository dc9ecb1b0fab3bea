from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marquee.operators import trends
from marquee.plans import jobs
from marquee.sources.votes import parse_votes, parquet_stream, read_lots, text_votes
from marquee.streaming import runner

START = datetime(2024, 3, 1, 12, 0)
VOTE = "title_id string, rating long, ts timestamp"
TITLES = "title_id string, original_title string"


def at(minutes, seconds=0):
    return START + timedelta(minutes=minutes, seconds=seconds)


def votes(spark, *rows):
    return spark.createDataFrame(list(rows), VOTE)


def test_minute_and_lot_names(spark, rows):
    df = votes(spark, ("a", 1, at(9, 59)), ("b", 2, at(10)))
    assert rows(trends.logged_votes(df)) == [
        ("a", 1, "01-03-2024 12-09", "2024-03-01 12-00"), ("b", 2, "01-03-2024 12-10", "2024-03-01 12-10")]


def test_sliding_means_cover_ten_windows_and_end_is_open(spark):
    df = votes(spark, ("a", 4, at(0)), ("a", 7, at(5)))
    found = {r.window_start: (r.mean_vote, r.n_votes) for r in trends.window_means(df).collect()}
    assert len(found) == 15
    assert found[at(-9)] == (4.0, 1) and found[at(-4)] == (5.5, 2) and found[at(0)] == (5.5, 2)
    assert found[at(1)] == (7.0, 1) and at(6) not in found


@pytest.mark.parametrize(
    "length,slide", [("10 minutes", "1 minute"), ("10 minutes", "4 minutes"), ("1 hour", "90 seconds")])
def test_windows_from_panes_equal_windows_from_votes(spark, rows, length, slide):
    df = votes(spark, *[(t, (7 * n) % 11, at(0, 37 * n)) for n in range(60) for t in ("a", "b")[: 1 + n % 2]])
    want = df.groupBy(F.window("ts", length, slide).alias("w"), "title_id").agg(
        F.avg("rating").alias("mean_vote"), F.count("*").alias("n_votes"))
    want = want.select("w.start", "w.end", "title_id", "mean_vote", "n_votes")
    for panes in (True, False):
        assert rows(trends.window_means(df, length, slide, panes)) == rows(want)


def test_best_means_rank_before_ids_and_unknown_titles_take_no_place(spark, rows):
    df = votes(spark, *[(t, r, at(0)) for t, r in [("z", 9), ("y", 10), ("b", 8), ("a", 8), ("c", 8)]])
    titles = spark.createDataFrame([(t, t.upper()) for t in "abcz"], TITLES)
    top = trends.top_window_titles(trends.window_means(df), titles).where(F.col("window_start") == at(0))
    assert rows(top, "rank", "title_id", "original_title", "mean_vote") == [
        (1, "z", "Z", 9.0), (2, "a", "A", 8.0), (3, "b", "B", 8.0)]


def trend_votes(spark):
    counts = {"up": (2, 3, 0), "same": (3, 3, 3), "gap": (3, 0, 1), "late": (0, 0, 2)}
    return votes(spark, *[
        (title, 5, at(15 * period, n)) for title, many in counts.items() for period, c in enumerate(many)
        for n in range(c)])


RISING = sorted([
    ("up", at(0), 2, 0), ("same", at(0), 3, 0), ("gap", at(0), 3, 0), ("up", at(15), 3, 2),
    ("gap", at(30), 1, 0), ("late", at(30), 2, 0),
], key=repr)


def test_rising_titles(spark, rows):
    names = ("title_id", "period_start", "n_votes", "previous_votes")
    df = trend_votes(spark)
    assert rows(trends.rising_titles(df), *names) == RISING
    assert rows(trends.rising_titles_by_lag(trends.period_counts(df)), *names) == RISING


@pytest.fixture
def vote_files(spark, tmp_path):
    """Five micro-batches; one vote comes two batches after its windows were finished."""
    folder = tmp_path / "votes"
    late = ("late", 9, at(1))
    batches = [
        [("a", 4, at(0)), ("a", 8, at(3)), ("b", 5, at(9, 59)), ("b", 1, at(10))],
        [("a", 2, at(16)), ("c", 3, at(31))],
        [("c", 4, at(32))],
        [late, ("c", 6, at(33))],
        [("end", 1, at(120))],
    ]
    for batch in batches:
        votes(spark, *batch).coalesce(1).write.mode("append").parquet(str(folder))
    known = [v for batch in batches for v in batch if v is not late]
    return str(folder), known


@pytest.fixture
def run(spark, vote_files, tmp_path):
    folder, known = vote_files
    child = runner.stream_session(spark)
    schema = spark.createDataFrame([], VOTE).schema
    stream = parquet_stream(child, folder, schema, max_files=1)

    def go(transform, start=runner.to_files):
        out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
        rows = transform(stream.withWatermark("ts", "1 minute"))
        runner.finish(start(rows, out, checkpoint))
        return spark.read.parquet(out)
    return go, votes(spark, *known), at(119)


def window_means_from_panes(votes):
    return trends.window_means(votes, panes=True)


@pytest.mark.parametrize("transform,end", [
    (trends.window_means, "window_end"), (window_means_from_panes, "window_end"),
    (trends.period_counts, "period_end"), (trends.rising_titles, "period_end")])
def test_stream_equals_table_for_finished_windows(run, rows, transform, end):
    go, table, up_to = run
    want = transform(table).where(F.col(end) <= up_to)
    got = go(transform)
    assert rows(got, *want.columns) == rows(want)
    assert want.count() > 0 and got.where("title_id = 'late'").count() == 0


def test_top3_stream_equals_table(spark, run, rows):
    go, table, up_to = run
    titles = spark.createDataFrame([(t, t.upper()) for t in "abc"], TITLES)

    def start(stream, out, checkpoint):
        return runner.to_batches(stream, lambda b: trends.top_window_titles(b, titles), out, checkpoint)

    got = go(trends.window_means, start).drop("batch")
    want = trends.top_window_titles(trends.window_means(table), titles).where(F.col("window_end") <= up_to)
    assert rows(got, *want.columns) == rows(want) and want.count() > 0


@pytest.mark.parametrize("fmt,files_per_lot", [("parquet", None), ("csv", None), ("parquet", 2)])
def test_lots_hold_every_vote_and_rerun_adds_nothing(spark, vote_files, tmp_path, rows, fmt, files_per_lot):
    folder, _ = vote_files
    child = runner.stream_session(spark)
    schema = spark.createDataFrame([], VOTE).schema
    out, checkpoint = str(tmp_path / "lots"), str(tmp_path / "checkpoint")
    for _ in range(2):
        stream = parquet_stream(child, folder, schema, max_files=1)
        runner.finish(jobs.log_votes(stream, out, checkpoint, fmt=fmt, files_per_lot=files_per_lot, every=None))
    want = trends.logged_votes(spark.read.parquet(folder))
    found = read_lots(spark, out, fmt)
    assert rows(found.withColumn("rating", F.col("rating").cast("long"))) == rows(want)
    assert (tmp_path / "lots" / "lot=2024-03-01 12-10").is_dir()
    assert "PartitionFilters: [isnotnull(lot" in found.where("lot = '2024-03-01 12-10'")._jdf.queryExecution().toString()


@pytest.mark.parametrize("show", [False, True])
def test_trending_job_names_titles_from_the_kept_table(spark, vote_files, tmp_path, rows, show):
    folder, known = vote_files
    child = runner.stream_session(spark)
    stream = parquet_stream(child, folder, spark.createDataFrame([], VOTE).schema, max_files=1)
    titles = child.createDataFrame([("a", "A"), ("c", "C")], TITLES)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    runner.finish(jobs.trending(stream, titles, out, checkpoint, every=None, show=show))
    found = spark.read.parquet(out)
    table = trends.rising_titles(votes(spark, *known)).where(F.col("period_end") <= at(119))
    want = trends.named_titles(table, titles)
    assert rows(found, *want.columns) == rows(want) and want.count() > 0


def test_a_kept_table_is_not_shuffled_by_its_join(spark):
    child = runner.stream_session(spark)
    child.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    titles = runner.kept(child.createDataFrame([("a", "A"), ("c", "C")], TITLES), "title_id")
    rising = child.createDataFrame([("a", 1)], "title_id string, n_votes long")
    plan = trends.named_titles(rising, titles)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("InMemoryRelation")[0].count("Exchange") == 1
    titles.unpersist()


def test_vote_lines(spark, rows):
    lines = spark.createDataFrame(
        [("a\t7", START), ("b\tx", START), ("c", START), ("d\t0\textra", START)], "value string, timestamp timestamp")
    assert rows(parse_votes(lines)) == [("a", 7, START), ("d", 0, START)]


def test_votes_flow_through_text_stream_into_the_ratings_file(spark, tmp_path):
    ratings = tmp_path / "ratings.tsv"
    ratings.write_text("tconst\taverageRating\tnumVotes\nt1\t8.0\t90\nt2\t2.0\t10\n")
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "one.txt").write_text("".join(f"t{n % 2 + 1}\t{n % 11}\n" for n in range(200)))
    child = runner.stream_session(spark)
    lots = str(tmp_path / "lots")
    runner.finish(jobs.log_votes(text_votes(child, str(tmp_path / "lines")), lots, str(tmp_path / "c"), every=None))
    logged = read_lots(spark, lots)
    assert logged.count() == 200 and logged.schema.names[:3] == [f for f in ("title_id", "rating", "minute")]
    jobs.update_ratings(spark, str(ratings), lots, str(tmp_path / "new"))
    from marquee.sources.tsv import read_ratings
    new = {r.tconst: r for r in read_ratings(spark, str(tmp_path / "new")).collect()}
    assert sum(r.numVotes for r in new.values()) == 300 and set(new) == {"t1", "t2"}
    sums = {r.title_id: r.s for r in logged.groupBy("title_id").agg(F.sum("rating").alias("s")).collect()}
    for title, mean, n in (("t1", 8.0, 90), ("t2", 2.0, 10)):
        assert abs(new[title].averageRating - (mean * n + sums.get(title, 0)) / new[title].numVotes) <= 0.0501


def test_lots_and_minutes_are_utc_in_any_session(spark):
    """At the end of summer time two lots would get one name in local time."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        votes = spark.sql("SELECT 't' AS title_id, 1L AS rating, timestamp_seconds(s) AS ts "
                          "FROM VALUES (1730612100L), (1730615700L) AS v(s)")
        found = {(r.lot, r.minute) for r in trends.logged_votes(votes).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == {("2024-11-03 05-30", "03-11-2024 05-35"), ("2024-11-03 06-30", "03-11-2024 06-35")}


def _trend_stream(spark, tmp_path, **options):
    """25 rising titles in one period, and a late vote that ends it."""
    child = runner.stream_session(spark)
    source = str(tmp_path / "votes")
    child.sql("SELECT concat('t', id) AS title_id, 5L AS rating, timestamp'2024-01-01 00:05:00' AS ts FROM range(25) "
              "UNION ALL SELECT 'late', 1L, timestamp'2024-01-01 09:00:00'").write.parquet(source)
    votes = child.readStream.schema("title_id string, rating long, ts timestamp").parquet(source)
    titles = child.sql("SELECT concat('t', id) AS title_id, concat('Title ', id) AS original_title FROM range(25)")
    return jobs.trending(votes, titles, str(tmp_path / "out"), str(tmp_path / "c"), show=True, **options)


def test_a_report_shows_every_title(spark, tmp_path, capsys):
    runner.finish(_trend_stream(spark, tmp_path, every=None))
    shown = capsys.readouterr().out
    assert all(f"|Title {n} " in shown or f"|Title {n}|" in shown for n in range(25))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 25
    assert not runner._KEPT


def test_a_stream_with_a_trigger_can_be_stopped(spark, tmp_path):
    import time

    query = _trend_stream(spark, tmp_path, every="1 second")
    for _ in range(60):
        if list((tmp_path / "out").glob("batch=*/_SUCCESS")) and len(query.recentProgress) > 2:
            break
        time.sleep(1)
    query.stop()
    runner.finish(query)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 25
