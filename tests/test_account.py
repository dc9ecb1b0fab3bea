from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from marquee.operators import reconcile, trends
from marquee.sources.votes import parquet_stream
from marquee.streaming import account, runner

START = datetime(2024, 3, 1, 12, 0)
VOTE = "title_id string, rating long, ts timestamp"


def at(minutes):
    return START + timedelta(minutes=minutes)


BATCHES = [
    [("a", 1, at(0)), ("a", 2, at(14)), ("b", 3, at(20))],
    [("a", 4, at(31)), ("b", 5, at(1))],  # the batch that closes period 0 still takes votes of it
    [("a", 6, at(2)), ("late", 7, at(3)), ("b", 8, at(62))],
    [("b", 9, at(63)), ("late", 7, at(16)), ("a", 1, at(46))],
]


@pytest.fixture
def ran(spark, tmp_path):
    for batch in BATCHES:
        spark.createDataFrame(batch, VOTE).coalesce(1).write.mode("append").parquet(str(tmp_path / "votes"))
    child = runner.stream_session(spark)
    schema = spark.createDataFrame([], VOTE).schema
    stream = parquet_stream(child, str(tmp_path / "votes"), schema, max_files=1).withWatermark("ts", "1 minute")
    book = account.follow(child)
    counts = trends.period_counts(account.observed(stream))
    query = runner.to_files(counts, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    runner.finish(query)
    import time

    for _ in range(50):  # listeners hear of a batch after it has ended
        if book.n_votes == 11:
            break
        time.sleep(0.1)
    account.unfollow(child, book)
    votes = spark.createDataFrame([v for batch in BATCHES for v in batch], VOTE)
    return votes, spark.read.parquet(str(tmp_path / "out")), query, book


def test_reported_late_and_open_votes_are_all_votes(ran, rows):
    votes, reported, query, book = ran
    closed = account.last_watermark(query)
    assert closed == datetime(2024, 3, 1, 13, 2, tzinfo=timezone.utc)
    found = reconcile.vote_account(votes, reported, F.lit(closed).cast("timestamp"))
    assert rows(found.select("title_id", "period_start", "n_votes", "n_reported", "n_late", "n_open")) == sorted([
        ("a", at(0), 3, 2, 1, 0), ("late", at(0), 1, 0, 1, 0), ("b", at(0), 1, 1, 0, 0), ("b", at(15), 1, 1, 0, 0),
        ("late", at(15), 1, 0, 1, 0), ("a", at(30), 1, 1, 0, 0), ("a", at(45), 1, 1, 0, 0), ("b", at(60), 2, 0, 0, 2)], key=repr)
    total = reconcile.totals(found).first()
    assert total.n_votes == 11 == total.n_reported + total.n_late + total.n_open
    assert rows(reconcile.corrections(found).select("title_id", "period_start", "n_votes", "was_reported")) == sorted([
        ("a", at(0), 3, 2), ("late", at(0), 1, 0), ("late", at(15), 1, 0)], key=repr)
    lost = reconcile.unreported_votes(votes, reported, F.lit(closed).cast("timestamp"))
    assert rows(lost) == sorted([("late", 7, at(3)), ("late", 7, at(16))], key=repr)


def test_the_listener_counts_votes_drops_and_lateness(ran):
    _, reported, query, book = ran
    assert book.n_votes == 11
    assert book.dropped == 3
    with_votes = [b for b in book.batches if b.n_votes]
    assert [b.n_votes for b in with_votes] == [3, 2, 3, 3]
    assert [round(b.lateness) for b in with_votes] == [0, 18 * 60, 28 * 60, 45 * 60]
    assert with_votes[2].first == datetime(2024, 3, 1, 12, 2, tzinfo=timezone.utc)


def test_a_log_that_lost_votes_shows(spark, rows):
    votes = spark.createDataFrame([("a", 1, at(0))], VOTE)
    reported = trends.period_counts(spark.createDataFrame([("a", 1, at(0)), ("a", 1, at(1)), ("b", 1, at(1))], VOTE))
    found = reconcile.vote_account(votes, reported, F.lit(at(60)))
    assert rows(found.select("title_id", "n_votes", "n_reported", "n_late")) == [("a", 1, 2, -1), ("b", 0, 1, -1)]
    empty = spark.createDataFrame([], VOTE)
    nothing = reconcile.totals(reconcile.vote_account(empty, trends.period_counts(empty), F.lit(at(0))))
    assert tuple(nothing.first()) == (0, 0, 0, 0)
