from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marquee.operators import trends
from marquee.plans import jobs
from marquee.sources.votes import parquet_stream
from marquee.streaming import keyed, runner

START = datetime(2024, 3, 1, 12, 0)
VOTE = "title_id string, rating long, ts timestamp"


def at(minutes, seconds=0):
    return START + timedelta(minutes=minutes, seconds=seconds)


def votes(spark, *rows):
    return spark.createDataFrame(list(rows), VOTE)


class Votes:
    """A folder of votes, one file and so one micro-batch per list, that a stream can come back to."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.all = spark, folder, []

    def add(self, *batches):
        for batch in batches:
            votes(self.spark, *batch).coalesce(1).write.mode("append").parquet(str(self.folder / "votes"))
            self.all += batch

    def run(self, transform, **conf):
        child = runner.stream_session(self.spark)
        for key, value in conf.items():
            child.conf.set(key.replace("__", "."), value)
        schema = self.spark.createDataFrame([], VOTE).schema
        stream = parquet_stream(child, str(self.folder / "votes"), schema, max_files=1).withWatermark("ts", "1 minute")
        out, checkpoint = str(self.folder / "out"), str(self.folder / "checkpoint")
        query = runner.to_files(transform(stream), out, checkpoint)
        runner.finish(query)
        return self.spark.read.parquet(out), query

    def table(self):
        return votes(self.spark, *self.all)


@pytest.fixture
def source(spark, tmp_path):
    return Votes(spark, tmp_path)


def many(title, period, n):
    return [(title, 5, at(15 * period, k)) for k in range(n)]


BATCHES = [
    many("up", 0, 2) + many("same", 0, 3) + many("gap", 0, 3),
    many("up", 1, 3) + many("same", 1, 3),
    many("gap", 2, 1) + many("same", 2, 3) + many("late", 2, 2),
    many("same", 4, 1),
    # Several periods end in one batch.
    many("gap", 5, 1) + many("gap", 6, 2) + many("up", 6, 1) + many("gap", 7, 1),
    [("end", 1, at(600))],
]
NAMES = ("title_id", "period_start", "period_end", "n_votes", "previous_votes")


def test_rising_titles_by_state_equal_the_table(source, rows):
    source.add(*BATCHES)
    got, _ = source.run(keyed.rising_titles)
    want = trends.rising_titles(source.table()).where(F.col("period_end") <= at(599))
    assert rows(got, *NAMES) == rows(want, *NAMES) and want.count() > 5


def test_a_restart_goes_on_with_the_last_period(source, rows):
    source.add(*BATCHES[:2])
    source.run(keyed.rising_titles)
    source.add(*BATCHES[2:])
    source.run(keyed.rising_titles)
    got, _ = source.run(keyed.rising_titles)  # nothing new
    want = trends.rising_titles(source.table()).where(F.col("period_end") <= at(599))
    assert rows(got, *NAMES) == rows(want, *NAMES)


def held(source, operator, name, variable="value"):
    reader = source.spark.read.format("statestore").option("operatorId", operator).option("stateVarName", name)
    return reader.load(str(source.folder / "checkpoint"))


def test_a_silent_period_clears_a_title(source):
    source.add(many("a", 0, 2) + many("b", 0, 1), many("a", 1, 1), [("c", 1, at(31, 1))])
    source.run(keyed.rising_titles)
    # Period 0 and 1 are over; b was silent in period 1 and is not held any longer.
    assert {(r.key.title_id, r.value.n_votes) for r in held(source, 0, "last").collect()} == {("a", 1)}


def test_state_follows_active_titles_and_not_all_that_ever_were(source):
    source.add(*[many(f"t{period}-{n}", period, 1) for period in range(12) for n in [0]],
               *[[(f"u{period}-{n}", 5, at(15 * period)) for n in range(20)] for period in range(12, 18)])
    got, _ = source.run(keyed.rising_titles)
    assert got.select("title_id").distinct().count() > 80
    assert held(source, 0, "last").count() <= 2 * 20


def test_best_of_parts_give_the_report_and_hold_little(spark, source, rows):
    titles = spark.createDataFrame([(f"t{n:02}", f"Title {n}") for n in range(40)], "title_id string, original_title string")
    source.add([(f"t{n:02}", (n * 7) % 5, at(n % 3)) for n in range(45)], [(f"t{n:02}", 4, at(20)) for n in range(9)],
               [("end", 1, at(90))])
    got, query = source.run(lambda v: keyed.best_of_parts(trends.window_means(v), titles, 3, 4),
                            spark__sql__streaming__stateStore__rocksdb__trackTotalNumberOfRows="true")
    means = trends.window_means(source.table()).where(F.col("window_end") <= at(89))
    want = trends.top_window_titles(means, titles)
    columns = ("window_end", "rank", "title_id", "original_title", "mean_vote")
    assert rows(trends.ranked_titles(got), *columns) == rows(want, *columns) and want.count() > 30
    assert got.groupBy("window_end").count().agg(F.max("count")).first()[0] <= 3 * 4
    # Windows that were handed over leave nothing behind.
    assert held(source, 0, "best").count() == 0


def test_top3_by_parts_writes_the_same_report(spark, source, tmp_path, rows):
    source.add(many("up", 0, 2) + many("same", 0, 3), [("end", 1, at(200))])
    titles = [(t, t.upper()) for t in ("up", "same", "gap")]
    found = []
    for job in (jobs.top3, jobs.top3_by_parts):
        child = runner.stream_session(spark)
        stream = parquet_stream(child, str(tmp_path / "votes"), spark.createDataFrame([], VOTE).schema, max_files=1)
        names = child.createDataFrame(titles, "title_id string, original_title string")
        out = str(tmp_path / job.__name__)
        runner.finish(job(stream, names, out, out + "-c", every=None))
        found.append(rows(spark.read.parquet(out).drop("batch")))
    assert found[0] == found[1] and found[0]


@pytest.mark.parametrize("job", [jobs.top3, jobs.top3_by_parts, jobs.trending])
def test_what_state_hands_over_is_never_broadcast(spark, source, tmp_path, monkeypatch, job):
    source.add(many("up", 0, 2) + many("same", 0, 3), [("end", 1, at(200))])
    child = runner.stream_session(spark)
    stream = parquet_stream(child, str(tmp_path / "votes"), spark.createDataFrame([], VOTE).schema, max_files=1)
    names = child.createDataFrame([(t, t.upper()) for t in ("up", "same")], "title_id string, original_title string")
    plans = []

    def planned(stream, transform, *args):
        def kept(batch):
            found = transform(batch)
            plans.append(str(found._jdf.queryExecution().executedPlan()))
            return found

        plans.append(lambda q: str(q._jsq.streamingQuery().lastExecution().executedPlan()))
        return to_batches(stream, kept, *args)

    to_batches = runner.to_batches
    monkeypatch.setattr(runner, "to_batches", planned)
    out = str(tmp_path / "out")
    query = job(stream, names, out, out + "-c", every=None)
    runner.finish(query)
    found = [p(query) if callable(p) else p for p in plans]
    assert any("SortMergeJoin" in p for p in found) and not any("BroadcastHashJoin" in p for p in found)
    assert spark.read.parquet(out).count() > 0


def test_trending_job_by_state(spark, source, tmp_path, rows):
    source.add(*BATCHES)
    child = runner.stream_session(spark)
    stream = parquet_stream(child, str(tmp_path / "votes"), spark.createDataFrame([], VOTE).schema, max_files=1)
    titles = child.createDataFrame([("gap", "Gap"), ("up", "Up")], "title_id string, original_title string")
    runner.finish(jobs.trending(stream, titles, str(tmp_path / "o"), str(tmp_path / "c"), every=None, by_state=True))
    found = spark.read.parquet(str(tmp_path / "o"))
    want = trends.named_titles(trends.rising_titles(source.table()).where(F.col("period_end") <= at(599)), titles)
    assert rows(found, *want.columns) == rows(want) and want.count() > 3


class Values:
    """State and timers of one key, as a processor sees them."""

    def __init__(self, watermark=0):
        self.rows, self.timers, self.watermark = [], set(), watermark

    def getListState(self, name, columns):
        return self

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = rows

    def clear(self):
        self.rows = []

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def getCurrentWatermarkInMs(self):
        return self.watermark


def test_a_part_holds_k_rows_until_its_window_is_closed():
    from pyspark.sql import Row

    part, state = keyed.BestOfPart(2, ""), Values()
    part.init(state)
    row = lambda n, mean: Row(mean_vote=mean, title_id=n, original_title=f"T{n}")
    for some in ([row(n, float(n % 5)) for n in range(20)], [row(99, 4.0), row(1, 9.0)]):
        assert list(part.handleInputRows((60, 0), iter(some), state)) == []
        assert len(state.rows) == 2 and state.timers == {60_000}
    assert [r.title_id for r in part.handleExpiredTimer((60, 0), state, None)] == [1, 4] and not state.rows
    state.watermark = 60_000
    assert [r.title_id for r in part.handleInputRows((60, 0), iter([row(5, 1.0), row(3, 2.0), row(2, 0.0)]), state)] == [3, 5]
    assert not state.rows
