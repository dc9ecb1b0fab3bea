from datetime import datetime, timezone

import pytest

from marquee.operators import trends
from marquee.sources import lines
from marquee.streaming import rescale, runner

START = datetime(2024, 3, 1, 12, 0, tzinfo=timezone.utc)


def line(title, minutes):
    return f"{title}\t5\t{int((START.timestamp() + 60 * minutes) * 1000)}\n"


class Stream:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.said = spark, folder, []
        (folder / "votes").mkdir()

    def add(self, name, *votes):
        self.said += votes
        with open(self.folder / "votes" / name, "a") as file:
            file.write("".join(line(*v) for v in votes))

    def run(self, name, partitions, after=None):
        child = runner.stream_session(self.spark)
        child.conf.set("spark.sql.shuffle.partitions", str(partitions))
        at = lambda what, n=name: str(self.folder / f"{what}-{n}")
        old = after and rescale.last_batch(child, at("checkpoint", after))
        held = after and rescale.held_votes(child, at("checkpoint", after))
        votes = lines.growing_votes(child, str(self.folder / "votes"), at("progress"), start=old and old.places[0])
        counts = rescale.period_counts(votes.withWatermark("ts", "1 minute"), "10 minutes", held, old.closed_until if old else 0)
        runner.drain(runner.to_files(counts, at("out"), at("checkpoint"), every="100 milliseconds"))

    def found(self, *names):
        rows = [r for n in names for r in self.spark.read.parquet(str(self.folder / f"out-{n}")).collect()]
        assert len({(r.title_id, r.period_start) for r in rows}) == len(rows)
        minutes = lambda t: int((t.replace(tzinfo=timezone.utc) - START).total_seconds() / 60)
        return sorted((r.title_id, minutes(r.period_start), r.n_votes) for r in rows)


@pytest.fixture
def stream(spark, tmp_path):
    return Stream(spark, tmp_path)


FIRST = [("a", 0), ("a", 3), ("b", 9), ("a", 11), ("c", 14), ("d", 19), ("d", 20)]
SECOND = [("late", 8), ("a", 12), ("c", 15), ("a", 26), ("e", 31), ("end", 90)]


def partitions_of(folder):
    return len([p for p in folder.glob("state/0/*") if p.name.isdigit()])


def test_counts_across_the_change_equal_one_run(stream, tmp_path):
    stream.add("1.txt", *FIRST)
    stream.run("old", 2)
    assert stream.found("old") == [("a", 0, 2), ("b", 0, 1)]
    stream.add("1.txt", *SECOND[:3])
    stream.add("2.txt", *SECOND[3:])
    stream.run("new", 5, after="old")
    assert stream.found("old", "new") == [("a", 0, 2), ("a", 10, 2), ("a", 20, 1), ("b", 0, 1), ("c", 10, 2), ("d", 10, 1),
                                          ("d", 20, 1), ("e", 30, 1)]
    assert (partitions_of(tmp_path / "checkpoint-old"), partitions_of(tmp_path / "checkpoint-new")) == (2, 5)


def test_state_and_place_are_read_from_the_checkpoint(stream, tmp_path):
    stream.add("1.txt", *FIRST)
    stream.run("old", 2)
    checkpoint = str(tmp_path / "checkpoint-old")
    start = int(START.timestamp())
    assert sorted(tuple(r) for r in rescale.held_votes(stream.spark, checkpoint).collect()) == [
        ("a", start + 600, 1), ("c", start + 600, 1), ("d", start + 600, 1), ("d", start + 1200, 1)]
    last = rescale.last_batch(stream.spark, checkpoint)
    assert last.closed_until == 1000 * (start + 19 * 60)
    assert last.places == [f'{{"1.txt": {(tmp_path / "votes" / "1.txt").stat().st_size}}}']
    with pytest.raises(ValueError):
        rescale.last_batch(stream.spark, str(tmp_path / "nothing"))


def test_counts_equal_those_of_the_engine(spark, stream):
    stream.add("1.txt", *FIRST, *SECOND[1:])
    stream.run("one", 3)
    votes = spark.createDataFrame([(t, 5, datetime.fromtimestamp(START.timestamp() + 60 * m, timezone.utc).replace(tzinfo=None))
                                   for t, m in stream.said], "title_id string, rating long, ts timestamp")
    want = trends.period_counts(votes, "10 minutes").where("title_id <> 'end'").collect()
    assert stream.found("one") == sorted(
        (r.title_id, int((r.period_start.replace(tzinfo=timezone.utc) - START).total_seconds() / 60), r.n_votes) for r in want)


def test_held_counts_come_in_once_and_are_counted_by_the_engine(spark, stream, tmp_path):
    stream.add("1.txt", *FIRST)
    stream.run("old", 2)
    stream.run("new", 3, after="old")
    stream.add("1.txt", *SECOND)
    stream.run("new", 3, after="old")  # goes on from its own checkpoint
    assert ("d", 20, 1) in stream.found("old", "new") and ("c", 10, 2) in stream.found("old", "new")
    votes = lines.growing_votes(runner.stream_session(spark), str(tmp_path / "votes"), str(tmp_path / "progress-plan"))
    plan = rescale.period_counts(votes.withWatermark("ts", "1 minute"), "10 minutes")._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "TransformWithState" not in plan
