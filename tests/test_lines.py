from datetime import datetime, timedelta, timezone

import pytest

from marquee.operators import trends
from marquee.sources import lines
from marquee.streaming import runner

START = datetime(2024, 3, 1, 12, 0, tzinfo=timezone.utc)


def line(title, rating, seconds):
    return f"{title}\t{rating}\t{int((START.timestamp() + seconds) * 1000)}\n"


class Growing:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        (folder / "votes").mkdir()
        self.batches = 0

    def append(self, name, text):
        with open(self.folder / "votes" / name, "a") as file:
            file.write(text)

    def run(self, **bounds):
        child = runner.stream_session(self.spark)
        votes = lines.growing_votes(child, str(self.folder / "votes"), str(self.folder / "progress"), **bounds)
        query = runner.to_files(votes, str(self.folder / "out"), str(self.folder / "checkpoint"), every="100 milliseconds")
        runner.drain(query)
        self.batches = len([p for p in query.recentProgress if p["numInputRows"]])
        return sorted((r.title_id, r.rating) for r in self.spark.read.parquet(str(self.folder / "out")).collect())


@pytest.fixture
def growing(spark, tmp_path):
    return Growing(spark, tmp_path)


def test_every_line_once_over_restarts(growing):
    growing.append("a.txt", line("t1", 5, 0) + line("t2", 6, 1))
    assert growing.run() == [("t1", 5), ("t2", 6)]
    assert growing.run() == [("t1", 5), ("t2", 6)] and growing.batches == 0
    growing.append("a.txt", line("t3", 7, 2))
    growing.append("b.txt", line("t4", 8, 3))
    assert growing.run() == [("t1", 5), ("t2", 6), ("t3", 7), ("t4", 8)]


def test_a_half_written_line_waits(growing):
    whole = line("t1", 5, 0)
    growing.append("a.txt", whole + line("t2", 6, 1)[:-4])
    assert growing.run() == [("t1", 5)]
    growing.append("a.txt", line("t2", 6, 1)[-4:])
    assert growing.run() == [("t1", 5), ("t2", 6)]


def test_lines_that_are_no_votes_are_dropped(growing):
    growing.append("a.txt", "t\n\nt\tx\t1\nt\t1\n" + line("", 3, 0) + line("ok", 4, 0) + "t\t1\tnever\r\n")
    growing.append("_hidden", line("no", 1, 0))
    assert growing.run() == [("", 3), ("ok", 4)]


def test_a_batch_that_ran_without_being_noted_reads_the_same_lines(growing):
    for n in range(5):
        growing.append(f"{n}.txt", line(f"t{n}", n, n))
    first = growing.run()
    commits = growing.folder / "checkpoint" / "commits"
    for crc in commits.glob(".*.crc"):
        crc.unlink()
    sorted(commits.glob("[0-9]*"), key=lambda p: int(p.name))[-1].unlink()
    growing.append("0.txt", line("more", 9, 9))
    assert growing.run() == sorted([*first, ("more", 9)])


def reader(growing, batch, task=1 << 20):
    return lines.GrowingLinesReader({"path": str(growing.folder / "votes"), "progress": str(growing.folder / "progress"),
                                     "batchBytes": str(batch), "taskBytes": str(task)})


def test_batches_and_tasks_are_bounded_and_end_at_line_ends(growing):
    text = {f"{n}.txt": "".join(line(f"title{n}-{k}", k, k) for k in range(40)) for n in range(3)}
    for name, lot in text.items():
        growing.append(name, lot)
    growing.append("long.txt", "x" * 5_000 + "\n" + line("after", 1, 1))
    made, at, source = [], {}, reader(growing, 300, 120)
    for _ in range(200):
        end = source.latestOffset()
        if end == at:
            break
        size = sum(end.values()) - sum(at.values())
        assert size <= 300 or any(n == "long.txt" for n in end if end[n] != at.get(n))
        parts = source.partitions(at, end)
        assert all(p.end - p.start <= 120 or p.path == "long.txt" for p in parts)
        made += [(p.path, v) for p in parts for v, _, _ in source.read(p)]
        at = end
    want = [(n, v) for n, lot in text.items() for v in lot.splitlines()]
    assert sorted(made) == sorted(want + [("long.txt", "x" * 5_000), ("long.txt", line("after", 1, 1).strip())])


def test_a_restarted_reader_is_never_behind_the_place_it_handed_out(growing):
    growing.append("a.txt", "".join(line("t", k, k) for k in range(50)))
    end = reader(growing, 100).latestOffset()
    again = reader(growing, 100)
    assert again.latestOffset()["a.txt"] > end["a.txt"]
    assert reader(growing, 1 << 20).latestOffset()["a.txt"] == (growing.folder / "votes" / "a.txt").stat().st_size
    assert len(list((growing.folder / "progress").glob("place-*"))) <= 2


def test_windows_over_growing_files_go_by_the_lines_own_times(growing, spark, rows):
    votes = [("a", 4, 0), ("b", 5, 100), ("a", 8, 650), ("end", 1, 9000)]
    growing.append("a.txt", "".join(line(*v) for v in votes))
    child = runner.stream_session(spark)
    stream = lines.growing_votes(child, str(growing.folder / "votes"), str(growing.folder / "p2"), 60, 60)
    counts = trends.period_counts(stream.withWatermark("ts", "1 minute"), "10 minutes")
    query = runner.to_files(counts, str(growing.folder / "c-out"), str(growing.folder / "c"), every="100 milliseconds")
    runner.drain(query)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 1
    found = spark.read.parquet(str(growing.folder / "c-out")).select("title_id", "period_start", "n_votes")
    begin = START.replace(tzinfo=None)
    assert rows(found) == [("a", begin, 1), ("a", begin + timedelta(minutes=10), 1), ("b", begin, 1)]
