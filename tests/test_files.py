import bz2
import gzip

import pytest

from marquee.schema import RATINGS
from marquee.sinks.tsv import ratings_rows, write_tsv
from marquee.sources import tsv

TITLES = (
    "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\n"
    "t1\tmovie\tA\tPrice 5€ \"now\"\t0\t1999\t\\N\t90\tDrama,War\n"
    "t2\tmovie\tB\tback\\slash \"half\t0\t\\N\t\\N\t\\N\t\\N\n"
    "t3\tshort\tC\tShort row\n"
)
RATED = "tconst\taverageRating\tnumVotes\nt1\t7.5\t10\nt2\t0.0\t3\n"


def test_titles_keep_quotes_and_read_nulls(spark, tmp_path, rows):
    path = tmp_path / "titles.tsv"
    path.write_text(TITLES, encoding="utf-8")
    df = tsv.read_titles(spark, str(path))
    assert rows(df, "tconst", "originalTitle", "startYear", "genres") == [
        ("t1", 'Price 5€ "now"', 1999, "Drama,War"),
        ("t2", 'back\\slash "half', None, None),
        ("t3", "Short row", None, None),
    ]


def test_raw_columns_stay_text(spark, tmp_path):
    path = tmp_path / "titles.tsv"
    path.write_text(TITLES, encoding="utf-8")
    df = tsv.read_titles(spark, str(path), raw=True)
    assert {kind for _, kind in df.dtypes} == {"string"}
    assert df.where("tconst = 't1'").first().startYear == "1999"


def test_codecs_and_repeated_headers_read_equal(spark, tmp_path, rows):
    text = RATED + RATED.replace("t1", "t3").replace("t2", "t4")
    (tmp_path / "r.tsv").write_text(text)
    (tmp_path / "r.tsv.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "r.tsv.bz2").write_bytes(bz2.compress(text.encode()))
    want = [("t1", 7.5, 10), ("t2", 0.0, 3), ("t3", 7.5, 10), ("t4", 0.0, 3)]
    for name in ("r.tsv", "r.tsv.gz", "r.tsv.bz2"):
        assert rows(tsv.read_ratings(spark, str(tmp_path / name))) == want
    spread = tsv.read_ratings(spark, str(tmp_path / "r.tsv.gz"), splits=3)
    assert spread.rdd.getNumPartitions() == 3 and rows(spread) == want


def test_only_needed_columns_are_read(spark, tmp_path):
    path = tmp_path / "titles.tsv"
    path.write_text(TITLES, encoding="utf-8")
    plan = tsv.read_titles(spark, str(path)).select("originalTitle")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<tconst:string,originalTitle:string>" in plan


@pytest.mark.parametrize("codec,suffix", [(None, ".csv"), ("gzip", ".csv.gz"), ("bzip2", ".csv.bz2")])
def test_written_file_has_header_and_overwrites(spark, tmp_path, codec, suffix):
    out = str(tmp_path / "out")
    merged = spark.createDataFrame([("t1", 7.25, 4), ("t2", None, 0)], "title_id string, mean double, votes long")
    for _ in range(2):
        write_tsv(ratings_rows(merged), out, codec, files=1)
    files = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    assert len(files) == 1 and files[0].name.endswith(suffix)
    opener = {None: open, "gzip": gzip.open, "bzip2": bz2.open}[codec]
    with opener(files[0], "rt") as lines:
        assert lines.read() == "tconst\taverageRating\tnumVotes\nt1\t7.3\t4\nt2\t\\N\t0\n"
    back = tsv.read_tsv(spark, out, RATINGS)
    assert sorted(map(tuple, back.collect())) == [("t1", 7.3, 4), ("t2", None, 0)]
