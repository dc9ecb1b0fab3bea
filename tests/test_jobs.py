"""The user-level jobs from catalog files to a page, and the command line."""

import hashlib
import os
import subprocess
import sys
import uuid

import pytest

from marquee import __main__ as cli
from marquee.plans import jobs

FILES = {
    "titles": "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\n"
              "t1\tmovie\tOne\tUno €\t0\t2001\t\\N\t90\tDrama,War\n"
              "t2\tmovie\tTwo\tDos\t0\t2002\t\\N\t91\tDrama\n"
              "t3\tmovie\tThree\tTres\t0\t2003\t\\N\t92\t\\N\n"
              "t4\tmovie\tFour\tCuatro\t0\t2004\t\\N\t93\t\\N\n",
    "people": "nconst\tprimaryName\tbirthYear\tdeathYear\tprimaryProfession\tknownForTitles\n"
              "n1\tAda\t1950\t\\N\tactress\tt1\nn2\tBo\t1960\t2010\tactor\tt1\nn3\tCy\t\\N\t\\N\twriter\t\\N\n",
    "credits": "tconst\tordering\tnconst\tcategory\tjob\tcharacters\n"
               "t1\t1\tn1\tactress\t\\N\t[\"A\"]\nt1\t2\tn2\tactor\t\\N\t\\N\nt2\t1\tn1\tactress\t\\N\t\\N\n"
               "t3\t1\tn1\tactress\t\\N\t\\N\nt4\t1\tn1\tactress\t\\N\t\\N\nt2\t2\tn3\twriter\t\\N\t\\N\n"
               "t1\t3\tn1\tactress\t\\N\t\\N\n",
    "ratings": "tconst\taverageRating\tnumVotes\nt1\t7.0\t10\nt2\t9.1\t20\nt3\t7.0\t5\nt4\t6.5\t1\n",
}


def part(person, parts=16):
    return int(hashlib.md5(person.encode()).hexdigest()[:15], 16) % parts


@pytest.fixture
def paths(tmp_path):
    for name, text in FILES.items():
        (tmp_path / f"{name}.tsv").write_text(text, encoding="utf-8")
    return {name: str(tmp_path / f"{name}.tsv") for name in FILES}


def test_pages_through_the_tables(spark, paths):
    titles, people = f"titles_{uuid.uuid4().hex}", f"people_{uuid.uuid4().hex}"
    jobs.create_tables(spark, titles, people)
    jobs.load_titles(spark, paths["titles"], titles)
    jobs.load_people(spark, paths["people"], people)
    for _ in range(2):
        jobs.load_summaries(spark, paths["credits"], paths["ratings"], titles, people)
    pages = {p: [tuple(r) for r in jobs.page(spark, p, people).collect()] for p in ("n1", "n2", "n3", "nobody")}
    assert pages == {
        "n1": [("n1", "Ada", 1950, None, 4, "Dos", "Tres", "Uno €")],
        "n2": [("n2", "Bo", 1960, 2010, 1, "Uno €", None, None)],
        "n3": [("n3", "Cy", None, None, 0, None, None, None)],
        "nobody": [],
    }
    stored = spark.table(titles).where("title_id = 't1'").first()
    assert stored.details.genres == ["Drama", "War"] and stored.details.start_year == 2001
    jobs.drop_tables(spark, titles, people)
    assert not spark.catalog.tableExists(titles) and not spark.catalog.tableExists(people)


def test_rankings_and_collaborators(spark, paths, rows):
    assert rows(jobs.top_people(spark, paths["credits"], paths["people"])) == [
        (1, "n1", "Ada", 4), (2, "n2", "Bo", 1)]
    assert rows(jobs.top_people(spark, paths["credits"], paths["people"], distinct=False, k=1)) == [
        (1, "n1", "Ada", 5)]
    assert rows(jobs.collaborators(spark, paths["credits"])) == [("n1", part("n2"), ["n2"]), ("n2", part("n1"), ["n1"])]


def test_command_line(spark, paths, tmp_path, capsys):
    cli.main(["top-people", paths["credits"], paths["people"]])
    cli.main(["collaborators", paths["credits"], str(tmp_path / "collaborators")])
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "one.txt").write_text("t1\t7\nt2\t9\n" * 25)
    source = ["--folder", str(tmp_path / "lines"), "--once"]
    cli.main(["log", str(tmp_path / "lots"), str(tmp_path / "c1"), *source])
    cli.main(["top3", paths["titles"], str(tmp_path / "top3"), str(tmp_path / "c2"), *source])
    cli.main(["trending", paths["titles"], str(tmp_path / "trending"), str(tmp_path / "c3"), *source])
    cli.main(["update-ratings", paths["ratings"], str(tmp_path / "lots"), str(tmp_path / "new")])
    assert "Ada" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "collaborators")).count() == 2
    assert spark.read.csv(str(tmp_path / "new"), sep="\t", header=True).agg({"numVotes": "sum"}).first()[0] == 86


def test_tables_outlive_a_command(paths, tmp_path):
    """Each command is a process of its own and finds the tables by their folder."""
    folder = tmp_path / "tables"

    def run(*args):
        done = subprocess.run(
            [sys.executable, "-m", "marquee", "--master", "local[2]", "--tables", str(folder), *args],
            capture_output=True, text=True, timeout=300, cwd=tmp_path,
            env=os.environ | {"PYTHONPATH": os.getcwd(), "SPARK_LOCAL_IP": "127.0.0.1"})
        assert done.returncode == 0, done.stderr[-2000:]
        return done.stdout

    run("create-tables")
    run("load-titles", paths["titles"])
    run("load-people", paths["people"])
    run("load-summaries", paths["credits"], paths["ratings"])
    shown = run("page", "n1")
    assert "Ada" in shown and "Dos" in shown
    run("drop-tables")
    assert not any((folder / name).exists() for name in ("movies", "actors"))
