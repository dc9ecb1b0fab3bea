"""Title and person details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import text_or_dashes


def numbered_genres(titles: DataFrame) -> DataFrame:
    """One row per title and genre, genres numbered from 1; a title without genres keeps one row."""
    return titles.select(
        "title_id", "original_title", F.posexplode_outer("genres").alias("_at", "genre"),
    ).select("title_id", "original_title", (F.col("_at") + 1).alias("genre_no"), "genre")


def title_family(titles: DataFrame) -> DataFrame:
    """Rows of the title file in the shape of the title table."""
    return titles.select(
        F.col("tconst").alias("title_id"),
        F.struct(
            F.col("titleType").alias("title_type"),
            F.col("primaryTitle").alias("primary_title"),
            F.col("originalTitle").alias("original_title"),
            F.col("isAdult").alias("is_adult"),
            F.col("startYear").alias("start_year"),
            F.col("endYear").alias("end_year"),
            F.col("runtimeMinutes").alias("runtime_minutes"),
            F.split("genres", ",").alias("genres"),
        ).alias("details"),
    )


def person_family(people: DataFrame) -> DataFrame:
    """People in the shape of the details family of the person table."""
    return people.select("person_id", F.struct("name", "birth", "death").alias("details"))


def summary_family(summary: DataFrame) -> DataFrame:
    """Title summaries in the shape of the movies family of the person table."""
    top3 = F.filter(F.array("top1", "top2", "top3"), lambda name: name.isNotNull())
    return summary.select(
        "person_id",
        F.struct(F.col("total").cast("int").alias("total"), top3.alias("top3")).alias("movies"),
    )


def pages_from_table(table: DataFrame) -> DataFrame:
    """The stored person table as flat pages."""
    def ranked(n):
        return F.get(F.col("movies.top3"), F.lit(n - 1)).alias(f"top{n}")
    return table.select(
        "person_id", F.col("details.name").alias("name"), F.col("details.birth").alias("birth"),
        F.col("details.death").alias("death"),
        F.coalesce(F.col("movies.total"), F.lit(0)).cast("bigint").alias("total"),
        ranked(1), ranked(2), ranked(3),
    )


def shown_person(people: DataFrame) -> DataFrame:
    """Name, birth and death as a page shows them."""
    return people.withColumn("death", text_or_dashes(F.col("death")))


# The labels of a page.
LABELS = ("Name: ", "Birth: ", "Death: ", "Number of movies: ")


def page_lines(pages: DataFrame) -> DataFrame:
    """Pages as the lines that are shown; a ranked title that is missing has no line."""
    def ranked(n):
        return F.when(F.col(f"top{n}").isNotNull(), F.concat(F.lit(f"#{n} => "), F.col(f"top{n}")))
    name, birth, death, total = map(F.lit, LABELS)
    lines = F.array(
        F.concat(name, F.coalesce("name", F.lit(""))),
        F.concat(birth, text_or_dashes(F.col("birth"))),
        F.concat(death, text_or_dashes(F.col("death"))),
        F.concat(total, F.col("total").cast("string")),
        ranked(1), ranked(2), ranked(3),
    )
    shown = F.filter(lines, lambda line: line.isNotNull())
    return pages.select("person_id", F.posexplode(shown).alias("line_no", "line"))
