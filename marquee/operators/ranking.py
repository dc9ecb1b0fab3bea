"""People ranked by how many titles they are credited in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.scalars import ACTING_CATEGORIES
from marquee.operators.credits import acting_credits

TOP_PEOPLE = 10


def titles_per_person(credits: DataFrame, acting: tuple[str, ...] = ACTING_CATEGORIES) -> DataFrame:
    """Distinct titles per person, spread by person and title before the count."""
    return acting_credits(credits, acting).groupBy("person_id").agg(F.countDistinct("title_id").alias("n"))


def credits_per_person(credits: DataFrame, acting: tuple[str, ...] = ACTING_CATEGORIES) -> DataFrame:
    """Credit rows per person, repeats counted."""
    return acting_credits(credits, acting).groupBy("person_id").agg(F.count("*").alias("n"))


def top_people(counts: DataFrame, people: DataFrame, k: int = TOP_PEOPLE) -> DataFrame:
    """The k largest counts with names; ties by id, and a person without a name is kept.

    The k ranked rows are the only side that is broadcast, so the people table is
    filtered to them in one scan, whatever its size.
    """
    top = counts.orderBy(F.desc("n"), "person_id").limit(k)
    order = Window.orderBy(F.desc("n"), "person_id")
    ranked = top.withColumn("rank", F.row_number().over(order))
    names = people.select("person_id", "name").join(
        F.broadcast(top.select("person_id")), "person_id", "left_semi")
    return ranked.join(names, "person_id", "left").select("rank", "person_id", "name", "n")
