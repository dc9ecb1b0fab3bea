"""Declared schemas of the catalog files and the vote log. Nothing is inferred."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


TITLES = _struct(
    tconst=StringType(),
    titleType=StringType(),
    primaryTitle=StringType(),
    originalTitle=StringType(),
    isAdult=IntegerType(),
    startYear=IntegerType(),
    endYear=IntegerType(),
    runtimeMinutes=IntegerType(),
    genres=StringType(),
)

PEOPLE = _struct(
    nconst=StringType(),
    primaryName=StringType(),
    birthYear=IntegerType(),
    deathYear=IntegerType(),
    primaryProfession=StringType(),
    knownForTitles=StringType(),
)

CREDITS = _struct(
    tconst=StringType(),
    ordering=IntegerType(),
    nconst=StringType(),
    category=StringType(),
    job=StringType(),
    characters=StringType(),
)

RATINGS = _struct(
    tconst=StringType(),
    averageRating=DoubleType(),
    numVotes=IntegerType(),
)

VOTES = _struct(title_id=StringType(), rating=IntegerType(), ts=TimestampType())

TOP_TITLES = _struct(
    window_start=TimestampType(),
    window_end=TimestampType(),
    rank=IntegerType(),
    title_id=StringType(),
    original_title=StringType(),
    mean_vote=DoubleType(),
)

TRENDING_TITLES = _struct(
    period_start=TimestampType(),
    period_end=TimestampType(),
    title_id=StringType(),
    n_votes=LongType(),
    previous_votes=LongType(),
    original_title=StringType(),
)

LOGGED_VOTES = _struct(title_id=StringType(), rating=IntegerType(), minute=StringType())


def as_text(schema: StructType) -> StructType:
    """The same columns, every one kept as the text in the file."""
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])
