"""Give any table the column names the operators work on.

Every operator takes DataFrames in one of these roles. The source columns are
parameters here, so the operators themselves need none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def credits(df: DataFrame, title: ColumnLike = "tconst", person: ColumnLike = "nconst",
            category: ColumnLike = "category") -> DataFrame:
    return df.select(_col(title).alias("title_id"), _col(person).alias("person_id"),
                     _col(category).alias("category"))


def titles(df: DataFrame, title: ColumnLike = "tconst", name: ColumnLike = "originalTitle",
           **extra: ColumnLike) -> DataFrame:
    return df.select(_col(title).alias("title_id"), _col(name).alias("original_title"),
                     *[_col(c).alias(out) for out, c in extra.items()])


def people(df: DataFrame, person: ColumnLike = "nconst", name: ColumnLike = "primaryName",
           birth: ColumnLike = "birthYear", death: ColumnLike = "deathYear") -> DataFrame:
    return df.select(_col(person).alias("person_id"), _col(name).alias("name"),
                     _col(birth).alias("birth"), _col(death).alias("death"))


def ratings(df: DataFrame, title: ColumnLike = "tconst", mean: ColumnLike = "averageRating",
            votes: ColumnLike = "numVotes") -> DataFrame:
    return df.select(_col(title).alias("title_id"), _col(mean).alias("mean"),
                     _col(votes).cast("bigint").alias("votes"))


def votes(df: DataFrame, title: ColumnLike = "title_id", rating: ColumnLike = "rating",
          ts: ColumnLike | None = "ts") -> DataFrame:
    columns = [_col(title).alias("title_id"), _col(rating).cast("bigint").alias("rating")]
    if ts is not None:
        columns.append(_col(ts).alias("ts"))
    return df.select(*columns)
