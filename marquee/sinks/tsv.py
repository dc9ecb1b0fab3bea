"""Tab-separated output in the dialect of the input files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import number_text, one_decimal_text


def write_tsv(df: DataFrame, path: str, codec: str | None = None, files: int | None = None) -> None:
    """Write with a header line, replacing what is there.

    Every task writes its own file; with ``files`` the rows are dealt to that many.
    """
    out = df.repartition(files) if files else df
    writer = out.write.mode("overwrite").options(
        sep="\t", header="true", quote="", escape="", nullValue="\\N", emptyValue="", encoding="UTF-8",
    )
    if codec:
        writer = writer.option("compression", codec)
    writer.csv(path)


def ratings_rows(merged: DataFrame) -> DataFrame:
    """Merged ratings as the three text columns of the ratings file."""
    return merged.select(
        number_text(F.col("title_id")).alias("tconst"),
        one_decimal_text(F.col("mean")).alias("averageRating"),
        number_text(F.col("votes")).alias("numVotes"),
    )
