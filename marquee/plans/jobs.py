"""The user-level jobs over catalog files, tables and vote streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from marquee.operators import collaboration, credits, details, ranking, ratings, trends
from marquee.schema import LOGGED_VOTES, TOP_TITLES, TRENDING_TITLES
from marquee.sinks.puts import get_row, get_rows, put_rows, read_table
from marquee.sinks.tables import compact, upsert_table
from marquee.sinks.tsv import ratings_rows, write_tsv
from marquee.sources import roles, tables, tsv
from marquee.sources.votes import read_lots
from marquee.streaming import folding, keyed, runner

TITLE_TABLE = "movies"
PERSON_TABLE = "actors"


# Tables


SCHEMAS = {TITLE_TABLE: tables.TITLE_TABLE, PERSON_TABLE: tables.PERSON_TABLE}


def open_tables(spark: SparkSession, folder: str) -> None:
    """Make the tables that lie in a folder known to this session."""
    for name, schema in SCHEMAS.items():
        tables.open_table(spark, name, schema, f"{folder.rstrip('/')}/{name}")


def create_tables(spark: SparkSession, titles: str = TITLE_TABLE, people: str = PERSON_TABLE,
                  folder: str | None = None) -> None:
    for name, schema in ((titles, tables.TITLE_TABLE), (people, tables.PERSON_TABLE)):
        tables.create_table(spark, name, schema, location=folder and f"{folder.rstrip('/')}/{name}")


def drop_tables(spark: SparkSession, titles: str = TITLE_TABLE, people: str = PERSON_TABLE,
                delete: bool = False) -> None:
    for name in (titles, people):
        tables.drop_table(spark, name, delete)


# A load merges its rows into the table, which rewrites it; with ``put`` it writes only its own rows.


def _store(spark: SparkSession, table: str, rows: DataFrame, key: str, put: bool) -> None:
    (put_rows if put else upsert_table)(spark, table, rows, key)


def load_titles(spark: SparkSession, path: str, table: str = TITLE_TABLE, splits: int | None = None,
                put: bool = False) -> None:
    _store(spark, table, details.title_family(tsv.read_titles(spark, path, splits=splits)), "title_id", put)


def load_people(spark: SparkSession, path: str, table: str = PERSON_TABLE, splits: int | None = None,
                put: bool = False) -> None:
    people = details.person_family(roles.people(tsv.read_people(spark, path, splits=splits)))
    _store(spark, table, people, "person_id", put)


def load_summaries(spark: SparkSession, credits_path: str, ratings_path: str, titles: str = TITLE_TABLE,
                   people: str = PERSON_TABLE, splits: int | None = None, put: bool = False) -> None:
    """Number of rated titles and the three best titles of each person, into the person table."""
    names = tables.scan_family(read_table(spark, titles, "title_id"), "title_id", "details")
    best = credits.person_title_best(
        roles.credits(tsv.read_credits(spark, credits_path, splits=splits)),
        names,
        roles.ratings(tsv.read_ratings(spark, ratings_path, splits=splits)),
    )
    _store(spark, people, details.summary_family(credits.title_summary(best)), "person_id", put)


def compact_tables(spark: SparkSession, titles: str = TITLE_TABLE, people: str = PERSON_TABLE, keep: int = 2) -> None:
    """Merge what was put into both tables and delete versions that are older than the last ``keep``."""
    for name, key in ((titles, "title_id"), (people, "person_id")):
        compact(spark, name, key)
        tables.clean_versions(spark, name, keep)


def page(spark: SparkSession, person_id: str, table: str = PERSON_TABLE) -> DataFrame:
    """The page of one person, without a row where the id is unknown."""
    return details.pages_from_table(get_row(spark, table, "person_id", person_id))


def pages(spark: SparkSession, person_ids: list[str], table: str = PERSON_TABLE) -> DataFrame:
    """The pages of a list of people, without rows for unknown ids."""
    return details.pages_from_table(get_rows(spark, table, "person_id", person_ids))


# Batch reports


def top_people(spark: SparkSession, credits_path: str, people_path: str, distinct: bool = True,
               k: int = ranking.TOP_PEOPLE, splits: int | None = None) -> DataFrame:
    count = ranking.titles_per_person if distinct else ranking.credits_per_person
    counts = count(roles.credits(tsv.read_credits(spark, credits_path, splits=splits)))
    return ranking.top_people(counts, roles.people(tsv.read_people(spark, people_path, splits=splits)), k)


def collaborators(spark: SparkSession, credits_path: str, splits: int | None = None) -> DataFrame:
    shared = collaboration.shared_title_counts(roles.credits(tsv.read_credits(spark, credits_path, splits=splits)))
    return collaboration.collaborator_sets(collaboration.collaborator_pairs(shared))


def update_ratings(spark: SparkSession, ratings_path: str, lots_path: str, out: str, fmt: str = "parquet",
                   codec: str | None = None, splits: int | None = None) -> None:
    """Write the ratings file with all logged votes added. ``out`` is not the file it reads.

    Every call adds all lots to the ratings it is given; to add new lots again and again use ``fold_lots``.
    """
    stored = roles.ratings(tsv.read_ratings(spark, ratings_path, splits=splits))
    votes = roles.votes(read_lots(spark, lots_path, fmt), ts=None)
    merged = ratings.merge_ratings(stored, ratings.vote_totals(votes))
    write_tsv(ratings_rows(merged), out, codec)


def fold_lots(spark: SparkSession, lots_path: str, ledger: str, checkpoint: str, fmt: str = "parquet",
              every: str | None = None, max_files: int | None = None) -> StreamingQuery:
    """Add the lots that are new to the ledger of votes; run it as often as wanted."""
    return folding.fold_lots(spark, lots_path, ledger, checkpoint, every, fmt, max_files=max_files)


def write_ratings(spark: SparkSession, ratings_path: str, ledger: str, out: str, codec: str | None = None,
                  splits: int | None = None) -> None:
    """Write the ratings file with the votes of the ledger added, after summing the ledger up."""
    folding.sum_up(spark, ledger)
    stored = roles.ratings(tsv.read_ratings(spark, ratings_path, splits=splits))
    write_tsv(ratings_rows(folding.folded_ratings(spark, stored, ledger)), out, codec)


# Streams. Each takes the votes of any source in ``marquee.sources.votes``.


def log_votes(votes: DataFrame, out: str, checkpoint: str, lot: str = trends.LOT, fmt: str = "parquet",
              files_per_lot: int | None = None, every: str | None = "1 minute") -> StreamingQuery:
    kinds = {f.name: f.dataType for f in LOGGED_VOTES.fields}
    logged = trends.logged_votes(votes, lot)
    typed = logged.withColumns({n: F.col(n).cast(kind) for n, kind in kinds.items()})
    return runner.lots_to_files(typed, out, checkpoint, files_per_lot, fmt, every)


def _typed(rows: DataFrame, schema: StructType) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def top3(votes: DataFrame, titles: DataFrame, out: str, checkpoint: str, delay: str = "1 minute",
         length: str = trends.MEAN_WINDOW, slide: str = trends.MEAN_SLIDE, every: str | None = "1 minute",
         show: bool = False) -> StreamingQuery:
    """The three titles with the best mean of each window, in order of window and rank."""
    means = trends.window_means(votes.withWatermark("ts", delay), length, slide)
    titles = runner.kept(titles, "title_id")

    def report(batch: DataFrame) -> DataFrame:
        return _typed(trends.top_window_titles(trends.from_state(batch), titles), TOP_TITLES)

    return runner.to_batches(means, report, out, checkpoint, every, show, ["window_end", "rank"], [titles])


def top3_by_parts(votes: DataFrame, titles: DataFrame, out: str, checkpoint: str, delay: str = "1 minute",
                  length: str = trends.MEAN_WINDOW, slide: str = trends.MEAN_SLIDE, every: str | None = "1 minute",
                  show: bool = False, parts: int = 16) -> StreamingQuery:
    """The report of ``top3`` for catalogs of very many titles: each part of a window keeps its three best in state.

    A batch then ranks three rows a part and window, not every title.
    """
    means = trends.window_means(votes.withWatermark("ts", delay), length, slide)
    titles = runner.kept(titles, "title_id")
    best = keyed.best_of_parts(means, titles, 3, parts)
    start = F.col("window_end") - F.make_dt_interval(secs=F.lit(trends.seconds(length)))

    def report(batch: DataFrame) -> DataFrame:
        return _typed(trends.ranked_titles(batch.withColumn("window_start", start)), TOP_TITLES)

    return runner.to_batches(best, report, out, checkpoint, every, show, ["window_end", "rank"], [titles])


def trending(votes: DataFrame, titles: DataFrame, out: str, checkpoint: str, delay: str = "1 minute",
             period: str = trends.TREND_PERIOD, every: str | None = "1 minute", show: bool = False,
             by_state: bool = False) -> StreamingQuery:
    """Every title with more votes than in the period before, in order of period and name.

    With ``by_state`` each active title's last period is held, and votes lie in one window, not two.
    """
    rising = (keyed if by_state else trends).rising_titles(votes.withWatermark("ts", delay), period)
    titles = runner.kept(titles, "title_id")

    def report(batch: DataFrame) -> DataFrame:
        return _typed(trends.named_titles(trends.from_state(batch), titles), TRENDING_TITLES)

    return runner.to_batches(rising, report, out, checkpoint, every, show, ["period_end", "original_title", "title_id"],
                             [titles])
