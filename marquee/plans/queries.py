"""Every operator bound to the benchmark tables, as ``(session, folder) -> DataFrame``.

Each query reads whole tables. Streams run until their input is used up and the
rows they wrote are returned.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.functions import millis_time, minute_text, tab_line, utc_time
from marquee.operators import collaboration, credits, details, intervals, ranking, ratings, reconcile, running, sliding, stored, trends
from marquee.plans import bindings as b
from marquee.plans import jobs
from marquee.schema import RATINGS, TOP_TITLES
from marquee.session import new_folder
from marquee.sinks.puts import get_rows, put_rows, read_table
from marquee.sinks.tables import compact, upsert_table
from marquee.sinks.tsv import ratings_rows, write_tsv
from marquee.sources import roles, tables
from marquee.sources.lines import growing_votes
from marquee.sources.tsv import read_credits, read_people, read_ratings, read_titles, read_tsv
from marquee.sources.votes import parquet_stream, read_lots
from marquee.streaming import account, folding, keyed, rescale, runner

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _fresh_table(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    """Times as UTC shows them."""
    return df.withColumns({n: utc_time(F.col(n)) for n in names})


# Catalog and pages


@_query
def acting_credits(spark, folder):
    return credits.acting_credits(b.order_credits(spark, folder), b.ACTING)


@_query
def title_details(spark, folder):
    return details.numbered_genres(b.titles(spark, folder))


@_query
def person_details(spark, folder):
    return details.shown_person(b.people(spark, folder))


@_query
def credited_rated_titles(spark, folder):
    return credits.credited_rated_titles(
        b.part_credits(spark, folder), b.titles(spark, folder), b.part_ratings(spark, folder), b.ACTING)


@_query
def stored_rated_titles(spark, folder):
    """The same credits from tables that were stored in buckets of titles, joined without a shuffle."""
    catalog = stored.store_catalog(spark, _fresh_table("catalog"), b.part_credits(spark, folder),
                                   b.titles(spark, folder).select("title_id", "original_title"), b.part_ratings(spark, folder))
    return stored.stored_rated_titles(spark, catalog, b.ACTING)


def _best(spark, folder):
    return credits.person_title_best(
        b.part_credits(spark, folder), b.titles(spark, folder), b.part_ratings(spark, folder), b.ACTING)


def _pages(spark, folder):
    return credits.person_pages(b.people(spark, folder), credits.title_summary(_best(spark, folder)))


@_query
def person_title_best(spark, folder):
    return _best(spark, folder)


@_query
def person_top3_titles(spark, folder):
    return credits.top_titles(_best(spark, folder))


@_query
def person_title_total(spark, folder):
    return credits.title_totals(_best(spark, folder))


@_query
def person_pages(spark, folder):
    return _pages(spark, folder)


@_query
def person_page_lines(spark, folder):
    """Every page as the lines that are shown."""
    return details.page_lines(_pages(spark, folder))


@_query
def person_page_lookup(spark, folder):
    """All pages are stored in a table; one is then read back by its key, which is the feature."""
    pages = _pages(spark, folder)
    name = _fresh_table("page_table")
    tables.create_table(spark, name, pages.schema)
    upsert_table(spark, name, pages, "person_id")
    found = details.page_lines(tables.lookup(spark.table(name), "person_id", 7))
    tables.drop_table(spark, name)
    return found


# Ranking and collaboration


@_query
def top10_people_by_titles(spark, folder):
    counts = ranking.titles_per_person(b.order_credits(spark, folder), b.ACTING)
    return ranking.top_people(counts, b.people(spark, folder))


@_query
def top10_people_by_credits(spark, folder):
    counts = ranking.credits_per_person(b.order_credits(spark, folder), b.ACTING)
    return ranking.top_people(counts, b.people(spark, folder))


def _shared(spark, folder):
    return collaboration.shared_title_counts(b.order_credits(spark, folder), b.ACTING)


@_query
def collaborator_pairs(spark, folder):
    return collaboration.collaborator_pairs(_shared(spark, folder))


@_query
def collaborator_sets(spark, folder):
    sets = collaboration.collaborator_sets(collaboration.collaborator_pairs(_shared(spark, folder)))
    return sets.withColumn("others", F.array_join(F.col("others").cast("array<string>"), ","))


@_query
def collaborator_strength(spark, folder):
    return collaboration.collaborator_strength(_shared(spark, folder))


# Ratings


@_query
def new_vote_totals(spark, folder):
    return ratings.vote_totals(b.new_votes(spark, folder))


def _merged(spark, folder):
    return ratings.merge_ratings(
        b.stored_ratings(spark, folder), ratings.vote_totals(b.new_votes(spark, folder)))


@_query
def ratings_merge(spark, folder):
    return _merged(spark, folder)


@_query
def ratings_merge_tsv(spark, folder):
    """The merged file is written and read back as text, with each line as it was written."""
    path = new_folder(spark, "ratings")
    write_tsv(ratings_rows(_merged(spark, folder)), path)
    rows = read_ratings(spark, path, raw=True)
    return rows.withColumn("line", tab_line("tconst", "averageRating", "numVotes"))


# Streams


@_query
def vote_minutes(spark, folder):
    return b.event_votes(spark, folder).select("title_id", "rating", minute_text(F.col("ts")).alias("minute"))


@_query
def vote_log_lines(spark, folder):
    """Votes as the lines of the log, from arrival times in milliseconds."""
    votes = b.event_votes(spark, folder).withColumn("millis", F.unix_millis("ts"))
    line = tab_line(F.col("title_id"), F.col("rating"), minute_text(millis_time(F.col("millis"))))
    return votes.select("millis", line.alias("line"))


_LOGGED = "title_id BIGINT, rating BIGINT, minute STRING"


def _write_lots(spark, folder):
    path = new_folder(spark, "lots")
    child = runner.stream_session(spark)
    logged = trends.logged_votes(b.event_vote_stream(child, folder), b.LOT)
    runner.finish(runner.lots_to_files(logged, path, new_folder(spark, "checkpoint")))
    return path


def _read_lots(spark, path):
    return read_lots(spark, path, schema=StructType.fromDDL(_LOGGED))


@_query
def vote_lots(spark, folder):
    """Votes and their sum in each lot that the stream wrote."""
    lots = _read_lots(spark, _write_lots(spark, folder))
    return lots.groupBy("lot").agg(F.count("*").alias("n_votes"), F.sum("rating").alias("vote_sum"))


@_query
def lots_union(spark, folder):
    """Every vote of every lot."""
    return _read_lots(spark, _write_lots(spark, folder))


@_query
def ratings_folded(spark, folder):
    """Lots folded into the stored ratings a few files at a time, the ledger summed up on the way."""
    lots, ledger = _write_lots(spark, folder), new_folder(spark, "ledger")
    checkpoint = new_folder(spark, "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        runner.finish(folding.fold_lots(spark, lots, ledger, checkpoint, schema=StructType.fromDDL(_LOGGED), max_files=20))
        folding.sum_up(spark, ledger, StructType.fromDDL(_LOGGED))
    return folding.folded_ratings(spark, b.stored_ratings(spark, folder), ledger)


def _run(spark, folder, transform):
    """Run a windowed transform over the vote stream and return the rows of the finished windows."""
    path = new_folder(spark, "windows")
    child = runner.stream_session(spark)
    votes = b.event_vote_stream(child, folder).withWatermark("ts", b.DELAY)
    rows = transform(child, votes)
    runner.finish(runner.to_files(rows, path, new_folder(spark, "checkpoint")))
    return spark.read.schema(rows.schema).parquet(path)


@_query
def window_vote_means(spark, folder):
    rows = _run(spark, folder, lambda s, votes: trends.window_means(votes, b.MEAN_WINDOW, b.MEAN_SLIDE))
    return _ntz(rows, "window_start", "window_end")


@_query
def window_vote_means_batch(spark, folder):
    """Every window of every vote, from the table."""
    means = trends.window_means(b.event_votes(spark, folder), b.MEAN_WINDOW, b.MEAN_SLIDE)
    return _ntz(means, "window_start", "window_end")


@_query
def window_vote_means_by_change(spark, folder):
    """The same windows from panes that are added and subtracted."""
    means = sliding.window_means(b.event_votes(spark, folder), b.MEAN_WINDOW, b.MEAN_SLIDE)
    return _ntz(means, "window_start", "window_end")


@_query
def window_vote_runs(spark, folder):
    """Runs of windows in which the votes of a title stay the same."""
    runs = sliding.window_runs(b.event_votes(spark, folder), b.MEAN_WINDOW, b.MEAN_SLIDE)
    return _ntz(runs, "first_start", "last_start")


@_query
def top3_window_titles(spark, folder):
    """The three best titles of each finished window, by the job's own path."""
    path = new_folder(spark, "top3")
    child = runner.stream_session(spark)
    query = jobs.top3(b.event_vote_stream(child, folder), b.stream_titles(child, folder), path,
                      new_folder(spark, "checkpoint"), b.DELAY, b.MEAN_WINDOW, b.MEAN_SLIDE, every=None)
    runner.finish(query)
    rows = spark.read.schema(TOP_TITLES).parquet(path).select(*TOP_TITLES.names)
    return _ntz(rows.withColumn("title_id", F.col("title_id").cast("bigint")), "window_start", "window_end")


@_query
def top3_window_titles_by_parts(spark, folder):
    """The same report, from the three best of each part of a window that state holds."""
    path = new_folder(spark, "top3")
    child = runner.stream_session(spark)
    query = jobs.top3_by_parts(b.event_vote_stream(child, folder), b.stream_titles(child, folder), path,
                               new_folder(spark, "checkpoint"), b.DELAY, b.MEAN_WINDOW, b.MEAN_SLIDE, every=None, parts=4)
    runner.finish(query)
    rows = spark.read.schema(TOP_TITLES).parquet(path).select(*TOP_TITLES.names)
    return _ntz(rows.withColumn("title_id", F.col("title_id").cast("bigint")), "window_start", "window_end")


@_query
def top3_window_titles_batch(spark, folder):
    means = trends.window_means(b.event_votes(spark, folder), b.MEAN_WINDOW, b.MEAN_SLIDE)
    return _ntz(trends.top_window_titles(means, b.stream_titles(spark, folder)), "window_start", "window_end")


@_query
def period_vote_counts(spark, folder):
    rows = _run(spark, folder, lambda s, votes: trends.period_counts(votes, b.PERIOD))
    return _ntz(rows, "period_start", "period_end")


@_query
def trending_titles(spark, folder):
    def trending(child, votes):
        return trends.named_titles(trends.rising_titles(votes, b.PERIOD), b.stream_titles(child, folder))

    return _ntz(_run(spark, folder, trending), "period_start", "period_end")


@_query
def trending_titles_by_state(spark, folder):
    """The same titles, from the last period that state holds of each active title."""
    def trending(child, votes):
        return trends.named_titles(keyed.rising_titles(votes, b.PERIOD), b.stream_titles(child, folder))

    return _ntz(_run(spark, folder, trending), "period_start", "period_end")


@_query
def vote_line_stream(spark, folder):
    """Votes written as lines with their times, then read as a stream in bounded batches that is stopped and goes on."""
    written, progress = new_folder(spark, "lines"), new_folder(spark, "progress")
    votes = b.event_votes(spark, folder)
    line = tab_line(F.col("title_id"), F.col("rating"), F.unix_millis("ts"))
    path, checkpoint = new_folder(spark, "line-votes"), new_folder(spark, "checkpoint")
    child = runner.stream_session(spark)
    for half in range(2):  # the second start finds the files of the second half
        votes.where(F.pmod("title_id", F.lit(2)) == half).select(line.alias("value")).write.mode("append").text(written)
        stream = growing_votes(child, written, progress, 64 << 20)
        runner.drain(runner.to_files(stream, path, checkpoint, every="100 milliseconds"))
    read = spark.read.schema(stream.schema).parquet(path)
    return _ntz(read.select(F.col("title_id").cast("bigint").alias("title_id"), "rating", "ts"), "ts")


@_query
def rescaled_vote_counts(spark, folder):
    """Votes per period of a stream that is stopped half way and goes on with three times the state partitions."""
    written = new_folder(spark, "lines")
    votes = b.event_votes(spark, folder)
    middle = F.lit("2024-01-15 07:00:00").cast("timestamp")
    line = tab_line(F.col("title_id"), F.col("rating"), F.unix_millis("ts"))
    held, place, paths = None, None, []
    for half, partitions in ((F.col("ts") < middle, 2), (F.col("ts") >= middle, 6)):
        votes.where(half).select(line.alias("value")).write.mode("append").text(written)
        child = runner.stream_session(spark)
        child.conf.set("spark.sql.shuffle.partitions", str(partitions))
        stream = growing_votes(child, written, new_folder(spark, "progress"), start=place and place.places[0])
        counts = rescale.period_counts(stream.withWatermark("ts", "40 days" if place is None else b.DELAY), b.PERIOD, held,
                                       place.closed_until if place else 0)
        checkpoint, path = new_folder(spark, "checkpoint"), new_folder(spark, "counts")
        runner.drain(runner.to_files(counts, path, checkpoint, every="100 milliseconds"))
        held, place = rescale.held_votes(child, checkpoint), rescale.last_batch(spark, checkpoint)
        paths.append(path)
    rows = spark.read.schema(counts.schema).parquet(*paths)
    return _ntz(rows.withColumn("title_id", F.col("title_id").cast("bigint")), "period_start", "period_end")


@_query
def late_votes(spark, folder):
    """Votes that come in four batches, each from all times: what of every period was reported, late or open."""
    source, path = new_folder(spark, "votes"), new_folder(spark, "counts")
    events = b.table(spark, folder, "events")
    for part in range(4):  # one file, so one batch, after the other
        events.where(F.col("event_id") % 4 == part).coalesce(1).write.mode("append").parquet(source)
    child = runner.stream_session(spark)
    votes = b.as_votes(parquet_stream(child, source, events.schema, max_files=1)).withWatermark("ts", b.DELAY)
    counts = trends.period_counts(account.observed(votes), b.PERIOD)
    query = runner.to_files(counts, path, new_folder(spark, "checkpoint"))
    runner.finish(query)
    closed = F.lit(account.last_watermark(query)).cast("timestamp")
    reported = spark.read.schema(counts.schema).parquet(path)
    found = reconcile.vote_account(b.event_votes(spark, folder), reported, closed, b.PERIOD)
    return _ntz(found, "period_start", "period_end")


@_query
def trending_batch(spark, folder):
    counts = trends.period_counts(b.event_votes(spark, folder), b.PERIOD)
    rising = trends.named_titles(trends.rising_titles_by_lag(counts), b.stream_titles(spark, folder))
    return _ntz(rising, "period_start", "period_end")


# Running votes


@_query
def running_votes(spark, folder):
    return running.running_total(b.part_ratings(spark, folder), ["title_id"], "votes", "running_votes").select(
        "title_id", "votes", "running_votes")


@_query
def vote_holders(spark, folder):
    """The title that holds each numbered vote, titles laid end to end by id."""
    found = intervals.holders(b.vote_numbers(spark, folder), b.part_ratings(spark, folder), "title_id", "votes")
    return found.select("event_id", "point", "title_id")


# Tables and files


@_query
def table_upsert(spark, folder):
    """People loaded into the person table, then their title summaries on the same keys."""
    name = _fresh_table("person_table")
    schema = tables.PERSON_TABLE
    tables.create_table(spark, name, schema)
    people = details.person_family(b.people(spark, folder).withColumn(
        "person_id", F.col("person_id").cast("string")))
    upsert_table(spark, name, people, "person_id")
    summary = credits.title_summary(_best(spark, folder)).withColumn(
        "person_id", F.col("person_id").cast("string"))
    upsert_table(spark, name, details.summary_family(summary), "person_id")
    pages = details.pages_from_table(spark.table(name))
    tables.drop_table(spark, name)
    return pages


def _before_drop(spark, name, rows):
    """Rows that were read from a table, written down before it is dropped."""
    path = new_folder(spark, "rows")
    rows.write.parquet(path)
    tables.drop_table(spark, name)
    return spark.read.schema(rows.schema).parquet(path)


@_query
def table_puts(spark, folder):
    """Pages of people whose details and summaries were put on the same keys, with a merge and a second put of some."""
    name = _fresh_table("person_table")
    tables.create_table(spark, name, tables.PERSON_TABLE)
    people = details.person_family(b.people(spark, folder).withColumn("person_id", F.col("person_id").cast("string")))
    summary = details.summary_family(credits.title_summary(_best(spark, folder)).withColumn(
        "person_id", F.col("person_id").cast("string")))
    unnamed = people.withColumn("details", F.col("details").withField("name", F.lit("nobody")))
    put_rows(spark, name, unnamed, "person_id")
    put_rows(spark, name, summary, "person_id")
    compact(spark, name, "person_id")
    put_rows(spark, name, people, "person_id")
    return _before_drop(spark, name, details.pages_from_table(read_table(spark, name, "person_id")))


@_query
def person_pages_get(spark, folder):
    """All pages are stored, half of them by a put; those of a list of people are then read back by key."""
    pages = _pages(spark, folder)
    name = _fresh_table("page_table")
    tables.create_table(spark, name, pages.schema)
    upsert_table(spark, name, pages.where("person_id % 2 = 0"), "person_id")
    put_rows(spark, name, pages.where("person_id % 2 = 1"), "person_id")
    return _before_drop(spark, name, details.page_lines(get_rows(spark, name, "person_id", [*range(1, 40), -5, 10**9])))


@_query
def catalog_ddl(spark, folder):
    """Create the title table twice, load it, read its details family, drop it twice."""
    name = _fresh_table("title_table")
    created = [tables.create_table(spark, name, tables.TITLE_TABLE) for _ in range(2)]
    titles = b.titles(spark, folder).select(
        F.col("title_id").cast("string").alias("title_id"),
        F.struct("original_title", "genres").alias("details"))
    stored = upsert_table(spark, name, titles, "title_id")
    dropped = [tables.drop_table(spark, name) for _ in range(2)]
    steps = {"created": created, "dropped": dropped}
    flags = [F.lit(done).alias(f"{step}_{n}") for step, both in steps.items() for n, done in enumerate(both, 1)]
    kept = spark.read.schema(tables.TITLE_TABLE).parquet(stored)
    return tables.scan_family(kept, "title_id", "details").select(
        "title_id", "original_title", F.array_join("genres", ",").alias("genres"), *flags)


_CODECS = {"plain": None, "gzip": "gzip", "bzip2": "bzip2"}


@_query
def tsv_roundtrip(spark, folder):
    """The ratings file written plain, as gzip and as bzip2, and read back."""
    rows = ratings_rows(b.part_ratings(spark, folder))
    parts = []
    for name, codec in _CODECS.items():
        path = new_folder(spark, f"tsv-{name}")
        write_tsv(rows, path, codec)
        parts.append(read_tsv(spark, path, RATINGS).withColumn("codec", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


def _written(spark, name, df):
    path = new_folder(spark, f"tsv-{name}")
    write_tsv(df, path)
    return path


@_query
def titles_tsv(spark, folder):
    """Titles written as a catalog file and read back; a missing year is null."""
    part = b.table(spark, folder, "part")
    rows = part.select(
        F.col("p_partkey").cast("string").alias("tconst"), F.lit("movie").alias("titleType"),
        F.col("p_name").alias("primaryTitle"), F.col("p_name").alias("originalTitle"), F.lit(0).alias("isAdult"),
        (F.lit(1900) + F.col("p_size")).alias("startYear"), F.nullif(F.col("p_size"), F.lit(1)).alias("endYear"),
        F.col("p_size").alias("runtimeMinutes"), F.replace("p_name", F.lit(" "), F.lit(",")).alias("genres"))
    return read_titles(spark, _written(spark, "titles", rows))


@_query
def title_names_tsv(spark, folder):
    """The two columns of a title file that joins need."""
    part = b.table(spark, folder, "part")
    rows = part.select(
        F.col("p_partkey").cast("string").alias("tconst"), F.lit("movie").alias("titleType"),
        F.col("p_name").alias("primaryTitle"), F.upper("p_name").alias("originalTitle"), F.lit(0).alias("isAdult"),
        *[F.lit(None).cast("int").alias(c) for c in ("startYear", "endYear", "runtimeMinutes")],
        F.lit(None).cast("string").alias("genres"))
    return roles.titles(read_titles(spark, _written(spark, "names", rows)))


@_query
def people_tsv(spark, folder):
    rows = b.people(spark, folder).select(
        F.col("person_id").cast("string").alias("nconst"), F.col("name").alias("primaryName"),
        F.col("birth").alias("birthYear"), F.col("death").alias("deathYear"),
        F.lit("actor").alias("primaryProfession"), F.lit(None).cast("string").alias("knownForTitles"))
    return read_people(spark, _written(spark, "people", rows))


@_query
def credits_tsv(spark, folder):
    rows = b.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("tconst"), F.col("l_linenumber").cast("int").alias("ordering"),
        F.col("l_suppkey").cast("string").alias("nconst"), F.col("l_returnflag").alias("category"),
        F.lit(None).cast("string").alias("job"), F.col("l_linestatus").alias("characters"))
    return read_credits(spark, _written(spark, "credits", rows))
