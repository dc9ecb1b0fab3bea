"""Run one job: ``spark-submit ... -m marquee`` or ``python -m marquee <job> ...``."""

from __future__ import annotations

import argparse

from marquee.operators import trends
from marquee.plans import jobs
from marquee.session import build_session
from marquee.sources import roles, tsv
from marquee.sources.lines import growing_votes
from marquee.sources.votes import socket_votes, text_votes
from marquee.streaming.runner import drain, finish, stream_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="marquee")
    parser.add_argument("--master")
    parser.add_argument("--tables", help="folder that the title and person tables lie in")
    sub = parser.add_subparsers(dest="job", required=True)

    def job(name, *paths):
        one = sub.add_parser(name)
        for path in paths:
            one.add_argument(path)
        return one

    job("create-tables")
    job("drop-tables")
    job("compact-tables")
    for name, paths in (("titles", ["titles"]), ("people", ["people"]), ("summaries", ["credits", "ratings"])):
        job(f"load-{name}", *paths).add_argument(
            "--put", action="store_true", help="write only these rows; compact-tables merges them")
    job("page").add_argument("person_id", nargs="+")
    job("top-people", "credits", "people").add_argument("--credit-rows", action="store_true")
    job("collaborators", "credits", "out")
    update = job("update-ratings", "ratings", "lots", "out")
    update.add_argument("--format", default="parquet")
    update.add_argument("--codec")
    fold = job("fold-lots", "lots", "ledger", "checkpoint")
    fold.add_argument("--format", default="parquet")
    fold.add_argument("--max-files", type=int, help="files of one micro-batch at most")
    job("write-ratings", "ratings", "ledger", "out").add_argument("--codec")
    for name in ("titles", "people", "credits", "ratings"):
        for one in sub.choices.values():
            if any(a.dest == name for a in one._actions) and not any(a.dest == "splits" for a in one._actions):
                one.add_argument("--splits", type=int, help="partitions that files of an unsplittable codec are dealt to")
    for name in ("log", "top3", "trending"):
        stream = job(name, *([] if name == "log" else ["titles"]), "out", "checkpoint")
        source = stream.add_mutually_exclusive_group(required=True)
        source.add_argument("--folder", help="folder of vote lines")
        source.add_argument("--growing", help="folder of growing files of vote lines that carry their times")
        source.add_argument("--socket", help="host:port of vote lines")
        stream.add_argument("--once", action="store_true", help="handle what is there and stop")
        stream.add_argument("--max-files", type=int, help="files of one micro-batch at most")
        if name == "log":
            stream.add_argument("--lot", default=trends.LOT, help="length of a lot")
            stream.add_argument("--files-per-lot", type=int, help="files of a lot in one micro-batch")
            continue
        stream.add_argument("--delay", default="1 minute", help="how late a vote may come")
        stream.add_argument("--length", default=trends.MEAN_WINDOW if name == "top3" else trends.TREND_PERIOD)
        if name == "top3":
            stream.add_argument("--slide", default=trends.MEAN_SLIDE)
    return parser


def _stream(spark, args):
    child = stream_session(spark)
    if args.folder:
        votes = text_votes(child, args.folder, args.max_files)
    elif args.growing:
        votes = growing_votes(child, args.growing, f"{args.checkpoint.rstrip('/')}-lines")
    else:
        host, port = args.socket.rsplit(":", 1)
        votes = socket_votes(child, host, int(port))
    every = None if args.once and not args.growing else "1 second" if args.once else "1 minute"
    if args.job == "log":
        return jobs.log_votes(votes, args.out, args.checkpoint, args.lot, files_per_lot=args.files_per_lot, every=every)
    titles = roles.titles(tsv.read_titles(child, args.titles))
    if args.job == "top3":
        return jobs.top3(votes, titles, args.out, args.checkpoint, args.delay, args.length, args.slide, every, True)
    return jobs.trending(votes, titles, args.out, args.checkpoint, args.delay, args.length, every, True)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"marquee {args.job}", args.master)
    if args.tables:
        jobs.open_tables(spark, args.tables)
    if args.job == "create-tables":
        jobs.create_tables(spark, folder=args.tables)
    elif args.job == "drop-tables":
        jobs.drop_tables(spark, delete=bool(args.tables))
    elif args.job == "load-titles":
        jobs.load_titles(spark, args.titles, splits=args.splits, put=args.put)
    elif args.job == "load-people":
        jobs.load_people(spark, args.people, splits=args.splits, put=args.put)
    elif args.job == "load-summaries":
        jobs.load_summaries(spark, args.credits, args.ratings, splits=args.splits, put=args.put)
    elif args.job == "compact-tables":
        jobs.compact_tables(spark)
    elif args.job == "page":
        jobs.pages(spark, args.person_id).show(len(args.person_id), truncate=False)
    elif args.job == "top-people":
        jobs.top_people(spark, args.credits, args.people, not args.credit_rows, splits=args.splits).show(truncate=False)
    elif args.job == "collaborators":
        jobs.collaborators(spark, args.credits, args.splits).write.mode("overwrite").parquet(args.out)
    elif args.job == "update-ratings":
        jobs.update_ratings(spark, args.ratings, args.lots, args.out, args.format, args.codec, args.splits)
    elif args.job == "fold-lots":
        finish(jobs.fold_lots(spark, args.lots, args.ledger, args.checkpoint, args.format, max_files=args.max_files))
    elif args.job == "write-ratings":
        jobs.write_ratings(spark, args.ratings, args.ledger, args.out, args.codec, args.splits)
    else:
        query = _stream(spark, args)
        (drain if args.once and args.growing else finish)(query)


if __name__ == "__main__":
    main()
