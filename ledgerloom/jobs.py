"""Command line of the jobs: `python -m ledgerloom <job> ...` or spark-submit.

Master, memory, storage endpoints and credentials are spark-submit settings.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession, functions as F

from ledgerloom import fixed
from ledgerloom.operators.bundle import BUNDLE_SCHEMA
from ledgerloom.operators.sync_state import SyncStateStore
from ledgerloom.plans import compaction, daily, models, reports, upkeep
from ledgerloom.schemas import ENTITIES
from ledgerloom.session import build_session
from ledgerloom.sources.feeds import Feed
from ledgerloom.sources.lake import Lake, staged_files
from ledgerloom.streaming.bronze import await_all, await_any, start_bronze
from ledgerloom.streaming.jdbc import WRITERS_PER_SHARD, SentShards, ShardedSink, start_jdbc_stream
from ledgerloom.streaming.publish import publish_bundles, start_publish_stream
from ledgerloom.streaming.speed import SpeedStore, start_speed


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    queries = start_bronze(
        _feed(args),
        Lake(spark, args.root, args.table_format),
        args.tables,
        _trigger(args),
        args.files_per_partition,
    )
    _await(spark, queries, args)


def speed(spark: SparkSession, args: argparse.Namespace) -> None:
    store = SpeedStore(f"{args.root}/speed", args.shards, args.table_format)
    queries = start_speed(
        spark, _feed(args), store, f"{args.root}/checkpoints", args.tables, _trigger(args)
    )
    _await(spark, queries, args)


def jdbc(spark: SparkSession, args: argparse.Namespace) -> None:
    """Topics to the tables of one database per shard."""
    queries = []
    for table in args.tables:
        checkpoint = f"{args.root}/checkpoints/jdbc-{table}"
        sink = ShardedSink(
            args.shard_url,
            args.target.format(table=table),
            dict(option.split("=", 1) for option in args.jdbc_option),
            SentShards(f"{checkpoint}-sent"),
            args.writers,
            args.token_property,
        )
        queries.append(
            start_jdbc_stream(spark, _feed(args), ENTITIES[table], sink, checkpoint, _trigger(args))
        )
    _await(spark, queries, args)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Print the four bronze reports, and the whale mart if it has been built."""
    lake = Lake(spark, args.root, args.table_format)
    lake.register_views()
    blocks, txs = spark.table("blocks"), spark.table("transactions")
    reports.latest_transactions(txs).show(args.rows, truncate=False)
    reports.daily_tx_counts(txs).show(args.rows)
    reports.chain_tip(blocks).show(args.rows)
    reports.top_blocks(blocks, txs).show(args.rows, truncate=False)
    if args.whales:
        models.ranked(lake.read("gold", fixed.GOLD_WHALES)).show(args.rows, truncate=False)


def run_daily(spark: SparkSession, args: argparse.Namespace) -> None:
    lake = Lake(spark, args.root, args.table_format)
    daily.run_daily(lake, args.chains, args.threshold)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Merge the speed store's batches into sorted tables without repeats."""
    lake = Lake(spark, args.root, args.table_format)
    store = SpeedStore(f"{args.root}/speed", table_format=args.table_format)
    for table in args.tables:
        if args.table_format == "parquet":
            compaction.compact_store(store, lake, ENTITIES[table], args.blocks_per_range)
        else:
            compaction.compact(store.read(spark, table), ENTITIES[table], lake)


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """Send bronze to the topics as it grows, or the bundles of a folder."""
    lake = Lake(spark, args.root, args.table_format)
    store = SyncStateStore(spark, args.state)
    store.init(args.chains)
    if args.bundles:
        bundles = staged_files(spark, args.bundles, BUNDLE_SCHEMA)
        wanted = F.col("block.chainName").isin(*args.chains)
        publish_bundles(bundles.where(wanted), _feed(args), store)
        return
    query = start_publish_stream(lake, _feed(args), store, args.chains, _trigger(args))
    _await(spark, [query], args)


def compact_bronze(spark: SparkSession, args: argparse.Namespace) -> None:
    """Copy the closed dates of bronze into few files."""
    lake = Lake(spark, args.root, args.table_format)
    for table in args.tables:
        upkeep.compact_bronze(lake, table, args.before, args.settle_seconds)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerloom")
    jobs = top.add_subparsers(dest="job", required=True)

    def add(name: str, run, *, feed: bool = False, stream: bool = False, tables: bool = False):
        job = jobs.add_parser(name)
        job.set_defaults(run=run)
        job.add_argument("--root", required=True, help="lake root")
        job.add_argument("--table-format", default="parquet", choices=["parquet", "delta"])
        if feed:
            job.add_argument("--feed", required=True, choices=["kafka", "files"])
            job.add_argument("--feed-location", required=True)
            job.add_argument("--feed-option", action="append", default=[], metavar="KEY=VALUE")
        if stream:
            job.add_argument("--every", default=fixed.TRIGGER_INTERVAL, help="trigger interval")
            job.add_argument("--once", action="store_true", help="read what is there and stop")
        if tables:
            job.add_argument("--tables", nargs="+", default=list(ENTITIES), choices=list(ENTITIES))
        return job

    job = add("ingest", ingest, feed=True, stream=True, tables=True)
    job.add_argument("--files-per-partition", type=int)
    job = add("speed", speed, feed=True, stream=True, tables=True)
    job.add_argument("--shards", type=int, default=fixed.SHARDS)
    job = add("jdbc", jdbc, feed=True, stream=True, tables=True)
    job.add_argument("--shard-url", action="append", required=True, help="once per shard, in order")
    job.add_argument("--target", default="raw_{table}_local", help="table name, with {table}")
    job.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    job.add_argument("--writers", type=int, default=WRITERS_PER_SHARD, help="connections per shard")
    job.add_argument("--token-property", help="driver property for the token of an insert")
    job = add("report", report)
    job.add_argument("--whales", action="store_true")
    job.add_argument("--rows", type=int, default=20, help="rows printed of each report")
    job = add("daily", run_daily)
    job.add_argument("--chains", nargs="+", default=list(fixed.ACCEPTED_CHAINS))
    job.add_argument("--threshold", type=int, default=fixed.WHALE_THRESHOLD)
    job = add("compact", compact, tables=True)
    job.add_argument("--blocks-per-range", type=int, default=compaction.BLOCKS_PER_RANGE)
    job = add("compact-bronze", compact_bronze, tables=True)
    job.add_argument("--before", required=True, help="first date (yyyy-MM-dd) that is not closed")
    job.add_argument("--settle-seconds", type=int, default=upkeep.SETTLE_SECONDS)
    job = add("publish", publish, feed=True, stream=True)
    job.add_argument("--bundles", help="folder of Parquet bundles to send instead of bronze")
    job.add_argument("--state", required=True, help="directory of the watermark table")
    job.add_argument("--chains", nargs="+", default=list(fixed.PUBLISHED_CHAINS))
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.root = args.root.rstrip("/")
    session = spark or build_session(
        f"ledgerloom-{args.job}", delta=args.table_format == "delta"
    )
    args.run(session, args)


def _feed(args: argparse.Namespace) -> Feed:
    options = dict(option.split("=", 1) for option in args.feed_option)
    return Feed(args.feed, args.feed_location, options)


def _trigger(args: argparse.Namespace) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": args.every}


def _await(spark: SparkSession, queries: list, args: argparse.Namespace) -> None:
    if args.once:
        await_all(queries)
    else:
        await_any(spark, queries)
