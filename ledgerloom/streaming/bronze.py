"""Message topics -> bronze tables, one stream per table.

Accepted and rejected rows leave in the same pass, told apart by the leading
partition column `status`, so nothing is read or parsed twice and both share
the sink's exactly-once log.

A stream is map-only by default: each task writes a file per chain and date it
meets. `files_per_partition` trades a shuffle of the micro-batch for fewer
files, which pays off with many tasks or when a long backlog is read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.fixed import TRIGGER_INTERVAL
from ledgerloom.functions.codec import decode
from ledgerloom.functions.columns import partition_date
from ledgerloom.schemas import ENTITIES, OK, RAW, STATUS, Entity
from ledgerloom.sources.feeds import Feed
from ledgerloom.sources.lake import Lake

DEFAULT_TRIGGER = {"processingTime": TRIGGER_INTERVAL}
PARTITIONS = (STATUS, "chainName", "dt")


def bronze_rows(messages: DataFrame, entity: Entity) -> DataFrame:
    decoded = decode(messages, entity)
    # A rejected row has no place in the chain and date partitions; its
    # content is in `raw`.
    kept = F.col(STATUS) == OK
    return decoded.withColumns(
        {
            "chainName": F.when(kept, F.col("chainName")),
            "dt": F.when(kept, partition_date(F.col("timestamp"))),
        }
    )


def gather(rows: DataFrame, entity: Entity, files_per_partition: int) -> DataFrame:
    """Bring the rows of a chain and date to at most `files_per_partition`
    tasks, spread by key, so that a hot chain still has several writers."""
    spread = F.xxhash64(*[F.col(c) for c in entity.natural_key], F.col(RAW))
    return rows.repartition(
        *[F.col(c) for c in PARTITIONS], F.pmod(spread, F.lit(files_per_partition))
    )


def start_bronze_stream(
    feed: Feed,
    lake: Lake,
    entity: Entity,
    trigger: dict | None = None,
    files_per_partition: int | None = None,
) -> StreamingQuery:
    rows = bronze_rows(feed.stream(lake.spark, entity), entity)
    if files_per_partition:
        rows = gather(rows, entity, files_per_partition)
    return (
        rows.writeStream.queryName(f"bronze-{entity.table}")
        .format(lake.table_format)
        .outputMode("append")
        .partitionBy(*PARTITIONS)
        .option("path", lake.path("bronze", entity.table))
        .option("checkpointLocation", lake.checkpoint(f"bronze-{entity.table}"))
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .start()
    )


def start_bronze(
    feed: Feed,
    lake: Lake,
    tables: Iterable[str] = tuple(ENTITIES),
    trigger: dict | None = None,
    files_per_partition: int | None = None,
) -> list[StreamingQuery]:
    """Start the streams of several tables side by side in one session."""
    return [
        start_bronze_stream(feed, lake, ENTITIES[t], trigger, files_per_partition)
        for t in tables
    ]


def await_any(spark: SparkSession, queries: Iterable[StreamingQuery]) -> None:
    """Block until one stream ends, then stop the others. An error of the
    ended stream is raised."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Block until every stream has ended (for `availableNow` runs)."""
    for query in queries:
        query.awaitTermination()
