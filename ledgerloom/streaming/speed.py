"""Message topics -> sharded store for quick reads, safe against replays.

Every micro-batch owns one directory and overwrites it as a whole, so a batch
that is run again after a failure replaces its rows instead of adding them. In
a Delta table, the transaction id of the write serves the same end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import Future
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType

from ledgerloom.fixed import SHARDS
from ledgerloom.functions.codec import accepted, decode, rejected
from ledgerloom.functions.columns import normalize_amount, shard_of
from ledgerloom.schemas import ENTITIES, LONG, OK, RAW, STATUS, TEXT, Entity
from ledgerloom.sources.feeds import Feed
from ledgerloom.streaming.bronze import DEFAULT_TRIGGER

START_SECONDS = 120

BatchWriter = Callable[[DataFrame, int], None]


def speed_rows(messages: DataFrame, entity: Entity, shards: int) -> DataFrame:
    """Decoded messages under store names, amounts in plain digits, with their shard."""
    rows = decode(messages, entity, check_amount=True)
    if entity.amount:
        rows = normalize_amount(rows, entity.amount)
    return rows.withColumnsRenamed(entity.store_columns).withColumn(
        "shard", F.when(F.col(STATUS) == OK, shard_of(F.col("block_number"), shards))
    )


@dataclass(frozen=True)
class SpeedStore:
    root: str
    shards: int = SHARDS
    table_format: str = "parquet"
    max_rows_per_file: int = 5_000_000

    def path(self, entity: Entity) -> str:
        return f"{self.root.rstrip('/')}/{entity.table}"

    def write_batch(self, rows: DataFrame, entity: Entity, run_id: str, batch_id: int) -> None:
        """Write the rows of one micro-batch, without a shuffle: each task
        sorts its rows by shard and block and writes a file per shard."""
        ordered = rows.sortWithinPartitions(STATUS, "shard", "chain_name", *entity.store_order)
        if self.table_format == "delta":
            (
                ordered.withColumns(
                    {"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("bigint")}
                )
                .write.format("delta")
                .mode("append")
                .option("txnAppId", run_id)
                .option("txnVersion", batch_id)
                .option("maxRecordsPerFile", self.max_rows_per_file)
                .partitionBy(STATUS, "shard")
                .save(self.path(entity))
            )
            return
        (
            ordered.write.format(self.table_format)
            .mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("maxRecordsPerFile", self.max_rows_per_file)
            .partitionBy(STATUS, "shard")
            .save(f"{self.path(entity)}/run_id={run_id}/batch_id={batch_id}")
        )

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """All shards of a table as one, with `shard`, `run_id` and `batch_id`.
        A filter on `shard` reads only that shard's files."""
        return accepted(self._all(spark, ENTITIES[table]))

    def quarantine(self, spark: SparkSession, table: str) -> DataFrame:
        return rejected(self._all(spark, ENTITIES[table]))

    def _all(self, spark: SparkSession, entity: Entity) -> DataFrame:
        if self.table_format == "delta":
            return spark.read.format("delta").load(self.path(entity))
        schema = (
            entity.store_schema.add(RAW, TEXT)
            .add("run_id", TEXT)
            .add("batch_id", LONG)
            .add(STATUS, TEXT)
            .add("shard", IntegerType())
        )
        return spark.read.format(self.table_format).schema(schema).load(self.path(entity))


def start_speed_stream(
    spark: SparkSession,
    feed: Feed,
    store: SpeedStore,
    entity: Entity,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    rows = speed_rows(feed.stream(spark, entity), entity, store.shards)

    def write(batch: DataFrame, run_id: str, batch_id: int) -> None:
        store.write_batch(batch, entity, run_id, batch_id)

    return start_batches(rows, write, f"speed-{entity.table}", checkpoint, trigger)


def start_speed(
    spark: SparkSession,
    feed: Feed,
    store: SpeedStore,
    checkpoints: str,
    tables: Iterable[str] = tuple(ENTITIES),
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    return [
        start_speed_stream(
            spark, feed, store, ENTITIES[t], f"{checkpoints.rstrip('/')}/speed-{t}", trigger
        )
        for t in tables
    ]


def start_batches(
    rows: DataFrame,
    write: Callable[[DataFrame, str, int], None],
    name: str,
    checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    """Start a stream whose batches are written under the id of its run.

    The run id is the query's id. It is kept in the checkpoint: a restart goes on under
    the same id, and a new checkpoint, whose batches count from 0 again, gets a new one.
    The first batch may begin before it is known here.
    """
    run_id: Future[str] = Future()

    def named(batch: DataFrame, batch_id: int) -> None:
        write(batch, run_id.result(START_SECONDS), batch_id)

    query = _start(rows, named, name, checkpoint, trigger)
    run_id.set_result(str(query.id))
    return query


def _start(
    rows: DataFrame, write: BatchWriter, name: str, checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    return (
        rows.writeStream.queryName(name)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .start()
    )
