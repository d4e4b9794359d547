"""Message topics -> one database per shard, over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.fixed import JDBC_BATCH_ROWS
from ledgerloom.functions.codec import accepted
from ledgerloom.schemas import Entity
from ledgerloom.sources import files
from ledgerloom.sources.feeds import Feed
from ledgerloom.streaming.speed import speed_rows, start_batches

# Connections that a shard has to bear at once.
WRITERS_PER_SHARD = 4

Insert = Callable[[DataFrame, str, str], None]


@dataclass(frozen=True)
class SentShards:
    """Which batches have reached which shard: an empty table for each, made after the
    insert. A batch that runs again skips the shards that it had reached."""

    root: str

    def path(self, token: str) -> str:
        return f"{self.root.rstrip('/')}/{token}"

    def has(self, spark: SparkSession, token: str) -> bool:
        return bool(files.found(spark, f"{self.path(token)}/_SUCCESS"))

    def add(self, spark: SparkSession, token: str) -> None:
        spark.range(0).coalesce(1).write.mode("overwrite").parquet(self.path(token))


@dataclass(frozen=True)
class ShardedSink:
    """Writes the accepted rows of a batch to the table of their shard's database.

    The batch is dealt once, to at most `writers` tasks for each shard, and the shards are
    written side by side. The token of an insert, run, batch and shard, keeps a batch that
    is run again from adding its rows twice. If a run is killed after an insert and before
    that was noted, or within an insert, only a database that knows the token (the
    property `token_property` of its driver) can tell; any other gets these rows again.
    """

    urls: Sequence[str]
    table: str
    properties: Mapping[str, str]
    sent: SentShards
    writers: int = WRITERS_PER_SHARD
    token_property: str | None = None
    insert: Insert | None = None

    def write(self, batch: DataFrame, run_id: str, batch_id: int) -> None:
        spark = batch.sparkSession
        token = lambda shard: f"{run_id}-{batch_id}-{shard}"
        due = [s for s in range(len(self.urls)) if not self.sent.has(spark, token(s))]
        if not due:
            return
        rows = accepted(batch).where(F.col("shard").isin(due))
        writer = F.pmod(F.xxhash64(*rows.columns), F.lit(self.writers))
        # Kept for the shards, which would each fetch and decode the batch otherwise. A
        # lost executor's part is computed again.
        rows = rows.repartition(len(due) * self.writers, "shard", writer).persist()

        def send(shard: int) -> None:
            mine = rows.where(F.col("shard") == shard).drop("shard").coalesce(self.writers)
            (self.insert or self._insert)(mine, self.urls[shard], token(shard))
            self.sent.add(spark, token(shard))

        try:
            with ThreadPoolExecutor(len(due)) as pool:
                # All shards end before an error is raised, so what was sent is noted.
                results = [pool.submit(inheritable_thread_target(spark)(send), s) for s in due]
            for result in results:
                result.result()
        finally:
            rows.unpersist()

    def _insert(self, rows: DataFrame, url: str, token: str) -> None:
        settings = {"batchsize": str(JDBC_BATCH_ROWS), **self.properties}
        if self.token_property:
            settings[self.token_property] = token
        rows.write.mode("append").jdbc(url, self.table, properties=settings)


def start_jdbc_stream(
    spark: SparkSession,
    feed: Feed,
    entity: Entity,
    sink: ShardedSink,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    rows = speed_rows(feed.stream(spark, entity), entity, len(sink.urls))
    return start_batches(rows, sink.write, f"jdbc-{entity.table}", checkpoint, trigger)
