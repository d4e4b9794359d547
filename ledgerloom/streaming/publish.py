"""Publish what the lake or a bundle holds to the topics of a feed.

Bronze is read as a stream: its progress, kept in the checkpoint, is the set of files that
have been sent. So a row is sent whenever it arrives, also if its block went out long ago.
The watermark of a chain says how far the chain has been sent; it selects nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.fixed import PUBLISHED_CHAINS
from ledgerloom.functions.codec import message
from ledgerloom.operators.bundle import bundle_messages
from ledgerloom.operators.sync_state import SyncStateStore, advance, chain_tips, pending
from ledgerloom.schemas import BLOCKS, ENTITIES, OK, STATUS
from ledgerloom.sources.feeds import FILE_DEFAULTS, Feed
from ledgerloom.sources.lake import Lake
from ledgerloom.streaming.bronze import DEFAULT_TRIGGER


def bronze_messages(lake: Lake, chains: Iterable[str] = PUBLISHED_CHAINS) -> DataFrame:
    """All accepted rows of the chains as one stream of (topic, key, value), and for a
    block its `chainName` and `blockNumber`."""
    wanted = (F.col(STATUS) == OK) & F.col("chainName").isin(*chains)
    feeds = []
    for entity in ENTITIES.values():
        reader = lake.spark.readStream.format(lake.table_format).options(**FILE_DEFAULTS)
        if lake.table_format == "parquet":
            reader = reader.schema(entity.bronze_schema)
        rows = reader.load(lake.path("bronze", entity.table)).where(wanted)
        number = F.col("blockNumber") if entity is BLOCKS else F.lit(None).cast("bigint")
        feeds.append(
            rows.select(
                F.lit(entity.topic).alias("topic"),
                *message(entity),
                "chainName",
                number.alias("blockNumber"),
            )
        )
    return reduce(DataFrame.unionByName, feeds)


def start_publish_stream(
    lake: Lake,
    feed: Feed,
    store: SyncStateStore,
    chains: Iterable[str] = PUBLISHED_CHAINS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Send new rows of bronze, then move the watermarks. A batch that failed is sent
    again, so its messages may come twice; a clean run sends each once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        feed.send(batch.select("topic", "key", "value"))
        # Only the blocks' part of the batch is read again, and of it two columns.
        move_watermarks(store, batch)

    return (
        bronze_messages(lake, chains)
        .writeStream.queryName("publish")
        .foreachBatch(write)
        .option("checkpointLocation", lake.checkpoint("publish"))
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .start()
    )


def move_watermarks(store: SyncStateStore, sent: DataFrame) -> None:
    tips = chain_tips(sent)
    if not tips.isEmpty():
        store.replace(advance(store.read(), tips).coalesce(1))


def publish_bundles(bundles: DataFrame, feed: Feed, store: SyncStateStore) -> None:
    """Send the blocks above the watermarks with all that hangs on them, then move the
    watermarks. A bundle is whole, so here the watermark does select."""
    flat = bundles.select(
        "*", F.col("block.chainName").alias("chainName"), F.col("block.blockNumber").alias("blockNumber")
    )
    due = pending(flat, store.read())
    feed.send(bundle_messages(due))
    move_watermarks(store, due)
