"""A bundle is one message with a block, its transactions and its logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ledgerloom.functions.codec import message
from ledgerloom.schemas import BLOCKS, LOGS, TRANSACTIONS, Entity

BUNDLE_SCHEMA = StructType(
    [
        StructField("block", BLOCKS.message_schema),
        StructField("transactions", ArrayType(TRANSACTIONS.message_schema)),
        StructField("logs", ArrayType(LOGS.message_schema)),
    ]
)


def block_feed(bundles: DataFrame) -> DataFrame:
    return bundles.select("block.*")


def transaction_feed(bundles: DataFrame) -> DataFrame:
    """One row per transaction; a block without any gives none."""
    return bundles.select(F.explode("transactions").alias("row")).select("row.*")


def log_feed(bundles: DataFrame) -> DataFrame:
    return bundles.select(F.explode("logs").alias("row")).select("row.*")


def split_bundles(bundles: DataFrame) -> dict[str, DataFrame]:
    """The three flat feeds of a frame of bundles, by table name. Each one
    reads only its own part of the bundle, and none of them shuffles."""
    return {
        BLOCKS.table: block_feed(bundles),
        TRANSACTIONS.table: transaction_feed(bundles),
        LOGS.table: log_feed(bundles),
    }


def bundle_messages(bundles: DataFrame) -> DataFrame:
    """All messages of a frame of bundles, (topic, key, value), in one pass: of each
    bundle its block, then its transactions, then its logs."""

    def sent(entity: Entity, row: Column) -> Column:
        return F.struct(F.lit(entity.topic).alias("topic"), *message(entity, row))

    def all_of(entity: Entity) -> Column:
        rows = F.coalesce(F.col(entity.table), F.array().cast(ArrayType(entity.message_schema)))
        return F.transform(rows, lambda row: sent(entity, row))

    block = F.col("block")
    first = F.filter(F.array(sent(BLOCKS, block)), lambda _: block.isNotNull())
    return bundles.select(F.inline(F.concat(first, all_of(TRANSACTIONS), all_of(LOGS))))
