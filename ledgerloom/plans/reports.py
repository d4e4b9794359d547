"""Reports on the bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.fixed import REPORT_ROWS, SHARDS
from ledgerloom.functions.columns import partition_date, shard_of

LATEST = ["chainName", "blockNumber", "txHash", "from", "to", "value"]
BLOCK_KEY = ["chainName", "blockNumber"]


def latest_transactions(txs: DataFrame, k: int = REPORT_ROWS) -> DataFrame:
    """The k newest transactions; ties by hash, rows without a time last.

    A first pass over the timestamp column alone finds the k-th newest time.
    As a scalar subquery it becomes a partition filter and a row-group filter
    of the second pass, which then reads the wide columns of a few row groups
    only, not of the whole table.
    """
    newest = txs.select("timestamp").orderBy(F.desc("timestamp")).limit(k)
    since = newest.agg(F.min("timestamp").alias("since"))
    recent = txs.where(F.col("timestamp") >= since.scalar())
    undated = txs.where(F.col("timestamp").isNull())
    if "dt" in txs.columns:
        # `dt` is derived from the timestamp: both are absent together.
        # Text order is date order for years of four digits. Other years start
        # with a sign, which sorts before the digits, and are always let in.
        dt = F.col("dt")
        since_date = since.select(partition_date(F.col("since"))).scalar()
        recent = recent.where((dt >= since_date) | (dt < "0") | dt.isNull())
        undated = undated.where(dt.isNull())
    wide = [*LATEST, "timestamp"]
    order = [F.desc_nulls_last("timestamp"), F.asc("txHash")]
    # Counts only when there are fewer than k rows with a time.
    rest = undated.select(*wide).orderBy("txHash").limit(k)
    return recent.select(*wide).unionByName(rest).orderBy(*order).limit(k).select(*LATEST)


def daily_tx_counts(txs: DataFrame) -> DataFrame:
    return (
        txs.groupBy("chainName", "dt")
        .agg(F.count("*").alias("tx_count"))
        .orderBy(F.desc("dt"), F.desc("tx_count"), "chainName")
    )


def chain_tip(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("chainName").agg(F.max("blockNumber").alias("latest_block"))


def block_tx_counts(blocks: DataFrame, txs: DataFrame) -> DataFrame:
    """Transactions per (blockNumber, miner), 0 for an empty block. Chains that
    share a block number and a miner share a row."""
    return (
        _counted_blocks(blocks, txs)
        .groupBy("blockNumber", "miner")
        .agg(F.sum("n").alias("tx_count"))
    )


def block_tx_counts_by_chain(blocks: DataFrame, txs: DataFrame) -> DataFrame:
    """The same with the chain as part of the key."""
    return _counted_blocks(blocks, txs).select(
        "chainName", "blockNumber", "miner", F.col("n").alias("tx_count")
    )


def top_blocks(blocks: DataFrame, txs: DataFrame, k: int = REPORT_ROWS) -> DataFrame:
    """The k highest rows of `block_tx_counts`.

    They lie within the k highest block numbers, which the blocks alone tell,
    so both tables are cut down to those before the join.
    """
    order = [F.desc_nulls_last("blockNumber"), F.asc_nulls_first("miner")]
    number = F.col("blockNumber")
    highest = blocks.select(number).distinct().orderBy(number.desc_nulls_last()).limit(k)
    lowest = highest.agg(F.min("blockNumber")).scalar()
    # A block without a number sorts last and matters only in a short table.
    counted = block_tx_counts(
        blocks.where((number >= lowest) | number.isNull()), txs.where(number >= lowest)
    )
    return counted.orderBy(*order).limit(k)


def shard_counts(blocks: DataFrame, shards: int = SHARDS) -> DataFrame:
    return (
        blocks.groupBy(shard_of(F.col("blockNumber"), shards).alias("shard"))
        .agg(F.count("*").alias("n_rows"))
    )


def _counted_blocks(blocks: DataFrame, txs: DataFrame) -> DataFrame:
    """Left join of blocks to transactions, counted: one row per (chain, block,
    miner) with `n` joined transactions.

    Both sides are counted before they meet, so many transactions in one block
    or many copies of one block collapse inside the map tasks. What can still
    pile up under one join key is one block with very many miners. `_key` is
    there for that: it makes the join exchange both sides afresh, which is the
    shape AQE can split a hot partition of.
    """
    key = F.xxhash64(*BLOCK_KEY).alias("_key")
    tx_counts = (
        txs.where(F.col("txHash").isNotNull())
        .groupBy(*BLOCK_KEY)
        .agg(F.count("*").alias("_txs"))
        .select("*", key)
    )
    block_counts = (
        blocks.groupBy(*BLOCK_KEY, "miner")
        .agg(F.count("*").alias("_copies"))
        .select("*", key)
    )
    # Every copy of a block joins every transaction of it.
    n = F.col("_copies") * F.coalesce("_txs", F.lit(0))
    return block_counts.join(tx_counts, ["_key", *BLOCK_KEY], "left").select(
        *BLOCK_KEY, "miner", n.alias("n")
    )
