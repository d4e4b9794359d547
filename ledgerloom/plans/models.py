"""Silver and gold models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.fixed import WHALE_THRESHOLD


def silver_transactions(txs: DataFrame) -> DataFrame:
    """Bronze transactions that have a receiver, under warehouse names. The
    file path is there if the scan carries `source_path`."""
    source = F.col("source_path") if "source_path" in txs.columns else F.lit(None).cast("string")
    return txs.where(F.col("to").isNotNull()).select(
        F.col("chainName").alias("chain_name"),
        F.col("blockNumber").alias("block_number"),
        F.col("from").alias("from_address"),
        F.col("to").alias("to_address"),
        F.col("value").alias("tx_value"),
        # A real date: MAX over text would fall back to sort-based aggregation.
        F.col("dt").try_cast("date").alias("partition_date"),
        source.alias("s3_file_path"),
    )


def whale_wallets(silver: DataFrame, threshold: int = WHALE_THRESHOLD) -> DataFrame:
    """Wallets that sent more than `threshold` transactions. Unordered, as a
    table is; see `ranked`."""
    return (
        silver.groupBy(F.col("from_address").alias("whale_wallet"))
        .agg(
            F.count("*").alias("total_tx_count"),
            F.max("partition_date").alias("last_active_date"),
        )
        .where(F.col("total_tx_count") > threshold)
    )


def wallet_days(silver: DataFrame) -> DataFrame:
    """Transactions of each wallet by chain and date: what `whale_wallets` adds up."""
    return silver.groupBy("from_address", "chain_name", "partition_date").agg(
        F.count("*").alias("tx_count")
    )


def whales_of_days(days: DataFrame, threshold: int = WHALE_THRESHOLD) -> DataFrame:
    """`whale_wallets`, from its wallet days."""
    return (
        days.groupBy(F.col("from_address").alias("whale_wallet"))
        .agg(
            F.sum("tx_count").alias("total_tx_count"),
            F.max("partition_date").alias("last_active_date"),
        )
        .where(F.col("total_tx_count") > threshold)
    )


def ranked(whales: DataFrame) -> DataFrame:
    return whales.orderBy(F.desc("total_tx_count"), "whale_wallet")
