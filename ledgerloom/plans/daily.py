"""The daily run: silver, its data tests, then gold.

Each step takes up only what has changed. Silver rebuilds the chains and dates for which
bronze has new files; the wallet counts of a date are made again when silver's were; gold
adds up the counts. A step is written whole, and silver also tested, before it counts.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import DateType, StructType

from ledgerloom.fixed import (
    ACCEPTED_CHAINS,
    GOLD_WHALES,
    SILVER_TRANSACTIONS,
    WHALE_THRESHOLD,
)
from ledgerloom.operators.dedup import dedup_ingested
from ledgerloom.operators.quality import QualityError, TableTests, require
from ledgerloom.plans.models import silver_transactions, wallet_days, whales_of_days, whale_wallets
from ledgerloom.schemas import LONG, TEXT, TRANSACTIONS
from ledgerloom.sources.lake import MODIFIED, SOURCE_PATH, Lake, written_since
from ledgerloom.sources.partitioned import PartitionedTable

KEYS = ("chain_name", "partition_date")
SILVER_SCHEMA = (
    StructType()
    .add("chain_name", TEXT)
    .add("block_number", LONG)
    .add("from_address", TEXT)
    .add("to_address", TEXT)
    .add("tx_value", TEXT)
    .add("partition_date", DateType())
    .add("s3_file_path", TEXT)
)
WALLET_DAYS = "wallet_days"
WALLET_DAYS_SCHEMA = (
    StructType()
    .add("from_address", TEXT)
    .add("tx_count", LONG)
    .add("chain_name", TEXT)
    .add("partition_date", DateType())
)

# Notes of silver: the time of the newest bronze file it has seen, and the files of that
# time, as others may still get the same; and the tests it has passed. Note of the wallet
# counts: a version of silver.
SEEN, SEEN_FILES, PASSED, MERGED = "seen", "seen_files", "passed", "merged"


def silver_table(lake: Lake) -> PartitionedTable:
    return PartitionedTable(
        lake.spark, lake.path("silver", SILVER_TRANSACTIONS), SILVER_SCHEMA, KEYS
    )


def wallet_days_table(lake: Lake) -> PartitionedTable:
    return PartitionedTable(lake.spark, lake.path("gold", WALLET_DAYS), WALLET_DAYS_SCHEMA, KEYS)


def silver_tests(chains: Sequence[str] = ACCEPTED_CHAINS) -> TableTests:
    return TableTests(not_null=("tx_value",), accepted={"chain_name": chains})


def silver_rows(bronze: DataFrame) -> DataFrame:
    """Silver of bronze transactions, of which the producer may have sent some twice:
    the latest ingested one of a date counts."""
    rows = dedup_ingested(bronze, (*TRANSACTIONS.natural_key, "dt"), "ingestionTimestamp")
    return silver_transactions(rows)


@dataclass(frozen=True)
class Changes:
    """Partitions of silver that new bronze files belong to, and how far they reach."""

    partitions: list[str]
    notes: dict[str, str]


def _partition(table: PartitionedTable) -> Column:
    """The partition of silver that a bronze row belongs to."""
    return table.key(F.col("chainName"), F.col("dt").try_cast("date"))


def silver_changes(lake: Lake, tests: TableTests) -> Changes | None:
    """What bronze has gained since silver was made, or all of it if silver was made
    under other tests. Only the new files are opened, and of them no column is read."""
    table = silver_table(lake)
    known = table.notes()
    passed = json.dumps([list(tests.not_null), {c: list(v) for c, v in (tests.accepted or {}).items()}])
    if known.get(PASSED) != passed:
        known = {}
    files = lake.bronze_files("transactions").where(written_since(int(known.get(SEEN, 0))))
    files = files.where(~F.col(SOURCE_PATH).isin(json.loads(known.get(SEEN_FILES, "[]"))))
    found = files.groupBy(_partition(table).alias("key")).agg(F.max(MODIFIED).alias("at")).collect()
    if not found:
        return None
    newest = max(row["at"] for row in found)
    last = files.where(written_since(newest)).select(SOURCE_PATH).distinct().collect()
    names = {row[0] for row in last}
    if newest == int(known.get(SEEN, 0)):
        names |= set(json.loads(known[SEEN_FILES]))
    return Changes(
        sorted(row["key"] for row in found),
        {SEEN: str(newest), SEEN_FILES: json.dumps(sorted(names)), PASSED: passed},
    )


def build_silver(lake: Lake, tests: TableTests) -> PartitionedTable:
    """Bring silver up to bronze. The tests are counted while the new rows are written;
    if one finds a row, QualityError is raised and silver stays as it was."""
    table = silver_table(lake)
    changes = silver_changes(lake, tests)
    if changes is None:
        return table
    bronze = lake.bronze("transactions", lineage=True)
    rows = silver_rows(bronze.where(_partition(table).isin(changes.partitions)))
    # Rows are gathered by chain and date for the write, and AQE splits the large ones.
    counts = Observation("silver tests")
    offending = [F.count_if(bad).alias(name) for name, bad in tests.conditions().items()]
    number = table.stage(rows.hint("rebalance", *KEYS).observe(counts, *offending))
    failures = {name: n for name, n in counts.get.items() if n}
    if failures:
        raise QualityError(SILVER_TRANSACTIONS, failures)
    table.commit(number, changes.partitions, changes.notes)
    table.vacuum()
    return table


def build_wallet_days(lake: Lake, silver: PartitionedTable) -> PartitionedTable:
    """Transactions of each wallet, chain and date, made again where silver is newer."""
    days = wallet_days_table(lake)
    merged, newest = int(days.notes().get(MERGED, 0)), silver.manifest.version()
    if newest == merged:
        return days
    pairs = silver.in_force()
    newer = {key for key, version in pairs if version > merged}
    gone = {key for key, _ in days.in_force()} - {key for key, _ in pairs}
    rows = wallet_days(silver.read().where(silver.key().isin(sorted(newer))))
    number = days.stage(rows.hint("rebalance", *KEYS))
    days.commit(number, newer | gone, {MERGED: str(newest)})
    days.vacuum()
    return days


def run_daily(
    lake: Lake,
    chains: Sequence[str] = ACCEPTED_CHAINS,
    threshold: int = WHALE_THRESHOLD,
) -> DataFrame:
    """Raises QualityError, and leaves silver and gold as they were, if the new part of
    silver fails a test."""
    tests = silver_tests(chains)
    if lake.table_format != "parquet":
        return _rebuild(lake, tests, threshold)
    days = build_wallet_days(lake, build_silver(lake, tests))
    return lake.replace(whales_of_days(days.read(), threshold), "gold", GOLD_WHALES)


def _rebuild(lake: Lake, tests: TableTests, threshold: int) -> DataFrame:
    """The whole run at once, for table formats with a log of their own."""
    rows = silver_rows(lake.bronze("transactions", lineage=True)).hint("rebalance", *KEYS)
    require(rows, SILVER_TRANSACTIONS, tests)
    silver = lake.replace(rows, "silver", SILVER_TRANSACTIONS, KEYS)
    return lake.replace(whale_wallets(silver, threshold), "gold", GOLD_WHALES)
