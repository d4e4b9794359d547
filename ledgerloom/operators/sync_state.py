"""Incremental-load state: the last processed block of each task (= chain)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.fixed import START_BLOCK
from ledgerloom.operators.joins import broadcast_if_small
from ledgerloom.schemas import SYNC_STATE_SCHEMA
from ledgerloom.sources.versioned import VersionedTable

# Up to this many chains, `pending` spells the watermarks out in its filter.
MAX_FILTER_CHAINS = 100


def high_watermark(state: DataFrame, task: str) -> DataFrame:
    """Last processed block of one task; no row if the task is unknown."""
    return state.where(F.col("task_name") == task).select("last_processed_block")


def init_tasks(
    state: DataFrame, tasks: DataFrame, start_block: int = START_BLOCK
) -> DataFrame:
    """Add the tasks of `tasks` (column task_name) that have no state yet."""
    absent = (
        tasks.select("task_name")
        .where(F.col("task_name").isNotNull())
        .distinct()
        .join(state.select("task_name"), "task_name", "left_anti")
    )
    fresh = absent.select(
        "task_name",
        F.lit(start_block).cast("bigint").alias("last_processed_block"),
        F.current_timestamp().alias("updated_at"),
    )
    return state.unionByName(fresh)


def chain_tips(
    rows: DataFrame, chain: str = "chainName", block: str = "blockNumber"
) -> DataFrame:
    """Highest block per chain in the form `advance` takes."""
    return (
        rows.where(F.col(chain).isNotNull() & F.col(block).isNotNull())
        .groupBy(F.col(chain).alias("task_name"))
        .agg(F.max(block).alias("reached_block"))
    )


def advance(state: DataFrame, tips: DataFrame) -> DataFrame:
    """Move every task to the block it reached. A task never moves back, and
    only a task that moved gets a new `updated_at`."""
    old, new = F.col("last_processed_block"), F.col("reached_block")
    moved = old.isNull() | (new > old)
    return state.join(tips, "task_name", "full_outer").select(
        "task_name",
        F.greatest(old, new).alias("last_processed_block"),
        F.when(moved, F.current_timestamp())
        .otherwise(F.col("updated_at"))
        .alias("updated_at"),
    )


def pending(
    rows: DataFrame,
    state: DataFrame,
    *,
    upto: DataFrame | None = None,
    start_block: int = START_BLOCK,
    chain: str = "chainName",
    block: str = "blockNumber",
) -> DataFrame:
    """Rows above the watermark of their chain (above `start_block` if the
    chain has none) and, given `upto`, not above the watermark there.

    A handful of chains, as is usual, becomes a plain filter: the block ranges
    reach the scan as row-group filters and nothing is joined or shuffled. For
    more chains than that it is a join with the state.
    """
    ranges = _ranges(state, upto, start_block)
    few = ranges.limit(MAX_FILTER_CHAINS + 1).collect()
    if len(few) > MAX_FILTER_CHAINS:
        return _pending_by_join(rows, ranges, upto is not None, start_block, chain, block)

    number, name = F.col(block), F.col(chain)
    wanted = F.lit(False)
    for r in few:
        inside = (name == r.task_name) & (number > r.low)
        wanted = wanted | (inside if upto is None else inside & (number <= r.high))
    if upto is None:
        known = name.isin(*[r.task_name for r in few])
        wanted = wanted | ((name.isNull() | ~known) & (number > start_block))
    return rows.where(wanted)


def _ranges(state: DataFrame, upto: DataFrame | None, start_block: int) -> DataFrame:
    """Per task the open block range (low, high]. A state written by hand means the same
    to both forms of `pending`: of a repeated task the highest watermark holds, one
    without a watermark starts at `start_block`, and rows without a task are ignored."""
    low = _per_task(state, "low")
    if upto is None:
        high = low.withColumn("high", F.lit(None).cast("bigint"))
    else:
        high = _per_task(upto, "high").join(low, "task_name", "left")
    return high.select("task_name", F.coalesce("low", F.lit(start_block)).alias("low"), "high")


def _per_task(state: DataFrame, name: str) -> DataFrame:
    known = state.where(F.col("task_name").isNotNull())
    return known.groupBy("task_name").agg(F.max("last_processed_block").alias(name))


def _pending_by_join(
    rows: DataFrame, ranges: DataFrame, bounded: bool, start_block: int, chain: str, block: str
) -> DataFrame:
    side = ranges.select(
        F.col("task_name").alias(chain), F.col("low").alias("_low"), F.col("high").alias("_high")
    )
    joined = rows.join(broadcast_if_small(side), chain, "inner" if bounded else "left")
    wanted = F.col(block) > F.coalesce("_low", F.lit(start_block))
    if bounded:
        wanted = wanted & (F.col(block) <= F.col("_high"))
    return joined.where(wanted).select(*[F.col(f"`{c}`") for c in rows.columns])


class SyncStateStore(VersionedTable):
    """The state as a small table that is replaced at every step."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, SYNC_STATE_SCHEMA)

    def init(self, tasks: Iterable[str], start_block: int = START_BLOCK) -> None:
        wanted = self.spark.createDataFrame([(t,) for t in tasks], "task_name STRING")
        self.replace(init_tasks(self.read(), wanted, start_block).coalesce(1))
