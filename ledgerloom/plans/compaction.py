"""Streamed rows as a compact, sorted and deduplicated table.

The table is cut by chain and range of blocks. A run takes in the batches that the speed
store has completed since the last one, and merges them with the ranges that they touch;
as blocks arrive in order, that is the end of each chain. Ranges and the mark of what has
been taken in change in one step, and batches are removed a run later.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions.columns import shard_of
from ledgerloom.operators.dedup import dedup_ingested
from ledgerloom.schemas import ENTITIES, LONG, OK, STATUS, Entity
from ledgerloom.sources import files
from ledgerloom.sources.lake import Lake
from ledgerloom.sources.partitioned import PartitionedTable
from ledgerloom.streaming.speed import SpeedStore

COMPACTED = "compacted"
BUCKET_KEY = ("chain_name", "block_number")
_LARGEST = "ledgerloom.largest_bucket_share"

BLOCK_RANGE = "block_range"
BLOCKS_PER_RANGE = 1_000_000
# Notes of a compacted table: the last batch of each run that it holds; blocks in a range.
TAKEN, RANGE = "taken", "blocks_per_range"


def store_layout(rows: DataFrame, entity: Entity, partitions: int | None = None) -> DataFrame:
    """Store rows in the order (chain, block, ...), range-partitioned.

    Ranges over the whole sort key cut a chain, and a block, into as many
    files as its rows need, each with a narrow min/max of block numbers.
    Very many copies of a row, which no range could part, are cut down before that.
    """
    key = ["chain_name", *entity.store_order]
    rows = rows.select(*entity.store_schema.names)
    return dedup_ingested(rows, entity.store_key, "ingestion_timestamp", key, partitions)


def compacted_table(lake: Lake, entity: Entity) -> PartitionedTable:
    schema = entity.store_schema.add(BLOCK_RANGE, LONG)
    path = lake.path(COMPACTED, entity.table)
    return PartitionedTable(lake.spark, path, schema, ("chain_name", BLOCK_RANGE))


def compact_store(
    store: SpeedStore, lake: Lake, entity: Entity, blocks_per_range: int = BLOCKS_PER_RANGE
) -> int:
    """Merge new batches into the compacted table. Returns the number of the change, 0 if
    there was none. `blocks_per_range` counts for a table that has none yet."""
    table = compacted_table(lake, entity)
    notes = table.notes()
    before = json.loads(notes.get(TAKEN, "{}"))
    after = _later(before, complete_batches(lake.spark, store, entity).items())
    retire(lake.spark, store, entity, before)
    if after == before:
        return 0
    width = notes.get(RANGE, str(blocks_per_range))
    block_range = F.floor(F.col("block_number") / int(width)).cast("bigint").alias(BLOCK_RANGE)
    new = store.read(lake.spark, entity.table).where(_taken(after) & ~_taken(before))
    new = new.select(*entity.store_schema.names, block_range)
    touched = [row["key"] for row in new.select(table.key().alias("key")).distinct().collect()]
    old = table.read().where(table.key().isin(touched))
    merged = store_layout(old.unionByName(new), entity).select("*", block_range)
    number = table.stage(merged)
    table.commit(number, touched, {TAKEN: json.dumps(after), RANGE: width})
    table.vacuum()
    return number


def read_store(store: SpeedStore, lake: Lake, table: str) -> DataFrame:
    """All rows of the speed store with their `shard`: what has been compacted, and the
    batches that have not. A row is in one of the two, before, between and after the
    steps of a run; a batch that is written again after it was taken in is passed over."""
    entity = ENTITIES[table]
    compacted = compacted_table(lake, entity)
    marks = json.loads(compacted.notes().get(TAKEN, "{}"))
    names = [*entity.store_schema.names, "shard"]
    shard = shard_of(F.col("block_number"), store.shards)
    tail = store.read(lake.spark, table).where(~_taken(marks))
    return compacted.read().withColumn("shard", shard).select(*names).unionByName(tail.select(*names))


def complete_batches(spark: SparkSession, store: SpeedStore, entity: Entity) -> dict[str, int]:
    """The last complete batch of each run; a run writes its batches one by one."""
    return _later({}, _batches(files.found(spark, f"{store.path(entity)}/run_id=*/batch_id=*/_SUCCESS")))


def retire(spark: SparkSession, store: SpeedStore, entity: Entity, taken: Mapping[str, int]) -> None:
    """Remove batches up to those in `taken`. Rows that were not accepted stay."""
    batches: dict[str, set[str]] = {}
    for path in files.found(spark, f"{store.path(entity)}/run_id=*/batch_id=*/*"):
        (run, batch), = _batches([path])
        if batch <= taken.get(run, -1):
            folder, name = path.rsplit("/", 1)
            batches.setdefault(folder, set()).add(name)
    accepted = f"{STATUS}={OK}"
    for folder, names in batches.items():
        rejected = {n for n in names if n.startswith(f"{STATUS}=")} - {accepted}
        if accepted in names or not rejected:
            files.remove(spark, f"{folder}/{accepted}" if rejected else folder)


def _batches(paths: list[str]) -> list[tuple[str, int]]:
    found = [re.search(r"/run_id=([^/]*)/batch_id=(\d+)/", path) for path in paths]
    return [(m[1], int(m[2])) for m in found if m]


def _later(marks: Mapping[str, int], batches: Iterable[tuple[str, int]]) -> dict[str, int]:
    out = dict(marks)
    for run, batch in batches:
        out[run] = max(batch, out.get(run, -1))
    return out


def _taken(marks: Mapping[str, int]) -> Column:
    """Whether the batch of a row is marked: a filter on partition columns."""
    if not marks:
        return F.lit(False)
    last = F.create_map(*[F.lit(x) for mark in sorted(marks.items()) for x in mark])
    return F.coalesce(F.col("batch_id") <= F.try_element_at(last, F.col("run_id")), F.lit(False))


def compact(
    rows: DataFrame, entity: Entity, lake: Lake, partitions: int | None = None
) -> DataFrame:
    """Replace the lake's compacted table, one directory per chain."""
    return lake.replace(
        store_layout(rows, entity, partitions), COMPACTED, entity.table, ["chain_name"]
    )


def write_bucketed(rows: DataFrame, table: str, path: str, buckets: int) -> None:
    """Save store rows as a catalog table bucketed by (chain, block), for joins
    between entities without a shuffle.

    The rebalance hint brings a bucket's rows together and lets AQE split a
    bucket that is too large for one writer.
    """
    spark = rows.sparkSession
    (
        rows.hint("rebalance", buckets, *BUCKET_KEY)
        .write.format("parquet")
        .mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, *BUCKET_KEY)
        .sortBy(*BUCKET_KEY)
        .saveAsTable(table)
    )
    per_bucket = (
        spark.read.parquet(path)
        .groupBy(F.pmod(F.hash(*BUCKET_KEY), F.lit(buckets)).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )
    share = per_bucket.agg(F.max("n") / F.sum("n")).first()[0] or 0.0
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_LARGEST}' = '{share}')")


def open_bucketed(spark: SparkSession, table: str, path: str, max_share: float) -> DataFrame:
    """The bucketed table, or the same files without their buckets if one
    bucket holds more than `max_share` of the rows: a bucket is read by one
    task, and a plain scan splits its files."""
    found = spark.sql(f"SHOW TBLPROPERTIES {table} ('{_LARGEST}')").first()["value"]
    return spark.table(table) if float(found) <= max_share else spark.read.parquet(path)
