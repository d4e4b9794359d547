"""Deduplication on the natural key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, StringType

#: Keys are counted by hash in so many buckets; a bucket of more rows than one task
#: sorts in memory holds a key with very many copies, or several with many.
BUCKETS, HOT_ROWS = 1 << 16, 1_000_000
#: Keys that copies place differently are told by hash, to so many buckets at most.
MOVED_BUCKETS = 1 << 20
#: Bytes that a task sorts, as they are in memory, and partitions up to which a shuffle
#: writes rows as they come (spark.shuffle.sort.bypassMergeThreshold): beyond, it sorts
#: them by partition, and spills what does not fit.
SORTED_BYTES, UNSORTED_PARTITIONS = 128 << 20, 200
#: A table of fewer rows is left to adaptive execution; of a larger one some are read
#: for the width of a row, and so many for the places where slices are cut.
SAMPLED_ROWS, SAMPLED_FROM = 20_000, 100_000


def dedup_latest(
    rows: DataFrame, keys: Sequence[str], latest_first: Sequence[Column]
) -> DataFrame:
    """Keep one row per key: the first by `latest_first`, which should be a
    total order up to identical rows.

    Rows are shuffled by key as they come and sorted only there, where a task has its
    share of the keys; sorted before, a map task's whole input would be spilled. Keys
    with very many copies are cut down first: see `_first`. Without any, which a count
    of the keys alone shows, adaptive execution drops that part before it reads a row.
    """
    few, many = _by_copies(rows, keys, HOT_ROWS)
    few = few.repartition(*keys)
    return _first(few, keys, latest_first).union(_first(many, keys, latest_first))


def _by_copies(
    rows: DataFrame, keys: Sequence[str], hot_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Rows of keys with few copies, and of those with very many."""
    marked = rows.withColumn("_bucket", _bucket(F.xxhash64(*keys), BUCKETS))
    hot = marked.groupBy("_bucket").count().where(F.col("count") > hot_rows)
    hot = F.broadcast(hot.select("_bucket"))
    few = marked.join(hot, "_bucket", "left_anti").select(*_named(rows.columns))
    many = marked.join(hot, "_bucket", "left_semi").select(*_named(rows.columns))
    return few, many


def _bucket(hashed: Column, buckets: int) -> Column:
    return F.pmod(hashed, F.lit(buckets))


def _named(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def _first(rows: DataFrame, keys: Sequence[str], latest_first: Sequence[Column]) -> DataFrame:
    """`row_number() = 1` lets the optimizer cut every key down to one row inside
    each map task (WindowGroupLimit) before a shuffle that it adds itself, so a key
    with very many copies sends one row per task."""
    order = Window.partitionBy(*keys).orderBy(*latest_first)
    return (
        rows.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def dedup_ingested(
    rows: DataFrame,
    keys: Sequence[str],
    ingested_at: str,
    layout: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """`dedup_latest` by ingestion time, ties broken by the rest of the row.

    With a `layout`, which holds the keys, rows are range-partitioned and sorted by it.
    """
    latest_first = _ingested_last(rows.columns, keys, ingested_at)
    if layout:
        return _laid_out(rows, keys, ingested_at, latest_first, layout, partitions)
    return dedup_latest(rows, keys, latest_first)


def _laid_out(
    rows: DataFrame,
    keys: Sequence[str],
    ingested_at: str,
    latest_first: Sequence[Column],
    layout: Sequence[str],
    partitions: int | None,
) -> DataFrame:
    """`dedup_latest` of rows in their layout.

    Whole rows are shuffled once, to the place where they are laid out, and copies meet
    there unless they differ in the rest of the layout (a transaction that came in
    another block). Those are found by a shuffle of hashed keys and that rest, and the
    places that lose are marked: see `_lost`. A large table is laid out slice by slice,
    so that a task sorts what fits in its memory, and still no shuffle has so many
    partitions that it sorts too: see `_slices`.
    """
    count = rows.count()
    slices = [(F.lit(True), partitions)] if partitions else _slices(rows, count, layout)
    # Ranges are drawn from rows with their copies: no key may weigh as much as a range.
    ranges = sum(n or 0 for _, n in slices)
    weighty = max(count // (4 * ranges), 4 * count // BUCKETS, 1) if ranges else HOT_ROWS
    few, many = _by_copies(rows, keys, min(HOT_ROWS, weighty))
    placed = few.union(_first(many, keys, latest_first)).withColumn("_lost", F.lit(False))
    if not set(layout) <= set(keys):
        parts = None if partitions else min(UNSORTED_PARTITIONS, ranges)
        lost = _lost(placed, keys, ingested_at, layout, parts)
        placed = placed.unionByName(lost.withColumn("_lost", F.lit(True)), allowMissingColumns=True)
    done = None
    for within, n in slices:
        part = placed.where(within)
        part = part.repartitionByRange(*([n] if n else []), *layout)
        part = _first(part, layout, [F.desc("_lost"), *latest_first]).where(~F.col("_lost"))
        part = part.select(*_named(rows.columns)).sortWithinPartitions(*layout)
        done = part if done is None else done.union(part)
    return done


def _lost(
    rows: DataFrame, keys: Sequence[str], ingested_at: str, layout: Sequence[str], partitions: int | None
) -> DataFrame:
    """The places in the layout that hold copies of a key, but not the one to keep."""
    rest = [c for c in layout if c not in keys]
    thin = rows.select(F.xxhash64(*keys).alias("_key"), *_named(rest))
    # A minimum of structs is taken over sorted rows: hash maps of all keys would not fit.
    places = _shuffled(thin, partitions, ["_key"]).groupBy("_key").agg(
        F.min(F.struct(*rest)).alias("least"), F.max(F.struct(*rest)).alias("most")
    )
    moved = places.where(~F.col("least").eqNullSafe(F.col("most")))
    moved = moved.select(_bucket(F.col("_key"), MOVED_BUCKETS).alias("_bucket")).distinct()
    marked = rows.withColumn("_bucket", _bucket(F.xxhash64(*keys), MOVED_BUCKETS))
    copies = marked.join(F.broadcast(moved), "_bucket", "left_semi")
    # The order, as far as it tells places apart.
    names = [c for c in rows.columns if c not in (*keys, ingested_at, "_lost")]
    names = names[: max((names.index(c) + 1 for c in rest if c in names), default=0)]
    copies = copies.select(*_named([*keys, ingested_at, *names]))
    order = Window.partitionBy(*keys).orderBy(*_ingested_last(copies.columns, keys, ingested_at))
    kept = _shuffled(copies, partitions, keys).withColumn("_kept", F.first(F.struct(*rest)).over(order))
    return kept.where(~F.struct(*rest).eqNullSafe(F.col("_kept"))).select(*_named(layout))


def _shuffled(rows: DataFrame, partitions: int | None, keys: Sequence[str]) -> DataFrame:
    return rows.repartition(partitions, *keys) if partitions else rows.repartition(*keys)


def _slices(
    rows: DataFrame, count: int, layout: Sequence[str]
) -> list[tuple[Column, int | None]]:
    """Conditions that cut the rows into slices, in the order of the layout's first two
    columns, and the partitions of each; None leaves them to adaptive execution.

    Counting reads no column, and widths are read for some blocks alone. The session's
    number of partitions says nothing about the rows, and adaptive execution merges
    partitions by their compressed size, about a quarter of what a task has to sort.
    """
    if count <= SAMPLED_FROM:
        return [(F.lit(True), None)]
    by, width = list(layout[:2]), F.avg(_width(rows))
    some = rows.where(_bucket(F.xxhash64(*by), count // SAMPLED_FROM) == 0)
    mean = some.agg(width).first()[0] or rows.limit(SAMPLED_ROWS).agg(width).first()[0]
    total = count * mean
    cores = rows.sparkSession.sparkContext.defaultParallelism
    partitions = max(1, math.ceil(total / SORTED_BYTES), min(cores, count // SAMPLED_FROM))
    n = math.ceil(partitions / (0.9 * UNSORTED_PARTITIONS))  # slices differ a little in size
    if n == 1:
        return [(F.lit(True), partitions)]
    sample = rows.select(*_named(by)).sample(min(1.0, SAMPLED_ROWS / count), seed=0).collect()
    values = sorted((tuple(r) for r in sample), key=lambda r: [(v is not None, v) for v in r])
    cuts = list(dict.fromkeys(values[len(values) * i // n] for i in range(1, n) if values))
    at = [0, *(values.index(cut) for cut in cuts), len(values)]
    place, types = F.struct(*_named(by)), [rows.schema[c].dataType for c in by]
    bounds = [F.struct(*[F.lit(v).cast(t).alias(c) for c, v, t in zip(by, cut, types)]) for cut in cuts]
    slices = []
    for i in range(len(cuts) + 1):
        within = F.lit(True) if i == 0 else place >= bounds[i - 1]
        within = within if i == len(cuts) else within & (place < bounds[i])
        share = (at[i + 1] - at[i]) / len(values) if cuts else 1
        slices.append((within, max(1, math.ceil(partitions * share))))
    return slices


def _width(rows: DataFrame) -> Column:
    """Bytes of a row as it is sorted: words, texts rounded up, and the sorter's pointers."""
    texts = [f.name for f in rows.schema if isinstance(f.dataType, (StringType, BinaryType))]
    words = [F.ceil(F.coalesce(F.octet_length(c), F.lit(0)) / 8) for c in _named(texts)]
    return sum(words, F.lit(len(rows.columns) + 8)) * 8


def _ingested_last(names: Sequence[str], keys: Sequence[str], ingested_at: str) -> list[Column]:
    """Latest ingested first, ties broken by the rest of the row."""
    rest = [c for c in names if c not in (*keys, ingested_at)]
    order = [F.col(f"`{ingested_at}`").desc_nulls_last()]
    return order + [F.col(f"`{c}`").asc_nulls_last() for c in rest]
