"""Operator 13: exact top-k search by inner product, as a Voronoi kNN join.

Vectors and queries are grouped by their nearest pivot. Each group of vectors has a small
summary: its radius and the distances of its k + 1 members nearest to the pivot. From the
summaries alone follows, for each group of queries, a score that at least k + 1 vectors
reach for every query of the group. A vector is sent to a group of queries only if its
score may reach that far; where no bound can part them, as with vectors that point
everywhere, it is sent to all groups. Each group solves its part exactly.

Equal vectors travel as one, with the k + 1 smallest ids that have it: no query can need
more of them, as ties go to the smaller id and only its own row is left out. So a vector
that a third of all rows share is one vector. A group of queries has at most
GROUP_QUERIES distinct ones, and its vectors are cut into slices of bounded bytes.

Components are numbers times SCALE, rounded down (beyond 2^62 either way, that). Sums are exact: in doubles where they
stay below 2^53, else in Python's integers; a score beyond 64 bits is the nearest 64-bit
value. Shorter vectors count as padded with zeros.

Rows: the k best rows for each query row, its own left out; fewer if there are fewer.
Ties go to the smaller id, a null id last. Vectors that are null or hold null, NaN or
infinite components take no part, on either side. Rows repeated with the same id are rows
of their own, as queries and as candidates. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .shared import stored

SCALE = 64
MAX_PIVOTS = 256
#: Numbers in the table of pivots, which every task has.
MAX_PIVOT_NUMBERS = 4_000_000
GROUP_QUERIES = 4096
SLICE_BYTES = 64 << 20
CHUNK = 4096
#: More than any rounding of bounds in doubles.
SLACK = 1e-9
LARGEST = 1 << 62
NO_ID = (1 << 63) - 1


def whole_vectors(rows: DataFrame, vec_id: Column, vector: Column, is_query: Column) -> DataFrame:
    """(vec_id, ints, key, query) of the rows that take part. Equal vectors have the same
    key, the hash of their numbers without zeros at the end."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    most = F.lit(float(LARGEST))
    whole = lambda x: F.greatest(F.least(F.floor(x * SCALE), most), -most).cast("long")
    taken = rows.select(
        vec_id.cast("long").alias("vec_id"),
        F.when(finite, F.transform(numbers, whole)).alias("ints"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    ).where(F.col("ints").isNotNull())
    text = F.regexp_replace(F.array_join("ints", ","), r"(^|,)0(,0)*$", "")
    return taken.withColumn("key", F.sha2(text, 256))


@dataclass
class Shape:
    points: int
    queries: int
    dim: int
    largest: int

    @property
    def dtype(self) -> str:
        fits = [t for t in ("<i1", "<i2", "<i4") if self.largest <= np.iinfo(t).max]
        return (fits or ["<i8"])[0]

    @property
    def slices(self) -> int:
        return -(-self.points * (self.dim * np.dtype(self.dtype).itemsize + 8) // SLICE_BYTES) or 1


def distinct_points(taken: DataFrame, k: int) -> DataFrame:
    """(point, key, ints, ids, query): one row for each distinct vector, its k + 1
    smallest ids, and whether any of its rows is a query."""
    by_id = W.partitionBy("key").orderBy(F.col("vec_id").asc_nulls_last())
    few = taken.select("key", "vec_id").withColumn("place", F.row_number().over(by_id))
    few = few.where(F.col("place") <= k + 1)
    ids = few.groupBy("key").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "vec_id"))), lambda x: x["vec_id"]
        ).alias("ids")
    )
    # Equal vectors may differ in zeros at the end.
    one = taken.groupBy("key").agg(F.max("query").alias("query"), F.min("ints").alias("ints"))
    return stored(
        one.join(ids, "key").withColumn("point", F.monotonically_increasing_id()), "points"
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of numbers as rows of doubles, padded with zeros."""
    column = pa.array(column)
    sizes = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), dim))
    out[np.arange(dim) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def choose_pivots(points: DataFrame, shape: Shape) -> np.ndarray:
    """Some of the distinct vectors, by hash; all of them are known to every task."""
    n = max(1, min(MAX_PIVOTS, MAX_PIVOT_NUMBERS // max(shape.dim, 1), -(-shape.points // 64)))
    rows = points.select("key", "ints").orderBy("key").limit(n).collect()
    pivots = np.zeros((len(rows), shape.dim))
    for row, pivot in zip(rows, pivots):
        pivot[: len(row["ints"])] = row["ints"]
    return pivots


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cell = (0.5 * (pivots**2).sum(axis=1) - x @ pivots.T).argmin(axis=1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))


def place(points: DataFrame, pivots: np.ndarray, n_groups: int, shape: Shape) -> DataFrame:
    """(point, key, ids, query, first, vec, cell, distance, query_cell, query_distance):
    each vector packed, with its nearest pivot, and the nearest of the first `n_groups`."""
    schema = (
        "point long, query boolean, first long, vec binary, cell int, distance double, "
        "query_cell int, query_distance double"
    )
    dim, dtype = shape.dim, shape.dtype

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("ints"), dim)
            exact = np.zeros(x.shape, dtype=dtype)
            lists = pa.array(batch.column("ints"))
            sizes = np.diff(np.asarray(lists.offsets))
            exact[np.arange(dim) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            cell, distance = _nearest(x, pivots)
            query_cell, query_distance = _nearest(x, pivots[:n_groups])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("point"),
                    batch.column("query"),
                    batch.column("first"),
                    pa.array([v.tobytes() for v in exact], pa.binary()),
                    pa.array(cell.astype(np.int32)),
                    pa.array(distance),
                    pa.array(query_cell.astype(np.int32)),
                    pa.array(query_distance),
                ],
                names=[c.split()[0] for c in schema.split(", ")],
            )

    first = F.coalesce(F.try_element_at("ids", F.lit(1)), F.lit(NO_ID))
    return points.select("point", "query", first.alias("first"), "ints").mapInArrow(run, schema)


def thresholds(placed: DataFrame, pivots: np.ndarray, n_groups: int, k: int) -> tuple[np.ndarray, ...]:
    """For each group of queries: how many it has, its radius, and a score that at least
    k + 1 vectors reach for all of its queries (minus infinity if there are fewer)."""
    groups = placed.where("query").groupBy("query_cell").agg(
        F.count("*").alias("n"), F.max("query_distance").alias("radius")
    )
    size, radius = np.zeros(n_groups, dtype=np.int64), np.zeros(n_groups)
    for row in groups.collect():
        size[row["query_cell"]], radius[row["query_cell"]] = row["n"], row["radius"]
    near = placed.select("cell", "distance").withColumn(
        "place", F.row_number().over(W.partitionBy("cell").orderBy("distance"))
    )
    summary = near.where(F.col("place") <= k + 1).groupBy("cell").agg(F.collect_list("distance").alias("d"))
    rows = [(r["cell"], d) for r in summary.collect() for d in r["d"]]
    cells, d = np.array([c for c, _ in rows], dtype=int), np.array([x for _, x in rows])
    least = np.full(n_groups, -np.inf)
    if len(rows) > k:
        # A query is c + u with |u| <= radius, a member p + v with |v| = d.
        centres = pivots[:n_groups]
        length = np.sqrt((pivots**2).sum(axis=1))
        for i, c in enumerate(centres):
            reach = pivots[cells] @ c - length[i] * d - radius[i] * (length[cells] + d)
            least[i] = np.partition(reach, -(k + 1))[-(k + 1)]
    return size, radius, least


def replicate(
    placed: DataFrame, centres: np.ndarray, radius: np.ndarray, least: np.ndarray, parts: np.ndarray, shape: Shape
) -> DataFrame:
    """(group, part, slice, points, firsts, vecs): the vectors that a group of queries
    may need, packed by the batch."""
    dim, dtype, slices = shape.dim, shape.dtype, shape.slices
    schema = pa.schema(
        [("group", pa.int32()), ("part", pa.int32()), ("slice", pa.int32())]
        + [(c, pa.binary()) for c in ("points", "firsts", "vecs")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        for batch in batches:
            point, first = (batch.column(c).to_numpy() for c in ("point", "first"))
            x = np.frombuffer(b"".join(batch.column("vec").to_pylist()), dtype=dtype).reshape(len(point), dim)
            wide = x.astype(float)
            length = np.sqrt((wide**2).sum(axis=1))
            reach = wide @ centres.T
            slack = SLACK * (np.abs(reach) + length[:, None] * (radius + np.sqrt((centres**2).sum(axis=1))))
            needed = reach + length[:, None] * radius + slack >= least
            number += 1
            for group in np.flatnonzero(parts):
                rows = needed[:, group]
                if not rows.any():
                    continue
                sent = [a[rows].tobytes() for a in (point, first, x)]
                for part in range(parts[group]):
                    row = {"group": int(group), "part": part, "slice": number % slices}
                    row |= dict(zip(("points", "firsts", "vecs"), sent))
                    yield pa.RecordBatch.from_pylist([row], schema=schema)

    return placed.select("point", "first", "vec").mapInArrow(
        run, "`group` int, part int, slice int, points binary, firsts binary, vecs binary"
    )


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, exact, as 64-bit integers."""
    top = [int(max(a.max(initial=0), -int(a.min(initial=0)))) for a in (q, x)]
    if top[0] * top[1] * q.shape[1] < 1 << 53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    sums = q.astype(object) @ x.astype(object).T
    return np.clip(sums, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def solve(q: np.ndarray, chunks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int):
    """The n best vectors of each query: (row of q, point, score). Chunks are (points,
    firsts, vectors); equal scores go to the vector with the smaller first id."""
    empty = np.empty(0, dtype=np.int64)
    row, point, first, score = empty, empty, empty, empty
    least = np.full(len(q), np.iinfo(np.int64).min)
    for points, firsts, x in chunks:
        found = _products(q, x)
        if len(points) >= n:
            least = np.maximum(least, np.partition(found, -n, axis=1)[:, -n])
        r, c = np.nonzero(found >= least[:, None])
        row, point = np.concatenate([row, r]), np.concatenate([point, points[c]])
        first, score = np.concatenate([first, firsts[c]]), np.concatenate([score, found[r, c]])
        # ~score orders as -score does, without overflow.
        order = np.lexsort((first, ~score, row))
        row, point, first, score = (a[order] for a in (row, point, first, score))
        starts = np.searchsorted(row, row)
        kept = np.arange(len(row)) - starts < n
        row, point, first, score = (a[kept] for a in (row, point, first, score))
        last = np.arange(len(row)) - np.searchsorted(row, row) == n - 1
        least[row[last]] = score[last]
    return row, point, score


def _solved(queries: DataFrame, sent: DataFrame, shape: Shape, n: int) -> DataFrame:
    """(query_point, point, score): the n best of each slice, for each distinct query."""
    dim, dtype = shape.dim, shape.dtype

    def run(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        def vectors(parts) -> np.ndarray:
            return np.frombuffer(b"".join(parts), dtype=dtype).reshape(-1, dim)

        def chunks():
            for points, firsts, vecs in zip(held["points"], held["firsts"], held["vecs"]):
                ids, first = (np.frombuffer(b, dtype="<i8") for b in (points, firsts))
                x = np.frombuffer(vecs, dtype=dtype).reshape(len(ids), dim)
                for at in range(0, len(ids), CHUNK):
                    yield tuple(a[at : at + CHUNK] for a in (ids, first, x))

        names = ["query_point", "point", "score"]
        if asked.empty or held.empty:
            return pd.DataFrame({c: np.empty(0, dtype=np.int64) for c in names})
        row, point, score = solve(vectors(asked["vec"]), chunks(), n)
        return pd.DataFrame(dict(zip(names, (asked["point"].to_numpy()[row], point, score))))

    keys = ["group", "part", "slice"]
    return (
        queries.groupBy(*keys)
        .cogroup(sent.groupBy(*keys))
        .applyInPandas(run, "query_point long, point long, score long")
    )


def nearest(rows: DataFrame, vec_id: Column, vector: Column, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score for the rows where `is_query` holds."""
    taken = whole_vectors(rows, vec_id, vector, is_query)
    points = distinct_points(taken, k)
    largest = F.greatest(F.abs(F.coalesce(F.array_max("ints"), F.lit(0))), F.abs(F.coalesce(F.array_min("ints"), F.lit(0))))
    seen = points.agg(
        F.count("*"), F.count_if("query"), F.max(F.size("ints")), F.max(largest)
    ).first()
    if not seen[0] or not seen[1]:
        empty = "query_id long, rank int, vec_id long, score long"
        return rows.sparkSession.createDataFrame([], empty)
    shape = Shape(seen[0], seen[1], max(seen[2], 1), seen[3])
    pivots = choose_pivots(points, shape)
    # Each group of queries costs a copy of the vectors that it cannot exclude.
    n_groups = min(len(pivots), max(8, shape.queries // GROUP_QUERIES))
    placed = stored(place(points, pivots, n_groups, shape), "placed")
    size, radius, least = thresholds(placed, pivots, n_groups, k)
    parts = -(-size // GROUP_QUERIES)
    sent = replicate(placed, pivots[:n_groups], radius, least, parts, shape)
    part = F.element_at(F.lit([int(p) for p in parts]), F.col("query_cell") + 1)
    queries = placed.where("query").select(
        F.col("query_cell").alias("group"),
        F.pmod(F.xxhash64("point"), part).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(shape.slices - 1))).alias("slice"),
        "point",
        "vec",
    )
    return _per_row(taken, points, _solved(queries, sent, shape, k + 1), k)


def _per_row(taken: DataFrame, points: DataFrame, solved: DataFrame, k: int) -> DataFrame:
    """From distinct vectors to rows. Of a query's k + 1 best vectors the rows are at most
    (k + 1) squared; the first k + 1 of them hold its answer and perhaps its own row."""
    ids = points.select("point", "ids", F.coalesce(F.try_element_at("ids", F.lit(1)), F.lit(NO_ID)).alias("first"))
    best = W.partitionBy("query_point").orderBy(F.desc("score"), "first")
    winners = solved.join(ids, "point").withColumn("place", F.row_number().over(best))
    winners = winners.where(F.col("place") <= k + 1)
    row = F.struct(
        (-F.col("score").cast("decimal(38,0)")).alias("worse"),
        F.col("vec_id").isNull().alias("none"),
        "vec_id",
        "score",
        (F.col("point") == F.col("query_point")).alias("own"),
    )
    listed = (
        winners.select("query_point", "point", "score", F.explode("ids").alias("vec_id"))
        .groupBy("query_point")
        .agg(F.slice(F.array_sort(F.collect_list(row)), 1, k + 1).alias("found"))
    )
    asked = taken.where("query").select(F.col("vec_id").alias("query_id"), "key")
    known = points.where("query").select(F.col("point").alias("query_point"), "key")
    matched = asked.join(known.join(listed, "query_point"), "key")
    # Its own row: one of its own vector's rows with its id.
    mine = F.array_position(
        F.transform("found", lambda x: x["own"] & x["vec_id"].eqNullSafe(F.col("query_id"))), True
    )
    others = F.filter("found", lambda x, i: i + 1 != mine)
    return matched.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.score"
    )
