"""Operator 7: repeated passages by content-defined chunking.

A gear hash rolls over the UTF-8 bytes of a text; a chunk ends where its lowest bits
are zero, so the ends move with the text when something is inserted before it. Chunks
are deduplicated by digest over all documents. Runs of neighbouring chunks that other
documents have too are repeated passages.

A passage reaches into the chunks around its run at most. A run is reported if it has
``RUN_WORDS`` words, and with the two chunks around it ``PASSAGE_WORDS``. Where a
chunk occurs first (smallest doc_id, nulls last, then the first row read) it is kept; a
run of which only some chunks are kept is a row for each part, however short.

Null texts count as empty and have no chunk. Repeats inside one row alone are not
reported; rows that repeat a text are, whatever their doc_id. Other columns are
ignored. Chunks are at most ``LONGEST`` bytes, in texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from .shared import received_ids, sent_ids, stored, text_of

#: A chunk ends after a byte with probability 2^-CUT_BITS, not before SHORTEST bytes.
CUT_BITS, SHORTEST, LONGEST = 5, 12, 256
PASSAGE_WORDS, RUN_WORDS = 50, 10

_GEAR = np.array([xxhash.xxh64_intdigest(bytes([i]), seed=7) for i in range(256)], dtype=np.uint64)
STRETCH = 1 << 20


def cuts(data: bytes) -> np.ndarray:
    """Ends of the chunks of ``data``, in bytes. Only whole characters are cut off.

    The lowest CUT_BITS bits of the gear hash depend on as many bytes, so the hash of
    all places is a sum of shifted table rows.
    """
    n = len(data)
    if not n:
        return np.empty(0, dtype=np.int64)
    found = []
    for at in range(0, n, STRETCH):
        lead = min(at, CUT_BITS - 1)
        raw = np.frombuffer(data[at - lead : at + STRETCH], dtype=np.uint8)
        gear = _GEAR[raw]
        rolled = gear.copy()
        for j in range(1, CUT_BITS):
            rolled[j:] += gear[:-j] << np.uint64(j) if len(gear) > j else np.uint64(0)
        ends = np.flatnonzero((rolled[lead:] & np.uint64((1 << CUT_BITS) - 1)) == 0) + at + 1
        found.append(ends)
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.concatenate(found)
    ends = ends[ends < n]
    ends = ends[(raw[ends] & 0xC0) != 0x80].tolist() + [n]
    out, last = [], 0
    for end in ends:
        while end - last > LONGEST:
            last += LONGEST
            while last > 0 and raw[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        if end - last >= SHORTEST or end == n:
            out.append(end)
            last = end
    return np.array(sorted(set(out)), dtype=np.int64)


SCHEMA = (
    "row_id long, doc_id long, digests array<long>, starts array<int>, ends array<int>, "
    "words array<int>"
)


def _chunks_of(text: str) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    data = text.encode("utf-8", "surrogatepass")
    ends = cuts(data)
    starts = np.append(0, ends[:-1]) if len(ends) else ends
    digests = [
        xxhash.xxh3_64_intdigest(data[a:b]) - (1 << 63) for a, b in zip(starts.tolist(), ends.tolist())
    ]
    raw = np.frombuffer(data, dtype=np.uint8)
    points = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begins = np.append(0, np.cumsum(~blank & np.append(True, blank[:-1]))) if len(raw) else np.zeros(1)
    return digests, points[starts], points[ends], begins[ends] - begins[starts]


def chunk(docs: DataFrame) -> DataFrame:
    """row_id, doc_id and the chunks of each document, stored: digests, starts and ends
    (code points), and the words that begin in each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [_chunks_of(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "row_id": batch["row_id"],
                    "doc_id": received_ids(batch),
                    "digests": [p[0] for p in parts],
                    "starts": [p[1] for p in parts],
                    "ends": [p[2] for p in parts],
                    "words": [p[3] for p in parts],
                }
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        *sent_ids(docs["doc_id"]),
        text_of(docs).alias("text"),
    )
    return stored(rows.mapInPandas(run, SCHEMA), "chunks")


def repeats(docs: DataFrame) -> DataFrame:
    """A row for each repeated passage of a document, or each part of one that is kept
    throughout or not at all: doc_id, start_char, end_char (end
    exclusive), n_words, n_chunks, kept (it occurs here first), first_doc_id (where its
    first chunk does), n_copies (of its most frequent chunk)."""
    docs_chunks = chunk(docs)
    at = F.posexplode(F.arrays_zip("digests", "starts", "ends", "words"))
    row_order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")
    seen = docs_chunks.select("row_id", "doc_id", F.explode("digests").alias("digest"))
    shared = (
        seen.groupBy("digest")
        .agg(
            F.count("*").alias("n_copies"),
            F.min(row_order).alias("first"),
            F.max("row_id").alias("last_row"),
            F.min("row_id").alias("first_row"),
        )
        .where("last_row > first_row")
        .select(
            "digest",
            "n_copies",
            F.col("first.row_id").alias("first_row"),
            F.col("first.doc_id").alias("first_doc_id"),
        )
    )
    word = lambda i: F.coalesce(F.get("words", i), F.lit(0))
    every = (
        docs_chunks.select("row_id", "doc_id", "words", at.alias("place", "c"))
        .withColumns({"before": word(F.col("place") - 1), "after": word(F.col("place") + 1)})
        .select(
            "row_id",
            "doc_id",
            "place",
            F.col("c.digests").alias("digest"),
            F.col("c.starts").alias("start_char"),
            F.col("c.ends").alias("end_char"),
            F.col("c.words").alias("n_words"),
            "before",
            "after",
        )
    )
    marked = every.join(stored(shared, "shared"), "digest").withColumn(
        "kept", F.col("first_row") == F.col("row_id")
    )
    run = F.col("place") - F.row_number().over(W.partitionBy("row_id", "kept").orderBy("place"))
    runs = (
        marked.withColumn("run", run)
        .groupBy("row_id", "doc_id", "kept", "run")
        .agg(
            F.min("start_char").cast("long").alias("start_char"),
            F.max("end_char").cast("long").alias("end_char"),
            F.sum("n_words").alias("n_words"),
            F.count("*").alias("n_chunks"),
            F.min_by("first_doc_id", "place").alias("first_doc_id"),
            F.max("n_copies").alias("n_copies"),
            F.min_by("before", "place").alias("before"),
            F.max_by("after", "place").alias("after"),
            F.min("place").alias("place"),
        )
    )
    # Parts that follow each other without a gap are one run, which is tested as a whole.
    in_row = W.partitionBy("row_id").orderBy("place")
    earlier = F.coalesce(F.sum("n_chunks").over(in_row.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumn("whole", F.col("place") - earlier)
    whole = W.partitionBy("row_id", "whole")
    runs = runs.withColumns(
        {
            "run_words": F.sum("n_words").over(whole),
            "around": F.min_by("before", "place").over(whole) + F.max_by("after", "place").over(whole),
        }
    )
    long_enough = (F.col("run_words") >= RUN_WORDS) & (F.col("run_words") + F.col("around") >= PASSAGE_WORDS)
    return runs.where(long_enough).drop(
        "row_id", "run", "before", "after", "place", "whole", "run_words", "around"
    )
