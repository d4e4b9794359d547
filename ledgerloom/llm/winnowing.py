"""Operator 10: document fingerprints by winnowing (Schleimer et al., 2003).

Every k-gram of code points has a rolling hash. In each window of w consecutive
k-grams the smallest hash is chosen, the rightmost of equal ones, and kept with its
position. Two texts that share a passage of w + k - 1 code points or more share a
chosen hash. A text shorter than k is one gram; fewer than w grams are one window.

``neighbours`` also compares each document with the next by doc_id. Documents are
range-partitioned by doc_id once; the first document of each range goes to the range
before it as well, so a task sees each document with its successor and keeps two.

Null texts count as empty, whose fingerprint is empty; two empty fingerprints are
alike (1.0). Null doc_ids come last, equal ones are ordered by text; rows equal in
both are neighbours of each other. The only document is its own successor. Other
columns are ignored. Very long texts are hashed in stretches.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from .shared import stored, text_of

GRAM, WINDOW = 10, 40
STRETCH = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Bytes of text in a range of doc_ids, about, and ranges at most: their bounds and
#: first documents are broadcast.
RANGE_BYTES = 32 << 20
MAX_RANGES = 1 << 15


def _grams(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all k-grams: a polynomial over the code points, mixed."""
    with np.errstate(over="ignore"):
        n = len(points) - k + 1
        rolled = points[:n].astype(np.uint64)
        for j in range(1, k):
            rolled = rolled * BASE + points[j : j + n]
        rolled ^= rolled >> np.uint64(29)
        rolled *= np.uint64(0xBF58476D1CE4E5B9)
        return rolled >> np.uint64(32)


def winnow(text: str, k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (32 bits) and positions (code points) that are chosen, by position."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if not len(points):
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    k = min(k, len(points))
    w = min(w, len(points) - k + 1)
    n_windows = len(points) - k + 1 - w + 1
    hashes, places = [], []
    for at in range(0, n_windows, STRETCH):
        to = min(at + STRETCH, n_windows)
        grams = _grams(points[at : to + w - 1 + k - 1], k)
        # The smaller key has the smaller hash, or else stands further right.
        key = (grams << np.uint64(32)) | np.arange(len(grams), 0, -1, dtype=np.uint64)
        have = 1
        while have < w:
            step = min(have, w - have)
            key = np.minimum(key[:-step], key[step:])
            have += step
        chosen = key[np.append(True, key[1:] != key[:-1])]
        hashes.append(chosen >> np.uint64(32))
        places.append(at + len(grams) - (chosen & np.uint64(0xFFFFFFFF)).astype(np.int64))
    hashes, places = np.concatenate(hashes), np.concatenate(places)
    new = np.append(True, places[1:] != places[:-1])
    return hashes[new], places[new]


def packed(hashes: np.ndarray, places: np.ndarray) -> str:
    """The fingerprint as text: base64 of 32-bit hashes, then 32-bit positions."""
    return base64.b64encode(hashes.astype("<u4").tobytes() + places.astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of distinct hashes in common (Jaccard), 0 to 1; a and b are distinct."""
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def edited(text: str, following: str) -> str:
    """``text`` whose last half (rounded down) is the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _in_ranges(docs: DataFrame) -> DataFrame:
    """(range, later, key, none, doc_id, text): rows dealt to ranges of doc_id, each
    range's first document also as the last row of the range before."""
    spark = docs.sparkSession
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit((1 << 63) - 1))
    keys = stored(docs.select(key.alias("key"), F.octet_length(text_of(docs)).alias("bytes")), "keys")
    # By the size of the texts, and for a small table by the tasks there are.
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    n = max(1, min(max(wide, -(-total // RANGE_BYTES)), MAX_RANGES))
    cuts = keys.agg(
        F.percentile_approx(
            "key", [i / n for i in range(1, n)] or [0.5], min(100 * n, 1_000_000)
        ).alias("c")
    ).first()["c"]
    splits = [-float("inf"), *sorted({float(c) for c in cuts or [0]}), float("inf")]
    bucket = Bucketizer(splits=splits, inputCol="number", outputCol="bucket")

    def dealt(rows: DataFrame) -> DataFrame:
        rows = bucket.transform(rows.withColumn("number", F.col("key").cast("double")))
        return rows.withColumn("range", F.col("bucket").cast("int")).drop("number", "bucket")

    # One row for each range, so bounded; the range before it, the first's is the last.
    firsts = dealt(keys.select("key")).groupBy("range").agg(F.min("key").alias("key")).orderBy("range").collect()
    before = [(r["key"], firsts[i - 1]["range"]) for i, r in enumerate(firsts)]
    also = F.broadcast(spark.createDataFrame(before, "key long, before int"))
    rows = dealt(
        docs.select(
            key.alias("key"),
            docs["doc_id"].isNull().alias("none"),
            docs["doc_id"].cast("long").alias("doc_id"),
            text_of(docs).alias("text"),
        )
    )
    copies = F.when(
        F.col("before").isNotNull(),
        F.array(
            F.struct("range", F.lit(False).alias("later")),
            F.struct(F.col("before").alias("range"), F.lit(True).alias("later")),
        ),
    ).otherwise(F.array(F.struct("range", F.lit(False).alias("later"))))
    rows = rows.join(also, "key", "left").withColumn("to", F.explode(copies))
    return (
        rows.select("to.range", "to.later", "key", "none", "text")
        # Range i to partition i: hashed, some partitions would get several, some none.
        .repartitionById(len(splits) - 1, "range")
        .sortWithinPartitions("range", "later", "key", "none", "text")
    )


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def neighbours(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Each document's fingerprint, its edited text's, and how alike it is to that and
    to the next document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the document that waits for its successor
        for batch in batches:
            out = []
            for at, later, key, none, text in zip(*(batch[c].tolist() for c in ("range", "later", "key", "none", "text"))):
                if held and held[0] != at:
                    raise RuntimeError("a range without the next one's first document")
                if later and held is None:
                    continue  # more rows with the next range's first doc_id
                hashes, places = winnow(text, k, w)
                now = (at, None if none else key, text, hashes, places, np.unique(hashes))
                if held:
                    _, doc_id, own, h, p, distinct = held
                    other = edited(own, text)
                    eh, ep = winnow(other, k, w)
                    out.append(
                        (
                            doc_id,
                            len(own),
                            hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(),
                            packed(h, p),
                            packed(eh, ep),
                            likeness(distinct, np.unique(eh)),
                            likeness(distinct, now[5]),
                        )
                    )
                held = None if later else now
            if out:
                names = [c.split()[0] for c in SCHEMA.split(", ")]
                columns = dict(zip(names, zip(*out)))
                # Not by way of doubles, which a null among the ids would bring.
                yield pd.DataFrame(columns | {"doc_id": pd.array(columns["doc_id"], dtype="Int64")})

    return _in_ranges(docs).mapInPandas(run, SCHEMA)
