"""Operator 1: exact deduplication with a heavy-hitter split.

A summary of bounded size (the Misra-Gries scheme of ``DataFrame.stat.freqItems``)
names every digest that may hold more than ``SUPPORT`` of all rows. These few are
counted exactly; the verified ones are broadcast, and their rows are settled inside
the map tasks. All other digests go through ordinary shuffles, where no group can
hold more than that share.

Rows: one for each input row. A null text counts as empty. Of equal texts the row
with the largest doc_id stays (a null doc_id is smaller than any); rows that agree
in text and doc_id both count as that row here, and ``drop_copies`` keeps one.
Other columns are ignored here and carried by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .shared import stored, text_of

#: A digest with more than this share of all rows is settled without a shuffle.
#: The summary, and so the broadcast, has at most 1 / SUPPORT = 500 entries.
SUPPORT = 0.002


def digests(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.sha2(text_of(docs), 256).alias("digest"))


def heavy_hitters(keys: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(digest, keep_id, group_size) of each digest with more than ``support`` of
    the rows of ``keys`` (doc_id, digest)."""
    names = keys.stat.freqItems(["digest"], support).select(
        F.explode("digest_freqItems").alias("digest")
    )
    total = keys.agg((F.count("*") * support).alias("least"))
    counted = (
        keys.join(F.broadcast(names), "digest")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    return (
        counted.join(F.broadcast(total))
        .where("group_size > least")
        .drop("least")
    )


def resolve(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row."""
    keys = stored(digests(docs), "digests")
    heavy = stored(heavy_hitters(keys, support), "heavy")
    split = keys.join(F.broadcast(heavy), "digest", "left")
    group = W.partitionBy("digest")
    rest = (
        split.where("group_size IS NULL")
        .withColumn("keep_id", F.max("doc_id").over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    return (
        split.where("group_size IS NOT NULL")
        .unionByName(rest)
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
    )


def drop_copies(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One whole row of ``docs`` for each text. Copies of a heavy digest leave in
    the map tasks; of the rest each map task sends one row per text (window group
    limit), and rows equal in text and doc_id are told apart by their other columns."""
    columns = docs.columns
    heavy = stored(heavy_hitters(stored(digests(docs), "digests"), support), "heavy")
    rows = docs.select(
        F.struct(*[docs[c] for c in columns]).alias("row"),
        docs["doc_id"].cast("long").alias("id"),
        F.sha2(text_of(docs), 256).alias("digest"),
    )
    rest = rows.join(F.broadcast(heavy.drop("group_size")), "digest", "left").where(
        F.col("keep_id").isNull() | F.col("id").eqNullSafe(F.col("keep_id"))
    )
    ties = [F.xxhash64(F.to_json("row"))]
    first = F.row_number().over(
        W.partitionBy("digest").orderBy(F.col("id").desc_nulls_last(), *ties)
    )
    return rest.withColumn("place", first).where("place = 1").select("row.*")
