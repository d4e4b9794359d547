"""What several operators need: tables that cut lineage, and connected components."""

from __future__ import annotations

import re
import tempfile
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAX_ROUNDS = 100


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach. Only where driver and executors are one
    process, as in tests, a folder of this machine does as well and is set for the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: computed once,
    with no lineage, and safe against lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column].cast("string"), F.lit(""))


def sent_ids(doc_id: Column) -> list[Column]:
    """doc_id for a pandas batch, where a null would turn all ids into doubles: null as
    0, and a flag."""
    number = doc_id.cast("long")
    return [F.coalesce(number, F.lit(0)).alias("doc_id"), number.isNull().alias("no_id")]


def received_ids(batch: pd.DataFrame) -> pd.Series:
    """The doc_ids that `sent_ids` sent, each exact."""
    return batch["doc_id"].astype("Int64").mask(batch["no_id"].astype(bool))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (a, b), both long: a row
    (node, root) for each node that has an edge to another one, root the smallest
    node of its component, itself included.

    Alternates the large-star and small-star steps (Kiveris et al., 2014) until
    nothing changes. Each round is a stored table; a hub's edges are joined to its
    minimum by a sort-merge join whose two sides are both exchanged, so that AQE
    can split the hub. Only counts reach the driver.
    """
    now = stored(_downward(edges), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        size = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if size == state or not size[0]:
            break
        state = size
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(stored(least, "least"), "a")
            .where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = stored(_downward(large), "edges")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(
            _downward(small.unionByName(least.select("a", F.col("m").alias("b")))), "edges"
        )
    else:
        raise RuntimeError(f"components: no end after {MAX_ROUNDS} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger node to its smaller one; no loops."""
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct()
    )
