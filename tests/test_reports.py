"""Reports on hand-made and random tables against the plain SQL they stand for."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import reports
from ledgerloom.schemas import BLOCKS, TRANSACTIONS

JOIN_SQL = """
    FROM blocks b LEFT JOIN transactions t
      ON b.blockNumber = t.blockNumber AND b.chainName = t.chainName
"""


def blocks_frame(spark, rows):
    return spark.createDataFrame(rows, "chainName STRING, blockNumber BIGINT, miner STRING")


def tx_frame(spark, rows):
    return spark.createDataFrame(rows, "chainName STRING, blockNumber BIGINT, txHash STRING")


@pytest.fixture(scope="module")
def skewed(spark):
    """Random rows with repeated blocks, nulls everywhere, and a third of both
    tables on one block."""
    rng = random.Random(3)

    def pick(values):
        return rng.choice([*values, None])

    def block():
        hot = rng.random() < 0.34
        return ("bsc", 8) if hot else (pick(["bsc", "ethereum"]), pick(range(10)))

    blocks = [(*block(), pick(["m1", "m2", "m3"])) for _ in range(300)]
    txs = [(*block(), pick([f"0x{i}"])) for i in range(900)]
    return blocks_frame(spark, blocks).cache(), tx_frame(spark, txs).cache()


def as_set(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def sql(spark, skewed, text):
    blocks, txs = skewed
    blocks.createOrReplaceTempView("blocks")
    txs.createOrReplaceTempView("transactions")
    return spark.sql(text)


def test_block_counts_equal_the_raw_join(spark, skewed):
    expected = sql(
        spark,
        skewed,
        f"SELECT b.blockNumber, b.miner, count(t.txHash) {JOIN_SQL} GROUP BY b.blockNumber, b.miner",
    )
    assert as_set(reports.block_tx_counts(*skewed)) == as_set(expected)


def test_block_counts_by_chain_equal_the_raw_join(spark, skewed):
    expected = sql(
        spark,
        skewed,
        f"SELECT b.chainName, b.blockNumber, b.miner, count(t.txHash) {JOIN_SQL} "
        "GROUP BY b.chainName, b.blockNumber, b.miner",
    )
    assert as_set(reports.block_tx_counts_by_chain(*skewed)) == as_set(expected)


@pytest.mark.parametrize("k", [1, 5, 1000])
def test_top_blocks_equal_the_raw_join(spark, skewed, k):
    expected = sql(
        spark,
        skewed,
        f"SELECT b.blockNumber, b.miner, count(t.txHash) {JOIN_SQL} GROUP BY b.blockNumber, b.miner "
        f"ORDER BY b.blockNumber DESC, b.miner LIMIT {k}",
    )
    actual = [tuple(r) for r in reports.top_blocks(*skewed, k=k).collect()]
    assert actual == [tuple(r) for r in expected.collect()]


def test_same_block_number_on_two_chains(spark):
    blocks = blocks_frame(spark, [("bsc", 1, "m"), ("ethereum", 1, "m"), ("bsc", 2, "m")])
    txs = tx_frame(spark, [("bsc", 1, "a"), ("ethereum", 1, "b"), ("ethereum", 1, "c")])
    assert as_set(reports.block_tx_counts(blocks, txs)) == {(1, "m", 3), (2, "m", 0)}
    assert as_set(reports.block_tx_counts_by_chain(blocks, txs)) == {
        ("bsc", 1, "m", 1),
        ("ethereum", 1, "m", 2),
        ("bsc", 2, "m", 0),
    }


def test_reports_on_empty_tables(spark):
    blocks, txs = blocks_frame(spark, []), spark.createDataFrame([], TRANSACTIONS.bronze_schema)
    assert reports.block_tx_counts(blocks, txs).count() == 0
    assert reports.top_blocks(blocks, txs).count() == 0
    assert reports.latest_transactions(txs).count() == 0
    assert reports.daily_tx_counts(txs).count() == 0
    assert reports.chain_tip(blocks).count() == 0
    one = blocks_frame(spark, [("bsc", 1, "m")])
    assert as_set(reports.top_blocks(one, txs)) == {(1, "m", 0)}


def latest(spark, stamps, k=5):
    """Hashes of the newest transactions, from rows with the given times."""
    rows = [
        ("bsc", f"h{i:02}", i, "b", "f", "t", "1", t, 0) for i, t in enumerate(stamps)
    ]
    txs = spark.createDataFrame(rows, TRANSACTIONS.message_schema)
    from ledgerloom.functions.columns import partition_date

    dated = txs.withColumn("dt", partition_date(F.col("timestamp")))
    with_dt = [r.txHash for r in reports.latest_transactions(dated, k).collect()]
    assert with_dt == [r.txHash for r in reports.latest_transactions(txs, k).collect()]
    by_rule = sorted(
        enumerate(stamps), key=lambda p: (p[1] is None, -(p[1] or 0), p[0])
    )
    assert with_dt == [f"h{i:02}" for i, _ in by_rule[:k]]


def test_latest_breaks_ties_by_hash(spark):
    latest(spark, [5] * 20)
    latest(spark, [1, 9, 9, 9, 9, 9, 9, 2])


def test_latest_with_missing_times(spark):
    latest(spark, [None, 3, None, 8])
    latest(spark, [None] * 9)
    latest(spark, [None, None, 1, 2, 3, 4, 5, 6])


def test_latest_with_times_outside_the_calendar(spark):
    day = 86_400
    ms = 1_700_000_000_000  # milliseconds by mistake: the year 55840
    latest(spark, [1_700_000_000 + i * day for i in range(9)] + [ms, 2**62])
    latest(spark, [ms + i for i in range(7)] + [5, 6])
    latest(spark, [-(10**12), -(10**12) - 5, None, -5])


def lake_tables(spark, tmp_path):
    """A small parquet lake in the bronze layout, 40 days of 250 rows."""
    tx = spark.range(10_000).select(
        F.lit("bsc").alias("chainName"),
        F.concat(F.lit("0x"), "id").alias("txHash"),
        (F.col("id") / 10).cast("bigint").alias("blockNumber"),
        *[F.lit("x" * 40).alias(c) for c in ("blockHash", "from", "to")],
        F.lit("1").alias("value"),
        (F.lit(1_700_000_000) + F.col("id") * 345).alias("timestamp"),
        F.lit(0).cast("bigint").alias("ingestionTimestamp"),
        F.date_from_unix_date(
            F.floor((F.lit(1_700_000_000) + F.col("id") * 345) / 86_400).cast("int")
        )
        .cast("string")
        .alias("dt"),
    )
    path = str(tmp_path / "tx")
    tx.coalesce(1).write.partitionBy("chainName", "dt").parquet(path)
    schema = TRANSACTIONS.message_schema.add("dt", "string")
    return spark.read.schema(schema).parquet(path)


def scan_metrics(df):
    """(name of the first read column, files read) of every scan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            found.append((node.output().mkString(","), node.metrics().apply("numFiles").value()))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return found


def test_latest_reads_wide_columns_of_the_last_days_only(spark, tmp_path):
    txs = lake_tables(spark, tmp_path)
    assert len(txs.inputFiles()) > 35
    report = reports.latest_transactions(txs)
    scans = scan_metrics(report)
    wide = [files for columns, files in scans if "value" in columns]
    assert sorted(wide) == [0, 1], scans
    text = report._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text
    newest = [r.txHash for r in report.collect()]
    assert newest == [f"0x{i}" for i in range(9999, 9994, -1)]


def test_counts_run_as_hash_aggregates(spark, tmp_path):
    txs = lake_tables(spark, tmp_path)
    plan = reports.daily_tx_counts(txs)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "ReadSchema: struct<>" in plan, "partition columns only: no data column is read"


def test_hot_join_key_is_split(spark):
    """One block with very many miners: no aggregate can shrink it, so the join
    has to be in the form that AQE splits."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    hot = spark.range(20_000).select(
        F.lit("bsc").alias("chainName"),
        F.lit(7).cast("bigint").alias("blockNumber"),
        F.concat(F.lit("m"), "id").alias("miner"),
    )
    cold = spark.range(20_000).select(
        F.lit("bsc").alias("chainName"),
        (F.col("id") + 100).alias("blockNumber"),
        F.concat(F.lit("m"), "id").alias("miner"),
    )
    txs = spark.range(40_000).select(
        F.lit("bsc").alias("chainName"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_000).cast("bigint").alias("blockNumber"),
        F.col("id").cast("string").alias("txHash"),
    )
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        counts = reports.block_tx_counts(hot.union(cold).repartition(8), txs)
        rows = counts.agg(F.sum("tx_count"), F.count("*"))
        [(total, n)] = rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    expected_hot = txs.where("blockNumber = 7").count()
    expected_cold = txs.where("blockNumber >= 100").count()
    assert (total, n) == (20_000 * expected_hot + expected_cold, 40_000)
    assert "SortMergeJoin(skew=true)" in plan


def test_blocks_schema_is_enough(spark):
    blocks = spark.createDataFrame([], BLOCKS.bronze_schema)
    assert reports.shard_counts(blocks).count() == 0
