"""Watermarks, data tests, models, the daily gate, bundles and compaction."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ledgerloom.operators import dedup, quality, sync_state
from ledgerloom.operators.bundle import BUNDLE_SCHEMA, split_bundles
from ledgerloom.operators.dedup import dedup_ingested
from ledgerloom.operators.joins import broadcast_if_small
from ledgerloom.operators.sync_state import (
    SyncStateStore,
    advance,
    chain_tips,
    high_watermark,
    init_tasks,
    pending,
)
from ledgerloom.plans import compaction, models
from ledgerloom.fixed import GOLD_WHALES as GOLD, SILVER_TRANSACTIONS as SILVER
from ledgerloom.plans.daily import run_daily, silver_rows, silver_table
from ledgerloom.schemas import BLOCKS, LOGS, SYNC_STATE_SCHEMA, TRANSACTIONS
from ledgerloom.sources.feeds import Feed
from ledgerloom.sources.lake import Lake, staged_files
from ledgerloom.streaming.bronze import await_all, start_bronze

ONCE = {"availableNow": True}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- watermarks -------------------------------------------------------------


@pytest.fixture
def state(spark):
    return spark.sql(
        "SELECT 'ethereum' AS task_name, 10050L AS last_processed_block, "
        "TIMESTAMP '2020-01-01 00:00:00' AS updated_at "
        "UNION ALL SELECT 'bsc', 20000L, TIMESTAMP '2020-01-01 00:00:00'"
    )


def block_numbers(spark, rows):
    return spark.createDataFrame(rows, "chainName STRING, blockNumber BIGINT")


def levels(df):
    return {r.task_name: r.last_processed_block for r in df.collect()}


def test_high_watermark(state):
    assert [r[0] for r in high_watermark(state, "bsc").collect()] == [20000]
    assert high_watermark(state, "polygon").count() == 0


def test_init_keeps_what_is_there(spark, state):
    tasks = spark.createDataFrame([("bsc",), ("polygon",), ("polygon",), (None,)], "task_name STRING")
    assert levels(init_tasks(state, tasks)) == {"ethereum": 10050, "bsc": 20000, "polygon": 10000}
    assert init_tasks(state, tasks).count() == 3


def test_advance_never_moves_back(spark, state):
    rows = block_numbers(spark, [("ethereum", 10060), ("ethereum", 1), ("bsc", 30), ("polygon", 7), ("x", None), (None, 9)])
    moved = advance(state, chain_tips(rows))
    assert levels(moved) == {"ethereum": 10060, "bsc": 20000, "polygon": 7}
    old = moved.where("updated_at = TIMESTAMP '2020-01-01 00:00:00'")
    assert [r.task_name for r in old.collect()] == ["bsc"]


def test_pending(spark, state):
    rows = block_numbers(
        spark,
        [("ethereum", 10050), ("ethereum", 10051), ("bsc", 15000), ("polygon", 10000), ("polygon", 10001), ("bsc", None)],
    )
    found = sorted(map(tuple, pending(rows, state).collect()))
    assert found == [("ethereum", 10051), ("polygon", 10001)]
    assert "Join" not in plan_of(pending(rows, state))


@pytest.mark.parametrize("limit", [100, 1, 0])
def test_pending_by_filter_and_by_join_agree(spark, state, monkeypatch, limit):
    monkeypatch.setattr(sync_state, "MAX_FILTER_CHAINS", limit)
    numbers = [1, 10_000, 10_001, 10_050, 10_051, 10_060, 10_061, 20_000, 20_001, None]
    rows = block_numbers(
        spark, [(c, n) for c in ("ethereum", "bsc", "polygon", None) for n in numbers]
    )
    low = {"ethereum": 10_050, "bsc": 20_000}
    expected = {
        (c, n) for c, n in map(tuple, rows.collect()) if n and n > low.get(c, 10_000)
    }
    found = pending(rows, state)
    assert ("Join" in plan_of(found)) == (limit < 2)
    assert set(map(tuple, found.collect())) == expected

    tips = block_numbers(spark, [("ethereum", 10_060), ("polygon", 10_050)])
    upto = advance(state, chain_tips(tips))
    high = {"ethereum": 10_060, "bsc": 20_000, "polygon": 10_050}
    expected = {(c, n) for c, n in expected if c in high and n <= high[c]}
    assert set(map(tuple, pending(rows, state, upto=upto).collect())) == expected


@pytest.mark.parametrize("limit", [100, 0])
def test_pending_of_an_odd_state(spark, monkeypatch, limit):
    """No watermark, no task, a task twice: the same answer from both forms."""
    monkeypatch.setattr(sync_state, "MAX_FILTER_CHAINS", limit)
    state = spark.createDataFrame(
        [("bsc", None), (None, 5), ("eth", 10_010), ("eth", 10_020)],
        "task_name STRING, last_processed_block BIGINT",
    )
    numbers = (10_000, 10_001, 10_015, 10_021)
    rows = block_numbers(spark, [(c, n) for c in ("bsc", "eth", "new", None) for n in numbers])
    found = sorted(map(tuple, pending(rows, state).collect()), key=str)
    above = [n for n in numbers if n > 10_000]
    expected = [("eth", 10_021)] + [(c, n) for c in ("bsc", "new", None) for n in above]
    assert found == sorted(expected, key=str)


def test_pending_reaches_the_scan(spark, state, tmp_path):
    path = str(tmp_path / "blocks")
    rows = spark.range(100).select(F.lit("bsc").alias("chainName"), F.col("id").alias("blockNumber"))
    rows.write.partitionBy("chainName").parquet(path)
    upto = advance(state, chain_tips(block_numbers(spark, [("bsc", 20_010)])))
    found = pending(spark.read.parquet(path), state, upto=upto)
    assert "GreaterThan(blockNumber,20000)" in plan_of(found).replace(" ", "")


def test_small_side_is_broadcast_only_if_it_is_small(spark):
    side = spark.range(11).withColumnRenamed("id", "k")
    rows = spark.range(100).withColumnRenamed("id", "k")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = rows.join(broadcast_if_small(side, 11), "k")
        large = rows.join(broadcast_if_small(side, 10), "k")
        assert "BroadcastHashJoin" in plan_of(small)
        assert "SortMergeJoin" in plan_of(large)
        assert small.count() == large.count() == 11
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_state_store_versions(spark, tmp_path):
    store = SyncStateStore(spark, str(tmp_path / "state"))
    assert store.version() == 0 and store.read().count() == 0
    store.init(["ethereum", "bsc"])
    store.init(["bsc"])
    assert levels(store.read()) == {"ethereum": 10000, "bsc": 10000}

    tips = chain_tips(block_numbers(spark, [("bsc", 10007)]))
    number = store.stage(advance(store.read(), tips))
    assert levels(store.read())["bsc"] == 10000, "staged, not yet in force"
    number = store.stage(advance(store.read(), tips))  # a second attempt takes its place
    store.commit(number)
    assert levels(store.read()) == {"ethereum": 10000, "bsc": 10007}
    assert store.read().columns == SYNC_STATE_SCHEMA.names


def make(spark, entity, rows):
    full = [tuple(row.get(c) for c in entity.columns) for row in rows]
    return spark.createDataFrame(full, entity.message_schema)


def bundle_rows(numbers):
    blocks = [dict(chainName="bsc", blockNumber=n, blockHash=f"b{n}") for n in numbers]
    txs = [dict(chainName="bsc", blockNumber=n, txHash=f"t{n}-{i}") for n in numbers for i in range(n % 3)]
    logs = [dict(chainName="bsc", blockNumber=n, logIndex=0, address="a") for n in numbers]
    return blocks, txs, logs


def test_split_bundles(spark):
    blocks, txs, logs = bundle_rows(range(1, 7))

    def struct(entity, row):
        return tuple(row.get(c) for c in entity.columns)

    bundles = spark.createDataFrame(
        [
            (
                struct(BLOCKS, b),
                [struct(TRANSACTIONS, t) for t in txs if t["blockNumber"] == b["blockNumber"]],
                [struct(LOGS, x) for x in logs if x["blockNumber"] == b["blockNumber"]],
            )
            for b in blocks
        ],
        BUNDLE_SCHEMA,
    )
    feeds = split_bundles(bundles)
    assert {t: f.count() for t, f in feeds.items()} == {"blocks": 6, "transactions": 6, "logs": 6}
    assert {r.txHash for r in feeds["transactions"].collect()} == {t["txHash"] for t in txs}
    assert feeds["logs"].columns == LOGS.columns
    assert all("Exchange" not in plan_of(f) for f in feeds.values())


# --- data tests and models --------------------------------------------------


def test_quality_counts_and_gate(spark):
    rows = spark.createDataFrame(
        [("a", "x"), (None, "y"), ("b", None), (None, "x")], "v STRING, c STRING"
    )
    tests = quality.TableTests(not_null=["v"], accepted={"c": ["x"]})
    assert quality.failure_counts(rows, tests).first().asDict() == {
        "not_null_v": 2,
        "accepted_values_c": 1,
    }
    assert [tuple(r) for r in quality.accepted_values(rows, "c", ["x"]).collect()] == [("y", 1)]
    with pytest.raises(quality.QualityError) as failed:
        quality.require(rows, "t", tests)
    assert failed.value.failures == {"not_null_v": 2, "accepted_values_c": 1}
    quality.require(rows.where("v IS NOT NULL"), "t", tests)
    quality.require(rows.limit(0), "t", tests)


def wallets(spark, counts):
    rows = [
        dict(chainName="bsc", txHash=f"{w}-{i}", blockNumber=i, value="1", timestamp=1_700_000_000 + i * 86_400)
        | {"from": w, "to": "r"}
        for w, n in counts.items()
        for i in range(n)
    ]
    txs = make(spark, TRANSACTIONS, rows)
    return txs.withColumn("dt", F.from_unixtime("timestamp", "yyyy-MM-dd"))


def test_whale_threshold(spark):
    txs = wallets(spark, {"five": 5, "six": 6, "nine": 9, None: 7})
    silver = models.silver_transactions(txs)
    assert silver.schema["partition_date"].dataType == DateType()
    mart = [(r.whale_wallet, r.total_tx_count, str(r.last_active_date)) for r in models.ranked(models.whale_wallets(silver)).collect()]
    assert mart == [("nine", 9, "2023-11-22"), (None, 7, "2023-11-20"), ("six", 6, "2023-11-19")]
    plan = plan_of(models.whale_wallets(silver))
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2


def test_silver_needs_a_receiver(spark):
    txs = wallets(spark, {"a": 3}).withColumn("to", F.when(F.col("blockNumber") != 1, F.col("to")))
    silver = models.silver_transactions(txs)
    assert sorted(r.block_number for r in silver.collect()) == [0, 2]


def fill_bronze(spark, tmp_path, txs):
    feed = Feed("files", str(tmp_path / "feed"))
    feed.publish(txs, TRANSACTIONS)
    lake = Lake(spark, str(tmp_path / "lake"))
    await_all(start_bronze(feed, lake, ["transactions"], ONCE))
    return lake


def test_daily_run_and_gate(spark, tmp_path):
    lake = fill_bronze(spark, tmp_path, wallets(spark, {"five": 5, "six": 6}).coalesce(1))
    gold = run_daily(lake)
    assert [r.whale_wallet for r in gold.collect()] == ["six"]
    silver = silver_table(lake).read()
    assert silver.count() == 11
    assert silver.where("s3_file_path NOT LIKE 'bronze/transactions/%.parquet'").count() == 0
    one_day = silver.where("partition_date = DATE '2023-11-14'")
    assert "PartitionFilters: [isnotnull(partition_date" in plan_of(one_day)

    # a whole replacement, also of days that are gone; then a failing test
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        small = models.silver_transactions(wallets(spark, {"seven": 7}))
        assert lake.replace(small, "silver", SILVER, ["chain_name", "partition_date"]).count() == 7
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    with pytest.raises(quality.QualityError):
        run_daily(lake, chains=["ethereum"])
    assert [r.whale_wallet for r in lake.read("gold", GOLD).collect()] == ["six"], "gold is untouched"


def test_daily_run_on_an_empty_lake(spark, tmp_path):
    lake = fill_bronze(spark, tmp_path, wallets(spark, {"a": 1}).limit(0))
    assert run_daily(lake).count() == 0


def test_replace_is_all_or_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    one = spark.sql("SELECT 1 AS id, 'a' AS part")
    lake.replace(one, "gold", "t", ["part"])
    failing = spark.sql("SELECT id, CAST(raise_error('lost') AS STRING) AS part FROM range(3)")
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            lake.replace(failing, "gold", "t", ["part"])
        assert [tuple(r) for r in lake.read("gold", "t").collect()] == [(1, "a")]
    # the new version may be made from the old one
    for n in range(2, 5):
        grown = lake.read("gold", "t").select((F.col("id") + 1).alias("id"), "part")
        assert [r.id for r in lake.replace(grown, "gold", "t", ["part"]).collect()] == [n]
    kept = sorted(p.name for p in (tmp_path / "lake" / "gold" / "t").iterdir())
    assert kept == ["markers", "slot_0", "slot_1"]


def test_staged_files(spark, tmp_path):
    rows = wallets(spark, {"a": 4}).coalesce(1)
    rows.write.parquet(str(tmp_path / "drop" / "x" / "y"))
    (tmp_path / "drop" / "notes.txt").write_text("not parquet")
    schema = TRANSACTIONS.message_schema.add("dt", "string")
    found = staged_files(spark, str(tmp_path / "drop"), schema)
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.select(found.columns).collect()))


# --- compaction -------------------------------------------------------------


def store_rows(spark, n=6_000):
    """Two thirds of the rows are copies of one transaction."""
    hot = F.col("id") % 3 != 0
    number = F.when(hot, 7).otherwise(F.col("id")).cast("bigint")
    values = {
        "chain_name": F.when(hot | (F.col("id") % 2 == 0), "bsc").otherwise("ethereum"),
        "tx_hash": F.concat(F.lit("0x"), number),
        "block_number": number,
        "timestamp": F.lit(0).cast("bigint"),
        "ingestion_timestamp": F.col("id"),
    }
    return spark.range(n).select(
        *[
            values.get(f.name, F.lit("v")).cast(f.dataType).alias(f.name)
            for f in TRANSACTIONS.store_schema
        ]
    )


def test_compaction_layout(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    out = compaction.compact(store_rows(spark), TRANSACTIONS, lake, partitions=6)
    assert out.count() == 2_001
    assert out.where("tx_hash = '0x7'").select("ingestion_timestamp").first()[0] == 5_999
    per_file = (
        out.groupBy("chain_name", F.input_file_name().alias("f"))
        .agg(F.min("block_number").alias("lo"), F.max("block_number").alias("hi"), F.count("*").alias("n"))
        .orderBy("chain_name", "lo")
        .collect()
    )
    assert len(per_file) >= 6
    for a, b in zip(per_file, per_file[1:]):
        if a.chain_name == b.chain_name:
            assert a.hi <= b.lo, "files of a chain do not overlap"
    assert max(r.n for r in per_file) < 900, "one chain is not one file"


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    rows = store_rows(spark).dropDuplicates(["tx_hash"])
    logs = rows.select("chain_name", "block_number", F.col("tx_hash").alias("log_tx"))
    paths = {"txs": str(tmp_path / "t"), "logs": str(tmp_path / "l")}
    compaction.write_bucketed(rows, "bucketed_txs", paths["txs"], 4)
    compaction.write_bucketed(logs, "bucketed_logs", paths["logs"], 4)
    key = list(compaction.BUCKET_KEY)
    left = compaction.open_bucketed(spark, "bucketed_txs", paths["txs"], 0.5)
    right = compaction.open_bucketed(spark, "bucketed_logs", paths["logs"], 0.5)
    joined = left.join(right.hint("merge"), key)
    assert "Exchange" not in plan_of(joined)
    assert joined.count() == rows.count()

    # with a hot bucket the files are read without their buckets
    skewed = store_rows(spark).withColumn("tx_hash", F.col("ingestion_timestamp").cast("string"))
    compaction.write_bucketed(skewed, "bucketed_hot", str(tmp_path / "h"), 4)
    hot = compaction.open_bucketed(spark, "bucketed_hot", str(tmp_path / "h"), 0.5)
    assert "Exchange" in plan_of(hot.join(right.hint("merge"), key))
    assert hot.count() == 6_000
    for table in ("bucketed_txs", "bucketed_logs", "bucketed_hot"):
        spark.sql(f"DROP TABLE {table}")


def final_plan(rows):
    """Text of the plan as it ran."""
    rows.collect()
    return plan_of(rows).split("== Initial Plan ==")[0]


def below(plan, name):
    """The part of a plan under the first line with this name."""
    lines = plan.splitlines()
    depths = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
    at = next(i for i, line in enumerate(lines) if name in line)
    end = next((i for i in range(at + 1, len(lines)) if depths[i] <= depths[at]), len(lines))
    return "\n".join(lines[at + 1 : end])


def test_copies_are_not_sorted_before_the_shuffle(spark):
    rows = spark.range(500).selectExpr("id % 100 AS k", "id AS at", "CAST(id AS STRING) AS v")
    kept = dedup_ingested(rows, ["k"], "at")
    plan = final_plan(kept)
    assert sorted(tuple(r) for r in kept.collect()) == [(k, 400 + k, str(400 + k)) for k in range(100)]
    assert "Sort [" not in below(plan, "Exchange"), "a map task's whole input would be spilled"


def test_silver_sorts_copies_only_where_they_meet(spark):
    txs = wallets(spark, {"a": 3}).withColumn("ingestionTimestamp", F.lit(1).cast("long"))
    late = txs.withColumns({"ingestionTimestamp": F.lit(2).cast("long"), "to": F.lit("z")})
    silver = silver_rows(txs.unionByName(late))
    assert "Sort [" not in below(final_plan(silver), "Exchange")
    assert [r.to_address for r in silver.collect()] == ["z"] * 3


def test_a_key_of_many_copies_is_cut_down_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(dedup, "HOT_ROWS", 50)
    rows = spark.sql(
        "SELECT * FROM (SELECT CASE WHEN id < 900 THEN id % 100 WHEN id < 950 THEN 1000 END AS k, "
        "id % 7 AS at, CAST(id AS STRING) AS v FROM range(1000)) ORDER BY v"
    )
    kept = dedup_ingested(rows, ["k"], "at")
    plan = final_plan(kept)
    expected = {}
    for k, at, v in rows.collect():
        expected[k] = min(expected.get(k, (0, "~")), (-at, v))
    assert {r.k: (-r["at"], r.v) for r in kept.collect()} == expected
    assert kept.count() == 102
    assert "EmptyRelation Join LeftSemi" in plan, "no key has more than 50 rows"
    monkeypatch.setattr(dedup, "HOT_ROWS", 49)
    kept = dedup_ingested(rows, ["k"], "at")
    plan = final_plan(kept)
    assert {r.k: (-r["at"], r.v) for r in kept.collect()} == expected
    assert kept.count() == 102
    assert "EmptyRelation Join LeftSemi" not in plan


# --- store layout -----------------------------------------------------------


def mixed_copies(spark, entity):
    """Rows whose copies differ in any column, the block and the ingestion time among them,
    with nulls everywhere and keys that come once, often, and very often."""
    columns = []
    for i, (name, kind) in enumerate(entity.store_schema.simpleString()[7:-1].split(",")[j].split(":")
                                     for j in range(len(entity.store_schema))):
        number = f"pmod(xxhash64(id, {i}), {3 if name in ('chain_name', 'ingestion_timestamp') else 5})"
        if name in ("tx_hash", "log_index"):
            number = f"CASE WHEN id < 300 THEN 1000 ELSE pmod(xxhash64(id, {i}), 60) END"
        text = f"concat('0x', {number})" if kind == "string" else number
        columns.append(f"CAST(CASE WHEN pmod(xxhash64(id, {i}, 1), 9) > 0 THEN {text} END AS {kind}) AS {name}")
    return spark.range(1500).selectExpr(*columns)


def kept_by_hand(rows, entity):
    """The copy of each key to keep, and the rows in the order of the store."""
    names = entity.store_schema.names
    rest = [c for c in names if c not in (*entity.store_key, "ingestion_timestamp")]
    last, first = (lambda v: (v is None, v)), (lambda v: (v is not None, v))  # where nulls go
    best = {}
    for r in rows.collect():
        at = r.ingestion_timestamp
        rank = [last(None if at is None else -at), *[last(r[c]) for c in rest]]
        key = tuple(r[c] for c in entity.store_key)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, tuple(r))
    order = [names.index(c) for c in ("chain_name", *entity.store_order)]
    return sorted((r for _, r in best.values()), key=lambda r: [first(r[i]) for i in order])


@pytest.mark.parametrize("entity", [BLOCKS, TRANSACTIONS, LOGS], ids=lambda e: e.table)
@pytest.mark.parametrize("sliced", [False, True])
@pytest.mark.parametrize("hot_rows", [1_000_000, 100])
def test_store_layout_keeps_one_copy_wherever_copies_lie(spark, monkeypatch, entity, sliced, hot_rows):
    monkeypatch.setattr(dedup, "HOT_ROWS", hot_rows)
    if sliced:
        for name, value in {"SORTED_BYTES": 20_000, "SAMPLED_FROM": 100, "UNSORTED_PARTITIONS": 5}.items():
            monkeypatch.setattr(dedup, name, value)
    rows = mixed_copies(spark, entity).localCheckpoint()
    placed = {}
    for r in rows.collect():
        placed.setdefault(tuple(r[c] for c in entity.store_key), set()).add(tuple(r[c] for c in entity.store_order))
    assert any(len(places) > 1 for places in placed.values()) == (entity is not BLOCKS)
    laid_out = compaction.store_layout(rows, entity)
    assert [tuple(r) for r in laid_out.collect()] == kept_by_hand(rows, entity)
    if sliced:
        assert 5 < laid_out.rdd.getNumPartitions() and "Union" in plan_of(laid_out)


def test_store_layout_shuffles_whole_rows_once(spark):
    rows = store_rows(spark)
    again = rows.withColumn("ingestion_timestamp", F.lit(9).cast("long"))
    laid_out = compaction.store_layout(rows.unionByName(again), TRANSACTIONS)
    plan = final_plan(laid_out)
    above, under = plan.split("Exchange rangepartitioning")
    assert above.count("Sort [") == 1, "once for the copies and the layout"
    of_all, of_many = under.split("Exchange hashpartitioning(chain_name")  # else by key, and again by range
    assert "EmptyRelation" not in of_all and "EmptyRelation" in of_many


def test_store_layout_cuts_by_size_not_by_session(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SORTED_BYTES", 1 << 20)
    rows = spark.range(120_000).selectExpr(
        "'eth' AS chain_name", "CAST(id AS STRING) AS tx_hash", "id AS block_number", "'0x' AS block_hash",
        "'a' AS from_address", "'b' AS to_address", "'1' AS value", "id AS timestamp", "id AS ingestion_timestamp",
    )
    laid_out = compaction.store_layout(rows, TRANSACTIONS)
    sizes = laid_out.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 20 and max(r["count"] for r in sizes) < 12_000, "8 partitions in this session"
    assert laid_out.count() == 120_000
