"""Tables that change by partition, and what the lake's upkeep rests on them."""

import json
import os
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import __spark_entry__
import fixtures
from ledgerloom.functions.codec import encode
from ledgerloom.operators.quality import QualityError
from ledgerloom.plans import compaction, daily, models
from ledgerloom.plans.upkeep import compact_bronze
from ledgerloom.schemas import BLOCKS, TRANSACTIONS
from ledgerloom.sources.feeds import Feed
from ledgerloom.sources.lake import Lake
from ledgerloom.sources.partitioned import PartitionedTable
from ledgerloom.streaming.bronze import await_all, start_bronze
from ledgerloom.streaming.speed import SpeedStore, speed_rows

ONCE = {"availableNow": True}
DAY = 86_400
START = 1_700_000_000 // DAY * DAY  # 2023-11-14


def tx(n, day=0, **changes):
    return {
        "chainName": "bsc",
        "txHash": f"t{n}",
        "blockNumber": 10_001 + n,
        "blockHash": "b",
        "from": f"w{n % 3}",
        "to": "x",
        "value": str(n),
        "timestamp": START + day * DAY,
        "ingestionTimestamp": n,
        **changes,
    }


class World:
    """A feed of transactions and the lake that it fills."""

    def __init__(self, spark, folder):
        self.spark, self.n = spark, 0
        self.topic = folder / "feed" / TRANSACTIONS.topic
        self.topic.mkdir(parents=True)
        self.feed = Feed("files", str(folder / "feed"))
        self.lake = Lake(spark, str(folder / "lake"))

    def send(self, *rows):
        """One message file, one batch of the stream, a bronze file for each date."""
        self.n += 1
        lines = [row if isinstance(row, str) else json.dumps(row) for row in rows]
        (self.topic / f"{self.n}.txt").write_text("\n".join(lines) + "\n")
        await_all(start_bronze(self.feed, self.lake, ["transactions"], ONCE))

    def rows(self, lineage=True):
        found = self.lake.bronze("transactions", lineage=lineage)
        return sorted(map(tuple, found.select(sorted(found.columns)).collect()), key=str)

    def opened(self):
        """Files from which the lake's rows come."""
        scan = self.lake.bronze("transactions")
        return scan.select(F.input_file_name()).distinct().count()


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


# --- the table --------------------------------------------------------------

SCHEMA = StructType().add("v", "integer").add("chain", "string").add("day", "date")


def small(spark, *rows):
    return spark.createDataFrame(list(rows), "v INT, chain STRING, day STRING").withColumn(
        "day", F.col("day").cast("date")
    )


def values(df):
    return sorted((r["v"], r["chain"], str(r["day"])) for r in df.collect())


def test_partitions_change_in_one_step(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path), SCHEMA, ("chain", "day"))
    assert values(table.read()) == [] and table.notes() == {}
    n = table.stage(small(spark, (1, "a", "2024-01-01"), (2, "a", "2024-01-02"), (3, None, None)))
    assert values(table.read()) == []
    table.commit(n, notes={"upto": "5"})
    first = [(1, "a", "2024-01-01"), (2, "a", "2024-01-02"), (3, None, "None")]
    assert values(table.read()) == first and table.notes() == {"upto": "5"}

    # A change that is never committed is not seen, and the next one writes over it.
    table.stage(small(spark, (9, "a", "2024-01-01")))
    assert values(table.read()) == first
    untouched = {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*day=2024-01-02*/*.parquet")}
    n = table.stage(small(spark, (4, "a", "2024-01-01"), (5, "b", "2024-01-01")))
    gone = [r[0] for r in small(spark, (0, "a", "2024-01-01"), (0, None, None)).select(table.key()).collect()]
    table.commit(n, gone, {"upto": "6"})
    # The null partition was replaced by nothing, an added one is new.
    second = [(2, "a", "2024-01-02"), (4, "a", "2024-01-01"), (5, "b", "2024-01-01")]
    assert values(table.read()) == second and table.notes() == {"upto": "6"}
    assert untouched == {p: p.stat().st_mtime_ns for p in untouched}

    # Rows can also be added to a partition.
    table.commit(table.stage(small(spark, (6, "b", "2024-01-01"))))
    assert values(table.read()) == sorted([*second, (6, "b", "2024-01-01")])
    plan = table.read().where("chain = 'b'")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PartitionFilters: [" in plan and "Filter (" not in plan


def test_vacuum_keeps_what_readers_may_hold(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path), SCHEMA, ("chain", "day"))
    key = [r[0] for r in small(spark, (0, "a", "2024-01-01")).select(table.key()).collect()]
    for v in range(4):
        table.commit(table.stage(small(spark, (v, "a", "2024-01-01"))), key)
    before = table.read()
    table.commit(table.stage(small(spark, (7, "a", "2024-01-01"))), key)
    table.vacuum()
    assert values(before) == [(3, "a", "2024-01-01")] and values(table.read()) == [(7, "a", "2024-01-01")]
    assert sorted(os.listdir(tmp_path / "parts")) == ["version=4", "version=5"]


# --- bronze -----------------------------------------------------------------


def test_compacted_bronze(world):
    for n in (0, 2, 4):
        world.send(tx(n, 0), tx(n + 1, 1))
    world.send(tx(6, 5), tx(7, timestamp=None), "garbage")
    before, files = world.rows(), world.opened()
    assert len(before) == 8 and files == 8

    assert compact_bronze(world.lake, "transactions", "2023-11-17", 0) == 1
    # Two dates of three files each became one file each.
    assert world.rows() == before and world.opened() == 4
    assert world.lake.quarantine("transactions").count() == 1

    # A late row of a closed date is seen at once, and taken in by the next run.
    world.send(tx(8, 0), tx(9, 5))
    after = world.rows()
    assert len(after) == 10
    assert compact_bronze(world.lake, "transactions", "2023-11-17", 0) == 2
    assert world.rows() == after

    # An earlier date than before changes nothing, a later one closes more.
    compact_bronze(world.lake, "transactions", "2023-11-01", 0)
    assert world.rows() == after
    compact_bronze(world.lake, "transactions", "2024-01-01", 0)
    assert world.rows() == after and world.opened() <= 7


def test_files_taken_in_are_not_opened(world):
    world.send(*[tx(n, 0) for n in range(4)])
    world.send(tx(4, 3))
    before = world.rows()
    compact_bronze(world.lake, "transactions", "2023-11-15", 0)
    folder = Path(world.lake.path("bronze", "transactions"))
    for path in folder.rglob("dt=2023-11-14/*.parquet"):
        path.unlink()
    assert world.rows() == before


def test_a_compaction_that_fails_changes_nothing(world, monkeypatch):
    world.send(*[tx(n, 0) for n in range(4)])
    world.send(tx(4, 3))
    before = world.rows()

    def killed(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(PartitionedTable, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            compact_bronze(world.lake, "transactions", "2023-11-15", 0)
    assert world.rows() == before
    world.send(tx(5, 0))
    assert compact_bronze(world.lake, "transactions", "2023-11-15", 0) == 1
    assert len(world.rows()) == 6 and len(set(world.rows())) == 6


def test_nothing_to_compact(world):
    world.send("garbage")
    assert compact_bronze(world.lake, "transactions", "2023-11-15") == 0
    assert world.rows() == []


# --- silver and gold --------------------------------------------------------


def silver_files(world):
    parts = Path(daily.silver_table(world.lake).parts)
    return {str(p): p.stat().st_mtime_ns for p in parts.rglob("*.parquet")}


def whole_silver(world):
    rows = daily.silver_rows(world.lake.bronze("transactions", lineage=True))
    return sorted(map(tuple, rows.collect()), key=str)


def read_silver(world):
    return sorted(map(tuple, daily.silver_table(world.lake).read().collect()), key=str)


def whales(df):
    return sorted(map(tuple, models.ranked(df).collect()), key=str)


def test_silver_and_gold_by_changed_dates(world):
    lake = world.lake
    load = [tx(n, n % 3) for n in range(12)] + [tx(12, timestamp=None), tx(13, to=None)]
    world.send(*load, "garbage")
    assert len(whales(daily.run_daily(lake, threshold=3))) == 3
    assert read_silver(world) == whole_silver(world) and len(read_silver(world)) == 13

    # Nothing new: nothing is written. A late row and a row sent twice change one date.
    files = silver_files(world)
    daily.run_daily(lake, threshold=3)
    assert silver_files(world) == files
    world.send(tx(14, 1), tx(1, 1, ingestionTimestamp=99, value="7"))
    gold = daily.run_daily(lake, threshold=3)
    later = silver_files(world)
    assert {f: t for f, t in later.items() if f in files} == files, "old files are untouched"
    assert {f.split("partition_date=")[1][:10] for f in set(later) - set(files)} == {"2023-11-15"}
    assert read_silver(world) == whole_silver(world) and len(read_silver(world)) == 14
    assert whales(gold) == whales(models.whale_wallets(daily.silver_table(lake).read(), 3))

    # A third load, after compaction took the first two in: the same rows as at once.
    compact_bronze(lake, "transactions", "2023-11-16", 0)
    world.send(tx(15, 0, **{"from": "w1"}), tx(16, 9))
    gold = daily.run_daily(lake, threshold=3)
    assert read_silver(world) == whole_silver(world) and len(read_silver(world)) == 16
    assert whales(gold) == whales(models.whale_wallets(daily.silver_table(lake).read(), 3))


def test_silver_that_fails_stays_as_it_was(world):
    lake = world.lake
    world.send(*[tx(n) for n in range(6)])
    gold = whales(daily.run_daily(lake, threshold=1))
    before = read_silver(world)
    world.send(tx(6, 1), tx(7, 1, value=None), tx(8, 0, chainName="other"))
    for _ in range(2):  # the changes are still due
        with pytest.raises(QualityError) as raised:
            daily.run_daily(lake, threshold=1)
        assert raised.value.failures == {"not_null_tx_value": 1, "accepted_values_chain_name": 1}
        assert read_silver(world) == before
    assert whales(lake.read("gold", "mart_smart_money")) == gold
    world.send(tx(7, 1, ingestionTimestamp=100))
    daily.run_daily(lake, ["bsc", "other"], threshold=1)
    assert read_silver(world) == whole_silver(world) and len(read_silver(world)) == 9


@pytest.mark.parametrize("step", [1, 2])
def test_a_killed_run_is_made_up_for(world, monkeypatch, step):
    """Killed before silver counts, or between silver and the wallet counts."""
    world.send(*[tx(n, n % 2) for n in range(8)])
    daily.run_daily(world.lake, threshold=1)
    world.send(tx(8, 1), tx(9, 2))
    commits = []
    real = PartitionedTable.commit

    def killed(self, *args, **kwargs):
        commits.append(self)
        if len(commits) == step:
            raise KeyboardInterrupt
        real(self, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(PartitionedTable, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            daily.run_daily(world.lake, threshold=1)
    assert len(read_silver(world)) == (8 if step == 1 else 10)
    gold = daily.run_daily(world.lake, threshold=1)
    assert read_silver(world) == whole_silver(world)
    assert whales(gold) == whales(models.whale_wallets(daily.silver_table(world.lake).read(), 1))


def test_looking_for_changes_reads_no_column(world):
    """Only partition values and times of files."""
    world.send(*[tx(n, n % 2) for n in range(4)])
    files = world.lake.bronze_files("transactions")
    counted = files.groupBy("chainName").agg(F.max("modified"))
    assert "ReadSchema: struct<>" in counted._jdf.queryExecution().executedPlan().toString()


# --- the speed store --------------------------------------------------------


class Speed:
    def __init__(self, spark, folder):
        self.spark, self.n = spark, -1
        self.lake = Lake(spark, str(folder / "lake"))
        self.store = SpeedStore(str(folder / "speed"))

    def batch(self, *rows, run="r1", batch=None):
        self.n = self.n + 1 if batch is None else self.n
        lines = [(row if isinstance(row, str) else json.dumps(row),) for row in rows]
        messages = self.spark.createDataFrame(lines, "value STRING")
        decoded = speed_rows(messages, TRANSACTIONS, 2)
        self.store.write_batch(decoded, TRANSACTIONS, run, self.n if batch is None else batch)

    def compact(self):
        return compaction.compact_store(self.store, self.lake, TRANSACTIONS, 100)

    def rows(self):
        found = compaction.read_store(self.store, self.lake, "transactions")
        return sorted((r["tx_hash"], r["value"], r["shard"]) for r in found.collect())

    def batches(self):
        return sorted(p.name for p in Path(self.store.path(TRANSACTIONS)).glob("*/*") if any(p.glob("status=ok")))


@pytest.fixture
def speed(spark, tmp_path):
    return Speed(spark, tmp_path)


def test_batches_are_taken_in_and_retired(speed):
    speed.batch(*[tx(n) for n in range(4)], tx(500), "garbage")
    speed.batch(tx(4), tx(5))
    before = speed.rows()
    assert len(before) == 7
    assert speed.compact() == 1
    assert speed.rows() == before and speed.batches() == ["batch_id=0", "batch_id=1"]

    # Batches go a run later; what was rejected stays. A batch that is replayed after it
    # was taken in adds nothing.
    speed.batch(tx(6), tx(1, value="9", ingestionTimestamp=99))
    untaken = speed.rows()
    assert len(untaken) == 9 and speed.compact() == 2
    merged = speed.rows()
    assert len(merged) == 8 and ("t1", "9", 0) in merged and speed.batches() == ["batch_id=2"]
    assert speed.store.quarantine(speed.spark, "transactions").count() == 1
    speed.batch(tx(4), tx(5), batch=1)
    assert speed.rows() == merged
    assert speed.compact() == 0 and speed.rows() == merged and speed.batches() == []

    # A second run of the stream counts from 0 again.
    speed.batch(tx(7), run="r2", batch=0)
    assert len(speed.rows()) == 9 and speed.compact() == 3 and len(speed.rows()) == 9


def test_a_run_meets_only_the_ranges_it_touches(speed):
    speed.batch(*[tx(n) for n in range(0, 1000, 10)])
    speed.compact()
    parts = Path(compaction.compacted_table(speed.lake, TRANSACTIONS).parts)
    first = {str(p) for p in parts.rglob("*.parquet")}
    assert len({p.split("block_range=")[1].split("/")[0] for p in first}) == 10
    speed.batch(tx(995), tx(1001))
    speed.compact()
    second = {str(p) for p in parts.rglob("*.parquet")} - first
    assert {p.split("block_range=")[1].split("/")[0] for p in second} == {"109", "110"}
    assert compaction.compacted_table(speed.lake, TRANSACTIONS).read().count() == 102


@pytest.mark.parametrize("step", ["commit", "vacuum"])
def test_a_killed_compaction_loses_and_doubles_nothing(speed, monkeypatch, step):
    speed.batch(tx(1), tx(2))
    speed.compact()
    speed.batch(tx(3), tx(2, value="5", ingestionTimestamp=50))

    def killed(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(PartitionedTable, step, killed)
        with pytest.raises(KeyboardInterrupt):
            speed.compact()
    kept = [("t1", "1", 0), ("t2", "5", 1), ("t3", "3", 0)]
    # Not merged yet, both copies of t2 are there, as in the store itself.
    assert speed.rows() == (sorted([*kept, ("t2", "2", 1)]) if step == "commit" else kept)
    speed.compact()
    assert speed.rows() == kept


def test_a_batch_that_is_being_written_waits(speed):
    speed.batch(tx(1))
    speed.batch(tx(2))
    (Path(speed.store.path(TRANSACTIONS)) / "run_id=r1/batch_id=1/_SUCCESS").unlink()
    speed.compact()
    table = compaction.compacted_table(speed.lake, TRANSACTIONS)
    assert table.read().count() == 1 and len(speed.rows()) == 2


def test_shard_counts_of_a_store(spark, tmp_path):
    """The registered query's SQL, against a store that was written, then compacted."""
    sf = "/root/testdata/sf0.01"
    store, lake = SpeedStore(str(tmp_path / "speed")), Lake(spark, str(tmp_path / "lake"))
    messages = encode(fixtures.entity(spark, sf, "blocks"), BLOCKS)
    halves = messages.withColumn("half", F.crc32("key") % 2)
    for n in range(2):
        rows = speed_rows(halves.where(F.col("half") == n).drop("half"), BLOCKS, 2)
        store.write_batch(rows, BLOCKS, "r", n)
    con = duckdb.connect()
    for name in ("orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    expected = sorted(con.execute(__spark_entry__.oracle_sql()["shard_counts"]).fetchall())
    for _ in range(3):
        counts = compaction.read_store(store, lake, "blocks").groupBy("shard").count()
        assert sorted(map(tuple, counts.collect())) == expected
        compaction.compact_store(store, lake, BLOCKS)
