"""Streams from text files: decode, quarantine, restart, replay, sharding."""

import json

import pytest
from pyspark.errors import StreamingQueryException

from ledgerloom.functions.codec import decode, rejected
from ledgerloom.operators.dedup import dedup_ingested
from ledgerloom.schemas import BLOCKS, ENTITIES, LOGS, TRANSACTIONS
from ledgerloom.sources.feeds import Feed
from ledgerloom.sources.lake import Lake
from ledgerloom.streaming.bronze import await_all, await_any, bronze_rows, start_bronze
from ledgerloom.streaming.jdbc import SentShards, ShardedSink, start_jdbc_stream
from ledgerloom.streaming.speed import (
    SpeedStore,
    _start,
    speed_rows,
    start_speed,
    start_speed_stream,
)

ONCE = {"availableNow": True}
BIG = "9" * 78


def tx(n, **changes):
    row = {
        "chainName": "bsc",
        "txHash": f"0x{n}",
        "blockNumber": n,
        "blockHash": f"0xb{n}",
        "from": "0xf",
        "to": "0xt",
        "value": "99999999999999999999999999",
        "timestamp": 1_700_000_000,
        "ingestionTimestamp": 1_700_000_000_000 + n,
        "unknown": 1,
    }
    row.update(changes)
    return {k: v for k, v in row.items() if v is not ...}


GOOD = [
    json.dumps(tx(1)),
    json.dumps(tx(2, value=None, to=None)),
    # the literal number keeps its digits, the exponent is respelled
    json.dumps(tx(3)).replace('"99999999999999999999999999"', "99999999999999999999999999"),
    json.dumps(tx(4)).replace('"99999999999999999999999999"', "1e25"),
    json.dumps(tx(5, value=BIG)),
    json.dumps(tx(6, timestamp=1_700_006_400, chainName="ethereum")),
    json.dumps(tx(7, timestamp=None)),
    json.dumps(tx(-3)),
]
BAD = {
    "garbage": "undecodable",
    '{"chainName":"bsc","txHash":"0x8"': "undecodable",
    json.dumps(tx(9, blockNumber="x")): "undecodable",
    '{"chainName":"bsc"}': "missing_key",
    json.dumps(tx(10, chainName=None)): "missing_key",
    json.dumps(tx(11, blockNumber=...)): "missing_key",
    json.dumps(tx(12, chainName=" ")): "missing_key",
    json.dumps(tx(14)).replace('"value": ', '"value": 123456789012345678.25e3, "v": '): "bad_amount",
    "null": "undecodable",
    "": "undecodable",
}


def write_lines(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


@pytest.fixture
def feed(tmp_path):
    for entity in ENTITIES.values():
        (tmp_path / "feed" / entity.topic).mkdir(parents=True)
    write_lines(tmp_path / "feed" / TRANSACTIONS.topic, "1.txt", [*GOOD, *BAD])
    return Feed("files", str(tmp_path / "feed"))


def test_bronze_stream(spark, feed, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    run = lambda: await_all(start_bronze(feed, lake, ["transactions"], ONCE))
    run()

    rows = {r.txHash: r for r in lake.bronze("transactions").collect()}
    assert len(rows) == len(GOOD) == lake.bronze("transactions").count()
    assert rows["0x1"].dt == "2023-11-14"
    assert rows["0x6"].dt == "2023-11-15", "midnight belongs to the new day in UTC"
    assert rows["0x7"].dt is None
    assert rows["0x2"].value is None
    assert rows["0x3"].value == "99999999999999999999999999"
    assert rows["0x5"].value == BIG
    assert "unknown" not in lake.bronze("transactions").columns

    found = {r.raw: r.status for r in lake.quarantine("transactions").collect()}
    assert found == BAD

    run()
    assert lake.bronze("transactions").count() == len(GOOD), "nothing new, nothing written"

    # a late row goes to the partition of its own date
    write_lines(
        tmp_path / "feed" / TRANSACTIONS.topic, "2.txt", [json.dumps(tx(12, timestamp=1_600_000_000))]
    )
    run()
    assert lake.bronze("transactions").count() == len(GOOD) + 1
    late = lake.bronze("transactions").where("dt = '2020-09-13' AND chainName = 'bsc'")
    assert [r.txHash for r in late.collect()] == ["0x12"]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan and "(dt#" in plan

    # the views are what SQL users see; the path is relative to the root
    for other in ("blocks", "logs"):
        await_all(start_bronze(feed, lake, [other], ONCE))
    lake.register_views()
    assert spark.sql("SELECT count(*) FROM transactions").first()[0] == len(GOOD) + 1
    paths = lake.bronze("transactions", lineage=True).select("source_path").distinct().collect()
    assert all(r[0].startswith("bronze/transactions/status=ok/chainName=") for r in paths)


def test_backlog_is_taken_in_batches(spark, feed, tmp_path):
    for n in range(3):
        write_lines(tmp_path / "feed" / TRANSACTIONS.topic, f"b{n}.txt", [json.dumps(tx(100 + n))])
    slow = Feed("files", feed.location, {"maxFilesPerTrigger": "1"})
    lake = Lake(spark, str(tmp_path / "lake"))
    (query,) = start_bronze(slow, lake, ["transactions"], ONCE)
    await_all([query])
    assert query.lastProgress["batchId"] >= 3
    assert lake.bronze("transactions").count() == len(GOOD) + 3


def test_bronze_stream_agrees_with_batch(spark, feed, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    await_all(start_bronze(feed, lake, trigger=ONCE, files_per_partition=2))
    batch = bronze_rows(feed.batch(spark, TRANSACTIONS), TRANSACTIONS)
    stream = lake._bronze_all("transactions").select(batch.columns)
    assert sorted(map(str, batch.collect())) == sorted(map(str, stream.collect()))
    assert lake.bronze("blocks").count() == lake.bronze("logs").count() == 0


def test_speed_stream(spark, feed, tmp_path):
    write_lines(
        tmp_path / "feed" / TRANSACTIONS.topic, "3.txt", [json.dumps(tx(13, value="ten"))]
    )
    store = SpeedStore(str(tmp_path / "speed"), shards=3)
    run = lambda: await_all(
        start_speed(spark, feed, store, str(tmp_path / "points"), ["transactions"], ONCE)
    )
    run()
    rows = {r.tx_hash: r for r in store.read(spark, "transactions").collect()}
    assert len(rows) == len(GOOD)
    assert rows["0x2"].value == "0"
    assert rows["0x4"].value == "1" + "0" * 25
    assert rows["0x5"].value == BIG
    assert {r.block_number % 3 for r in rows.values() if r.shard == 1} == {1}
    assert rows["0x-3"].shard == 0
    assert rows["0x1"].to_address == "0xt"
    reasons = {r.raw: r.status for r in store.quarantine(spark, "transactions").collect()}
    assert reasons == {**BAD, json.dumps(tx(13, value="ten")): "bad_amount"}

    run()
    assert store.read(spark, "transactions").count() == len(GOOD)

    # the same checkpoint goes on under the same run id
    write_lines(tmp_path / "feed" / TRANSACTIONS.topic, "4.txt", [json.dumps(tx(14))])
    run()
    assert store.read(spark, "transactions").count() == len(GOOD) + 1
    runs = store.read(spark, "transactions").select("run_id", "batch_id").distinct().collect()
    assert len({r.run_id for r in runs}) == 1 and len(runs) == 2

    one_shard = store.read(spark, "transactions").where("shard = 1")
    assert "(shard#" in one_shard._jdf.queryExecution().executedPlan().toString()


def test_concurrent_speed_streams_keep_their_run_ids(spark, feed, tmp_path):
    for table, row in {
        "blocks": {"chainName": "bsc", "blockNumber": 1},
        "logs": {"chainName": "bsc", "blockNumber": 1, "logIndex": 0},
    }.items():
        write_lines(tmp_path / "feed" / ENTITIES[table].topic, "1.txt", [json.dumps(row)])
    store, points = SpeedStore(str(tmp_path / "speed")), str(tmp_path / "points")
    ids = {}
    for _ in range(2):
        queries = start_speed(spark, feed, store, points, trigger=ONCE)
        await_all(queries)
        for query in queries:
            assert ids.setdefault(query.name, str(query.id)) == str(query.id)
    for table in ENTITIES:
        runs = store.read(spark, table).select("run_id").distinct().collect()
        assert [r.run_id for r in runs] == [ids[f"speed-{table}"]]

    # a new checkpoint reads everything again, under a run of its own
    await_all(start_speed(spark, feed, store, str(tmp_path / "new"), ["logs"], ONCE))
    assert store.read(spark, "logs").select("run_id").distinct().count() == 2
    again = dedup_ingested(
        store.read(spark, "logs").select(LOGS.store_schema.names), LOGS.store_key, "ingestion_timestamp"
    )
    assert again.count() == 1


def test_replayed_batch_replaces_its_rows(spark, tmp_path):
    store = SpeedStore(str(tmp_path / "speed"))
    messages = spark.createDataFrame([(json.dumps(tx(n)),) for n in range(20)], "value STRING")
    # a first attempt with other shards and rows leaves nothing behind
    store.write_batch(speed_rows(messages, TRANSACTIONS, 5), TRANSACTIONS, "r", 7)
    store.write_batch(speed_rows(messages.limit(6), TRANSACTIONS, 2), TRANSACTIONS, "r", 7)
    store.write_batch(speed_rows(messages, TRANSACTIONS, 2), TRANSACTIONS, "r", 8)
    counts = store.read(spark, "transactions").groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in counts} == {7: 6, 8: 20}


class Databases:
    """What a sink inserts, by url, and how many connections it took."""

    def __init__(self, broken=()):
        self.rows, self.connections, self.broken = {}, [], set(broken)

    def insert(self, rows, url, token):
        self.connections.append(rows.rdd.getNumPartitions())
        if url in self.broken:
            raise OSError("away")
        assert "shard" not in rows.columns
        self.rows.setdefault(url, []).extend(r["tx_hash"] for r in rows.collect())


def sharded(folder, databases, urls="abc"):
    return ShardedSink(list(urls), "t", {}, SentShards(str(folder / "sent")), 2, insert=databases.insert)


def test_sharded_sink_skips_what_was_sent(spark, tmp_path):
    messages = spark.createDataFrame([(json.dumps(tx(n)),) for n in range(12)] + [("garbage",)], "value STRING")
    batch = speed_rows(messages, TRANSACTIONS, 3)
    databases = Databases(broken="b")
    sink = sharded(tmp_path, databases)
    with pytest.raises(OSError):
        sink.write(batch, "run", 0)
    assert set(databases.rows) == {"a", "c"}, "the other shards have been sent"
    databases.broken.clear()
    expected = {u: sorted(f"0x{n}" for n in range(12) if n % 3 == i) for i, u in enumerate("abc")}
    for _ in range(2):
        sink.write(batch, "run", 0)
        assert {u: sorted(r) for u, r in databases.rows.items()} == expected
    assert max(databases.connections) <= 2 and len(databases.connections) == 4
    sink.write(batch, "other run", 0)
    assert len(databases.rows["a"]) == 8


def test_jdbc_stream_replays_nothing(spark, feed, tmp_path):
    databases = Databases(broken="a")
    sink = sharded(tmp_path, databases, "ab")
    start = lambda: start_jdbc_stream(spark, feed, TRANSACTIONS, sink, str(tmp_path / "points"), ONCE)
    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    databases.broken.clear()
    for _ in range(2):
        start().awaitTermination()
    sent = sorted(databases.rows["a"] + databases.rows["b"])
    assert sent == sorted(set(sent)) and len(sent) == len(GOOD)


def test_one_failing_stream_ends_the_job(spark, feed, tmp_path):
    for query in spark.streams.active:
        query.stop()
    spark.streams.resetTerminated()
    lake = Lake(spark, str(tmp_path / "lake"))
    healthy = start_bronze(feed, lake, ["transactions"])

    def fail(batch, batch_id):
        raise RuntimeError("sink is away")

    store = SpeedStore(str(tmp_path / "speed"))
    rows = speed_rows(feed.stream(spark, TRANSACTIONS), TRANSACTIONS, store.shards)
    failing = _start(rows, fail, "failing", str(tmp_path / "point"), {"processingTime": "1 second"})
    with pytest.raises(StreamingQueryException, match="sink is away"):
        await_any(spark, [*healthy, failing])
    assert not any(q.isActive for q in [*healthy, failing])
    spark.streams.resetTerminated()

    # the failed batch is run again from the same checkpoint
    point = str(tmp_path / "point")
    await_all([start_speed_stream(spark, feed, store, TRANSACTIONS, point, ONCE)])
    assert store.read(spark, "transactions").count() == len(GOOD)


def test_publish_then_read_back(spark, tmp_path):
    feed = Feed("files", str(tmp_path / "feed"))
    logs = spark.createDataFrame(
        [("bsc", i, 5, "0xb", "0xt", "0xa", "t0", None, None, None, 'line\n"q"', 7, 8) for i in range(3)],
        LOGS.message_schema,
    )
    feed.publish(logs, LOGS)
    back = decode(feed.batch(spark, LOGS), LOGS)
    assert rejected(back).count() == 0
    assert sorted(back.select(LOGS.columns).collect()) == sorted(logs.collect())
    text = feed.batch(spark, LOGS).first().value
    assert json.loads(text)["topic1"] is None, "absent fields are written as null"


class FakeReader:
    """Takes the calls of a DataFrameReader and remembers them."""

    def __init__(self, messages):
        self.messages, self.seen = messages, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **values):
        self.seen.update(values)
        return self

    def load(self):
        return self.messages


def test_kafka_feed_options(spark):
    # There is no Kafka connector here: only what it would be asked for.
    messages = spark.sql("SELECT CAST('k' AS BINARY) AS key, CAST('{}' AS BINARY) AS value")
    reader = FakeReader(messages)
    feed = Feed("kafka", "broker:9092", {"maxOffsetsPerTrigger": "500"})
    values = feed._load(reader, LOGS)
    assert [r.value for r in values.collect()] == ["{}"] and values.columns == ["value"]
    assert reader.seen == {
        "format": "kafka",
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "topic_raw_logs",
        "startingOffsets": "earliest",
        "maxRecordsPerPartition": "1000000",
        "maxOffsetsPerTrigger": "500",
    }


def test_feed_kinds():
    with pytest.raises(ValueError):
        Feed("socket", "x")


def test_message_keys_and_required_fields():
    assert [e.message_key for e in (BLOCKS, TRANSACTIONS, LOGS)] == ["blockHash", "txHash", "address"]
    assert TRANSACTIONS.required == ("chainName", "txHash", "blockNumber")
    assert LOGS.required == LOGS.natural_key


def test_dedup_keeps_the_latest_ingested(spark):
    rows = spark.createDataFrame(
        [("a", 1, "old", 5), ("a", 1, "new", 9), ("a", 1, "new", 9), ("b", 1, "x", None)],
        "chain STRING, n INT, v STRING, at INT",
    )
    kept = dedup_ingested(rows, ["chain", "n"], "at")
    assert sorted((r.chain, r.v) for r in kept.collect()) == [("a", "new"), ("b", "x")]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan, "copies must go before the shuffle"


#: The number in the message, and the amount it must become; None if it cannot be told.
NUMBERS = {
    "12345678901234567.5": "12345678901234567.5",
    "12345678901234567890123456.5": "12345678901234567890123456.5",
    "0.0000000000000001": "0.0000000000000001",
    "12345.678901234567": "12345.678901234567",
    "1e25": "10000000000000000000000000",
    "1.5E-3": "0.0015",
    '"1.2345678901234567e30"': "1234567890123456700000000000000",
    "1.2345678901234567e30": None,
    "1.00000000000000000001e25": None,
    "1234567890123456789012345678901234567890.5": None,
    "1E400": None,
    "NaN": None,
}


def test_amounts_sent_as_numbers(spark):
    """Exact or refused, whatever else the message holds under the same name."""
    head = '{"chainName":"bsc","txHash":"%s","blockNumber":1,'
    lines, expected = [], {}

    def case(body, amount):
        name = f"t{len(lines)}"
        lines.append((head % name + body + "}",))
        expected[name] = amount

    for number, amount in NUMBERS.items():
        case(f'"value":{number}', amount)
        case(f'"data":{{"value":{number}}},"value":"7"', "7")
    case('"\\u0076alue":12345678901234567.5', "12345678901234567.5")
    case('"\\u0076alue":1e25', None)
    case('"extra":{"value":1234567890123456.5e3},"value":1e25', "10000000000000000000000000")
    case('"value":1.5,"value":2.5', None)
    rows = speed_rows(spark.createDataFrame(lines, "value STRING"), TRANSACTIONS, 2)
    found = {r["tx_hash"]: r["value"] if r["status"] == "ok" else None for r in rows.collect()}
    assert found == expected
    assert {r["status"] for r in rows.collect()} == {"ok", "bad_amount"}
