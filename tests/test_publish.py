"""Bronze and bundles to topics."""

import json

import pytest
from pyspark.errors import StreamingQueryException

import fixtures
from ledgerloom.operators import bundle
from ledgerloom.operators.bundle import BUNDLE_SCHEMA, bundle_messages
from ledgerloom.operators.sync_state import SyncStateStore
from ledgerloom.functions.codec import encode
from ledgerloom.jobs import main
from ledgerloom.schemas import ENTITIES
from ledgerloom.sources.feeds import Feed
from ledgerloom.sources.lake import Lake
from ledgerloom.streaming import publish
from ledgerloom.streaming.bronze import await_all, start_bronze

ONCE = {"availableNow": True}


class World:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0
        for entity in ENTITIES.values():
            (folder / "in" / entity.topic).mkdir(parents=True)
        self.lake = Lake(spark, str(folder / "lake"))
        self.out = Feed("files", str(folder / "out"))
        self.store = SyncStateStore(spark, str(folder / "state"))
        self.store.init(["ethereum", "bsc"])

    def arrive(self, blocks=(), txs=(), logs=()):
        """(chain, number) blocks, and transactions and logs of such blocks."""
        self.n += 1
        base = lambda c, n: {"chainName": c, "blockNumber": n, "timestamp": 1_700_000_000}
        rows = {
            "blocks": [{**base(c, n), "blockHash": f"b{n}"} for c, n in blocks],
            "transactions": [{**base(c, n), "txHash": f"t{self.n}-{n}"} for c, n in txs],
            "logs": [{**base(c, n), "logIndex": self.n, "address": "a"} for c, n in logs],
        }
        for table, lines in rows.items():
            path = self.folder / "in" / ENTITIES[table].topic / f"{self.n}.txt"
            path.write_text("".join(json.dumps(r) + "\n" for r in lines))
        feed = Feed("files", str(self.folder / "in"))
        await_all(start_bronze(feed, self.lake, trigger=ONCE))

    def publish(self):
        await_all([publish.start_publish_stream(self.lake, self.out, self.store, trigger=ONCE)])

    def sent(self, table):
        found = []
        for row in self.out.batch(self.spark, ENTITIES[table]).collect():
            message = json.loads(row["value"])
            found.append((message["chainName"], message["blockNumber"], message.get("txHash")))
        return sorted(found, key=str)

    def levels(self):
        return {r.task_name: r.last_processed_block for r in self.store.read().collect()}


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


def test_rows_later_than_their_block_are_sent(world):
    world.arrive([("bsc", 10_005), ("polygon", 10_001)], [("bsc", 10_005)])
    world.publish()
    assert world.levels() == {"ethereum": 10_000, "bsc": 10_005}
    # A run later: a transaction and a log of that block, one of an older block, a block
    # below the watermark.
    world.arrive([("bsc", 10_004)], [("bsc", 10_005), ("bsc", 9_000), ("polygon", 1)], [("bsc", 10_005)])
    world.publish()
    world.publish()
    assert world.sent("blocks") == [("bsc", 10_004, None), ("bsc", 10_005, None)]
    assert world.sent("transactions") == [
        ("bsc", 10_005, "t1-10005"), ("bsc", 10_005, "t2-10005"), ("bsc", 9_000, "t2-9000"),
    ]
    assert len(world.sent("logs")) == 1
    assert world.levels() == {"ethereum": 10_000, "bsc": 10_005}


def test_a_failed_batch_is_sent_again(world, monkeypatch):
    world.arrive([("ethereum", 10_001)], [("ethereum", 10_001)])
    with monkeypatch.context() as patch:  # after all messages are out
        def away(*_):
            raise OSError("state is away")

        patch.setattr(publish, "move_watermarks", away)
        with pytest.raises(StreamingQueryException):
            world.publish()
    assert world.levels() == {"ethereum": 10_000, "bsc": 10_000}
    world.arrive([("ethereum", 10_002)])
    world.publish()
    sent = world.sent("blocks")
    assert set(sent) == {("ethereum", n, None) for n in (10_001, 10_002)}
    assert len(sent) == 3 and world.levels()["ethereum"] == 10_002


def test_bundle_messages(spark):
    sf = "/root/testdata/sf0.001"
    bundles = fixtures.bundles(spark, sf)
    found = bundle_messages(bundles)
    for table, part in bundle.split_bundles(bundles).items():
        entity = ENTITIES[table]
        mine = found.where(found["topic"] == entity.topic).select("key", "value")
        expected = encode(part, entity)
        assert mine.count() == expected.count()
        assert mine.exceptAll(expected).isEmpty()
    odd = spark.createDataFrame([(None, None, None)], BUNDLE_SCHEMA)
    assert bundle_messages(odd).isEmpty()


def test_publish_bundles_job(spark, tmp_path):
    block = dict.fromkeys(ENTITIES["blocks"].columns)
    tx = dict.fromkeys(ENTITIES["transactions"].columns)
    rows = []
    for n in (9_999, 10_001, 10_002):
        own = {"chainName": "bsc", "blockNumber": n}
        rows.append(({**block, **own, "blockHash": f"b{n}"}, [{**tx, **own, "txHash": f"t{n}"}] * 2, None))
    rows.append(({**block, "chainName": "polygon", "blockNumber": 10_001}, [], []))
    spark.createDataFrame(rows, BUNDLE_SCHEMA).write.parquet(str(tmp_path / "drop" / "deep"))
    out = ["--feed", "files", "--feed-location", str(tmp_path / "out"), "--state", str(tmp_path / "state")]
    for _ in range(2):
        main(["publish", "--root", str(tmp_path), *out, "--bundles", str(tmp_path / "drop")], spark)
    sent = Feed("files", str(tmp_path / "out"))
    counts = {t: sent.batch(spark, e).count() for t, e in ENTITIES.items()}
    assert counts == {"blocks": 2, "transactions": 4, "logs": 0}
    state = SyncStateStore(spark, str(tmp_path / "state")).read()
    assert {r.task_name: r.last_processed_block for r in state.collect()} == {"ethereum": 10_000, "bsc": 10_002}
