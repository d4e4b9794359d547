"""The command line, end to end over text files."""

import json

import pytest

from ledgerloom.jobs import main, parser
from ledgerloom.plans.compaction import compacted_table
from ledgerloom.schemas import ENTITIES
from ledgerloom.sources.feeds import Feed
from ledgerloom.sources.lake import Lake


def test_jobs_end_to_end(spark, tmp_path, capfd):
    root, feed_dir = str(tmp_path / "lake"), tmp_path / "feed"
    for entity in ENTITIES.values():
        (feed_dir / entity.topic).mkdir(parents=True)
    base = {"chainName": "bsc", "timestamp": 1_700_000_000, "blockNumber": 10_001}
    blocks = [{**base, "blockHash": "b", "miner": "m"}]
    txs = [{**base, "txHash": f"t{i}", "from": "whale", "to": "x", "value": "1"} for i in range(6)]
    logs = [{**base, "logIndex": i, "txHash": "t0", "address": "a"} for i in range(2)]
    for table, rows in {"blocks": blocks, "transactions": txs, "logs": logs}.items():
        lines = "".join(json.dumps(r) + "\n" for r in rows)
        (feed_dir / ENTITIES[table].topic / "1.txt").write_text(lines)

    feed = ["--feed", "files", "--feed-location", str(feed_dir)]
    main(["ingest", "--root", root, *feed, "--once"], spark)
    main(["speed", "--root", root, *feed, "--once", "--shards", "3"], spark)
    main(["compact", "--root", root], spark)
    main(["daily", "--root", root], spark)
    capfd.readouterr()
    main(["report", "--root", root, "--whales"], spark)
    shown = capfd.readouterr().out
    assert "10001|m    |6" in shown.replace(" |m", "|m") or "|10001      |m    |6       |" in shown
    assert "whale" in shown and "2023-11-14" in shown

    assert compacted_table(Lake(spark, root), ENTITIES["transactions"]).read().count() == 6
    assert Lake(spark, root).read("gold", "mart_smart_money").count() == 1

    out = ["--feed", "files", "--feed-location", str(tmp_path / "out")]
    for _ in range(2):
        main(["publish", "--root", root, *out, "--once", "--state", str(tmp_path / "state")], spark)
    sent = Feed("files", str(tmp_path / "out"))
    assert {t: sent.batch(spark, e).count() for t, e in ENTITIES.items()} == {
        "blocks": 1,
        "transactions": 6,
        "logs": 2,
    }


def test_unknown_job():
    with pytest.raises(SystemExit):
        parser().parse_args(["unknown"])
