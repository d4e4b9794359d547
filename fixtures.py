"""The test tables seen as ledger entities.

Orders stand for blocks, line items for transactions and events for logs. Each
column is written once for both engines; what differs is filled in per engine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.bundle import BUNDLE_SCHEMA
from ledgerloom.sources.lake import with_source_path

SPARK = {
    "S": "STRING",
    "epoch": "unix_timestamp({d})",
    "date": "from_unixtime(unix_timestamp({d}), 'yyyy-MM-dd')",
    "quote": "`",
}
DUCKDB = {
    "S": "VARCHAR",
    # A plain cast would round half seconds up.
    "epoch": "CAST(floor(epoch({d})) AS BIGINT)",
    "date": "strftime({d}, '%Y-%m-%d')",
    "quote": '"',
}

_CHAIN = "CASE {k} % 3 WHEN 0 THEN 'ethereum' WHEN 1 THEN 'bsc' ELSE 'polygon' END"
_HASH = "concat('0x', lpad(CAST({k} AS {S}), 32, '0'))"
_ADDRESS = "concat('0x', lpad(CAST({a} AS {S}), 40, '0'))"
_TX_HASH = (
    "concat_ws('-', CAST(l_orderkey AS {S}), CAST(l_linenumber AS {S}), "
    "CAST(l_partkey AS {S}), CAST(l_suppkey AS {S}))"
)

# entity -> (table, key column, time column, columns)
_VIEWS: dict[str, tuple[str, str, str, dict[str, str]]] = {
    "blocks": (
        "orders",
        "o_orderkey",
        "o_orderdate",
        {
            "chainName": _CHAIN,
            "blockNumber": "{k}",
            "blockHash": _HASH,
            "parentHash": _HASH.replace("{k}", "greatest({k} - 1, 0)"),
            "timestamp": "{epoch}",
            "miner": _ADDRESS.replace("{a}", "o_custkey"),
            "baseFeePerGas": "20000000000 + (o_custkey % 1000) * 1000000",
            "ingestionTimestamp": "{epoch} * 1000 + 500",
            "dt": "{date}",
        },
    ),
    "transactions": (
        "lineitem",
        "l_orderkey",
        "l_shipdate",
        {
            "chainName": _CHAIN,
            "txHash": _TX_HASH,
            "blockNumber": "{k}",
            "blockHash": _HASH,
            "from": _ADDRESS.replace("{a}", "l_partkey * 8 + l_linenumber"),
            "to": "CASE WHEN l_returnflag <> 'N' THEN "
            + _ADDRESS.replace("{a}", "l_suppkey")
            + " END",
            "value": "concat(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS {S}), '0000000')",
            "timestamp": "{epoch}",
            "ingestionTimestamp": "{epoch} * 1000 + 500",
            "dt": "{date}",
        },
    ),
    "logs": (
        "events",
        "event_id",
        "ts",
        {
            "chainName": _CHAIN,
            "logIndex": "{k}",
            "blockNumber": "{k}",
            "blockHash": _HASH,
            "txHash": "concat('0x', lpad(CAST({k} * 7 AS {S}), 32, '0'))",
            "address": _ADDRESS.replace("{a}", "user_id"),
            "topic0": "event_type",
            "topic1": "CAST(NULL AS {S})",
            "topic2": "CAST(NULL AS {S})",
            "topic3": "CAST(NULL AS {S})",
            "data": "props",
            "timestamp": "{epoch}",
            "ingestionTimestamp": "{epoch} * 1000 + 500",
            "dt": "{date}",
        },
    ),
}


def _expressions(entity: str, engine: Mapping[str, str]) -> tuple[str, list[str]]:
    table, key, time, columns = _VIEWS[entity]
    fill = {
        "{epoch}": engine["epoch"],
        "{date}": engine["date"],
        "{k}": key,
        "{d}": time,
        "{S}": engine["S"],
    }
    quote = engine["quote"]
    selected = []
    for name, text in columns.items():
        for mark, replacement in fill.items():
            text = text.replace(mark, replacement)
        selected.append(f"{text} AS {quote}{name}{quote}")
    return table, selected


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The time-zone-free timestamps of the test tables are read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entity(spark: SparkSession, sf_dir: str, name: str, *, lineage: bool = False) -> DataFrame:
    source, columns = _expressions(name, SPARK)
    scan = table(spark, sf_dir, source)
    if lineage:
        scan = with_source_path(scan, sf_dir)
        columns = [*columns, "source_path"]
    return scan.selectExpr(*columns)


def entity_sql(name: str) -> str:
    source, columns = _expressions(name, DUCKDB)
    return f"SELECT {', '.join(columns)} FROM {source}"


def with_entities(sql: str) -> str:
    """Put the entity views in front of a DuckDB query."""
    views = ", ".join(f"{name} AS ({entity_sql(name)})" for name in _VIEWS)
    return f"WITH {views} {sql}"


def bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bundle per order: its block, `o_custkey % 4` transactions (so some
    blocks have none) and two logs for each of them."""
    block = entity(spark, sf_dir, "blocks").drop("dt")
    n = "CAST(right(miner, 6) AS BIGINT) % 4"
    tx = (
        "named_struct('chainName', chainName, 'txHash', concat(blockHash, '-', i), "
        "'blockNumber', blockNumber, 'blockHash', blockHash, 'from', miner, "
        "'to', blockHash, 'value', concat(i, '0000000'), 'timestamp', timestamp, "
        "'ingestionTimestamp', ingestionTimestamp)"
    )
    log = (
        "named_struct('chainName', chainName, 'logIndex', j - 1, "
        "'blockNumber', blockNumber, 'blockHash', blockHash, "
        "'txHash', concat(blockHash, '-', (j + 1) div 2), 'address', miner, "
        "'topic0', 'transfer', 'topic1', CAST(NULL AS STRING), "
        "'topic2', CAST(NULL AS STRING), 'topic3', CAST(NULL AS STRING), "
        "'data', CAST(j AS STRING), 'timestamp', timestamp, "
        "'ingestionTimestamp', ingestionTimestamp)"
    )
    nested = block.selectExpr(
        f"struct({', '.join(f'`{c}`' for c in block.columns)}) AS block",
        f"transform(filter(sequence(0L, {n}), i -> i > 0), i -> {tx}) AS transactions",
        f"transform(filter(sequence(0L, 2 * ({n})), j -> j > 0), j -> {log}) AS logs",
    )
    return nested.to(BUNDLE_SCHEMA)


def sync_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State in which ethereum is halfway, bsc is ahead of the data and polygon
    is unknown."""
    return (
        entity(spark, sf_dir, "blocks")
        .where("chainName <> 'polygon'")
        .groupBy("chainName")
        .agg({"blockNumber": "max"})
        .selectExpr(
            "chainName AS task_name",
            "CASE chainName WHEN 'bsc' THEN `max(blockNumber)` * 2 "
            "ELSE `max(blockNumber)` div 2 END AS last_processed_block",
            "TIMESTAMP '2024-01-01 00:00:00' AS updated_at",
        )
    )


SYNC_STATE_SQL = (
    'SELECT "chainName" AS task_name, CASE "chainName" WHEN \'bsc\' '
    'THEN max("blockNumber") * 2 ELSE max("blockNumber") // 2 END '
    "AS last_processed_block FROM blocks WHERE \"chainName\" <> 'polygon' "
    'GROUP BY "chainName"'
)
