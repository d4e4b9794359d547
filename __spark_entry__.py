"""Queries on the test tables, each with the SQL that must give the same rows.

``entry(spark)`` is the flagship query at sf0.001, ``queries()`` has one entry
per operator, and ``oracle_sql()`` has the DuckDB text for the same key.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

import fixtures  # noqa: E402
from ledgerloom.functions.codec import accepted, decode, encode, rejected  # noqa: E402
from ledgerloom.functions.columns import json_long, normalize_amount  # noqa: E402
from ledgerloom.operators import bundle, quality, sync_state  # noqa: E402
from ledgerloom.operators.dedup import dedup_latest  # noqa: E402
from ledgerloom.plans import models, reports  # noqa: E402
from ledgerloom.plans.compaction import store_layout  # noqa: E402
from ledgerloom.plans.daily import silver_rows, silver_tests  # noqa: E402
from ledgerloom.schemas import ENTITIES, TRANSACTIONS  # noqa: E402
from ledgerloom.streaming.bronze import bronze_rows  # noqa: E402
from ledgerloom.streaming.speed import speed_rows  # noqa: E402

try:  # the training-data operators are an optional part
    import corpus_pipeline  # noqa: E402
    from ledgerloom.llm import queries as training_data  # noqa: E402
except ModuleNotFoundError as missing:
    # Only if the part itself is not there, not if it lacks something.
    if missing.name not in ("corpus_pipeline", "ledgerloom.llm", "ledgerloom.llm.queries"):
        raise
    corpus_pipeline = training_data = None

SMOKE_DIR = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Transactions per block and miner, from registered views."""
    for name in ("blocks", "transactions"):
        fixtures.entity(spark, SMOKE_DIR, name).createOrReplaceTempView(name)
    return reports.block_tx_counts(spark.table("blocks"), spark.table("transactions"))


# --- messages ---------------------------------------------------------------


def _encoded(table: str) -> Query:
    return lambda spark, sf: encode(fixtures.entity(spark, sf, table), ENTITIES[table])


def _bronze(table: str) -> Query:
    """Rows as messages, through the ingestion plan and back."""
    return lambda spark, sf: accepted(
        bronze_rows(_encoded(table)(spark, sf), ENTITIES[table])
    )


def _speed(table: str, shards: int) -> Query:
    return lambda spark, sf: accepted(
        speed_rows(_encoded(table)(spark, sf), ENTITIES[table], shards)
    )


def _compacted(table: str) -> Query:
    """Store rows that came twice, the second time a second later: the layout
    keeps the later copy of each."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = _stored(table)(spark, sf)
        again = rows.withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + 1000)
        return store_layout(rows.unionByName(again), ENTITIES[table])

    return query


def _stored(table: str) -> Query:
    names = ENTITIES[table].store_columns
    return lambda spark, sf: fixtures.entity(spark, sf, table).drop("dt").withColumnsRenamed(names)


def _json_decode(spark: SparkSession, sf: str) -> DataFrame:
    return accepted(decode(_encoded("transactions")(spark, sf), TRANSACTIONS))


def _quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Every 7th block's messages are cut off, every 11th block's lack the key,
    every 13th block's have an amount that is no number."""
    txs = fixtures.entity(spark, sf, "transactions")
    block = F.col("blockNumber")
    value = (
        F.when(block % 7 == 0, F.concat(F.lit('{"txHash":"'), "txHash"))
        .when(block % 11 == 0, F.concat(F.lit('{"chainName":"bsc","data":"'), "txHash", F.lit('"}')))
        .when(
            block % 13 == 0,
            F.concat(
                F.lit('{"chainName":"bsc","blockNumber":1,"value":"ten","txHash":"'),
                "txHash",
                F.lit('"}'),
            ),
        )
        .otherwise(
            F.concat(F.lit('{"chainName":"bsc","blockNumber":1,"txHash":"'), "txHash", F.lit('"}'))
        )
    )
    messages = txs.select(value.alias("value"))
    return rejected(decode(messages, TRANSACTIONS, check_amount=True))


def _normalize_amount(spark: SparkSession, sf: str) -> DataFrame:
    """Missing, plain, exponent, fraction, and 78-digit amounts."""
    items = fixtures.table(spark, sf, "lineitem")
    form, part = F.col("l_linenumber") % 5, F.col("l_partkey").cast("string")
    amount = (
        F.when(form == 1, part)
        .when(form == 2, F.concat(part, F.lit("E"), (F.col("l_linenumber") + 20).cast("string")))
        .when(form == 3, F.concat(F.lit("00"), part, F.lit(".50")))
        .when(form == 4, F.concat(F.lit("-"), part, F.lit(".5e-3")))
        .when(F.col("l_suppkey") % 2 == 0, F.rpad(F.concat(F.lit("1"), part), 78, "7"))
    )
    amounts = items.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", amount.alias("amount")
    )
    return normalize_amount(amounts, "amount")


def _json_path_cast(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.table(spark, sf, "events").select(
        "event_id", json_long(F.col("props"), "$.k").alias("k")
    )


def _bundle(part: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: part(fixtures.bundles(spark, sf))


# --- reports and models -----------------------------------------------------


def _on(report: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda spark, sf: report(*[fixtures.entity(spark, sf, t) for t in tables])


def _silver(spark: SparkSession, sf: str, lineage: bool = False) -> DataFrame:
    return models.silver_transactions(
        fixtures.entity(spark, sf, "transactions", lineage=lineage)
    )


def _silver_with_files(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(spark, sf, lineage=True)


def _silver_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Silver of transactions that came twice, the second time a second later."""
    rows = fixtures.entity(spark, sf, "transactions")
    again = rows.withColumn("ingestionTimestamp", F.col("ingestionTimestamp") + 1000)
    return silver_rows(rows.unionByName(again)).drop("s3_file_path")


def _whales(spark: SparkSession, sf: str) -> DataFrame:
    return models.ranked(models.whale_wallets(_silver(spark, sf)))


def _dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    items = fixtures.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    order = [F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_extendedprice"]
    kept = dedup_latest(items, ["l_orderkey", "l_linenumber"], order)
    return kept.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


# --- incremental-load state -------------------------------------------------


def _watermark_read(spark: SparkSession, sf: str) -> DataFrame:
    return sync_state.high_watermark(fixtures.sync_state(spark, sf), "ethereum")


def _watermark_init(spark: SparkSession, sf: str) -> DataFrame:
    chains = fixtures.entity(spark, sf, "blocks").select(F.col("chainName").alias("task_name"))
    return sync_state.init_tasks(fixtures.sync_state(spark, sf), chains).drop("updated_at")


def _watermark_advance(spark: SparkSession, sf: str) -> DataFrame:
    tips = sync_state.chain_tips(fixtures.entity(spark, sf, "blocks"))
    return sync_state.advance(fixtures.sync_state(spark, sf), tips).drop("updated_at")


def _watermark_slice(spark: SparkSession, sf: str) -> DataFrame:
    return sync_state.pending(
        fixtures.entity(spark, sf, "blocks"), fixtures.sync_state(spark, sf)
    )


# --- data tests -------------------------------------------------------------


def _silver_with_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Silver in which every 5th block lacks amounts and every 7th senders."""
    return _silver(spark, sf).withColumns(
        {
            "tx_value": F.when(F.col("block_number") % 5 != 0, F.col("tx_value")),
            "from_address": F.when(F.col("block_number") % 7 != 0, F.col("from_address")),
        }
    )


def _dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.not_null(_silver_with_nulls(spark, sf), ["tx_value", "from_address"])


def _dq_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return quality.accepted_values(_silver(spark, sf), "chain_name", ["eth", "bsc", "polygon"])


def _dq_table_tests(spark: SparkSession, sf: str) -> DataFrame:
    return quality.failure_counts(_silver_with_nulls(spark, sf), silver_tests(["eth", "bsc", "polygon"]))


def queries() -> dict[str, Query]:
    if training_data is None:
        return core_queries()
    optional = training_data.queries() | {"pipeline": corpus_pipeline.run}
    return core_queries() | {name: _importable(query) for name, query in optional.items()}


def _importable(query: Query) -> Query:
    """For Python workers: this folder is on their path, as it is on the driver's."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = spark.sparkContext.environment.get("PYTHONPATH", "")
        if ROOT not in path.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, path]))
        return query(spark, sf)

    return run


def core_queries() -> dict[str, Query]:
    return {
        "json_encode": _encoded("transactions"),
        "json_encode_blocks": _encoded("blocks"),
        "json_encode_logs": _encoded("logs"),
        "json_decode": _json_decode,
        "json_path_cast": _json_path_cast,
        "quarantine": _quarantine,
        "normalize_amount": _normalize_amount,
        "bronze_blocks": _bronze("blocks"),
        "bronze_transactions": _bronze("transactions"),
        "bronze_logs": _bronze("logs"),
        "speed_blocks": _speed("blocks", 2),
        "speed_transactions": _speed("transactions", 2),
        "speed_logs": _speed("logs", 3),
        "compacted_blocks": _compacted("blocks"),
        "compacted_transactions": _compacted("transactions"),
        "compacted_logs": _compacted("logs"),
        "shard_counts": _on(reports.shard_counts, "blocks"),
        "explode_bundle": _bundle(bundle.transaction_feed),
        "explode_bundle_blocks": _bundle(bundle.block_feed),
        "explode_bundle_logs": _bundle(bundle.log_feed),
        "bundle_messages": _bundle(bundle.bundle_messages),
        "latest_transactions": _on(reports.latest_transactions, "transactions"),
        "daily_tx_counts": _on(reports.daily_tx_counts, "transactions"),
        "chain_tip": _on(reports.chain_tip, "blocks"),
        "block_tx_counts": _on(reports.block_tx_counts, "blocks", "transactions"),
        "block_tx_counts_by_chain": _on(
            reports.block_tx_counts_by_chain, "blocks", "transactions"
        ),
        "top_blocks": _on(reports.top_blocks, "blocks", "transactions"),
        "silver_transactions": _silver_with_files,
        "silver_dedup": _silver_dedup,
        "whale_wallets": _whales,
        "dedup_latest": _dedup_latest,
        "watermark_read": _watermark_read,
        "watermark_init": _watermark_init,
        "watermark_advance": _watermark_advance,
        "watermark_slice": _watermark_slice,
        "dq_not_null": _dq_not_null,
        "dq_accepted_values": _dq_accepted_values,
        "dq_table_tests": _dq_table_tests,
    }


# --- oracle -----------------------------------------------------------------


def _encode_sql(table: str, source: str | None = None) -> str:
    entity = ENTITIES[table]
    fields = ", ".join(f'"{c}" := "{c}"' for c in entity.columns)
    return (
        f'SELECT "{entity.message_key}" AS key, '
        f"CAST(to_json(struct_pack({fields})) AS VARCHAR) AS value FROM {source or table}"
    )


def _speed_sql(table: str, shards: int) -> str:
    renamed = ", ".join(f'"{c}" AS {s}' for c, s in ENTITIES[table].store_columns.items())
    return (
        f"SELECT {renamed}, CAST(abs(\"blockNumber\") % {shards} AS INTEGER) AS shard FROM {table}"
    )


def _compacted_sql(table: str) -> str:
    entity = ENTITIES[table]
    renamed = ", ".join(
        f'"{c}" + 1000 AS {s}' if s == "ingestion_timestamp" else f'"{c}" AS {s}'
        for c, s in entity.store_columns.items()
    )
    key = ", ".join(entity.store_key)
    rest = ", ".join(
        s
        for s in entity.store_columns.values()
        if s not in entity.store_key and s != "ingestion_timestamp"
    )
    return (
        f"SELECT * FROM (SELECT {renamed} FROM {table}) QUALIFY row_number() OVER "
        f"(PARTITION BY {key} ORDER BY ingestion_timestamp DESC, {rest}) = 1"
    )


_SILVER_SQL = """
    SELECT "chainName" AS chain_name, "blockNumber" AS block_number,
           "from" AS from_address, "to" AS to_address, value AS tx_value,
           CAST(dt AS DATE) AS partition_date, 'lineitem.parquet' AS s3_file_path
    FROM transactions WHERE "to" IS NOT NULL
"""

_SILVER_NULLS_SQL = f"""
    SELECT * REPLACE (CASE WHEN block_number % 5 <> 0 THEN tx_value END AS tx_value,
                      CASE WHEN block_number % 7 <> 0 THEN from_address END AS from_address)
    FROM ({_SILVER_SQL})
"""

_BLOCK_JOIN_SQL = """
    FROM blocks b LEFT JOIN transactions t
      ON b."blockNumber" = t."blockNumber" AND b."chainName" = t."chainName"
"""

_BUNDLE_N = 'CAST(right(miner, 6) AS BIGINT) % 4'


_BUNDLE_TXS_SQL = f"""
    SELECT "chainName", concat("blockHash", '-', i) AS "txHash", "blockNumber",
           "blockHash", miner AS "from", "blockHash" AS "to",
           concat(i, '0000000') AS value, timestamp, "ingestionTimestamp"
    FROM (SELECT *, unnest(range(1, {_BUNDLE_N} + 1)) AS i FROM blocks)
"""
_BUNDLE_LOGS_SQL = f"""
    SELECT "chainName", j - 1 AS "logIndex", "blockNumber", "blockHash",
           concat("blockHash", '-', (j + 1) // 2) AS "txHash", miner AS address,
           'transfer' AS topic0, CAST(NULL AS VARCHAR) AS topic1,
           CAST(NULL AS VARCHAR) AS topic2, CAST(NULL AS VARCHAR) AS topic3,
           CAST(j AS VARCHAR) AS data, timestamp, "ingestionTimestamp"
    FROM (SELECT *, unnest(range(1, 2 * ({_BUNDLE_N}) + 1)) AS j FROM blocks)
"""


def _bundle_messages_sql() -> str:
    parts = {"blocks": "blocks", "transactions": f"({_BUNDLE_TXS_SQL})", "logs": f"({_BUNDLE_LOGS_SQL})"}
    return " UNION ALL ".join(
        f"SELECT '{ENTITIES[t].topic}' AS topic, * FROM ({_encode_sql(t, source)})" for t, source in parts.items()
    )


def oracle_sql() -> dict[str, str]:
    state = fixtures.SYNC_STATE_SQL
    on_entities = {
        "bundle_messages": _bundle_messages_sql(),
        "json_encode": _encode_sql("transactions"),
        "json_encode_blocks": _encode_sql("blocks"),
        "json_encode_logs": _encode_sql("logs"),
        "json_decode": "SELECT * EXCLUDE (dt) FROM transactions",
        "bronze_blocks": "SELECT * FROM blocks",
        "bronze_transactions": "SELECT * FROM transactions",
        "bronze_logs": "SELECT * FROM logs",
        "speed_blocks": _speed_sql("blocks", 2),
        "speed_transactions": _speed_sql("transactions", 2),
        "speed_logs": _speed_sql("logs", 3),
        "compacted_blocks": _compacted_sql("blocks"),
        "compacted_transactions": _compacted_sql("transactions"),
        "compacted_logs": _compacted_sql("logs"),
        "quarantine": """
            SELECT CASE WHEN "blockNumber" % 7 = 0 THEN 'undecodable'
                        WHEN "blockNumber" % 11 = 0 THEN 'missing_key'
                        ELSE 'bad_amount' END AS status,
                   CASE WHEN "blockNumber" % 7 = 0 THEN concat('{"txHash":"', "txHash")
                        WHEN "blockNumber" % 11 = 0
                        THEN concat('{"chainName":"bsc","data":"', "txHash", '"}')
                        ELSE concat('{"chainName":"bsc","blockNumber":1,"value":"ten","txHash":"',
                                    "txHash", '"}') END AS raw
            FROM transactions
            WHERE "blockNumber" % 7 = 0 OR "blockNumber" % 11 = 0 OR "blockNumber" % 13 = 0
        """,
        "shard_counts": """
            SELECT CAST(abs("blockNumber") % 2 AS INTEGER) AS shard, count(*) AS n_rows
            FROM blocks GROUP BY 1
        """,
        "explode_bundle": _BUNDLE_TXS_SQL,
        "explode_bundle_blocks": "SELECT * EXCLUDE (dt) FROM blocks",
        "explode_bundle_logs": _BUNDLE_LOGS_SQL,
        "latest_transactions": """
            SELECT "chainName", "blockNumber", "txHash", "from", "to", value
            FROM transactions ORDER BY timestamp DESC, "txHash" LIMIT 5
        """,
        "daily_tx_counts": """
            SELECT "chainName", dt, count(*) AS tx_count
            FROM transactions GROUP BY "chainName", dt ORDER BY dt DESC, tx_count DESC
        """,
        "chain_tip": """
            SELECT "chainName", max("blockNumber") AS latest_block
            FROM blocks GROUP BY "chainName"
        """,
        "block_tx_counts": f"""
            SELECT b."blockNumber", b.miner, count(t."txHash") AS tx_count
            {_BLOCK_JOIN_SQL} GROUP BY b."blockNumber", b.miner
        """,
        "block_tx_counts_by_chain": f"""
            SELECT b."chainName", b."blockNumber", b.miner, count(t."txHash") AS tx_count
            {_BLOCK_JOIN_SQL} GROUP BY b."chainName", b."blockNumber", b.miner
        """,
        "top_blocks": f"""
            SELECT b."blockNumber", b.miner, count(t."txHash") AS tx_count
            {_BLOCK_JOIN_SQL} GROUP BY b."blockNumber", b.miner
            ORDER BY b."blockNumber" DESC, b.miner LIMIT 5
        """,
        "silver_transactions": _SILVER_SQL,
        "silver_dedup": f"SELECT * EXCLUDE (s3_file_path) FROM ({_SILVER_SQL})",
        "whale_wallets": f"""
            SELECT from_address AS whale_wallet, count(*) AS total_tx_count,
                   max(partition_date) AS last_active_date
            FROM ({_SILVER_SQL}) GROUP BY from_address HAVING count(*) > 5
            ORDER BY total_tx_count DESC
        """,
        "watermark_read": f"""
            SELECT last_processed_block FROM ({state}) WHERE task_name = 'ethereum'
        """,
        "watermark_init": f"""
            SELECT * FROM ({state}) UNION ALL
            SELECT DISTINCT "chainName", CAST(10000 AS BIGINT) FROM blocks
            WHERE "chainName" NOT IN (SELECT task_name FROM ({state}))
        """,
        "watermark_advance": f"""
            SELECT coalesce(s.task_name, t.task_name) AS task_name,
                   greatest(coalesce(last_processed_block, 0), coalesce(reached, 0))
                     AS last_processed_block
            FROM ({state}) s FULL OUTER JOIN
                 (SELECT "chainName" AS task_name, max("blockNumber") AS reached
                  FROM blocks GROUP BY 1) t ON s.task_name = t.task_name
        """,
        "watermark_slice": f"""
            SELECT b.* FROM blocks b LEFT JOIN ({state}) s ON b."chainName" = s.task_name
            WHERE b."blockNumber" > coalesce(s.last_processed_block, 10000)
        """,
        "dq_not_null": f"""
            SELECT count(*) FILTER (WHERE tx_value IS NULL) AS tx_value,
                   count(*) FILTER (WHERE from_address IS NULL) AS from_address
            FROM ({_SILVER_NULLS_SQL})
        """,
        "dq_accepted_values": f"""
            SELECT chain_name, count(*) AS n_records FROM ({_SILVER_SQL})
            WHERE chain_name NOT IN ('eth', 'bsc', 'polygon') GROUP BY chain_name
        """,
        "dq_table_tests": f"""
            SELECT count(*) FILTER (WHERE tx_value IS NULL) AS not_null_tx_value,
                   count(*) FILTER (WHERE chain_name NOT IN ('eth', 'bsc', 'polygon'))
                     AS accepted_values_chain_name
            FROM ({_SILVER_NULLS_SQL})
        """,
    }
    on_tables = {
        "json_path_cast": """
            SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
        """,
        "normalize_amount": """
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CASE l_linenumber % 5
                     WHEN 1 THEN CAST(l_partkey AS VARCHAR)
                     WHEN 2 THEN CASE WHEN l_partkey = 0 THEN '0'
                       ELSE concat(l_partkey, repeat('0', l_linenumber + 20)) END
                     WHEN 3 THEN concat(l_partkey, '.50')
                     WHEN 4 THEN concat('-', l_partkey // 1000, '.',
                                        lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0'), '5')
                     ELSE CASE WHEN l_suppkey % 2 = 0
                       THEN rpad(concat('1', l_partkey), 78, '7') ELSE '0' END
                   END AS amount
            FROM lineitem
        """,
        "dedup_latest": """
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                   CAST(l_shipdate AS DATE) AS l_shipdate
            FROM (SELECT *, row_number() OVER (
                    PARTITION BY l_orderkey, l_linenumber
                    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn
                  FROM lineitem)
            WHERE rn = 1
        """,
    }
    optional = training_data.oracle_sql() if training_data else {}
    return {k: fixtures.with_entities(v) for k, v in on_entities.items()} | on_tables | optional
