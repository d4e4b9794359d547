"""Scalar work: amounts, dates, shards, JSON paths, file paths."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.columns import (
    is_bad_amount,
    json_long,
    normalize_amount,
    partition_date,
    shard_of,
)
from ledgerloom.schemas import BLOCKS, LOGS, TRANSACTIONS
from ledgerloom.sources.lake import relative_path

AMOUNTS = {
    None: "0",
    "": "0",
    "  ": "0",
    "0": "0",
    "007": "7",
    "+5": "5",
    "-5": "-5",
    "-0": "0",
    "-0.0": "0.0",
    "1.0E25": "1" + "0" * 25,
    "1e5": "100000",
    "1e00005": "100000",
    "1e99999": None,
    "1.50": "1.50",
    ".5": "0.5",
    "5.": "5",
    "0E3": "0",
    "0.00": "0.00",
    "1.5E-3": "0.0015",
    "12.345e1": "123.45",
    "12.345e3": "12345",
    " 42 ": "42",
    "9" * 78: "9" * 78,
    "ten": None,
    "1e": None,
    ".": None,
    "1,000": None,
    "0x10": None,
    "1 2": None,
}


def _number_text(rng):
    text = rng.choice(["", "-", "+"])
    digits = "".join(rng.choice("0123456789") for _ in range(rng.randint(1, 80)))
    point = rng.randint(0, len(digits))
    text += digits if rng.random() < 0.5 else f"{digits[:point]}.{digits[point:]}"
    if rng.random() < 0.6:
        text += rng.choice("eE") + rng.choice(["", "+", "-"]) + str(rng.randint(0, 90))
    return text


def _plain(text):
    number = Decimal(text)
    sign, digits, exponent = number.as_tuple()
    if exponent >= 0:
        number = Decimal(int("".join(map(str, digits))) * 10**exponent * (-1 if sign else 1))
    plain = format(number, "f")
    return plain.lstrip("-") if not number else plain


def test_listed_amounts(spark):
    rows = spark.createDataFrame([(a,) for a in AMOUNTS], "raw STRING")
    out = normalize_amount(rows.withColumn("value", F.col("raw")), "value")
    bad = rows.where(is_bad_amount(F.col("raw")))
    assert {r.raw: r.value for r in out.collect()} == AMOUNTS
    assert {r.raw for r in bad.collect()} == {a for a, v in AMOUNTS.items() if v is None}


def test_random_amounts_against_decimal(spark):
    rng = random.Random(7)
    texts = [_number_text(rng) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "raw STRING")
    out = normalize_amount(rows.withColumn("value", F.col("raw")), "value").collect()
    assert {r.raw: r.value for r in out} == {t: _plain(t) for t in texts}


@pytest.mark.parametrize("zone", ["UTC", "America/Toronto", "Asia/Tokyo"])
def test_partition_date_is_utc_in_any_zone(spark, zone):
    cases = {
        0: "1970-01-01",
        -1: "1969-12-31",
        1_700_006_399: "2023-11-14",
        1_700_006_400: "2023-11-15",
        1_700_000_000_000: "+55840-11-08",
        2**63 - 1: None,
        -(2**63): None,
        None: None,
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t BIGINT")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        out = rows.select("t", partition_date(F.col("t")).alias("dt")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {r.t: r.dt for r in out} == cases
    day = datetime.datetime.fromtimestamp(1_700_006_400, datetime.UTC).date()
    assert cases[1_700_006_400] == day.isoformat()


def test_shard_is_never_negative(spark):
    numbers = [0, 1, 5, -4, 2**63 - 1, -(2**63)]
    rows = spark.createDataFrame([(n,) for n in numbers], "n BIGINT")
    out = {r.n: r.s for r in rows.select("n", shard_of(F.col("n"), 3).alias("s")).collect()}
    assert out == {n: n % 3 for n in numbers}


def test_json_path(spark):
    texts = {'{"k": 5}': 5, '{"k": "6"}': 6, '{"k": "x"}': None, '{"j": 1}': None, "no": None}
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    out = rows.select("t", json_long(F.col("t"), "$.k").alias("k")).collect()
    assert {r.t: r.k for r in out} == texts


@pytest.mark.parametrize(
    ("path", "root", "expected"),
    [
        ("file:///data/lake/a/b.parquet", "/data/lake", "a/b.parquet"),
        ("file:///data/lake/a/b.parquet", "/data/lake/", "a/b.parquet"),
        ("file:///data/lake/a/b.parquet", "file:///data/lake", "a/b.parquet"),
        ("file:///data/my%20lake/a.parquet", "/data/my lake", "a.parquet"),
        ("s3a://lake/a/b.parquet", "s3a://lake", "a/b.parquet"),
        ("s3a://bucket/lake/lake/b.parquet", "s3a://bucket/lake", "lake/b.parquet"),
        ("hdfs://node:8020/lake/b.parquet", "/lake", "b.parquet"),
        ("file:///elsewhere/b.parquet", "/data/lake", "file:///elsewhere/b.parquet"),
    ],
)
def test_relative_path(spark, path, root, expected):
    row = spark.range(1).select(relative_path(F.lit(path), root).alias("p")).first()
    assert row.p == expected


def test_store_names():
    assert TRANSACTIONS.store_columns == {
        "chainName": "chain_name",
        "txHash": "tx_hash",
        "blockNumber": "block_number",
        "blockHash": "block_hash",
        "from": "from_address",
        "to": "to_address",
        "value": "value",
        "timestamp": "timestamp",
        "ingestionTimestamp": "ingestion_timestamp",
    }
    assert BLOCKS.store_columns["baseFeePerGas"] == "base_fee_per_gas"
    assert LOGS.store_columns["topic0"] == "topic0"
    assert LOGS.store_key == ("chain_name", "block_number", "log_index")
