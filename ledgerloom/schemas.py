"""The three ledger entities and the extractor state, each declared once.

Every other schema in the package (messages, bronze, speed store) is derived
from these declarations.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql.types import (
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ledgerloom import fixed

LONG = LongType()
TEXT = StringType()

# Columns that the ingestion jobs add to a decoded message.
RAW = "raw"  # message text, kept only for rows that were not accepted
STATUS = "status"  # "ok" or the reason for quarantine
CORRUPT = "_corrupt_record"

OK = "ok"
UNDECODABLE = "undecodable"
MISSING_KEY = "missing_key"
BAD_AMOUNT = "bad_amount"

# `from` and `to` are reserved words in SQL stores and get their own names.
_STORE_NAMES = {"from": "from_address", "to": "to_address"}


def store_name(message_field: str) -> str:
    """camelCase message field -> snake_case store column."""
    return _STORE_NAMES.get(
        message_field, re.sub(r"([A-Z])", r"_\1", message_field).lower()
    )


@dataclass(frozen=True)
class Entity:
    table: str
    topic: str
    message_key: str
    fields: tuple[tuple[str, DataType], ...]
    natural_key: tuple[str, ...]
    store_order: tuple[str, ...]
    amount: str | None = None

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def required(self) -> tuple[str, ...]:
        """Fields a row cannot be stored without: its key, and the block it hangs on."""
        extra = () if "blockNumber" in self.natural_key else ("blockNumber",)
        return self.natural_key + extra

    @property
    def message_schema(self) -> StructType:
        return StructType([StructField(n, t) for n, t in self.fields])

    @property
    def bronze_schema(self) -> StructType:
        return (
            self.message_schema.add(RAW, TEXT).add(STATUS, TEXT).add("dt", TEXT)
        )

    @property
    def store_columns(self) -> dict[str, str]:
        return {name: store_name(name) for name in self.columns}

    @property
    def store_key(self) -> tuple[str, ...]:
        return tuple(store_name(name) for name in self.natural_key)

    @property
    def store_schema(self) -> StructType:
        return StructType([StructField(store_name(n), t) for n, t in self.fields])


BLOCKS = Entity(
    table="blocks",
    topic=fixed.TOPIC_BLOCKS,
    message_key="blockHash",
    fields=(
        ("chainName", TEXT),
        ("blockNumber", LONG),
        ("blockHash", TEXT),
        ("parentHash", TEXT),
        ("timestamp", LONG),  # seconds
        ("miner", TEXT),
        ("baseFeePerGas", LONG),
        ("ingestionTimestamp", LONG),  # milliseconds
    ),
    natural_key=("chainName", "blockNumber"),
    store_order=("block_number",),
)

TRANSACTIONS = Entity(
    table="transactions",
    topic=fixed.TOPIC_TRANSACTIONS,
    message_key="txHash",
    fields=(
        ("chainName", TEXT),
        ("txHash", TEXT),
        ("blockNumber", LONG),
        ("blockHash", TEXT),
        ("from", TEXT),
        ("to", TEXT),
        ("value", TEXT),  # text: amounts go beyond every numeric type
        ("timestamp", LONG),
        ("ingestionTimestamp", LONG),
    ),
    natural_key=("chainName", "txHash"),
    store_order=("block_number", "tx_hash"),
    amount="value",
)

LOGS = Entity(
    table="logs",
    topic=fixed.TOPIC_LOGS,
    message_key="address",
    fields=(
        ("chainName", TEXT),
        ("logIndex", LONG),  # counts through the whole block
        ("blockNumber", LONG),
        ("blockHash", TEXT),
        ("txHash", TEXT),
        ("address", TEXT),
        ("topic0", TEXT),
        ("topic1", TEXT),
        ("topic2", TEXT),
        ("topic3", TEXT),
        ("data", TEXT),
        ("timestamp", LONG),
        ("ingestionTimestamp", LONG),
    ),
    natural_key=("chainName", "blockNumber", "logIndex"),
    store_order=("block_number", "tx_hash", "log_index"),
)

ENTITIES = {e.table: e for e in (BLOCKS, TRANSACTIONS, LOGS)}

SYNC_STATE_SCHEMA = StructType(
    [
        StructField("task_name", TEXT, False),
        StructField("last_processed_block", LONG, False),
        StructField("updated_at", TimestampType()),
    ]
)
