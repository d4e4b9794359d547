"""Where the raw messages come from and go to: a Kafka cluster, or a directory
with one folder of text files per topic (one message per line)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.codec import encode
from ledgerloom.schemas import ENTITIES, Entity

# A stream starts at the earliest message, so the first batches may face a long
# backlog: the limits per trigger cut it into batches that commit one by one. A
# Kafka partition can hold far more than its share (logs are keyed by contract
# address), so one is read by as many tasks as it needs.
KAFKA_DEFAULTS = {
    "startingOffsets": "earliest",
    "maxOffsetsPerTrigger": "100000000",
    "maxRecordsPerPartition": "1000000",
}
FILE_DEFAULTS = {"maxFilesPerTrigger": "10000"}


@dataclass(frozen=True)
class Feed:
    kind: str  # "kafka" | "files"
    location: str  # bootstrap servers | directory
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.kind not in ("kafka", "files"):
            raise ValueError(f"unknown feed kind {self.kind!r}")

    def stream(self, spark: SparkSession, entity: Entity) -> DataFrame:
        """Unbounded `value` messages of the entity's topic, from the earliest on.
        `options` overrides the limits above."""
        return self._load(spark.readStream, entity)

    def batch(self, spark: SparkSession, entity: Entity) -> DataFrame:
        """The messages that are there now."""
        return self._load(spark.read, entity)

    def publish(self, rows: DataFrame, entity: Entity) -> None:
        """Write rows as keyed JSON messages."""
        messages = encode(rows, entity)
        if self.kind == "kafka":
            (
                messages.write.format("kafka")
                .option("kafka.bootstrap.servers", self.location)
                .option("topic", entity.topic)
                .options(**self.options)
                .save()
            )
        else:
            # Lines carry no key; no consumer reads it.
            messages.select("value").write.mode("append").text(self._folder(entity))

    def send(self, messages: DataFrame) -> None:
        """Write (topic, key, value) messages, each to its topic, in one pass for Kafka."""
        if self.kind == "kafka":
            (
                messages.write.format("kafka")
                .option("kafka.bootstrap.servers", self.location)
                .options(**self.options)
                .save()
            )
            return
        for entity in ENTITIES.values():
            mine = messages.where(F.col("topic") == entity.topic)
            mine.select("value").write.mode("append").text(self._folder(entity))

    def _load(self, reader, entity: Entity) -> DataFrame:
        if self.kind == "kafka":
            loaded = (
                reader.format("kafka")
                .option("kafka.bootstrap.servers", self.location)
                .option("subscribe", entity.topic)
                .options(**{**KAFKA_DEFAULTS, **self.options})
                .load()
            )
        else:
            options = {**FILE_DEFAULTS, **self.options}
            loaded = reader.format("text").options(**options).load(self._folder(entity))
        return loaded.select(F.col("value").cast("string").alias("value"))

    def _folder(self, entity: Entity) -> str:
        return f"{self.location.rstrip('/')}/{entity.topic}"
