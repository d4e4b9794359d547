"""The lake: one root with bronze, silver and gold tables and the checkpoints
of the streams that fill it.

Bronze files are written by streams and listed in the streams' own logs, which no other
writer may touch. Compaction therefore copies the rows of closed dates into a table beside
them. Its notes say which of the streams' files it has taken in: those of dates before
`BEFORE` that were written before `MODIFIED`. Readers take the copy for these and the
files for the rest, so a late row of a closed date is seen as soon as it is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import quote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.codec import accepted, rejected
from ledgerloom.schemas import ENTITIES, OK, STATUS, TEXT
from ledgerloom.sources.partitioned import PartitionedTable
from ledgerloom.sources.versioned import VersionedTable

# Notes of compacted bronze: a date, and microseconds of the epoch.
BEFORE, MODIFIED = "before", "modified"
SOURCE_PATH = "source_path"


class Lake:
    def __init__(self, spark: SparkSession, root: str, table_format: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.table_format = table_format

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def checkpoint(self, stream: str) -> str:
        return self.path("checkpoints", stream)

    def bronze(self, table: str, *, lineage: bool = False) -> DataFrame:
        """Accepted rows of a bronze table, with their `dt`. `lineage` adds the
        file each row came from as `source_path`, relative to the lake root."""
        rows = self._bronze_all(table)
        notes = self.compacted_bronze(table).notes() if self.table_format == "parquet" else {}
        if lineage:
            rows = with_source_path(rows, self.root)
        rows = accepted(not_taken_in(rows, notes))
        if notes:
            rows = rows.unionByName(self.compacted_bronze(table).read().select(*rows.columns))
        return rows

    def compacted_bronze(self, table: str) -> PartitionedTable:
        """Copies of accepted rows of closed dates, each with its first file."""
        schema = StructType(ENTITIES[table].message_schema.fields)
        schema = schema.add("dt", TEXT).add(SOURCE_PATH, TEXT)
        return PartitionedTable(
            self.spark, self.path("bronze_compacted", table), schema, ("chainName", "dt")
        )

    def bronze_files(self, table: str) -> DataFrame:
        """Accepted rows as the streams wrote them, with `modified`, the time at which
        their file was written (microseconds). A filter on it, as on the partition
        columns, is a choice of files."""
        rows = with_source_path(self._bronze_all(table), self.root)
        return rows.withColumn(MODIFIED, modified()).where(F.col(STATUS) == OK)

    def quarantine(self, table: str) -> DataFrame:
        """Text of the messages that were not accepted, with the reason."""
        return rejected(self._bronze_all(table))

    def register_views(self) -> None:
        """Bronze tables as temp views blocks, transactions and logs, for SQL."""
        for table in ENTITIES:
            self.bronze(table).createOrReplaceTempView(table)

    def read(self, layer: str, table: str, schema: StructType | None = None) -> DataFrame:
        """A replaced table as it is now. The schema is needed only for a
        partitioned table that may be empty."""
        if self.table_format == "parquet":
            return VersionedTable(self.spark, self.path(layer, table), schema).read()
        return self.spark.read.format(self.table_format).load(self.path(layer, table))

    def replace(
        self, rows: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Materialise a model: the table is replaced as a whole, and the old
        one stays in force until the new one is complete."""
        if self.table_format == "parquet":
            VersionedTable(self.spark, self.path(layer, table)).replace(rows, partition_by)
        else:
            writer = rows.write.format(self.table_format).mode("overwrite")
            # A session that overwrites partition by partition would keep old ones.
            writer = writer.option("partitionOverwriteMode", "static")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.save(self.path(layer, table))
        return self.read(layer, table, rows.schema)

    def _bronze_all(self, table: str) -> DataFrame:
        reader = self.spark.read.format(self.table_format)
        if self.table_format == "parquet":
            # Without a schema `dt` would come back as a date.
            reader = reader.schema(ENTITIES[table].bronze_schema)
        return reader.load(self.path("bronze", table))


def modified() -> Column:
    return F.unix_micros("_metadata.file_modification_time")


def written_since(micros: int) -> Column:
    return F.col("_metadata.file_modification_time") >= F.timestamp_micros(F.lit(micros))


def not_taken_in(rows: DataFrame, notes: Mapping[str, str]) -> DataFrame:
    """The rows of streamed files that are not in the compacted copy. Each part of the
    union is a choice of partitions and of files, so no other file is opened."""
    if not notes:
        return rows
    dt = F.col("dt")
    # A row without a date is never in a closed one.
    young = rows.where(dt.isNull() | (dt >= notes[BEFORE]))
    return young.unionByName(rows.where((dt < notes[BEFORE]) & written_since(int(notes[MODIFIED]))))


def staged_files(
    spark: SparkSession, path: str, schema: StructType, pattern: str = "*.parquet"
) -> DataFrame:
    """Parquet files dropped by somebody else, at any depth below `path`.

    Directory names are not read as columns, so what the schema names must be
    in the files. For tables of this lake use `Lake.bronze`.
    """
    return (
        spark.read.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .parquet(path)
    )


def with_source_path(scan: DataFrame, root: str) -> DataFrame:
    """Add `source_path`, the file of each row relative to `root`. `scan` must
    come straight from a file source."""
    return scan.withColumn(SOURCE_PATH, relative_path(F.col("_metadata.file_path"), root))


def relative_path(file_path: Column, root: str) -> Column:
    # file_path is a percent-encoded URI. A root written without a scheme gets
    # one there, so the match is on what follows it; the search and the cut
    # are the only work per row.
    where = urlparse(root)
    bucket = f"//{where.netloc}" if where.netloc else ""
    prefix = f"{bucket}{quote(where.path.rstrip('/'))}/"
    if prefix == "/":
        return file_path
    at = F.instr(file_path, prefix)
    return F.when(at > 0, F.substr(file_path, at + len(prefix))).otherwise(file_path)
