"""A Parquet table that changes partition by partition, for all readers at once."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructType

from ledgerloom.sources import files
from ledgerloom.sources.versioned import VersionedTable

MANIFEST_SCHEMA = StructType().add("key", "string").add("version", "long").add("note", "string")


class PartitionedTable:
    """Each change writes the new rows of some partitions into a folder of its own. The
    manifest, a small table that is replaced as a whole, names the folders in force for
    each partition, and carries notes: how far the source of the table has been read.

    So partitions and notes change in one step. A change that was not committed is not
    seen, and the next one writes over it. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str]):
        self.spark = spark
        self.schema = schema
        self.keys = tuple(keys)
        self.parts = f"{root.rstrip('/')}/parts"
        self.manifest = VersionedTable(spark, f"{root.rstrip('/')}/manifest", MANIFEST_SCHEMA)

    def key(self, *columns: Column) -> Column:
        """A partition as text, from its key columns (those of the table by default)."""
        values = columns or [F.col(f"`{k}`") for k in self.keys]
        texts = [F.coalesce(v.cast("string"), F.lit("\u0000")) for v in values]
        return F.concat_ws("\u0001", *texts)

    def in_force(self) -> list[tuple[str, int]]:
        """(partition, version) pairs. As many as the table has partitions, which the
        driver lists anyway to plan a scan."""
        rows = self.manifest.read().where("note IS NULL").select("key", "version").collect()
        return [(r["key"], r["version"]) for r in rows]

    def notes(self) -> dict[str, str]:
        rows = self.manifest.read().where("note IS NOT NULL").select("key", "note").collect()
        return {r["key"]: r["note"] for r in rows}

    def read(self) -> DataFrame:
        """The rows in force. The choice is a filter on partition columns: folders that
        are not in force are not opened."""
        pairs = self.in_force()
        if not pairs:
            return self.spark.createDataFrame([], self.schema)
        chosen = [f"{key}\u0001{version}" for key, version in pairs]
        rows = self._scan(sorted({version for _, version in pairs}))
        wanted = F.concat_ws("\u0001", self.key(), F.col("version").cast("string")).isin(chosen)
        return rows.where(wanted).drop("version")

    def stage(self, rows: DataFrame) -> int:
        """Write rows of some partitions without putting them in force."""
        number = self.manifest.version() + 1
        columns = [F.col(f"`{c}`") for c in self.schema.names]
        (
            rows.select(*columns)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(*self.keys)
            .parquet(f"{self.parts}/version={number}")
        )
        return number

    def staged(self, number: int) -> DataFrame:
        return self._scan([number]).drop("version")

    def commit(self, number: int, replaced: Iterable[str] = (), notes: Mapping[str, str] | None = None) -> None:
        """Put a staged change in force. Partitions in `replaced` (by `key`) lose the rows
        they had; those of the change that are not among them gain rows."""
        gone = set(replaced)
        new = self.staged(number).select(self.key().alias("key")).distinct().collect()
        pairs = [p for p in self.in_force() if p[0] not in gone] + [(r["key"], number) for r in new]
        entries = [(key, version, None) for key, version in pairs]
        entries += [(k, None, v) for k, v in (self.notes() | dict(notes or {})).items()]
        self.manifest.replace(self.spark.createDataFrame(entries, MANIFEST_SCHEMA).coalesce(1))

    def vacuum(self) -> None:
        """Remove the folders that neither the manifest in force nor the one before it
        names, on which a reader may have begun."""
        current = self.manifest.version()
        kept = {current, current + 1}
        for number in (current, current - 1):
            if number > 0:
                entries = self.manifest.staged(number).where("version IS NOT NULL")
                kept |= {r["version"] for r in entries.select("version").distinct().collect()}
        for path in files.found(self.spark, f"{self.parts}/version=*"):
            if int(path.rsplit("=", 1)[1]) not in kept:
                files.remove(self.spark, path)

    def _scan(self, versions: list[int]) -> DataFrame:
        schema = StructType([*self.schema.fields]).add("version", LongType())
        reader = self.spark.read.schema(schema).option("basePath", self.parts)
        rows = reader.parquet(*[f"{self.parts}/version={v}" for v in versions])
        return rows.select(*[F.col(f"`{c}`") for c in schema.names])
