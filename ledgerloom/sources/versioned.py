"""A table that is replaced as a whole without a moment in which it is gone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


class VersionedTable:
    """Parquet table with two slots that are written in turn.

    A new version goes to the slot that is not in force. It counts only once
    its number is in the slot's marker, so a failed write leaves the old
    version in force, and a reader that began on it can finish. One writer at
    a time.
    """

    SLOTS = 2

    def __init__(self, spark: SparkSession, root: str, schema: StructType | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema

    def version(self) -> int:
        """Number of the version in force, 0 if there is none."""
        try:
            markers = self.spark.read.schema("version BIGINT").parquet(f"{self.root}/markers/*")
            return markers.agg(F.max("version")).first()[0] or 0
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return 0
            raise

    def read(self) -> DataFrame:
        return self.staged(self.version())

    def stage(self, rows: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Write the next version without putting it in force."""
        number = self.version() + 1
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(number))
        return number

    def staged(self, number: int) -> DataFrame:
        if number == 0 and self.schema is not None:
            return self.spark.createDataFrame([], self.schema)
        if self.schema is None:
            return self.spark.read.parquet(self.path(number))
        # Partition columns come last in a scan, whatever the schema says.
        scan = self.spark.read.schema(self.schema).parquet(self.path(number))
        return scan.select(*[F.col(f"`{c}`") for c in self.schema.names])

    def commit(self, number: int) -> None:
        marker = self.spark.range(1).select(F.lit(number).cast("bigint").alias("version"))
        marker.coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/markers/slot_{number % self.SLOTS}"
        )

    def replace(self, rows: DataFrame, partition_by: Sequence[str] = ()) -> None:
        self.commit(self.stage(rows, partition_by))

    def path(self, number: int) -> str:
        return f"{self.root}/slot_{number % self.SLOTS}"
