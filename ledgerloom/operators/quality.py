"""Data tests: a test passes when it finds no offending row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


class QualityError(Exception):
    def __init__(self, table: str, failures: Mapping[str, int]):
        self.table = table
        self.failures = dict(failures)
        detail = ", ".join(f"{test}: {n} rows" for test, n in self.failures.items())
        super().__init__(f"data tests failed on {table}: {detail}")


@dataclass(frozen=True)
class TableTests:
    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] | None = None

    def conditions(self) -> dict[str, Column]:
        offending = {f"not_null_{c}": F.col(c).isNull() for c in self.not_null}
        for c, values in (self.accepted or {}).items():
            offending[f"accepted_values_{c}"] = _outside(c, values)
        return offending


def _outside(column: str, values: Sequence[str]) -> Column:
    # NULL is neither in nor out, so it passes.
    return ~F.col(column).isin(*values)


def failure_counts(rows: DataFrame, tests: TableTests) -> DataFrame:
    """All tests of a table in one pass: one row, a count per test."""
    return rows.agg(
        *[F.count_if(cond).alias(name) for name, cond in tests.conditions().items()]
    )


def not_null(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs per column, as one row."""
    return rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def accepted_values(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """The values outside the list with their row counts."""
    return (
        rows.where(_outside(column, values))
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
    )


def require(rows: DataFrame, table: str, tests: TableTests) -> None:
    """Raise QualityError if any test finds a row."""
    counts = failure_counts(rows, tests).first().asDict()
    failures = {name: n for name, n in counts.items() if n}
    if failures:
        raise QualityError(table, failures)
