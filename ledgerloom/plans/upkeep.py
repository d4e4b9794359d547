"""Upkeep of bronze: few files for the dates that are closed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.sources.lake import BEFORE, MODIFIED, Lake, not_taken_in, written_since

# Files this close to the newest one may belong to a batch that is still being written,
# or have a time from another clock. They wait for the next run.
SETTLE_SECONDS = 60


def compact_bronze(lake: Lake, table: str, before: str, settle_seconds: int = SETTLE_SECONDS) -> int:
    """Copy what the dates before `before` have gained since the last run into few files
    for each chain and date. Returns the number of the change, 0 if there was none.

    A stream writes the files of a batch after those of the batch before it, so no file
    that its log does not list yet is older than the newest listed one. Nothing is
    removed: files that have been taken in are not opened by readers of the lake, and
    streams that read bronze still find them. A run that fails leaves things as they were.
    """
    copy = lake.compacted_bronze(table)
    known = copy.notes()
    start = int(known.get(MODIFIED, 0))
    files = lake.bronze_files(table)
    newest = files.where(written_since(start)).agg(F.max(MODIFIED)).first()[0]
    if newest is None:
        return 0
    reached = {
        BEFORE: max(before, known.get(BEFORE, "")),
        MODIFIED: str(max(start, newest - settle_seconds * 1_000_000)),
    }
    closed = files.where(F.col("dt") < reached[BEFORE]).where(~written_since(int(reached[MODIFIED])))
    rows = not_taken_in(closed, known)
    # AQE gathers the rows of a chain and date, and splits those of a large one.
    number = copy.stage(rows.drop(MODIFIED).hint("rebalance", "chainName", "dt"))
    copy.commit(number, notes=reached)
    return number
