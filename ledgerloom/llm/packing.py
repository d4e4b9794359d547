"""Operator 9: packing documents into windows of equal length, sum-of-squares style.

Each map task packs its own documents as they come, so no text is shuffled. What a
document has beyond full windows is placed into one open window: of all fill levels
it fits, the one whose choice makes the sum of the squared numbers of open windows per
level smallest (Csirik et al.), ties to the fullest. A level array holds these numbers.
At the end, and whenever too many windows are open, the fullest are filled up with
pieces of the emptiest, cut where needed; the last rest is cut to powers of two, which
need no padding. Every id lies in exactly one piece.

Null texts count as empty: only the end id. Null and repeated doc_ids are kept. Other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .shared import text_of
from .tokens import encoder

LENGTH = 4096
END_ID = 2
#: Windows that a task holds open, at most.
MAX_OPEN = 1024
ROWS_AT_ONCE = 2048

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long"
)
#: A task numbers its sequences from its own multiple of 2^33.
TASK_BITS = 33

Piece = tuple[object, int, np.ndarray, int]  # doc_id, start, ids, doc_tokens


class Packer:
    """Packs pieces; ``done`` collects finished windows, each a list of pieces."""

    def __init__(self, length: int = LENGTH, max_open: int = MAX_OPEN) -> None:
        self.length, self.max_open = length, max_open
        self.levels = np.zeros(length + 1, dtype=np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(length + 1)]
        self.n_open = 0
        self.done: list[list[Piece]] = []

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        whole = len(ids) // self.length * self.length
        for at in range(0, whole, self.length):
            self.done.append([(doc_id, at, ids[at : at + self.length], len(ids))])
        if whole < len(ids):
            self._place((doc_id, whole, ids[whole:].copy(), len(ids)))
            if self.n_open > self.max_open:
                self.drain(last=False)

    def best_level(self, size: int) -> int:
        """The fill level to place ``size`` ids on; 0 opens a window. Moving a window
        from level h to h + size changes the sum of squares by 2 (n[h + size] - n[h])
        + 2, opening one by 2 n[size] + 1, and closing one by 1 - 2 n[h]."""
        n = self.levels
        cost = 2 * (n[size:] - n[: self.length + 1 - size]) + 2
        cost[-1] = 1 - 2 * n[self.length - size]
        cost[n[: len(cost)] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * n[size] + 1
        return len(cost) - 1 - int(np.argmin(cost[::-1]))

    def _place(self, piece: Piece) -> None:
        size = len(piece[2])
        level = self.best_level(size)
        window = self.open[level].pop() if level else []
        if level:
            self.levels[level] -= 1
            self.n_open -= 1
        window.append(piece)
        self._put(window, level + size)

    def _put(self, window: list[Piece], level: int) -> None:
        if level == self.length:
            self.done.append(window)
        else:
            self.open[level].append(window)
            self.levels[level] += 1
            self.n_open += 1

    def drain(self, last: bool) -> None:
        """Fills the fullest windows from the emptiest. If ``last``, also ends the one
        that remains, as windows of powers of two."""
        windows = [w for level in self.open for w in level]
        sizes = [h for h, level in enumerate(self.open) for _ in level]
        self.levels[:] = 0
        self.open = [[] for _ in range(self.length + 1)]
        self.n_open = 0
        low = 0
        while low < len(windows):
            window, size = windows.pop(), sizes.pop()
            while size < self.length and low < len(windows):
                taken = self._take(windows[low], self.length - size)
                window += taken
                moved = sum(len(p[2]) for p in taken)
                size += moved
                sizes[low] -= moved
                if not windows[low]:
                    low += 1
            if size == self.length or not last:
                self._put(window, size)
            else:
                while size:
                    part = 1 << (size.bit_length() - 1)
                    self.done.append(self._take(window, part))
                    size -= part

    @staticmethod
    def _take(window: list[Piece], size: int) -> list[Piece]:
        """Pieces of ``size`` ids, or all there are, off the end of ``window``."""
        taken = []
        while size and window:
            doc_id, start, ids, tokens = window.pop()
            if len(ids) > size:
                cut = len(ids) - size
                window.append((doc_id, start, ids[:cut], tokens))
                start, ids = start + cut, ids[cut:]
            taken.append((doc_id, start, ids, tokens))
            size -= len(ids)
        return taken


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: doc_id, start (its document's ids before it), length, ids
    (unsigned 32-bit, little-endian), doc_tokens, sequence_id, offset."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        packer = Packer(length)
        number = TaskContext.get().partitionId() << TASK_BITS
        rows: list[tuple] = []

        def finished() -> Iterator[pd.DataFrame]:
            nonlocal number, rows
            for window in packer.done:
                offset = 0
                for doc_id, start, ids, tokens in window:
                    rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes(), tokens, number, offset))
                    offset += len(ids)
                number += 1
            packer.done.clear()
            if rows:
                columns = dict(zip((c.split()[0] for c in SCHEMA.split(", ")), zip(*rows)))
                rows = []
                # Not by way of doubles, which a null among the ids would bring.
                yield pd.DataFrame(columns | {"doc_id": pd.array(columns["doc_id"], dtype="Int64")})

        for batch in batches:
            names = [None if none else n for n, none in zip(batch["doc_id"].tolist(), batch["none"].tolist())]
            for doc_id, ids in zip(names, encode.encode(batch["text"].tolist())):
                packer.add(doc_id, np.append(ids, np.uint32(end_id)))
                if len(packer.done) >= ROWS_AT_ONCE:
                    yield from finished()
        packer.drain(last=True)
        yield from finished()

    rows = docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(0).cast("long")).alias("doc_id"),
        docs["doc_id"].isNull().alias("none"),
        text_of(docs).alias("text"),
    )
    return rows.mapInPandas(run, SCHEMA)
