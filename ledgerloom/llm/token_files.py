"""Operator 4: token ids as flat binary files.

Documents are sorted by doc_id over range partitions. Each partition is one pair of
files, ``part-N.ids`` (ids, unsigned little-endian, 16 bits if the vocabulary fits,
else 32) and ``part-N.idx`` (n + 1 unsigned 64-bit offsets into the ids, then n signed
64-bit doc_ids). The manifest, a Parquet table, has a row for each partition with the
documents and ids before it, from prefix sums, so any document's ids can be found and
memory-mapped.

Files are written under another name and renamed when whole, and a repeated task
writes the same bytes, so a lost executor or a second attempt does no harm.

Null texts count as empty: only the end id. Null doc_ids come first and are stored
as the smallest 64-bit number. Rows with equal doc_ids are ordered by text. Other
columns are ignored. An empty table has an empty manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from .shared import stored, text_of
from .tokens import encoder

END_ID = 2
NO_ID = np.iinfo(np.int64).min
IDS_AT_ONCE = 1 << 20
MANIFEST = "part int, width int, n_docs long, n_ids long"


def _open(folder: str):
    """The file system of a folder (local, HDFS or an object store) and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes the files, and returns the manifest: part, width (bytes of an id),
    n_docs, n_ids, first_doc, first_id."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer)
        width = 2 if max(encode.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        store, path = _open(folder)
        store.create_dir(path, recursive=True)
        mark = uuid.uuid4().hex
        offsets, names, total = [0], [], 0
        with store.open_output_stream(f"{path}/.{mark}.ids") as out:
            for batch in batches:
                for ids in encode.encode(batch["text"].tolist()):
                    whole = np.append(ids, np.uint32(end_id))
                    out.write(whole.astype(f"<u{width}").tobytes())
                    total += len(whole)
                    offsets.append(total)
                names.append(batch["doc_id"].fillna(NO_ID).to_numpy(dtype="<i8"))
        if total:
            with store.open_output_stream(f"{path}/.{mark}.idx") as out:
                out.write(np.array(offsets, dtype="<u8").tobytes())
                out.write(np.concatenate(names).tobytes())
            for kind in ("ids", "idx"):
                store.move(f"{path}/.{mark}.{kind}", f"{path}/part-{part}.{kind}")
            yield pd.DataFrame({"part": [part], "width": [width], "n_docs": [len(offsets) - 1], "n_ids": [total]})
        else:
            store.delete_file(f"{path}/.{mark}.ids")

    ordered = (
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        # Pandas has no whole numbers with nulls.
        .withColumn("doc_id", F.coalesce("doc_id", F.lit(int(NO_ID))))
    )
    parts = stored(ordered.mapInPandas(write, MANIFEST), "manifest")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    manifest = parts.withColumns(
        {
            "first_doc": F.coalesce(F.sum("n_docs").over(before), F.lit(0)),
            "first_id": F.coalesce(F.sum("n_ids").over(before), F.lit(0)),
        }
    )
    manifest.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_ids, ids (unsigned 32-bit,
    little-endian) of each document, from the files."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import LocalFileSystem

        store, path = _open(folder)
        for batch in batches:
            for m in batch.itertuples():
                if isinstance(store, LocalFileSystem):
                    ids = np.memmap(f"{path}/part-{m.part}.ids", dtype=f"<u{m.width}", mode="r")
                    part = lambda a, b, ids=ids: ids[a:b]
                else:
                    file = store.open_input_file(f"{path}/part-{m.part}.ids")
                    part = lambda a, b, f=file, w=m.width: np.frombuffer(
                        f.read_at((b - a) * w, a * w), dtype=f"<u{w}"
                    )
                with store.open_input_file(f"{path}/part-{m.part}.idx") as f:
                    offsets = np.frombuffer(f.read(8 * (m.n_docs + 1)), dtype="<u8").astype(np.int64)
                    names = np.frombuffer(f.read(8 * m.n_docs), dtype="<i8")
                at = 0
                while at < m.n_docs:
                    to = int(np.searchsorted(offsets, offsets[at] + IDS_AT_ONCE, side="right"))
                    to = min(max(to - 1, at + 1), m.n_docs)
                    flat = part(int(offsets[at]), int(offsets[to])).astype("<u4")
                    cuts = (offsets[at : to + 1] - offsets[at]).tolist()
                    yield pd.DataFrame(
                        {
                            "doc_id": names[at:to],
                            "start": m.first_id + offsets[at:to],
                            "n_ids": np.diff(offsets[at : to + 1]),
                            "ids": [flat[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
                        }
                    )
                    at = to

    # With a number, so that AQE does not merge these few rows into one task.
    parts = manifest.repartitionByRange(max(1, manifest.count()), "part")
    rows = parts.mapInPandas(read, "doc_id long, start long, n_ids long, ids binary")
    return rows.withColumn("doc_id", F.nullif("doc_id", F.lit(int(NO_ID))))
