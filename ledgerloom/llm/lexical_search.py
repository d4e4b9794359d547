"""Operator 12: ranked lexical search with hashed max-sketches.

The impact of a term in a document grows with its frequency and falls with the
document's length. A document's impacts are folded into a vector of SKETCH maxima, one
for each hash value of its terms. The sum of a query's term weights times these maxima
is an upper bound of its score, and for a block of documents and all queries that is one
product of matrices. Documents are then scored exactly by falling bound, until the bound
is below the score of the query's k-th document so far. Such a document cannot enter, so
the result is exact whatever the hash values.

Queries come in blocks of bounded size, which the tasks get whole; for each block the
documents are read twice, once for the counts (documents with a term, terms, documents
for each query term) and once for the search. A task sends at most k rows a query.

Rows: the k best documents of each item by `rank`, fewer if fewer score above 0; equal
scores by doc_id, null last. Null or empty texts have no terms and match nothing; very
long ones are read whole. Each row of `items` is a query, so items with the same item_id
each get their rows, and each row of `docs` is a document, so copies rank one by one. No
documents or no items: no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

from .shared import text_of

# Fixed values of the score.
IMPACT_SCALE = 1_000_000_000

#: Letters and digits of ASCII, and all bytes of other characters, belong to terms; A-Z
#: become a-z and other bytes spaces.
_BYTES = bytes(ord(chr(i).lower()) if chr(i).isalnum() else 32 for i in range(128)) + bytes(
    range(128, 256)
)

SKETCH = 4096
#: Documents whose sketches are made and bounded together.
ROWS = 256
#: A block of queries ends at so many items or bytes of text; one longer item is a block.
BLOCK_ITEMS, BLOCK_BYTES = 1024, 4_000_000
MAX_CACHED = 500_000


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_BYTES).split()


def _bytes_of(df: DataFrame) -> Column:
    return text_of(df).cast("binary").alias("text")


class Places(dict):
    """The coordinate of each term, kept for terms seen before."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= MAX_CACHED:
            self.clear()
        self[term] = zlib.crc32(term) % SKETCH
        return self[term]


@dataclass
class Corpus:
    """Counts over all documents: those with a term, and all terms."""

    docs: int
    terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.docs + 2) / (2 * df + 1)))

    def length(self, n: int) -> int:
        return 100 - 75 + (75 * n * self.docs) // self.terms


@dataclass
class Queries:
    """A block of items: numbers, and per item its terms with their repeats."""

    ids: list = field(default_factory=list)
    numbers: list[int] = field(default_factory=list)
    terms: list[Counter] = field(default_factory=list)
    size: int = 0

    def add(self, number: int, item: Row) -> None:
        text = bytes(item["text"])
        self.ids.append(item["item_id"])
        self.numbers.append(number)
        self.terms.append(Counter(terms(text)))
        self.size += len(text)

    @property
    def full(self) -> bool:
        return len(self.ids) >= BLOCK_ITEMS or self.size >= BLOCK_BYTES

    def vocabulary(self) -> list[bytes]:
        return sorted(set().union(*self.terms)) if self.terms else []


def query_blocks(items: DataFrame) -> Iterator[Queries]:
    """`items`, a partition at a time, in blocks of bounded size."""
    rows = items.select(items["item_id"].cast("long").alias("item_id"), _bytes_of(items))
    block = Queries()
    for number, item in enumerate(rows.toLocalIterator()):
        block.add(number, item)
        if block.full:
            yield block
            block = Queries()
    if block.ids:
        yield block


def counts(docs: DataFrame, vocabulary: list[bytes]) -> tuple[Corpus, dict[bytes, int]]:
    """The corpus, and the documents that hold each term of a bounded vocabulary."""
    place = {t: i for i, t in enumerate(vocabulary)}
    schema = pa.schema([("place", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, with_terms, total = np.zeros(len(place), dtype=np.int64), 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = terms(text)
                with_terms += bool(found)
                total += len(found)
                for term in place.keys() & set(found):
                    df[place[term]] += 1
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([-2, -1, *used.tolist()], pa.int32()),
                pa.array([with_terms, total, *df[used].tolist()], pa.int64()),
            ],
            schema=schema,
        )

    parts = docs.select(_bytes_of(docs)).mapInArrow(run, "place int, n long")
    found = {r["place"]: r["n"] for r in parts.groupBy("place").agg(F.sum("n").alias("n")).collect()}
    corpus = Corpus(found.pop(-2, 0), found.pop(-1, 0))
    return corpus, {vocabulary[i]: n for i, n in found.items()}


class Searcher:
    """Searches documents one block after the other for a block of queries, and keeps
    the k best of each query."""

    def __init__(self, queries: Queries, weights: dict[bytes, int], corpus: Corpus, k: int):
        self.corpus, self.k = corpus, k
        # A term that no document holds, or of weight 0, adds nothing.
        self.queries = [
            {t: n * weights[t] for t, n in q.items() if weights.get(t)} for q in queries.terms
        ]
        self.places = Places()
        self.weights = np.zeros((SKETCH, len(self.queries)))
        for column, query in enumerate(self.queries):
            for term, weight in query.items():
                self.weights[self.places[term], column] += weight
        # Rounding must not push a bound below the score.
        self.weights *= 1 + 1e-9
        self.best: list[list[tuple]] = [[] for _ in self.queries]
        self.least = np.zeros(len(self.queries))
        self.scored = 0

    def impacts(self, found: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """The distinct terms of a document and their impacts."""
        tf = Counter(found)
        n = np.fromiter(tf.values(), dtype=np.int64, count=len(tf))
        return list(tf), IMPACT_SCALE * n // (1000 * n + 8 * self.corpus.length(len(found)))

    def search(self, ids: list, texts: list[bytes]) -> None:
        held, sketches = [], np.zeros((len(texts), SKETCH))
        for doc_id, text in zip(ids, texts):
            found = terms(text)
            if found:
                names, impact = self.impacts(found)
                places = list(map(self.places.__getitem__, names))
                np.maximum.at(sketches[len(held)], places, impact)
                held.append((doc_id, names, impact.tolist()))
        bounds = sketches[: len(held)] @ self.weights
        exact: list[dict | None] = [None] * len(held)
        # At the last score a document with a smaller id may still enter.
        hopeful = (bounds > 0) & (bounds >= self.least)
        for column in np.flatnonzero(hopeful.any(axis=0)):
            rows = np.flatnonzero(hopeful[:, column])
            query, best = self.queries[column], self.best[column]
            for row in rows[np.argsort(-bounds[rows, column], kind="stable")]:
                if bounds[row, column] < self.least[column]:
                    break
                doc_id, names, impact = held[row]
                if exact[row] is None:
                    exact[row] = dict(zip(names, impact))
                of = exact[row]
                score = sum(w * of[t] for t, w in query.items() if t in of)
                self.scored += 1
                if score > 0:
                    insort(best, (-score, doc_id is None, doc_id or 0))
                    if len(best) > self.k:
                        best.pop()
                    if len(best) == self.k:
                        self.least[column] = -best[-1][0]


def _search_block(
    docs: DataFrame, queries: Queries, weights: dict[bytes, int], corpus: Corpus, k: int
) -> DataFrame:
    schema = pa.schema(
        [("number", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(queries, weights, corpus, k)
        for batch in batches:
            ids, texts = (batch.column(i).to_pylist() for i in range(2))
            for at in range(0, len(ids), ROWS):
                searcher.search(ids[at : at + ROWS], texts[at : at + ROWS])
        rows = [
            (queries.numbers[i], queries.ids[i], None if none else doc_id, -score)
            for i, best in enumerate(searcher.best)
            for score, none, doc_id in best
        ]
        columns = list(zip(*rows)) or [[]] * len(schema)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
        )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), _bytes_of(docs))
    return rows.mapInArrow(run, "number long, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score, and number, the row of `items` (from 0)."""
    blocks: list[DataFrame] = []
    for queries in query_blocks(items):
        corpus, df = counts(docs, queries.vocabulary())
        weights = {t: corpus.weight(n) for t, n in df.items()}
        blocks.append(_search_block(docs, queries, weights, corpus, k))
    if not blocks:
        empty = "number long, item_id long, doc_id long, score long"
        blocks.append(docs.sparkSession.createDataFrame([], empty))
    return _best(reduce(DataFrame.unionByName, blocks), k)


def _best(found: DataFrame, k: int, spread: int = 64) -> DataFrame:
    """The k best rows of each query: first of each of `spread` shares, as every task of
    the search has sent its own k."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    share = F.pmod(F.xxhash64("doc_id"), F.lit(spread))
    first = found.withColumn("share", share).withColumn(
        "place", F.row_number().over(W.partitionBy("number", "share").orderBy(*order))
    )
    kept = first.where(F.col("place") <= k).drop("share", "place")
    ranked = kept.withColumn("rank", F.row_number().over(W.partitionBy("number").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score", "number")
