"""Operator 6: SimHash near-duplicates by bit-sliced comparison.

Fingerprints are compared in blocks. A block is stored as bit planes: plane b holds
bit b of 64 fingerprints in each machine word. A few queries run over the planes
at once; differing bits are added into vertical counters with carry-save adders, a
counter overflows when its distance passes the radius, and words whose 64 lanes
have all overflowed leave the comparison.

Two ways to find what shares a block:

* ``fingerprint_groups``: exact. Fingerprints within ``radius`` agree in some
  choice of bit fields (pigeonhole), so all links are found.
* ``near_groups``: for similarity on five-word shingles, where the radius is too
  large for that. Sets that are alike share one of their first shingles (prefix
  filter, complete at any size of the table), which are the blocks for 256-bit
  fingerprints. What these link are candidates; a link needs the Jaccard similarity of
  the shingle sets.

Equal fingerprints are one node, however many documents have them. A group of
nodes is returned as links to one of its members, never as all pairs.

Null text counts as empty; a text without words has fingerprint zero and is linked
like any other. Null and repeated doc_ids are allowed; the smallest non-null one
names a component. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .shared import ascii_lower, components, received_ids, sent_ids, stored, text_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SEED = 42
#: Shingles whose bits are counted at once; bounds memory for very long texts.
SHINGLES_AT_ONCE = 1 << 15
#: A comparison block holds about so many fingerprints ...
BLOCK = 1024
#: ... and a larger one is cut into tiles of this size.
TILE = 4096
#: Queries times words of a plane that are compared at once.
WORDS_AT_ONCE = 1 << 13
#: Shingle hashes of a tile, in bytes.
TILE_BYTES = 1 << 25

# --- fingerprints -----------------------------------------------------------


def shingle_hashes(text: str, width: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles, in stretches. A shorter text is one shingle."""
    words = WORD.findall(text)
    count = max(len(words) - width + 1, 1 if words else 0)
    for at in range(0, count, SHINGLES_AT_ONCE):
        some = words[at : at + min(SHINGLES_AT_ONCE, count - at) + width - 1]
        if len(words) < width:
            texts = [" ".join(words)]
        else:
            texts = map(" ".join, zip(*(some[i:] for i in range(width))))
        yield np.fromiter((xxhash.xxh64_intdigest(t, seed=SEED) for t in texts), dtype=np.uint64)


def bit_votes(stretches: Iterable[np.ndarray], seeds: tuple[int, ...]) -> tuple[np.ndarray, int]:
    """How many shingles set each bit (64 bits a seed), and the number of shingles."""
    votes = np.zeros(64 * len(seeds), dtype=np.int64)
    count = 0
    for hashes in stretches:
        count += len(hashes)
        for i, seed in enumerate(seeds):
            mixed = hashes if seed == SEED else _remix(hashes, seed)
            bits = np.unpackbits(mixed.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes[64 * i : 64 * i + 64] += bits.sum(axis=0, dtype=np.int64)
    return votes, count


def _remix(hashes: np.ndarray, seed: int) -> np.ndarray:
    """Another hash of the same shingles (a 64-bit finaliser)."""
    with np.errstate(over="ignore"):
        x = hashes + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _pack(bits: np.ndarray) -> np.ndarray:
    """Bit i of word i // 64 from booleans."""
    return np.packbits(bits, bitorder="little").view("<u8")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fp: the 64-bit fingerprint as a long. A bit is 1 if it is set in over
    half of the shingles' hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.empty(len(batch), dtype=np.uint64)
            for i, text in enumerate(batch["text"]):
                votes, count = bit_votes(shingle_hashes(text, width), (SEED,))
                fps[i] = _pack(2 * votes > count)[0]
            yield pd.DataFrame({"doc_id": received_ids(batch), "fp": fps.view(np.int64)})

    rows = docs.select(*sent_ids(docs["doc_id"]), ascii_lower(text_of(docs)).alias("text"))
    return rows.mapInPandas(run, "doc_id long, fp long")


# --- bit-sliced comparison --------------------------------------------------


def planes_of(fps: np.ndarray) -> np.ndarray:
    """Bit planes of fps (n rows of 64-bit words): [bits, ceil(n / 64)] words."""
    n, words = fps.shape
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(n, 8 * words), axis=1, bitorder="little")
    padded = np.zeros((64 * words, -(-n // 64) * 64), dtype=np.uint8)
    padded[:, :n] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def within(queries: np.ndarray, planes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, lane) of all pairs at distance ``radius`` or less."""
    n_bits, n_words = planes.shape
    flips = np.zeros((n_bits, len(queries)), dtype=np.uint64)
    bits = np.unpackbits(
        queries.astype("<u8").view(np.uint8).reshape(len(queries), -1), axis=1, bitorder="little"
    ).T
    flips[bits.astype(bool)] = np.uint64(0xFFFFFFFFFFFFFFFF)
    # Counters of m bits start so that radius + 1 differences overflow them.
    m = max(radius.bit_length(), 2)
    start = (1 << m) - (radius + 1)
    query, word = (x.ravel() for x in np.indices((len(queries), n_words)))
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    counters = [np.full(len(query), ones if start >> k & 1 else 0, dtype=np.uint64) for k in range(m)]
    dead = np.zeros(len(query), dtype=np.uint64)
    for b in range(0, n_bits, 3):
        x, y, z = (
            planes[k][word] ^ flips[k][query] if k < n_bits else np.zeros(len(query), dtype=np.uint64)
            for k in range(b, b + 3)
        )
        # Three planes to a sum and a carry, then both into the counters.
        xy = x ^ y
        ones_bit, twos = xy ^ z, (x & y) | (xy & z)
        carry = counters[0] & ones_bit
        counters[0] ^= ones_bit
        both = counters[1] ^ twos
        over = (counters[1] & twos) | (both & carry)
        counters[1] = both ^ carry
        for k in range(2, m):
            counters[k], over = counters[k] ^ over, counters[k] & over
        dead |= over
        if b % 12 == 9 or b + 3 >= n_bits:
            alive = dead != ones
            if not alive.all():
                query, word, dead = query[alive], word[alive], dead[alive]
                counters = [c[alive] for c in counters]
                if not len(query):
                    break
    open_lanes = np.unpackbits((~dead).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(open_lanes)
    return query[at], word[at] * 64 + lane


class _Forest:
    """Union-find over 0 .. n - 1, fed with arrays of pairs."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def alike(sets: list[np.ndarray], one: int, others: np.ndarray, similarity: float) -> np.ndarray:
    """Which of the sets ``others`` have this Jaccard similarity to ``one`` or more."""
    mine = sets[one]
    sizes = np.array([len(sets[i]) for i in others])
    flat = np.concatenate([sets[i] for i in others])
    found = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
    shared = np.add.reduceat(found, np.append(0, np.cumsum(sizes)[:-1]), dtype=np.int64)
    return shared >= similarity * (len(mine) + sizes - shared) - 1e-9


def link_block(
    left: np.ndarray,
    right: np.ndarray | None,
    radius: int,
    sets: list[np.ndarray] | None = None,
    similarity: float = 0.0,
) -> tuple[np.ndarray, np.ndarray]:
    """Links of one block with itself (right None) or with another block, numbered
    through left and then right, as a spanning forest. With ``sets`` (sorted, of left
    and then right) a link needs this similarity too; pairs already connected are not
    compared again."""
    other = left if right is None else right
    shift = 0 if right is None else len(left)
    forest = _Forest(len(left) if right is None else len(left) + len(right))
    planes = planes_of(other)
    step = max(1, WORDS_AT_ONCE // max(1, planes.shape[1]))
    for q0 in range(0, len(left), step):
        w0 = q0 // 64 if right is None else 0
        q, lane = within(left[q0 : q0 + step], planes[:, w0:], radius)
        q, lane = q + q0, lane + 64 * w0
        real = lane < len(other)
        if right is None:
            real &= lane > q
        q, lane = q[real], lane[real] + shift
        if sets is None:
            forest.add(q, lane)
            continue
        order = np.argsort(q, kind="stable")
        q, lane = q[order], lane[order]
        edges = np.flatnonzero(np.diff(q, prepend=-1))
        for at, to in zip(edges, [*edges[1:], len(q)]):
            one, others = q[at], lane[at:to]
            others = others[forest.root[others] != forest.root[one]]
            if len(others):
                others = others[alike(sets, one, others, similarity)]
                forest.add(np.full(len(others), one), others)
    node = np.arange(len(forest.root))
    moved = forest.root != node
    return forest.root[moved], node[moved]


# --- blocks -----------------------------------------------------------------


def field_choices(radius: int, key_bits: int) -> list[list[int]]:
    """Bit positions whose values are compared for equality: the bits are cut into f
    fields, of which at least f - radius agree; f is the smallest for which a key
    reaches ``key_bits``. Each choice is cut to that length, which only makes blocks
    larger."""
    f = radius + 1
    while f < 64 and (f - radius) * (64 // f) < key_bits:
        f += 1
    edges = [64 * i // f for i in range(f + 1)]
    fields = [list(range(a, b)) for a, b in zip(edges, edges[1:])]
    keys = [list(itertools.chain(*c)) for c in itertools.combinations(fields, f - radius)]
    shortest = min(map(len, keys))
    return [k[: min(key_bits, shortest)] for k in keys]


def key_bits_for(count: int, entries: int = 1) -> int:
    """Bits of a key at which blocks hold about BLOCK of count * entries rows."""
    return max(1, int(np.ceil(np.log2(max(count * entries, 2) / BLOCK))))


def _linked(rows: DataFrame, words: int, radius: int, similarity: float | None = None) -> DataFrame:
    """(a, b) edges between the rows (block, node, fp binary) of each block. Blocks of
    more than TILE rows are cut into slices, and each pair of slices is a task. With a
    similarity, rows have ``shingles`` (binary, sorted hashes), which must be so alike."""
    exact = [] if similarity is None else ["shingles"]
    size = F.count("*") / TILE
    if exact:
        size = F.greatest(size, F.sum(F.length("shingles")) / TILE_BYTES)
    counts = rows.groupBy("block").agg(F.ceil(size).cast("int").alias("slices"))
    counts = stored(counts.where(F.col("slices") > 1), "large")
    slices = F.coalesce("slices", F.lit(1))
    own = F.pmod(F.xxhash64("node", F.lit(7)), slices).cast("int")
    tiles = (
        rows.join(counts.select("block", "slices"), "block", "left")
        .select("block", "node", "fp", *exact, own.alias("slice"), slices.alias("slices"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .select(
            "block",
            "node",
            "fp",
            *exact,
            "slice",
            F.least("slice", "other").alias("lo"),
            F.greatest("slice", "other").alias("hi"),
        )
    )

    def compare(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("node")
        nodes = batch["node"].to_numpy()
        fps = np.frombuffer(b"".join(batch["fp"]), dtype="<u8").reshape(-1, words)
        sets = [np.frombuffer(x, dtype="<u8") for x in batch["shingles"]] if exact else None
        if batch["lo"].iat[0] == batch["hi"].iat[0]:
            a, b = link_block(fps, None, radius, sets, similarity)
        else:
            first = (batch["slice"] == batch["lo"]).to_numpy()
            nodes = np.concatenate([nodes[first], nodes[~first]])
            if exact:
                sets = [sets[i] for i in np.argsort(~first, kind="stable")]
            a, b = link_block(fps[first], fps[~first], radius, sets, similarity)
        return pd.DataFrame({"a": nodes[a], "b": nodes[b]})

    return tiles.groupBy("block", "lo", "hi").applyInPandas(compare, "a long, b long")


def fingerprint_groups(fps: DataFrame, radius: int = 3) -> DataFrame:
    """doc_id, fp, component_id of each row of ``fps`` (doc_id, fp): all links at
    ``radius`` or fewer differing bits, and their components."""
    fps = stored(fps, "fps")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    choices = field_choices(radius, key_bits_for(nodes.count()))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy()
            values = fp.view(np.uint64)
            packed = list(map(bytes, values.astype("<u8").view("V8")))
            for i, positions in enumerate(choices):
                key = np.zeros(len(values), dtype=np.uint64)
                for k, bit in enumerate(positions):
                    key |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
                block = (key.astype(np.int64) * len(choices)) + i
                yield pd.DataFrame({"block": block, "node": fp, "fp": packed})

    rows = nodes.select("fp").mapInPandas(keyed, "block long, node long, fp binary")
    return _named(fps, nodes, components(_linked(rows, 1, radius)))


def _named(fps: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Each row of ``fps`` with the smallest doc_id of its component."""
    linked = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    linked = stored(linked.select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    least = stored(linked.groupBy("root").agg(F.min("first").alias("component_id")), "named")
    names = stored(linked.join(least, "root").select("fp", "component_id"), "names")
    return fps.join(names, "fp")


# --- similarity on five-word shingles ---------------------------------------

WIDE_WIDTH = 5
WIDE_SEEDS = (SEED, 1, 2, 3)
#: A shingle is frequent if this many of about SAMPLE texts have it; at most so many are
#: looked for. That only sets the order of shingles, any order is complete.
SAMPLE, FREQUENT, MOST_FREQUENT = 4096, 16, 2_000


#: A candidate's bits may differ by so many standard deviations more than expected; and
#: the largest expected share at 0.8, of four and five shingles, where ties are frequent.
DEVIATIONS, SHORT_SHARE = 4, 3 / 16


def wide_radius(similarity: float) -> int:
    """Differing bits expected at this Jaccard similarity of the shingle sets, plus
    DEVIATIONS: of 256 bits, each differs with probability angle / pi."""
    share = max(np.arccos(2 * similarity / (1 + similarity)) / np.pi, SHORT_SHARE)
    bits = 64 * len(WIDE_SEEDS)
    return int(np.ceil(bits * share + DEVIATIONS * np.sqrt(bits * share * (1 - share))))


def distinct_shingles(text: str) -> np.ndarray:
    """Sorted hashes of the five-word shingles, each once; without words that of nothing."""
    found = list(shingle_hashes(text, WIDE_WIDTH))
    return np.unique(np.concatenate(found or [np.array([xxhash.xxh64_intdigest("", seed=SEED)], dtype=np.uint64)]))


def _wide_votes(hashes: np.ndarray) -> tuple[np.ndarray, int]:
    return bit_votes((hashes[i : i + SHINGLES_AT_ONCE] for i in range(0, len(hashes), SHINGLES_AT_ONCE)), WIDE_SEEDS)


def near_groups(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """doc_id, fp, component_id: documents whose sets of five-word shingles have this
    Jaccard similarity or more are linked; fp names the lower-cased text. The 256-bit
    fingerprints find the candidates, whose sets are then compared."""
    radius = wide_radius(similarity)
    texts = _texts(docs)
    frequent = _frequent(texts, docs.count())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            wide, keys = [], []
            for text in batch["text"]:
                hashes = distinct_shingles(text)
                votes, count = _wide_votes(hashes)
                wide.append(_pack(2 * votes > count).tobytes())
                keys.append(prefix_of(hashes, frequent, similarity).view(np.int64))
            yield pd.DataFrame({"doc_id": received_ids(batch), "fp": batch["fp"], "wide": wide, "keys": keys})

    sent = texts.select(*sent_ids(F.col("doc_id")), "fp", "text")
    fps = stored(sent.mapInPandas(run, "doc_id long, fp long, wide binary, keys array<long>"), "fps")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.first(F.struct("wide", "keys")).alias("s"))
    nodes = stored(nodes.select("fp", "first", "s.*"), "nodes")
    candidates = components(_linked(_shared_shingles(nodes), len(WIDE_SEEDS), radius))
    edges = _linked(_with_shingles(texts, nodes, candidates), len(WIDE_SEEDS), radius, similarity)
    return _named(fps.select("doc_id", "fp"), nodes.select("fp", "first"), components(edges))


def prefix_of(hashes: np.ndarray, frequent: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a set, frequent ones last: so many that any two sets of this
    similarity share one of them. (They share similarity * n or more of n shingles.)"""
    if len(frequent):
        often = np.isin(hashes, frequent)
        hashes = np.concatenate([hashes[~often], hashes[often]])
    return hashes[: len(hashes) - int(np.ceil(similarity * len(hashes) - 1e-9)) + 1]


def _frequent(texts: DataFrame, count: int) -> np.ndarray:
    """Shingles of many texts of a sample. As blocks they would be large."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.concatenate([distinct_shingles(t) for t in batch["text"]])
            shingles, n = np.unique(found, return_counts=True)
            yield pd.DataFrame({"shingle": shingles.view(np.int64), "n": n})

    some = texts.where(F.pmod("fp", F.lit(max(1, count // SAMPLE))) == 0).select("text")
    counts = some.mapInPandas(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT)
    return np.array([r["shingle"] for r in rows.collect()], dtype=np.int64).view(np.uint64)


def _shared_shingles(nodes: DataFrame) -> DataFrame:
    """(block, node, fp): the nodes that share a shingle of their prefixes. Of shingles
    that the same nodes have, one is taken."""
    keys = nodes.select(F.col("fp").alias("node"), F.explode("keys").alias("block"))
    sets = keys.groupBy("block").agg(
        F.count("*").alias("n"),
        F.min("node").alias("least"),
        F.max("node").alias("most"),
        F.bit_xor(F.xxhash64("node", F.lit(11))).alias("mix"),
    )
    blocks = sets.where("n > 1").groupBy("n", "least", "most", "mix").agg(F.min("block").alias("block"))
    rows = keys.join(stored(blocks.select("block"), "blocks"), "block")
    wide = nodes.select(F.col("fp").alias("node"), F.col("wide").alias("fp"))
    return stored(rows.join(wide, "node").select("block", "node", "fp"), "shared")


def _texts(docs: DataFrame) -> DataFrame:
    text = ascii_lower(text_of(docs))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), _text_key(docs).alias("fp"), text.alias("text"))


def _text_key(docs: DataFrame) -> Column:
    return F.xxhash64(ascii_lower(text_of(docs)))


def _with_shingles(texts: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(block, node, fp, shingles) of the nodes in ``roots``, the root as their block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["block", "node", "fp"]]
            yield out.assign(shingles=[distinct_shingles(t).astype("<u8").tobytes() for t in batch["text"]])

    members = nodes.join(roots.select(F.col("node").alias("fp"), F.col("root").alias("block")), "fp")
    members = members.select(F.col("fp").alias("node"), F.col("wide").alias("fp"), "block")
    rows = texts.select(F.col("fp").alias("node"), "text").join(members, "node").dropDuplicates(["node"])
    return stored(rows.mapInPandas(run, "block long, node long, fp binary, shingles binary"), "shingles")


def one_of_each(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the document with
    the smallest doc_id stays (and of its texts there, if it has several, one). Rows
    without a doc_id stay too."""
    groups = stored(near_groups(docs, similarity), "groups")
    # A doc_id may have several texts: rows are told apart by both.
    named = groups.where(F.col("doc_id") == F.col("component_id"))
    texts = named.groupBy("component_id").agg(F.min("fp").alias("stays"))
    gone = groups.where("doc_id IS NOT NULL").join(texts, "component_id")
    gone = gone.where((F.col("doc_id") != F.col("component_id")) | (F.col("fp") != F.col("stays")))
    gone = gone.select(F.col("doc_id").alias("gone"), F.col("fp").alias("gone_fp")).distinct()
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].cast("long").alias("id"),
        _text_key(docs).alias("key"),
    )
    same = (F.col("gone") == F.col("id")) & (F.col("gone_fp") == F.col("key"))
    return rows.join(gone, same, "left_anti").select("row.*")
