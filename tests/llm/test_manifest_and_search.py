"""Operators 11 to 13 against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import lexical_search, merkle, vector_search

WORDS = "ledger block chain trade coin wallet node miner gas fee".split()


def H(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode('utf-8'))}:{value}"


def leaf_of(row, text):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return H(*map(field, fields))


def lower(text):
    return None if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)


def tree(nodes):
    """The root, and per leaf its (left, right) siblings from the bottom up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            run = i // 16 * 16
            paths[leaf].append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 16])))
            at[leaf] = i // 16
        nodes = [H(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def plain_manifest(rows, tampered):
    first = lambda v: (v is not None, v if v is not None else 0)
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        listed = sorted(by_source[source], key=lambda r: (first(r["doc_id"]), leaf_of(r, r["text"])))
        trees[source] = (listed, *tree([leaf_of(r, r["text"]) for r in listed]))
    root, upper = tree([trees[s][1] for s in sources])
    out = []
    for source, above in zip(sources, upper):
        listed, subroot, paths = trees[source]
        for row, path in zip(listed, paths):
            own = leaf_of(row, row["text"])
            node = leaf_of(row, lower(row["text"])) if tampered(row["doc_id"]) else own
            for left, right in path + above:
                node = H(left, node, right)
            proof = H(*(left + right for left, right in path + above))
            out.append((row["doc_id"], own, subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def merkle_rows(docs):
    tampered = F.crc32(docs["doc_id"].cast("string")) % 5 == 0
    found = merkle.manifest(docs, tampered).drop("path").collect()
    assert not found or found[0].__fields__ == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
    ]
    return sorted((tuple(r) for r in found), key=str)


def test_merkle(spark, odd_docs, no_docs):
    tampered = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0
    assert merkle_rows(no_docs) == []
    assert merkle_rows(odd_docs) == plain_manifest([r.asDict() for r in odd_docs.collect()], tampered)
    columns = "tree, at, total, pos, node, item, path, roots, block, above, leaf, root".split(", ")
    clash = odd_docs.select("*", *[F.lit("x").alias(c) for c in columns])
    assert merkle_rows(clash) == merkle_rows(odd_docs)

    # One source of three rounds' depth, some of a run and of a block and one more, and
    # more sources than a block holds, so that the roots of the sources recurse as well.
    sizes = [5000, 1, 15, 16, 17, 255, 256, 257, 272, 0] + [1] * 300
    rows = [
        (2**60 + i, f"Text {i}", "en", None if size == 1 else f"s{s}", i)
        for s, size in enumerate(sizes)
        for i in range(size)
    ]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    many = docs.withColumn("source", F.when(F.length("source") > 3, F.col("source")).otherwise(F.concat("source", F.lit("é"))))
    assert merkle_rows(many) == plain_manifest([r.asDict() for r in many.collect()], tampered)
    spread = docs.where("source IS NULL").withColumn("source", F.concat(F.lit("t"), F.monotonically_increasing_id()))
    assert merkle_rows(spread) == plain_manifest([r.asDict() for r in spread.collect()], tampered)


def plain_terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower(text or ""))


def plain_search(docs, items, k=10):
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, bag in bags:
            score = 0
            for term in plain_terms(text):
                if term in bag:
                    w = floor(1000 * log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 100 - 75 + (75 * sum(bag.values()) * n_docs) // total
                    score += w * ((1_000_000_000 * bag[term]) // (1000 * bag[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_lexical_search(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [(1, "the CAT the dog"), (2, None), (3, ""), (1, "word7919 x déjà"), (None, "vu 𝒳 x x"), (4, "nowhere")],
        "item_id long, text string",
    )
    listed = [tuple(r) for r in items.collect()]
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    search = lambda d, i: found_rows(lexical_search.search(d, i).drop("number"))
    assert search(odd_docs, items) == plain_search(docs, listed)
    clash = odd_docs.select("*", *[F.lit(1).alias(c) for c in ("number", "score", "rank", "place", "share", "item_id")])
    assert search(clash, items.withColumn("doc_id", F.lit(1))) == search(odd_docs, items)
    assert search(no_docs, items) == [] and search(odd_docs, items.limit(0)) == []

    random.seed(2)
    texts = [" ".join(random.choices(WORDS, k=random.randint(0, 30))) for _ in range(900)] + ["coin fee"] * 60
    docs = [(2**60 + i if i % 97 else None, t) for i, t in enumerate(texts)]
    many = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = [(i, " ".join(random.choices(WORDS, k=random.randint(1, 9)))) for i in range(40)]
    some = spark.createDataFrame(asked, "item_id long, text string")
    assert search(many, some) == plain_search(docs, asked)


def test_lexical_blocks_of_queries(spark, monkeypatch):
    docs = [(i, f"coin{i % 7} wallet") for i in range(50)]
    asked = [(i, f"coin{i}") for i in range(7)]
    frames = [spark.createDataFrame(r, s) for r, s in ((docs, "doc_id long, text string"), (asked, "item_id long, text string"))]
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 3)
    assert len(list(lexical_search.query_blocks(frames[1]))) == 3
    assert found_rows(lexical_search.search(*frames).drop("number")) == plain_search(docs, asked)


def test_lexical_bounds_spare_documents():
    random.seed(3)
    vocabulary = [f"t{i}" for i in range(5000)]
    texts = [" ".join(random.choices(vocabulary, k=100)) for _ in range(1000)]
    bags = [Counter(plain_terms(t)) for t in texts]
    df = Counter(t for b in bags for t in b)
    corpus = lexical_search.Corpus(1000, 100_000)
    queries = lexical_search.Queries()
    for i in range(20):
        queries.add(i, {"item_id": i, "text": texts[i * 7].encode()})
    searcher = lexical_search.Searcher(queries, {t.encode(): corpus.weight(n) for t, n in df.items()}, corpus, 3)
    for at in range(0, 1000, 100):
        searcher.search(list(range(at, at + 100)), [t.encode() for t in texts[at : at + 100]])
    assert [best[0][2] for best in searcher.best] == [i * 7 for i in range(20)]
    assert searcher.scored < 0.5 * 20 * 1000


def plain_nearest(rows, asked, k):
    ok = []
    for vec_id, v in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            ok.append((vec_id, [floor(64 * float(x)) for x in v]))
    out = []
    for i, (query_id, q) in enumerate(ok):
        if not asked(query_id):
            continue
        scores = [
            (-sum(a * b for a, b in zip(q, x)), vec_id is None, vec_id or 0, vec_id)
            for j, (vec_id, x) in enumerate(ok)
            if i != j
        ]
        out += [(query_id, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


SPEC = "vec_id long, embedding array<float>, query int, point int, key int"


def nearest_rows(df, k):
    found = vector_search.nearest(df, df["vec_id"], df["embedding"], df["vec_id"] % 20 == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return found_rows(found)


@pytest.mark.parametrize("tiny", [False, True])
def test_vector_search(spark, monkeypatch, tiny):
    if tiny:  # many groups, parts and slices
        monkeypatch.setattr(vector_search, "GROUP_QUERIES", 3)
        monkeypatch.setattr(vector_search, "SLICE_BYTES", 2000)
        monkeypatch.setattr(vector_search, "CHUNK", 7)
    rng = np.random.default_rng(4)
    asked = lambda i: i is not None and i % 20 == 0
    centres = rng.normal(size=(5, 6)) * 5
    rows = [(2**60 + i, [float(x) for x in np.float32(centres[i % 5] + rng.normal(size=6) / 4)]) for i in range(400)]
    rows += [(i, [0.5, -0.25, 1.0, 0.0, 0.0, 0.0]) for i in range(0, 200, 5)]  # one common vector
    rows += [(40, [0.5, -0.25, 1.0, 0.0, 0.0, 0.0]), (40, [0.5, 0.25, 1.0])]
    odd = [
        (None, [1.0] * 6), (None, None), (20, None), (60, []), (80, [None, 1.0]), (100, [float("nan")] * 6),
        (120, [float("inf")] * 6), (140, [1.0, 2.0]), (160, [1.0, 2.0, 0.0]), (180, [-1e3] * 6),
    ]
    for data, k in ((rows + odd, 4), (odd, 20), (rows[:3], 20), ([], 3)):
        df = spark.createDataFrame([(i, v, 1, 1, 1) for i, v in data], SPEC).repartition(4)
        expected = plain_nearest([tuple(r)[:2] for r in df.collect()], asked, k)
        assert nearest_rows(df, k) == expected


def test_vector_scores_of_many_bits(spark):
    df = spark.createDataFrame(
        [(0, [3e7, 1.0]), (1, [3e7, 1.0]), (2, [3e7, 2.0]), (3, [3e38, 0.0])], "vec_id long, embedding array<float>"
    )
    big = (64 * 30_000_000) ** 2
    most = (1 << 63) - 1
    assert nearest_rows(df, 3) == [(0, 1, 3, most), (0, 2, 2, big + 64 * 128), (0, 3, 1, big + 64 * 64)]


def test_groups_far_from_a_query_are_not_sent(spark):
    rng = np.random.default_rng(5)
    centres = np.eye(8) * 100
    x = np.repeat(centres, 200, axis=0) + rng.normal(size=(1600, 8)) / 8
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    taken = vector_search.whole_vectors(df, df["vec_id"], df["embedding"], df["vec_id"] % 20 == 0)
    points = vector_search.distinct_points(taken, 5)
    shape = vector_search.Shape(1600, 80, 8, 6500)
    pivots = vector_search.choose_pivots(points, shape)
    placed = vector_search.place(points, pivots, len(pivots), shape).cache()
    size, radius, least = vector_search.thresholds(placed, pivots, len(pivots), 5)
    sent = vector_search.replicate(placed, pivots, radius, least, np.minimum(size, 1), shape)
    copies = sent.select(F.sum(F.octet_length("points") / 8)).first()[0]
    assert size.sum() == 80 and copies < 0.5 * 1600 * np.count_nonzero(size)
