"""The registered queries of the operators, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (
    chunk_dedup,
    exact_dedup,
    lexical_search,
    license_scan,
    merkle,
    mixing,
    packing,
    secret_scan,
    simhash,
    token_files,
    toxicity,
    vector_search,
    winnowing,
)
from .shared import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.resolve(_docs(spark, sf_dir))


def _license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(_docs(spark, sf_dir))
    joined = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return found.withColumns(joined)


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_docs(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "first_slot", "last_slot"
    )


def _token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-ids")
    manifest = token_files.write_ids(_docs(spark, sf_dir), folder, tokenizer("byte_bpe_50k.json"))
    return token_files.read_ids(manifest, folder).select(
        "doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def _secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_docs(spark, sf_dir))
    counts = [secret_scan.count_of(F.col("base"), k).alias(f"n_{k}") for k in secret_scan.BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.as_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("spans")).alias("spans"),
    )


def _simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    fps = simhash.fingerprints(_docs(spark, sf_dir), width=3)
    return simhash.fingerprint_groups(fps, radius=3).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeats(_docs(spark, sf_dir))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    scorer = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scorer.score(docs).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_rows(packing.pack(_docs(spark, sf_dir), tokenizer("word_bpe_49k.json")))


def packed_rows(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def _winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.neighbours(_docs(spark, sf_dir))


def _merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    tampered = F.crc32(docs["doc_id"].cast("string")) % 5 == 0
    return merkle.manifest(docs, tampered).drop("path")


def _lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical_search.search(_docs(spark, sf_dir), items).drop("number")


def _vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    asked = rows["vec_id"] % 20 == 0
    return vector_search.nearest(rows, rows["vec_id"], rows["embedding"], asked)


def queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": _exact_dedup,
        "op2_license_scan": _license_scan,
        "op3_mixing": _mixing,
        "op4_token_files": _token_files,
        "op5_secret_scan": _secret_scan,
        "op6_simhash": _simhash,
        "op7_chunk_dedup": _chunk_dedup,
        "op8_toxicity": _toxicity,
        "op9_packing": _packing,
        "op10_winnowing": _winnowing,
        "op11_merkle": _merkle,
        "op12_lexical_search": _lexical_search,
        "op13_vector_search": _vector_search,
    }


_EXACT_SQL = """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id,
           count(*) OVER (PARTITION BY h) AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY h) AS kept,
           h AS text_sha256
    FROM d
"""

# The words of a source that the mixture takes are the first ones of its stream, up to
# its target; the schedule only decides when.
# Slots rise with the rank within a source: a document's first one is that of its first
# word in the first epoch, its last one that of its last word in the last.
_MIX_SQL = r"""
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+')) AS size,
             CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || 'mix-1'), 1, 15)
                  AS BIGINT) AS shuffle
      FROM documents),
    n AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM n),
    r AS (
      SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS rest,
             sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS load
      FROM w WINDOW before AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    s AS (SELECT *, 3 * source_size * load <= rest * weight AS stopped FROM r),
    t AS (
      SELECT source, source_size,
             CASE WHEN stopped THEN CAST(3 * source_size AS DOUBLE)
                  ELSE CAST(max(rest) FILTER (NOT stopped) OVER () * weight AS DOUBLE)
                       / CAST(max(load) FILTER (NOT stopped) OVER () AS DOUBLE) END AS target
      FROM s),
    p AS (
      SELECT d.doc_id, d.source, d.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS words,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.shuffle, d.doc_id, d.size
                               ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS pos
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    u AS (
      SELECT *, CAST(sum(words) OVER () AS BIGINT) AS total,
             CAST(sum(words) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto,
             row_number() OVER (ORDER BY source NULLS LAST) AS number
      FROM (SELECT source, CAST(round(target) AS BIGINT) AS words FROM t) WHERE words > 0),
    b AS (SELECT *, CAST(greatest(ceil(log2(total / 1024)), 0) AS INTEGER) AS bits FROM u),
    g AS (
      SELECT *, 1::BIGINT << bits AS slots, (total + (1::BIGINT << bits) - 1) // (1::BIGINT << bits) AS block,
             (((upto - words)::HUGEINT << bits) + total - 1) // total AS low,
             ((upto::HUGEINT << bits) + total - 1) // total AS high
      FROM b),
    v AS (
      SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS BIGINT) AS rank, slot
      FROM (SELECT source, CASE WHEN bits = 0 THEN 0
                   ELSE CAST('0b' || reverse(lpad(bin(point), bits, '0')) AS BIGINT) END AS slot
            FROM (SELECT source, bits, unnest(generate_series(CAST(low AS BIGINT), CAST(high - 1 AS BIGINT))) AS point
                  FROM g))
      UNION ALL
      SELECT source, CAST(high - low AS BIGINT), slots + number - 1 FROM g),
    e AS (
      SELECT p.*, CASE WHEN p.size > 0 AND pos < p.words THEN pos // block END AS first_rank,
             CASE WHEN p.size > 0 AND pos < p.words THEN
               (least(pos + least(2, (p.words - 1 - pos) // source_size) * source_size + p.size, p.words) - 1) // block
             END AS last_rank
      FROM p LEFT JOIN g ON p.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
           CAST(a.slot AS BIGINT) AS first_slot, CAST(z.slot AS BIGINT) AS last_slot,
           CAST(greatest(0, least(pos + size, words) - pos)
              + greatest(0, least(pos + source_size + size, words) - pos - source_size)
              + greatest(0, least(pos + 2 * source_size + size, words) - pos - 2 * source_size)
             AS BIGINT) AS taken
    FROM e LEFT JOIN v a ON e.source IS NOT DISTINCT FROM a.source AND e.first_rank = a.rank
           LEFT JOIN v z ON e.source IS NOT DISTINCT FROM z.source AND e.last_rank = z.rank
"""


# Trees are grown from the leaves up by recursion, one level a step; `crc` is the CRC-32
# of the decimal doc_id, bit by bit.
_MERKLE_SQL = r"""
    WITH RECURSIVE f AS (
      SELECT doc_id, source, text,
             concat(coalesce(concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id), '-'),
                    coalesce(concat(strlen(source), ':', source), '-'),
                    coalesce(concat(strlen(lang), ':', lang), '-'),
                    coalesce(concat(strlen(CAST(n_chars AS VARCHAR)), ':', n_chars), '-')) AS head,
             xor(list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(
                 string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
               lambda c, b: list_reduce(
                 list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                 lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
             ), 4294967295::BIGINT) AS crc
      FROM documents),
    h AS (
      SELECT doc_id, source,
             sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS leaf,
             CASE WHEN crc % 5 = 0 THEN
               sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':',
                 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) END)) END AS forged
      FROM f),
    d AS (
      SELECT *, row_number() OVER () AS rid, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY source) AS n
      FROM h),
    up AS (
      SELECT tree, 0 AS level, pos AS idx, leaf AS node, n FROM d
      UNION ALL
      SELECT tree, level + 1, idx // 16, sha256(string_agg(node, '' ORDER BY idx)), (n + 15) // 16
      FROM up WHERE n > 1 GROUP BY tree, level, idx // 16, n),
    sub AS (SELECT tree, node FROM up WHERE n = 1),
    top AS (
      SELECT 0 AS level, tree - 1 AS idx, node, (SELECT count(*) FROM sub) AS n FROM sub
      UNION ALL
      SELECT level + 1, idx // 16, sha256(string_agg(node, '' ORDER BY idx)), (n + 15) // 16
      FROM top WHERE n > 1 GROUP BY level, idx // 16, n),
    sides AS (
      SELECT d.rid, u.level,
             coalesce(string_agg(u.node, '' ORDER BY u.idx)
               FILTER (u.idx < d.pos // CAST(pow(16, u.level) AS BIGINT)), '') AS lo,
             coalesce(string_agg(u.node, '' ORDER BY u.idx)
               FILTER (u.idx > d.pos // CAST(pow(16, u.level) AS BIGINT)), '') AS hi
      FROM d JOIN up u ON u.tree = d.tree AND u.n > 1
        AND u.idx // 16 = d.pos // CAST(pow(16, u.level + 1) AS BIGINT)
      GROUP BY d.rid, u.level
      UNION ALL
      SELECT d.rid, 100 + u.level,
             coalesce(string_agg(u.node, '' ORDER BY u.idx)
               FILTER (u.idx < (d.tree - 1) // CAST(pow(16, u.level) AS BIGINT)), ''),
             coalesce(string_agg(u.node, '' ORDER BY u.idx)
               FILTER (u.idx > (d.tree - 1) // CAST(pow(16, u.level) AS BIGINT)), '')
      FROM d JOIN top u ON u.n > 1 AND u.idx // 16 = (d.tree - 1) // CAST(pow(16, u.level + 1) AS BIGINT)
      GROUP BY d.rid, u.level),
    p AS (
      SELECT rid, sha256(string_agg(concat(lo, hi), '' ORDER BY level)) AS proof,
             list(concat(lo, '|', hi) ORDER BY level) AS path
      FROM sides GROUP BY rid),
    folded AS (
      SELECT d.doc_id, d.leaf, sub.node AS subroot, (SELECT node FROM top WHERE n = 1) AS root,
             coalesce(p.proof, sha256('')) AS proof_sha256,
             list_reduce(list_prepend(coalesce(d.forged, d.leaf), coalesce(p.path, []::VARCHAR[])),
               lambda node, s: sha256(concat(split_part(s, '|', 1), node, split_part(s, '|', 2))))
               AS folded_root
      FROM d JOIN sub ON sub.tree = d.tree LEFT JOIN p ON p.rid = d.rid)
    SELECT *, folded_root = root AS verified FROM folded
"""


_LEXICAL_SQL = r"""
    WITH words AS (
      SELECT number, item_id, doc_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM (SELECT row_number() OVER () AS number, NULL AS item_id, doc_id, text FROM documents
            UNION ALL
            SELECT -row_number() OVER (), item_id, NULL, text FROM benchmark)),
    tf AS (SELECT number, doc_id, term, count(*) AS tf FROM words WHERE number > 0 GROUP BY ALL),
    q AS (SELECT number AS query, item_id, term, count(*) AS times FROM words WHERE number < 0 GROUP BY ALL),
    n AS (SELECT number, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY number),
    c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
    w AS (
      SELECT term, CAST(floor(1000 * ln((2 * any_value(c.docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, c GROUP BY term),
    s AS (
      SELECT query, item_id, number, doc_id, CAST(sum(times * w *
               ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))) AS BIGINT) AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n USING (number), c
      GROUP BY query, item_id, number, doc_id),
    r AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
      FROM s WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


_VECTOR_SQL = r"""
    WITH v AS (
      SELECT row_number() OVER () AS row, vec_id,
             list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
      FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.row, q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.ints, c.ints), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 20 = 0),
    r AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank
      FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": _EXACT_SQL,
        "op3_mixing": _MIX_SQL,
        "op11_merkle": _MERKLE_SQL,
        "op12_lexical_search": _LEXICAL_SQL,
        "op13_vector_search": _VECTOR_SQL,
    }
