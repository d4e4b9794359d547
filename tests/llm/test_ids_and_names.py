"""Large ids beside a null one, and documents' columns with names used inside."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import (
    chunk_dedup,
    exact_dedup,
    license_scan,
    mixing,
    packing,
    queries,
    secret_scan,
    simhash,
    token_files,
    winnowing,
)
from ledgerloom.llm.shared import new_folder

BIG = 1 << 60
NAMES = (
    "toxic id score predicted gone gone_fp block fp key keys node root a b m n digest place row terms "
    "lower words votes margin features no_id wide row_id range size slot document"
).split()
SHARED = " ".join(f"shared{i * 37 % 101}" for i in range(80))


@pytest.fixture(scope="module")
def big(spark):
    """One partition, so one batch: ids that doubles cannot tell apart, and a null."""
    rows = [
        (BIG + 1, f"first one {SHARED}"),
        (BIG + 3, f"first two {SHARED}"),
        (None, "no id"),
        (BIG + 5, "mit license alone"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).cache()


def ids(df):
    return sorted({r["doc_id"] for r in df.select("doc_id").collect()}, key=lambda i: (i is not None, i or 0))


def test_large_ids_beside_a_null(spark, big):
    expected = [None, BIG + 1, BIG + 3, BIG + 5]
    fps = simhash.fingerprints(big)
    groups = simhash.fingerprint_groups(fps, radius=3)
    files = new_folder(spark, "ids")
    manifest = token_files.write_ids(big, files, queries.tokenizer("byte_bpe_50k.json"))
    found = {
        "op1": exact_dedup.resolve(big),
        "op2": license_scan.scan_licenses(big),
        "op3": mixing.mix(big.withColumn("source", F.lit("s"))),
        "op4": token_files.read_ids(manifest, files),
        "op5": secret_scan.scan_secrets(big),
        "op6": groups,
        "op9": packing.pack(big, queries.tokenizer("word_bpe_49k.json")),
        "op10": winnowing.neighbours(big),
    }
    assert {name: ids(df) for name, df in found.items()} == dict.fromkeys(found, expected)
    assert ids(chunk_dedup.repeats(big)) == [BIG + 1, BIG + 3]
    license = {r["doc_id"]: r["labels"] for r in found["op2"].collect()}
    assert license[BIG + 5] == ["mit"] and not license[BIG + 3]


def test_near_copies_with_large_ids(big):
    kept = sorted(r["text"] for r in simhash.one_of_each(big).collect())
    assert kept == ["first one " + SHARED, "mit license alone", "no id"]


def test_stages_carry_columns_with_any_name(spark, tmp_path):
    """Five rows of stages' input with clashing columns: the values come out unchanged."""
    texts = ["you idiot scum", "clean words here", f"a {SHARED}", f"b {SHARED}", "mit license"] * 8
    rows = [(i, f"{t} {i % 5} {'x' * (i % 3)}", "en", f"s{i % 2}", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.contains("text", F.lit("idiot")).cast("int").alias("toxic"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    wide = docs.select("*", *[F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in NAMES])
    for name, stage in corpus_pipeline.STAGES[:4]:
        wide = stage(spark, wide, str(tmp_path)).cache()
        assert wide.columns == [*docs.columns, *NAMES], name
        out = wide.collect()
        assert out and all(r[n] == f"{n}-{r['doc_id']}" for r in out for n in NAMES), name
    assert queries.packed_rows(packing.pack(wide, queries.tokenizer("word_bpe_49k.json"))).count() > 0
