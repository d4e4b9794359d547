"""Documents to packed training sequences, in five stages.

``STAGES`` lists them; each function takes (spark, docs, sf_dir) and returns a table
that is written and read back before the next. ``run`` does so for the documents of a
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import exact_dedup, mixing, packing, simhash, toxicity
from ledgerloom.llm.queries import packed_rows, tokenizer
from ledgerloom.llm.shared import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold stay. Learns from the labels beside them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scorer = toxicity.fit(docs, labels)
    # The documents' own columns travel as one, whatever their names.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("document"), docs["text"])
    return scorer.score(rows).where("predicted = 0").select("document.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8; of each group the smallest doc_id stays."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_rows(packing.pack(docs, tokenizer("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Not expressible: the first stage trains a classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
