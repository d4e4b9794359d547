"""Operator 3: mixing sources to target weights with a low-discrepancy schedule.

Every source is a stream of its documents in a shuffled order, up to three epochs
long, cut into blocks of equally many words. The mixture is a sequence of slots.
Slot i has the van der Corput point of i; the source in whose interval of the
cumulative weights the point lies fills the slot with its next block. Over a
complete set of 2^m points each source gets its share of slots to within one, and
nearly so in any stretch. A closing slot of each source takes what its target leaves.

``mixed_documents`` comes in the order of the schedule, so that any beginning of the
mixture is near the weights, and is written so by a plain write.

Sizes are counts of words (a null or empty text has 0). A document with no words is
never taken. A null source is a source of its own, the last. Rows that agree in
everything are separate documents. Other columns are ignored by ``mixture`` and
carried by ``mixed_documents``. An empty table gives no rows. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .shared import stored, text_of

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Words in a block, at most; the number of slots is the next power of two.
BLOCK_WORDS = 1024
MAX_SLOT_BITS = 40
#: A source's stream is laid out in 2^PIECE_BITS pieces side by side, and its slots
#: are numbered in chunks, so that no task has a whole source.
PIECE_BITS = 10
CHUNK_SLOTS = 4096
SEED = "mix-1"

_START = W.unboundedPreceding


def _source_key() -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))


def _row_key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"], docs["source"], docs["text"])


def sized(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, source, key, size, content), stored: the texts are read once."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        F.regexp_count(text_of(docs), F.lit(WORD)).cast("long").alias("size"),
        _row_key(docs).alias("content"),
    )
    return stored(rows.withColumn("key", _source_key()), "sizes")


def targets(sizes: DataFrame) -> DataFrame:
    """source, key, source_size, weight, target: the sources in order of code points,
    null last, weigh 5, 2, 1, 5, ... A target stops at three times its source, and the
    excess goes to the others by weight.

    In the order of size over weight the stopped sources come first; each is stopped
    if what is left, shared by weight, would give it its cap or more. The windows are
    over the table of sources, one row each.
    """
    names = sizes.groupBy("source", "key").agg(F.sum("size").alias("source_size"))
    last = F.col("source").asc_nulls_last()
    place = (F.row_number().over(W.orderBy(last)) - 1) % len(WEIGHTS)
    weights = F.array(*[F.lit(w).cast("long") for w in WEIGHTS])
    weighed = names.withColumn("weight", F.get(weights, place))
    ratio = F.col("source_size") / F.col("weight")
    before = W.orderBy(ratio, last).rowsBetween(_START, -1)
    whole = W.partitionBy()
    cap = F.col("source_size") * MAX_EPOCHS
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    load = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = weighed.withColumns({"left": left, "load": load}).withColumn(
        "stopped", cap * F.col("load") <= F.col("left") * F.col("weight")
    )
    first_open = {c: F.max(F.when(~F.col("stopped"), F.col(c))).over(whole) for c in ("left", "load")}
    share = first_open["left"] * F.col("weight") / first_open["load"]
    return ranked.select(
        "source",
        "key",
        "source_size",
        "weight",
        F.when(F.col("stopped"), cap.cast("double")).otherwise(share).alias("target"),
    )


def layout(wanted: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per source with a target: the whole words it is to give, the grid points
    [low, high) of its interval, and the block length that all sources share."""
    last = F.col("source").asc_nulls_last()
    rows = wanted.withColumn("words", F.round("target").cast("long")).where("words > 0")
    rows = rows.withColumns(
        {
            "total": F.sum("words").over(W.partitionBy()),
            "upto": F.sum("words").over(W.orderBy(last).rowsBetween(_START, 0)),
        }
    )
    bits = F.ceil(F.log2(F.col("total") / block_words)).cast("int")
    rows = rows.withColumn("bits", F.least(F.greatest(bits, F.lit(0)), F.lit(MAX_SLOT_BITS)))
    rows = rows.withColumn("slots", F.expr("shiftleft(1L, bits)"))
    # Point p / slots lies in [upto - words, upto) / total; in whole numbers.
    point = (
        "CAST((CAST({} AS DECIMAL(18,0)) * CAST(slots AS DECIMAL(14,0)) + total - 1) "
        "DIV total AS BIGINT)"
    )
    return rows.withColumns(
        {
            "block": F.ceil(F.col("total") / F.col("slots")).cast("long"),
            "low": F.expr(point.format("(upto - words)")),
            "high": F.expr(point.format("upto")),
        }
    )


def schedule(sources: DataFrame) -> DataFrame:
    """slot, key, rank, first_word, last_word: the slot takes that stretch (end
    exclusive) of the source's stream, its block number ``rank``."""
    step = F.lit(CHUNK_SLOTS).cast("long")
    starts = F.explode(F.sequence("low", F.col("high") - 1, step)).alias("p0")
    stretches = sources.where("high > low").select("key", "bits", "high", "words", "block", starts)
    until = F.least(F.col("p0") + step, F.col("high")) - 1
    slot = F.conv(F.reverse(F.lpad(F.bin("p"), F.col("bits"), F.lit("0"))), 2, 10)
    points = (
        stretches.repartition("key", "p0")
        .withColumn("p", F.explode(F.sequence("p0", until)))
        .withColumn("slot", F.coalesce(slot.cast("long"), F.lit(0).cast("long")))
        .withColumn("chunk", F.expr(f"slot DIV {CHUNK_SLOTS}"))
    )
    # The rank of a slot within its source: over whole chunks, then inside its chunk.
    earlier = W.partitionBy("key").orderBy("chunk").rowsBetween(_START, -1)
    bases = points.groupBy("key", "chunk").agg(F.count("*").alias("n")).select(
        "key", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    inside = F.row_number().over(W.partitionBy("key", "chunk").orderBy("slot")) - 1
    ranked = points.join(bases, ["key", "chunk"]).select(
        "slot", "key", (F.col("base") + inside).alias("rank"), "words", "block"
    )
    closing = sources.select(
        (F.col("slots") + F.row_number().over(W.orderBy("upto")) - 1).alias("slot"),
        "key",
        (F.col("high") - F.col("low")).alias("rank"),
        "words",
        "block",
    )
    first = F.col("rank") * F.col("block")
    return (
        ranked.unionByName(closing)
        .withColumn("first_word", first)
        .withColumn("last_word", F.least(first + F.col("block"), F.col("words")))
        .where("first_word < last_word")
        .select("slot", "key", "rank", "first_word", "last_word")
    )


def streams(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``at``, the words of its source before each document."""
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(SEED)))
    mixed = sizes.withColumn("shuffle", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    mixed = mixed.withColumn("piece", F.shiftright("shuffle", 60 - PIECE_BITS))
    earlier = W.partitionBy("key").orderBy("piece").rowsBetween(_START, -1)
    bases = mixed.groupBy("key", "piece").agg(F.sum("size").alias("n")).select(
        "key", "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    inside = (
        W.partitionBy("key", "piece")
        .orderBy("shuffle", "doc_id", "size", "row_id")
        .rowsBetween(_START, 0)
    )
    return mixed.join(bases, ["key", "piece"]).withColumn(
        "at", F.col("base") + F.sum("size").over(inside) - F.col("size")
    )


def mixture(sizes: DataFrame, sources: DataFrame, slots: DataFrame) -> DataFrame:
    """The mixture: slot, row_id, epoch, from_word, n_words (within the document)."""
    epochs = F.sequence(F.lit(0).cast("long"), F.lit(MAX_EPOCHS - 1).cast("long"))
    about = sources.select("key", "source_size", "words", "block")
    runs = (
        streams(sizes.where("size > 0"))
        .join(about, "key")
        .select("row_id", "key", "size", "at", "source_size", "words", "block", F.explode(epochs).alias("epoch"))
        .withColumn("begin", F.col("at") + F.col("epoch") * F.col("source_size"))
        .withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("words")))
        .where("begin < end")
        .withColumn("rank", F.expr("explode(sequence(begin DIV block, (end - 1) DIV block))"))
    )
    begin = F.greatest("begin", "first_word")
    return runs.join(slots, ["key", "rank"]).select(
        "slot",
        "row_id",
        "epoch",
        (begin - F.col("begin")).alias("from_word"),
        (F.least("end", "last_word") - begin).alias("n_words"),
    )


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """row_id, doc_id, content, size, source_size, target, taken of each document, the
    first and last slot that take from it (null: none does), and ``starts``, the first
    slot of each of its epochs in the mixture."""
    sizes = sized(docs)
    wanted = stored(targets(sizes), "targets")
    sources = stored(layout(wanted, block_words), "sources")
    starts = [F.min(F.when(F.col("epoch") == e, F.col("slot"))) for e in range(MAX_EPOCHS)]
    taken = mixture(sizes, sources, schedule(sources)).groupBy("row_id").agg(
        F.sum("n_words").alias("taken"),
        F.min("slot").alias("first_slot"),
        F.max("slot").alias("last_slot"),
        F.array_compact(F.array(*starts)).alias("starts"),
    )
    about = wanted.select("key", "source_size", "target")
    return (
        sizes.join(taken, "row_id", "left")
        .join(about, "key")
        .select(
            "row_id",
            "doc_id",
            "content",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
            "first_slot",
            "last_slot",
            "starts",
        )
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it, to the nearest
    whole document (at most three times), in the order of the slots in which its epochs
    begin. Rows equal in doc_id, source and text are told apart by a number."""
    same = ("id", "content")
    row = F.struct(*[docs[c] for c in docs.columns])
    copies = (
        mix(docs)
        .where("size > 0")
        .withColumn("copies", F.round(F.try_divide("taken", "size")).cast("int"))
        .where("copies > 0")
        .select(
            F.lit(None).cast(docs.select(row.alias("row")).schema["row"].dataType).alias("row"),
            F.col("doc_id").alias("id"),
            "content",
            F.slice("starts", F.lit(1), F.col("copies")).alias("slots"),
        )
    )
    rows = docs.select(
        row.alias("row"),
        docs["doc_id"].cast("long").alias("id"),
        _row_key(docs).alias("content"),
        F.lit(None).cast("array<long>").alias("slots"),
    )
    # The n-th of the equal rows gets the n-th of their lists of slots. Dealt out by what
    # both windows share, the texts are shuffled once for them; a join on the number would
    # shuffle them again.
    is_row = F.col("slots").isNull()
    nth = F.row_number().over(W.partitionBy(*same, is_row).orderBy("slots"))
    given = F.max("slots").over(W.partitionBy(*same, "nth"))
    # A slot has one block of one source, so no slot is hot and the ranges are even.
    placed = (
        rows.unionByName(copies)
        .repartition(*same)
        .withColumn("nth", nth)
        .withColumn("given", given)
        .where("row IS NOT NULL AND given IS NOT NULL")
        .select("row", F.explode("given").alias("slot"), *same)
    )
    return placed.repartitionByRange("slot", "id", "content").sortWithinPartitions(
        "slot", "id", "content"
    ).select("row.*")
