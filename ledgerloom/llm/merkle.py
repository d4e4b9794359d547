"""Operator 11: a Merkle manifest of a table, with a proof for each row.

Each row is a leaf. The leaves of a source, by doc_id, form a tree of runs of 16; the
roots of the sources form a tree of the same kind, whose root stands for the table.

Levels are concatenated strings: an aligned block of 256 nodes keeps each of its levels
as one hex string of 64 characters a node. A parent is the hash of a fixed-width
substring of 16 nodes; the siblings of a node are the substrings that flank it. The
roots of the blocks are the nodes of the next round, so a tree of n leaves takes
log256(n) rounds, and no group is larger than a block, however large a source is.

Positions come from a range partition by (source, doc_id): each task numbers its rows,
and the sizes of the tasks' shares, one row for each task and source, give the offsets.
The text is hashed in the first scan and goes no further.

Rows: one for each input row. A null field is written ``-``, an empty text ``0:``, and
texts are hashed whole. Null doc_ids come first in their source, rows with equal doc_ids
are ordered by leaf; repeated rows are leaves of their own with the same leaf hash. An
empty table gives no rows. Columns beside the five are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .shared import ascii_lower, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 16
#: Levels that a block keeps as strings; a block has RUN ** DEPTH nodes.
DEPTH = 2
BLOCK = RUN**DEPTH
HEX = 64


def leaf(fields: list[Column]) -> Column:
    """Hash of the fields, each with its length in bytes."""
    parts = []
    for field in fields:
        text = field.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(tree, doc_id, leaf, forged): `forged` is the leaf of the row with its text in
    lower case, where `tampered` holds."""
    fields = {name: docs[name] for name in FIELDS}
    forged = fields | {"text": ascii_lower(fields["text"])}
    return docs.select(
        fields["source"].cast("string").alias("tree"),
        fields["doc_id"].cast("long").alias("doc_id"),
        leaf(list(fields.values())).alias("leaf"),
        F.when(tampered, leaf(list(forged.values()))).alias("forged"),
    )


def placed(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """`rows` with `pos`, their place in their tree by `order`, and `total`, the tree's
    rows. Rows that agree in all of `order` have to be interchangeable."""
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Task number and place in the task, fixed once the table is written.
    numbered = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "placed")
    piece = F.shiftright("at", 33)
    shares = numbered.groupBy(F.col(tree).alias("t"), piece.alias("piece")).agg(
        F.min("at").alias("first"), F.count("*").alias("n")
    )
    whole = W.partitionBy("t")
    before = whole.orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    shares = shares.select(
        "t",
        "piece",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("total"),
    )
    same = (piece == shares["piece"]) & F.col(tree).eqNullSafe(shares["t"])
    return numbered.join(shares, same).select(
        *rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "total"
    )


def _parents(level: Column, nodes: Column) -> Column:
    """The level above: a hash for each run of the level string."""
    runs = F.sequence(F.lit(0), F.floor((nodes - 1) / RUN).cast("int"))
    width = RUN * HEX
    return F.array_join(
        F.transform(runs, lambda i: F.sha2(F.substring(level, i * width + 1, F.lit(width)), 256)), ""
    ).cast("binary")


def blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, total, pos, node, item) as aligned blocks: their items by position,
    the level strings and the block's root. A tree that fits in a block stops at its
    root; the blocks of others go up all DEPTH levels."""
    item = F.struct("pos", "node", "item")
    grouped = nodes.groupBy("tree", "total", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(item)).alias("items")
    )
    # Binary, as a substring of it is a copy and not a walk over characters.
    joined = F.array_join(F.transform("items", lambda x: x["node"]), "").cast("binary")
    out = grouped.withColumn("level0", joined)
    for depth in range(DEPTH):
        below = F.col(f"level{depth}")
        grows = F.col("total") > RUN**depth
        size = (F.octet_length(below) / HEX).cast("int")
        out = out.withColumn(f"level{depth + 1}", F.when(grows, _parents(below, size)))
    highest = [F.col(f"level{depth}") for depth in range(DEPTH, -1, -1)]
    return out.withColumn("root", F.coalesce(*highest).cast("string"))


def _segments(place: Column) -> Column:
    """What stands left and right of the node at `place` of the block, level by level."""
    found = []
    for depth in range(DEPTH):
        level, at = F.col(f"level{depth}"), F.floor(place / RUN**depth)
        run = F.floor(at / RUN) * RUN
        left = F.substring(level, (run * HEX + 1).cast("int"), ((at - run) * HEX).cast("int"))
        right = F.substring(
            level, ((at + 1) * HEX + 1).cast("int"), ((run + RUN - 1 - at) * HEX).cast("int")
        )
        pair = F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))
        found.append(F.when(F.col("total") > RUN**depth, pair))
    return F.array_compact(F.array(*found))


def opened(table: DataFrame) -> DataFrame:
    """The nodes of blocks that carry `above`, the path over the block's root, and
    `roots`: (tree, pos, node, item, path, roots), the path from the node's siblings up."""
    nodes = table.select("*", F.explode("items").alias("it"))
    place = F.pmod(F.col("it.pos"), F.lit(BLOCK))
    return nodes.select(
        "tree",
        "it.pos",
        "it.node",
        "it.item",
        F.concat(_segments(place), F.col("above")).alias("path"),
        "roots",
    )


def _grown(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The blocks of each round, from the leaves up."""
    rounds = [stored(blocks(nodes), name)]
    largest = rounds[0].agg(F.max("total")).first()[0] or 0
    while largest > BLOCK:
        upper = rounds[-1].where(F.col("total") > BLOCK)
        nodes = upper.select(
            "tree",
            F.ceil(F.col("total") / BLOCK).alias("total"),
            F.col("block").alias("pos"),
            F.col("root").alias("node"),
            F.lit(None).cast("string").alias("item"),
        )
        rounds.append(stored(blocks(nodes), name))
        largest = -(-largest // BLOCK)
    return rounds


def _roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, root) of each tree: the one block in which it ended."""
    ended = [r.where(F.col("total") <= BLOCK).select("tree", "root") for r in rounds]
    out = ended[0]
    for more in ended[1:]:
        out = out.unionByName(more)
    return out


def _proven(rounds: list[DataFrame], ended: DataFrame) -> DataFrame:
    """The leaves with their paths. `ended` has (t, path, roots) for each tree."""
    above = None  # (t, block, path, roots) for blocks below the round before
    for table in reversed(rounds):
        last = table.where(F.col("total") <= BLOCK)
        ready = last.join(ended, last["tree"].eqNullSafe(ended["t"]))
        ready = ready.withColumnRenamed("path", "above").drop("t")
        if above is not None:
            part = table.where(F.col("total") > BLOCK)
            same = part["tree"].eqNullSafe(above["t"]) & (part["block"] == above["b"])
            below = part.join(above, same).withColumnRenamed("path", "above").drop("t", "b")
            ready = ready.unionByName(below)
        nodes = opened(ready)
        above = nodes.select(
            F.col("tree").alias("t"), F.col("pos").alias("b"), "path", "roots"
        )
    return nodes


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, the path (left and right siblings from the leaf's run
    up), proof_sha256, folded_root (from the tampered leaf, where `tampered` holds, and
    the original siblings) and verified, for each row."""
    rows = placed(leaves(docs, tampered), "tree", "doc_id", "leaf")
    nodes = rows.select(
        "tree", "total", "pos", F.col("leaf").alias("node"), F.struct("doc_id", "forged").alias("item")
    )
    rounds = _grown(nodes, "merkle-leaves")
    subroots = _roots(rounds).select(F.lit(0).alias("tree"), F.col("tree").alias("source"), "root")
    ordered = placed(subroots, "tree", "source")
    tops = _grown(
        ordered.select("tree", "total", "pos", F.col("root").alias("node"), F.struct("source").alias("item")),
        "merkle-sources",
    )
    none = F.lit(None).cast("array<struct<left:string,right:string>>")
    whole = _roots(tops).select(
        F.col("tree").alias("t"), F.coalesce(none, F.array()).alias("path"), F.struct("root").alias("roots")
    )
    sources = _proven(tops, whole).select(
        F.col("item.source").alias("t"),
        "path",
        F.struct(F.col("roots.root").alias("root"), F.col("node").alias("subroot")).alias("roots"),
    )
    proven = _proven(rounds, stored(sources, "merkle-paths"))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    start = F.coalesce(F.col("item.forged"), F.col("node"))
    folded = F.aggregate(
        "path", start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256)
    )
    return proven.select(
        F.col("item.doc_id").alias("doc_id"),
        F.col("node").alias("leaf"),
        "roots.subroot",
        "roots.root",
        "path",
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
