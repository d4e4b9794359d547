"""Operator 5: secrets in texts, with parts of one credential linked.

Base kinds are always reported: assignments, access identifiers and long hex runs.
Weak candidates alone mean little: an identifier (``user``, ``client_id``, ...), a
bare 40-character string, an endpoint (URL or host). They are reported only if a
complementary part stands in the same scope: within ``SCOPE`` code points between
their nearest ends. Complementary are: identifier and secret, secret and endpoint;
assignments, bare strings and hex runs are secrets, access identifiers identifiers.

Only built-in functions. A pattern's places are found by cutting the text at its
matches: lengths of the pieces and of the matches add up to positions. Parts are
interval-joined on (row, cell of ``SCOPE`` code points): a part is dealt to every
cell that its interval, widened by the scope, touches. Spans of a kind do not overlap,
so a cell holds a bounded number of them.

Null texts count as empty. Rows are independent: repeated or null doc_ids are kept.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import stored, text_of

# The base kinds, in the order in which they are listed.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

IDENTIFIER = r"(?:user(?:name)?|client_id|account|login|key_id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]+"
BARE = r"(?<![A-Za-z0-9/+])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+])"
ENDPOINT = r"(?:https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9_.:@-]+"

#: kind: (pattern, group whose length counts, least length, part it is of)
KINDS = {
    "assign": (ASSIGN, 2, 6, "secret"),
    "access": (ACCESS, 0, 20, "identifier"),
    "hex": (HEX, 0, 24, "secret"),
    "identifier": (IDENTIFIER, 0, 0, "identifier"),
    "bare": (BARE, 0, 0, "secret"),
    "endpoint": (ENDPOINT, 0, 0, "endpoint"),
}
BASE = ("assign", "access", "hex")
COMPLEMENTS = {"identifier": ("secret",), "secret": ("identifier", "endpoint"), "endpoint": ("secret",)}
SCOPE = 200

_ORDER = {kind: i for i, kind in enumerate(KINDS)}


def _places(text: Column, kind: str) -> Column:
    """array<struct<start, rank, end>> of a kind's matches, by start."""
    pattern, group, least, _ = KINDS[kind]
    if kind == "hex":  # whole runs, so shorter ones need not be looked at
        pattern = rf"[0-9a-f]{{{least},}}"
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.split(text, pattern, -1)
    zero = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>").alias("found"),
    )

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.char_length(part["gap"])
        end = start + F.char_length(part["whole"])
        span = F.struct(start.alias("start"), F.lit(_ORDER[kind]).alias("rank"), end.alias("end"))
        keep = F.char_length(part["counted"]) >= least
        return F.struct(
            end.alias("at"),
            F.when(keep, F.array_append(state["found"], span)).otherwise(state["found"]).alias("found"),
        )

    parts = F.arrays_zip(
        F.slice(between, 1, F.size(whole)).alias("gap"), whole.alias("whole"), counted.alias("counted")
    )
    found = F.aggregate(parts, zero, step, lambda s: s["found"])
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(none)


def candidates(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, base, weak), stored: spans of the base kinds, and of the others."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    found = {kind: _places(F.col("text"), kind) for kind in KINDS}
    strong = F.array_sort(F.concat(*[found[k] for k in BASE]))
    weak = F.array_sort(F.concat(*[found[k] for k in KINDS if k not in BASE]))
    return stored(
        rows.select(
            F.monotonically_increasing_id().alias("row_id"), "doc_id", strong.alias("base"), weak.alias("weak")
        ),
        "candidates",
    )


def linked(spans: DataFrame) -> DataFrame:
    """The weak ones of ``spans`` (row_id, base, weak) that have a complement in scope:
    row_id, linked (array by start)."""
    def part_of(rank: Column) -> Column:
        return F.element_at(F.array(*[F.lit(k[3]) for k in KINDS.values()]), rank + 1)

    both = spans.where(F.size("weak") > 0)
    weak = both.select("row_id", F.explode("weak").alias("span"))
    weak = weak.withColumn("part", part_of(F.col("span.rank")))
    every = both.select("row_id", F.explode(F.concat("base", "weak")).alias("other"))
    every = every.withColumn("other_part", part_of(F.col("other.rank")))
    needs = F.create_map(*[x for k, v in COMPLEMENTS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    weak = weak.withColumn(
        "cell", F.explode(F.expr(f"sequence(span.start DIV {SCOPE}, span.end DIV {SCOPE})"))
    )
    every = every.withColumn(
        "cell",
        F.explode(
            F.expr(f"sequence(greatest(other.start - {SCOPE}, 0) DIV {SCOPE}, (other.end + {SCOPE}) DIV {SCOPE})")
        ),
    ).withColumnRenamed("row_id", "other_row")
    near = (
        (F.col("row_id") == F.col("other_row"))
        & (weak["cell"] == every["cell"])
        & F.array_contains(needs[F.col("part")], F.col("other_part"))
        & (F.greatest("span.start", "other.start") - F.least("span.end", "other.end") <= SCOPE)
    )
    hits = weak.join(every, near, "left_semi").select("row_id", "span").distinct()
    return hits.groupBy("row_id").agg(F.array_sort(F.collect_list("span")).alias("linked"))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base, spans: arrays of (start, rank, end) in code points, end exclusive;
    rank is the place of the kind in ``KINDS``."""
    found = candidates(docs)
    hits = linked(found)
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
    return found.join(hits, "row_id", "left").select(
        "doc_id",
        "base",
        F.array_sort(F.concat("base", F.coalesce("linked", none))).alias("spans"),
    )


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"]),
        ),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == _ORDER[kind])).cast("long")
