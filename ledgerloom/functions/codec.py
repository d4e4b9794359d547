"""Messages <-> typed rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.schemas import (
    BAD_AMOUNT,
    CORRUPT,
    MISSING_KEY,
    OK,
    RAW,
    STATUS,
    UNDECODABLE,
    Entity,
    TEXT,
)
from ledgerloom.functions.columns import is_bad_amount


def encode(rows: DataFrame, entity: Entity) -> DataFrame:
    """Rows -> `key`, `value` messages; absent fields are written as null."""
    return rows.select(*message(entity))


def message(entity: Entity, row: Column | None = None) -> list[Column]:
    """`key` and `value` of a row, which may be a struct in a column."""
    field = (lambda c: F.col(f"`{c}`")) if row is None else row.getField
    body = F.struct(*[field(c).alias(c) for c in entity.columns])
    return [
        field(entity.message_key).alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    ]


def decode(messages: DataFrame, entity: Entity, *, check_amount: bool = False) -> DataFrame:
    """`value` messages -> entity columns, plus `raw` and `status`.

    Rows that cannot be accepted stay in the frame with the reason in `status`.
    Fields that the entity does not know are dropped.
    """
    schema = entity.message_schema.add(CORRUPT, TEXT)
    data = F.from_json(F.col(RAW), schema, {"columnNameOfCorruptRecord": CORRUPT})
    # `inline` rather than `data.*`: a filter on the result would be pushed
    # through a projection and take a copy of the parse with it for every
    # field it names. It stays above a generator, and the parse is done once.
    parsed = messages.select(F.col("value").cast("string").alias(RAW)).select(
        RAW, F.inline_outer(F.array(data))
    )
    if entity.amount:
        parsed = _exact_amount(parsed, entity.amount)
    status = _status(entity, check_amount)
    return parsed.select(
        *[F.col(f"`{c}`") for c in entity.columns],
        F.when(status != OK, F.col(RAW)).alias(RAW),
        status.alias(STATUS),
    )


def _exact_amount(parsed: DataFrame, name: str) -> DataFrame:
    """Amounts as they were sent, and `_lost`: whether that cannot be had.

    The parser reads a number with a fraction or exponent as a double. Only where the
    amount may be one (it shows a point or an exponent, or is infinite) the message is
    parsed again, as a variant, which keeps 38 digits. What a variant holds as a double
    is good if it has the 15 digits that a double keeps: the number of that value in the
    message tells.
    """
    text, raw = F.col(f"`{name}`"), F.col(RAW)
    path = f"$.{name}"
    value = F.try_variant_get(F.try_parse_json(raw), path, "variant")
    kind = F.schema_of_variant(value)
    # Plain searches: a pattern would cost more than all else here.
    doubtful = reduce(lambda a, b: a | b, [text.contains(x) for x in (".", "e", "E", "Infinity", "NaN")])
    reread = F.when(
        doubtful,
        F.struct(
            F.coalesce(kind, F.lit("")).alias("kind"),
            F.when(kind.startswith("DECIMAL"), F.try_variant_get(value, "$", "string")).alias("digits"),
            F.when(kind.isin("DOUBLE", "FLOAT"), F.try_variant_get(value, "$", "double")).alias("double"),
        ),
    )
    again, double = F.col("_again"), F.col("_again.double")
    sent = F.regexp_extract_all(raw, F.lit(rf'"{name}"\s*:\s*(-?[0-9.]+(?:[eE][+-]?[0-9]+)?)'), F.lit(1))
    same = F.filter(sent, lambda x: x.try_cast("double") == double)
    digits = lambda x: F.length(F.regexp_replace(x, "^[-0.]+|[.]|[eE].*$", ""))
    kept = (F.abs(double) < float("inf")) & (F.size(same) > 0) & F.forall(same, lambda x: digits(x) <= 15)
    # No kind: the message has the key twice, or another fault that only variants see.
    lost = (again["kind"] == "") | (double.isNotNull() & ~kept)
    return parsed.withColumn("_again", reread).withColumns(
        {name: F.coalesce(F.col("_again.digits"), text), "_lost": F.coalesce(lost, F.lit(False))}
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(STATUS) == OK).drop(STATUS, RAW)


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(STATUS) != OK).select(STATUS, RAW)


def _status(entity: Entity, check_amount: bool) -> Column:
    keyless = F.lit(False)
    for name in entity.required:
        # A blank key would become a NULL partition value, so it is none either.
        keyless = keyless | F.col(name).isNull() | (F.trim(F.col(name).cast("string")) == "")
    blank = F.col(RAW).isNull() | (F.trim(F.col(RAW)) == "")
    status = F.when(blank | F.col(CORRUPT).isNotNull(), UNDECODABLE).when(
        keyless, MISSING_KEY
    )
    if entity.amount:
        status = status.when(F.col("_lost"), BAD_AMOUNT)
    if check_amount and entity.amount:
        status = status.when(is_bad_amount(F.col(entity.amount)), BAD_AMOUNT)
    return status.otherwise(OK)
