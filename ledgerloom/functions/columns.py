"""Column work shared by the jobs. All of it is built-in functions, so it stays
in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SECONDS_PER_DAY = 86_400

# Optional sign, digits with an optional point, optional exponent. Four
# exponent digits after leading zeros are far beyond any 256-bit amount; a larger
# exponent is a bad amount.
_NUMBER = r"^ *[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?0*[0-9]{1,4})? *$"
_PLAIN = r"^(0|[1-9][0-9]*)$"


def partition_date(epoch_seconds: Column) -> Column:
    """Epoch seconds -> 'yyyy-MM-dd' in UTC, whatever the session time zone is."""
    days = F.floor(epoch_seconds / F.lit(SECONDS_PER_DAY))
    return F.date_from_unix_date(days.try_cast("int")).cast("string")


def is_bad_amount(text: Column) -> Column:
    """Present, but not a number."""
    return ~_blank(text) & ~text.rlike(_PLAIN) & ~text.rlike(_NUMBER)


def normalize_amount(rows: DataFrame, column: str) -> DataFrame:
    """Put the amounts of `column` into plain decimal digits, at any length.

    '1.0E25' becomes '10000000000000000000000000', a missing amount '0', and
    text that is not a number NULL. Works on digits only: a 256-bit amount has
    78 of them, more than DECIMAL can hold. Steps are columns of their own so
    that each is computed once, and only for amounts that are not plain yet.
    """
    text = F.col(f"`{column}`")
    odd = ~text.rlike(_PLAIN) & text.rlike(_NUMBER)
    number = F.upper(F.trim(text))
    parts = F.struct(
        F.startswith(number, F.lit("-")).alias("negative"),
        F.ltrim(F.substring_index(number, "E", 1), F.lit("+-")).alias("mantissa"),
        F.when(F.contains(number, F.lit("E")), F.substring_index(number, "E", -1))
        .otherwise("0")
        .cast("int")
        .alias("exponent"),
    )
    mantissa = F.col("_parts.mantissa")
    fraction = F.when(
        F.contains(mantissa, F.lit(".")), F.length(F.substring_index(mantissa, ".", -1))
    ).otherwise(0)
    unscaled = F.struct(
        F.replace(mantissa, F.lit("."), F.lit("")).alias("digits"),
        (fraction - F.col("_parts.exponent")).alias("scale"),
    )
    digits, scale = F.col("_unscaled.digits"), F.col("_unscaled.scale")
    # Whole part and fraction, the first with its leading zeros.
    short = F.length(digits) <= scale
    pieces = F.when(
        scale <= 0,
        F.struct(
            F.concat(digits, F.repeat(F.lit("0"), -scale)).alias("whole"),
            F.lit("").alias("fraction"),
        ),
    ).otherwise(
        F.struct(
            F.when(short, F.lit("0"))
            .otherwise(F.substring(digits, F.lit(1), F.length(digits) - scale))
            .alias("whole"),
            F.concat(
                F.lit("."), F.lpad(F.right(digits, scale), scale, F.lit("0"))
            ).alias("fraction"),
        )
    )
    whole = F.ltrim(F.col("_pieces.whole"), F.lit("0"))
    plain = F.concat(
        F.when(F.col("_parts.negative") & digits.rlike("[1-9]"), F.lit("-")).otherwise(""),
        F.when(whole == "", F.lit("0")).otherwise(whole),
        F.col("_pieces.fraction"),
    )
    return (
        rows.withColumn("_parts", F.when(odd, parts))
        .withColumn("_unscaled", F.when(F.col("_parts").isNotNull(), unscaled))
        .withColumn("_pieces", F.when(F.col("_unscaled").isNotNull(), pieces))
        .withColumn(
            column,
            F.when(_blank(text), F.lit("0"))
            .when(text.rlike(_PLAIN), text)
            .when(F.col("_pieces").isNotNull(), plain),
        )
        .drop("_parts", "_unscaled", "_pieces")
    )


def _blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def shard_of(block_number: Column, shards: int) -> Column:
    """Shard index in 0..shards-1. All entities route by block number, so the
    rows of one block share a shard."""
    return F.pmod(block_number, F.lit(shards)).cast("int")


def json_long(text: Column, path: str) -> Column:
    """Pick a path out of JSON text as a whole number, NULL where it is none."""
    return F.get_json_object(text, path).try_cast("bigint")
