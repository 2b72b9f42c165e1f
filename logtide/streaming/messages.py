"""Decode transfer messages and set bad ones aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.constants import ALERT_THRESHOLD_TOKENS, DEFAULT_TOKEN_DECIMALS
from logtide.schemas import TRANSFER_EVENT

FIELDS = TRANSFER_EVENT.fieldNames()
ERROR = "decode_error"


def decode_messages(messages: DataFrame, text: str = "value") -> DataFrame:
    """Fields of each message, its ``raw`` text and what is wrong with it.

    ``decode_error`` is NULL for good messages, else the first of: not JSON, not
    an object, fields missing, fields unexpected or repeated, a required value
    NULL, a block number that is no integer. Other columns (offsets) are kept.

    The text is parsed inside a one-element list, so text after the first JSON
    value counts as malformed instead of being ignored.
    """
    listed = F.concat(F.lit("["), F.col(text), F.lit("]"))
    strict = {"allowSingleQuotes": "false"}
    parsed = F.from_json(listed, "array<map<string,string>>", strict)
    others = [c for c in messages.columns if c != text]
    rows = messages.select(*others, F.col(text).alias("raw"), parsed.alias("parsed"))
    rows = rows.withColumn(
        "fields", F.when(F.size("parsed") == 1, F.element_at("parsed", 1))
    )

    fields = F.col("fields")
    names = F.map_keys(fields)
    expected = F.array(*[F.lit(name) for name in FIELDS])
    block = fields["block_number"].try_cast("bigint")
    # Any one JSON value, looked at only where there is no object.
    values = F.from_json(F.concat(F.lit("["), "raw", F.lit("]")), "array<string>", strict)
    one_value = F.coalesce(F.size(values) == 1, F.lit(False))
    null_value = F.exists(F.array(*[fields[name] for name in FIELDS]), lambda v: v.isNull())
    error = (
        F.when(fields.isNull() & ~one_value, "malformed_json")
        .when(fields.isNull(), "not_an_object")
        .when(F.size(F.array_except(expected, names)) > 0, "missing_field")
        .when(F.size(names) != len(FIELDS), "unexpected_field")
        .when(null_value, "null_value")
        .when(block.isNull(), "bad_block_number")
    )
    columns = [
        (block if name == "block_number" else fields[name]).alias(name) for name in FIELDS
    ]
    return rows.select(*columns, *others, "raw", error.alias(ERROR))


def good_messages(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(ERROR).isNull()).drop("raw", ERROR)


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(ERROR).isNotNull()).select("raw", ERROR)


def is_large(value: Column, threshold: int = ALERT_THRESHOLD_TOKENS) -> Column:
    """Whether a raw value in text is at least ``threshold`` tokens.

    Values too long for a decimal are large; text that is no integer is not.
    """
    digits = F.ltrim(F.trim(value), F.lit("0"))
    is_integer = F.trim(value).rlike("^[0-9]+$")
    limit = F.lit(str(threshold * 10**DEFAULT_TOKEN_DECIMALS)).cast("decimal(38,0)")
    short = F.length(digits) <= 38
    number = F.when(digits == "", F.lit("0")).otherwise(digits).try_cast("decimal(38,0)")
    return F.coalesce(is_integer & (~short | (number >= limit)), F.lit(False))


def large_transfers(transfers: DataFrame, threshold: int = ALERT_THRESHOLD_TOKENS) -> DataFrame:
    return transfers.where(is_large(F.col("value"), threshold))
