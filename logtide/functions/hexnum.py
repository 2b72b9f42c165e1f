"""Hex, address and 256-bit amount expressions.

Everything here is a ``Column`` built from JVM functions, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtide.constants import DEFAULT_TOKEN_DECIMALS

DECODE_MODES = ("exact", "low64", "high16")

_HEX_TEXT = "^[0-9a-f]*$"
_TWO_POW_48 = 1 << 48
_TWO_POW_96 = 1 << 96
# 10^38 - 1, the largest decimal(38,0), has 32 hex digits.
_EXACT_DIGITS = 32
# A 256-bit word as eight 32-bit limbs; totals get a ninth for the carry.
_LIMBS, _LIMB_DIGITS = 8, 8
TOTAL_DIGITS = (_LIMBS + 1) * _LIMB_DIGITS


def bytes_to_hex(c: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(c)))


def base64_to_hex(c: Column) -> Column:
    """Hex of base64 text; NULL when the text is not base64."""
    return bytes_to_hex(F.try_to_binary(c, F.lit("base64")))


def trim_leading_zeros(c: Column) -> Column:
    return F.ltrim(c, F.lit("0"))


def substring_from(c: Column, start: int) -> Column:
    """``c`` from the 1-based position ``start`` to its end."""
    return c.substr(F.lit(start), F.length(c))


def topic_to_address(topic: Column) -> Column:
    """The 20 address bytes at the end of a 32-byte topic (66 characters)."""
    return F.concat(F.lit("0x"), substring_from(topic, 27))


def strip_hex_prefix(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "^0x", "")


def _digits_to_decimal(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("decimal(38,0)")


def _digits_to_long(digits: Column) -> Column:
    """At most twelve digits, through a long: cheaper than parsing a decimal."""
    return F.conv(digits, 16, 10).cast("bigint").cast("decimal(15,0)")


def hex_exact(digits: Column, trusted: bool = False) -> Column:
    """Value of lower-case hex ``digits`` as ``decimal(38,0)``.

    NULL for NULL, for text that is not hex, and for values of 10^38 and more.
    ``trusted`` is for digits out of ``hex()`` without leading zeros: they are
    used as they are. Each input is named as rarely as possible, because a filter
    on the result repeats the expression for every mention.
    """
    text = digits if trusted else trim_leading_zeros(digits)
    size = F.length(text)
    padded = F.lpad(text, _EXACT_DIGITS, "0")
    high = _digits_to_long(F.substring(padded, 1, 8))
    middle = _digits_to_long(F.substring(padded, 9, 12))
    low = _digits_to_long(F.substring(padded, 21, 12))
    two_48 = F.lit(str(_TWO_POW_48)).cast("decimal(15,0)")
    two_96 = F.lit(str(_TWO_POW_96)).cast("decimal(29,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    # Amounts past 2^96 are rare; the others skip the wide product.
    top = F.when(size > 24, F.try_multiply(high, two_96).cast("decimal(38,0)")).otherwise(zero)
    value = F.try_add((middle * two_48 + low).cast("decimal(38,0)"), top).cast("decimal(38,0)")
    fits = size <= _EXACT_DIGITS
    return F.when(fits if trusted else fits & digits.rlike(_HEX_TEXT), value)


def hex_low64(digits: Column) -> Column:
    """Value of the last 16 hex digits: the amount modulo 2^64.

    NULL and text that is not hex give 0. Kept for parity with warehouses that
    can only parse 64 bits; ``hex_exact`` is the default everywhere.
    """
    tail = F.right(digits, F.lit(16))
    parsed = F.when(tail.rlike("^[0-9a-f]+$"), _digits_to_decimal(tail))
    return F.coalesce(parsed, F.lit(0).cast("decimal(38,0)"))


def hex_high16(digits: Column) -> Column:
    """Value of the first 16 hex digits, for parity with left-truncating pads."""
    head = F.lpad(digits, 16, "0")
    return F.when(head.rlike("^[0-9a-f]+$"), _digits_to_decimal(head))


def amount_digits(event_data: Column) -> Column:
    """Hex digits of ``0x...`` event data without leading zeros; '' for no data."""
    return F.coalesce(trim_leading_zeros(substring_from(event_data, 3)), F.lit(""))


def amount_value(digits: Column, mode: str = "exact", trusted: bool = False) -> Column:
    """Amount of ``amount_digits``; no digits count as 0."""
    if mode not in DECODE_MODES:
        raise ValueError(f"unknown decode mode {mode!r}, use one of {DECODE_MODES}")
    if mode == "low64":
        return hex_low64(digits)
    if mode == "high16":
        return hex_high16(digits)
    return hex_exact(digits, trusted=trusted)


def decode_amount(event_data: Column, mode: str = "exact", trusted: bool = False) -> Column:
    """Amount in ``0x...`` event data; empty, NULL and all-zero data count as 0."""
    return amount_value(amount_digits(event_data), mode, trusted)


def uint256_to_decimal(hex_text: Column) -> Column:
    """Value of hex text with or without ``0x``; NULL where ``hex_exact`` is."""
    return hex_exact(strip_hex_prefix(hex_text))


def token_amount(raw: Column, decimals: int = DEFAULT_TOKEN_DECIMALS) -> Column:
    """Exact token amount as ``decimal(38,18)`` for one fixed number of decimals.

    The digits get an exponent and are read back, so nothing is divided or
    rounded. NULL when the amount does not fit.
    """
    return F.concat(raw.cast("string"), F.lit(f"E-{decimals}")).try_cast("decimal(38,18)")


def convert_token_amount(raw: Column, decimals: Column, precision: int = 8) -> Column:
    """Token amount by each token's own decimals, as ``decimal(28, precision)``.

    Rounds half up; NULL when the amount does not fit.
    """
    shifted = F.concat(raw.cast("string"), F.lit("E-"), decimals.cast("int").cast("string"))
    return shifted.try_cast(f"decimal(28,{precision})")


def total_hex(digits: Column) -> Column:
    """Aggregate: the exact total of hex ``digits`` as ``TOTAL_DIGITS`` hex digits.

    Each 32-bit limb is summed on its own, so no total is out of range, and the
    fixed width makes the text sort like the number. NULL and '' count as 0.
    """
    padded = F.lpad(F.coalesce(digits, F.lit("")), _LIMBS * _LIMB_DIGITS, "0")

    def limb_total(n: int) -> Column:
        limb = F.substring(padded, n * _LIMB_DIGITS + 1, _LIMB_DIGITS)
        return F.coalesce(F.sum(F.conv(limb, 16, 10).cast("bigint")), F.lit(0))

    lowest_first = F.array(*[limb_total(n) for n in reversed(range(_LIMBS))], F.lit(0).cast("bigint"))
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit("").alias("text"))

    def add(state: Column, limb: Column) -> Column:
        total = limb + state["carry"]
        low = F.lpad(F.lower(F.hex(total.bitwiseAND(F.lit(0xFFFFFFFF)))), _LIMB_DIGITS, "0")
        return F.struct(
            F.shiftright(total, 32).alias("carry"), F.concat(low, state["text"]).alias("text")
        )

    return F.aggregate(lowest_first, start, add)["text"]
