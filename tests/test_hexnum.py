import random
from decimal import Decimal, getcontext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logtide.functions import hexnum

getcontext().prec = 120
EDGES = [
    0, 1, 15, 16, 2**32, 2**48 - 1, 2**48, 16**15, 2**63, 2**64 - 1, 2**64, 2**96, 10**38 - 1,
    10**38, 2**127, 2**128 - 1, 2**128, 2**256 - 1,
]


def evaluate(spark, values, **columns):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return df.select("x", *[c.alias(n) for n, c in columns.items()]).collect()


@pytest.fixture(scope="module")
def words():
    rng = random.Random(11)
    numbers = EDGES + [rng.getrandbits(rng.randint(1, 256)) for _ in range(400)]
    return [f"0x{n:064x}" for n in numbers]


def test_exact_values_or_null(spark, words):
    rows = evaluate(spark, words, y=hexnum.decode_amount(F.col("x")).cast("string"))
    for row in rows:
        number = int(row.x, 16)
        assert row.y == (str(number) if number < 10**38 else None)


def test_trusted_digits_give_the_same(spark, words):
    digits = hexnum.amount_digits(F.col("x"))
    rows = evaluate(
        spark, words,
        a=hexnum.amount_value(digits), b=hexnum.amount_value(digits, trusted=True),
    )
    assert all(row.a == row.b for row in rows)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 2**256 - 1), min_size=1, max_size=50))
def test_uint256_without_padding(spark, numbers):
    rows = evaluate(
        spark, [f"{n:X}" for n in numbers], y=hexnum.uint256_to_decimal(F.col("x")).cast("string")
    )
    for row, n in zip(rows, numbers):
        assert row.y == (str(n) if n < 10**38 else None)


def test_low64_and_high16_parity_modes(spark, words):
    rows = evaluate(
        spark, words,
        low=hexnum.decode_amount(F.col("x"), "low64"),
        high=hexnum.decode_amount(F.col("x"), "high16"),
    )
    for row in rows:
        digits = row.x[2:].lstrip("0")
        assert int(row.low) == int(row.x, 16) % 2**64
        assert int(row.high) == int(digits[:16] or "0", 16)


def test_empty_null_and_bad_data(spark):
    values = ["0x", None, "0x" + "0" * 64, "0xzz"]
    exact = evaluate(spark, values, y=hexnum.decode_amount(F.col("x")))
    assert [r.y for r in exact] == [0, 0, 0, None]
    low = evaluate(spark, values, y=hexnum.decode_amount(F.col("x"), "low64"))
    assert [r.y for r in low] == [0, 0, 0, 0]


def test_unknown_mode_is_an_error():
    with pytest.raises(ValueError):
        hexnum.amount_value(None, "other")


def test_base64(spark):
    rows = evaluate(spark, ["aGk=", "***", None, ""], y=hexnum.base64_to_hex(F.col("x")))
    assert [r.y for r in rows] == ["0x6869", None, None, "0x"]


def test_topic_to_address(spark):
    topic = "0x" + "0" * 24 + "ab" * 20
    rows = evaluate(spark, [topic, None], y=hexnum.topic_to_address(F.col("x")))
    assert [r.y for r in rows] == ["0x" + "ab" * 20, None]


def test_token_amounts_are_exact(spark):
    rng = random.Random(3)
    numbers = [0, 1, 10**18, 10**38 - 1] + [rng.getrandbits(rng.randint(1, 126)) for _ in range(200)]
    raw = F.col("x").cast("decimal(38,0)")
    rows = evaluate(spark, [str(n) for n in numbers], y=hexnum.token_amount(raw))
    for row in rows:
        assert row.y == Decimal(row.x) / 10**18


def test_token_amount_by_decimals_rounds_half_up(spark):
    cases = [
        ("123456789", 6, "123.45678900"), ("5", 18, "0E-8"), ("15", 9, "0.00000002"),
        ("1" * 38, 30, "11111111.11111111"), ("1" * 38, 0, None), ("7", 0, "7.00000000"),
        ("9", 77, "0E-8"),
    ]
    df = spark.createDataFrame([(r, d) for r, d, _ in cases], "r string, d int")
    rows = df.select(
        hexnum.convert_token_amount(F.col("r").cast("decimal(38,0)"), F.col("d")).alias("y")
    ).collect()
    assert [r.y for r in rows] == [None if e is None else Decimal(e) for _, _, e in cases]
