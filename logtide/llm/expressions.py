"""Small ``Column`` helpers shared by the operators that stay in SQL functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = r"[ \t-\r]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also if ``body`` loops over it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than 0x20 and 0x09-0x0D; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{WHITE}+"), "")
