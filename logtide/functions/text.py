"""Text expressions with Python's idea of white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtide.constants import SPACE_CHARS, SPACE_CLASS


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def words(stripped: Column) -> Column:
    """Words of text that has no white space at either end."""
    return F.split(stripped, SPACE_CLASS + "+")


def word_count(stripped: Column) -> Column:
    return F.when(F.length(stripped) == 0, F.lit(0)).otherwise(F.size(words(stripped)))


def content_id(c: Column) -> Column:
    """Short content id: the first eight hex digits of the MD5."""
    return F.substring(F.md5(c), 1, 8)
