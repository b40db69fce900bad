"""Small helpers that several operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of the word and line rules: space and the code points 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drops columns that a result is about to bring; names compare without case."""
    taken = {name.lower() for name in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
