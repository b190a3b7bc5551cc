"""Small column helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The separators between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(column: str = "text") -> Column:
    """The column as a string, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text, in order."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def row_key(*columns: str) -> Column:
    """A key equal for rows that are equal in the columns (nulls included): repeated rows get the same results."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
    lengths = [F.length(p).cast("string") for p in parts]
    return F.sha2(F.concat_ws(":", *lengths, *parts), 256)


def wrapped(df: DataFrame, name: str = "__row") -> DataFrame:
    """The whole row as one struct, so that own columns never clash with the caller's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def unwrapped(df: DataFrame, name: str = "__row") -> DataFrame:
    return df.select(f"{name}.*")
