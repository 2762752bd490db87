"""Text pieces as column expressions, shared by the operators of this folder."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space: tab to carriage return, and the space.
SPACES = " \t\n\x0b\x0c\r"
#: Runs of them, as a pattern.
SPACE_RUNS = r"[\x20\x09-\x0D]+"
#: Every run of characters that separates words of letters, digits and non-ASCII characters.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Row key of an operator's own joins.
KEY = "__row_key"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    The built-in ``lower`` is quick and changes only letters, so it serves wherever
    no other upper-case letter occurs; ``translate`` does the rest.
    """
    other = F.rlike(text, F.lit(r"[\P{ASCII}&&[\p{Lu}\p{Lt}\p{Nl}\p{So}]]"))
    return F.when(other, F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(text))


def lines(text: Column) -> Column:
    """The text cut at every line feed; null or empty is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def strip(text: Column) -> Column:
    """Without ASCII white space at both ends."""
    return F.trim(text, F.lit(SPACES))


def cut(text: Column, breaks: str) -> Column:
    """What lies between matches of ``breaks``; null has nothing."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), breaks, -1), "")


def words(text: Column) -> Column:
    """Words of ASCII lower-case letters, digits and all non-ASCII characters."""
    return cut(ascii_lower(text), BREAKS)


def row_key(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """With ``KEY``: a digest of id and text. Rows alike in both share it, and get the same results."""
    number = F.col(id_column).cast("string")
    # The id's length and a sign before the text keep apart what would read alike when joined.
    own = F.concat(
        F.coalesce(F.concat(F.octet_length(number).cast("string"), F.lit(":"), number), F.lit("-")),
        F.coalesce(F.concat(F.lit("+"), F.col(text_column)), F.lit("-")),
    )
    return df.withColumn(KEY, F.unhex(F.md5(own.cast("binary"))))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add."""
    return df.drop(*names)
