"""Text clean-up with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Splits after every character that is neither letter nor digit.
_AFTER_SEPARATOR = r"(?<=[^\p{L}\p{N}])"


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def title_case(text: Column) -> Column:
    """Capitalise after every non-alphanumeric character (``O'Neil-Smith``).

    ``initcap`` alone only looks at whitespace.
    """
    words = F.split(F.lower(text), _AFTER_SEPARATOR)
    return F.array_join(F.transform(words, F.initcap), "")


def standard_city(text: Column) -> Column:
    return F.nullif(title_case(F.trim(text)), F.lit(""))


def natural_key(text: Column) -> Column:
    """Case- and padding-insensitive form used to spot duplicates."""
    return F.lower(F.trim(text))
