"""Joins whose physical form depends on a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

# Bytes of a narrow key list that may be sent to every task.
LOOKUP_BYTES = 16_000_000


def broadcast_if_small(keys: DataFrame, limit: int = LOOKUP_BYTES) -> DataFrame:
    """Mark ``keys`` for broadcast after measuring its bytes; a larger list is joined by shuffle.

    Worth the measurement where the other side is a whole fact table that would
    otherwise be shuffled. The result is the same either way.
    """
    width = F.lit(16)
    for field in keys.schema.fields:
        text = isinstance(field.dataType, (T.StringType, T.BinaryType))
        width = width + (F.coalesce(F.octet_length(field.name), F.lit(0)) if text else F.lit(8))
    size = keys.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return F.broadcast(keys) if size <= limit else keys
