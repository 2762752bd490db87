"""Labelled documents and the rows that no model learns from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows kept for testing: CRC-32 of the id as text leaves 2 when divided by 4. False for null."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, text and ``label`` of at most ``most`` labelled rows that are not held out.

    Rows are picked by a digest of the id, so the choice neither follows the order of
    the table nor changes between runs. The picked labels are bounded by ``most`` and so
    are broadcast; of the documents only the picked ones go on.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    one_each = known.groupBy("doc_id").agg(F.min(label).alias(label))
    picked = one_each.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
