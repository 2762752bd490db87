"""Lines that many documents share are removed from all but one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.text import KEY, ascii_lower, lines, row_key, strip, without
from bazaarlens.session import cut_lineage

MIN_CHARS = 40
MIN_DOCUMENTS = 5


def _long_lines(text: Column, min_chars: int) -> Column:
    """Position and digest of the key of each line whose key is long enough."""
    keyed = F.transform(lines(text), lambda line, at: F.struct(at.alias("at"), strip(line).alias("key")))
    long = F.filter(keyed, lambda x: F.length(x["key"]) >= min_chars)
    return F.transform(long, lambda x: F.struct(x["at"].alias("at"), F.md5(ascii_lower(x["key"]).cast("binary")).alias("digest")))


def line_dedup(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without ASCII white space at both ends and with A-Z in
    lower case. A key of ``min_chars`` code points or more that stands in
    ``min_documents`` or more rows stays only in the row of the largest id, in all
    its places there. Counting is a sum per digest, combined before the shuffle, so a
    line of a third of all documents costs a row per task; the dropped positions
    then go back to their document, and the rest of the lines keep their order.

    Null and empty texts are one empty line and come back as the empty text. Ids
    that are null are smaller than all others; a key that only such rows hold stays.
    Rows with equal ids count as documents each, and rows equal in id and text are
    treated alike. An empty table gives an empty table. Columns named as the added
    ones are replaced.
    """
    rows = row_key(without(docs, "n_lines", "n_dropped"), id_column, text_column)
    found = rows.select(KEY, F.col(id_column).alias("id"), _long_lines(F.col(text_column), min_chars).alias("found"))
    # Written, so that the join below deals both sides anew and can split a line of many rows.
    counted = cut_lineage(
        found.select("id", F.explode(F.array_distinct(F.col("found.digest"))).alias("digest"))
        .groupBy(F.unhex("digest").alias("digest"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
        .where((F.col("n") >= min_documents) & F.col("last").isNotNull())
        .select("digest", "last")
    )
    placed = found.select(KEY, "id", F.explode("found").alias("line")).select(
        KEY, "id", F.col("line.at").alias("at"), F.unhex("line.digest").alias("digest")
    )
    dropped = (
        placed.join(counted, "digest")
        .where(F.col("id").isNull() | (F.col("id") < F.col("last")))
        .groupBy(KEY)
        .agg(F.collect_set("at").alias("__dropped"))
    )
    split = rows.withColumn("__lines", lines(F.col(text_column))).join(dropped, KEY, "left")
    # A mark sorts before the line of its position, so a line goes if a mark precedes it.
    merged = split.withColumn(
        "__merged",
        F.when(
            F.col("__dropped").isNotNull(),
            F.sort_array(
                F.concat(
                    F.transform("__lines", lambda line, at: F.struct(at.alias("at"), F.lit(1).alias("kind"), line.alias("line"))),
                    F.transform("__dropped", lambda at: F.struct(at.alias("at"), F.lit(0).alias("kind"), F.lit("").alias("line"))),
                )
            ),
        ),
    )
    kept = F.filter(
        "__merged",
        lambda x, at: (x["kind"] == 1) & ((at == 0) | (F.get(F.col("__merged"), at - 1)["kind"] == 1)),
    )
    text = F.when(F.col("__merged").isNull(), F.coalesce(F.col(text_column), F.lit(""))).otherwise(
        F.array_join(F.transform(kept, lambda x: x["line"]), "\n")
    )
    return merged.select(
        *[(text.alias(c) if c == text_column else F.col(c)) for c in rows.columns if c != KEY],
        F.size("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
