"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read
again for the next one. All but the last keep the columns of ``documents``, whatever further ones there are.

Every stage takes null ids and texts, empty texts, repeated rows and an empty table: null and empty texts have no words, so the base
rules reject them; rows alike in id and text get the same verdict, and near dedup keeps one of them; an empty table
stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.decontamination import decontaminate
from bazaarlens.llm.labels import training_rows
from bazaarlens.llm.line_dedup import line_dedup
from bazaarlens.llm.near_dedup import near_dedup
from bazaarlens.llm.packing import pack
from bazaarlens.llm.quality_rules import TRAINING_ROWS, learn_rules, quality_rules
from bazaarlens.llm.queries import table, tokenizer_path
from bazaarlens.session import scratch_path

#: SQL can express neither learned rules nor sampling, components and packing.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the base rules or the learned rules reject.

    Rejected rows are left out by a generator: a filter would be moved down to the scan and there
    repeat every expression of the statistics.
    """
    labelled = training_rows(docs, table(spark, sf_dir, "labels"), "quality", TRAINING_ROWS)
    judged = quality_rules(docs, learn_rules(labelled))
    return judged.select(F.inline(F.when(F.col("kept"), F.array(F.struct(*docs.columns)))))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that other documents have; ``n_chars`` follows the text."""
    return line_dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("not contaminated").select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place in it."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
