"""The operators of this folder over the test tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm import labels as labelling
from bazaarlens.llm import quality_classifier, toxicity
from bazaarlens.llm.decontamination import decontaminate
from bazaarlens.llm.line_dedup import line_dedup
from bazaarlens.llm.near_dedup import near_classes
from bazaarlens.llm.ngram_join import ngram_components
from bazaarlens.llm.packing import pack
from bazaarlens.llm.prefix_trie import conversation_trie
from bazaarlens.llm.quality_rules import BASE, TRAINING_ROWS, learn_rules, quality_rules
from bazaarlens.llm.secrets import find_secrets
from bazaarlens.llm.substring_dedup import repeated_passages
from bazaarlens.llm.url_filter import url_filter
from bazaarlens.llm.whitening import whiten

#: Rules (host, path, verdict) of the url query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def url_rules(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in URL_RULES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = labelling.training_rows(docs, table(spark, sf_dir, "labels"), "quality", quality_classifier.TRAINING_ROWS)
    return quality_classifier.score(docs, quality_classifier.train(labelled)).select(
        "doc_id",
        labelling.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "copies", "kept")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = labelling.training_rows(docs, table(spark, sf_dir, "labels"), "quality", TRAINING_ROWS)
    return quality_rules(docs, learn_rules(labelled)).select("doc_id", *BASE, "base_failed", "kept", "rejected_by")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, url_rules(spark)).select("page_id", "host", "path", "rule", "verdict")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = labelling.training_rows(docs, table(spark, sf_dir, "labels"), "toxic", toxicity.TRAINING_ROWS)
    return toxicity.score(docs, toxicity.train(labelled)).select(
        "doc_id",
        labelling.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "spans",
    )


def tokenizer_path() -> str:
    """The public vocabulary that the packing query and stage use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_secrets": op7_secrets,
    "op8_url_filter": op8_url_filter,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_ngram_join": op11_ngram_join,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_prefix_trie": op13_prefix_trie,
}
