"""Registered queries of the operators for training data: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.llm import classifier, decontaminate, dialogue_repair, licenses, line_windows, minhash, mixing, ngram_join, prefix_trie, quality_rules, repair, substring, warc


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its topic, tokens, weight, probability and whether the mix holds it."""
    mixed = mixing.mix(_documents(spark, sf_dir))
    return mixed.select(
        "doc_id",
        "source",
        "lang",
        "mix.topic",
        F.col("mix.tokens").alias("n_tokens"),
        F.round("mix.weight", 6).alias("weight"),
        F.round("mix.probability", 6).alias("probability"),
        "mix.selected",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir), shingle=3, percent=(85, 100))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark, with the item and the best passage."""
    return decontaminate.contaminated(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_documents(spark, sf_dir))
    return judged.withColumn("failed", F.array_join("failed", ","))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units to remove, with their offsets and the occurrence that stays."""
    return substring.repeated_units(_documents(spark, sf_dir)).drop("content")


def op7_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, from bundles written and read back."""
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document, from grammar-compressed files written and read back."""
    return repair.round_trip(_documents(spark, sf_dir), tokenizer_path(), by_word=True)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return classifier.scored(docs, classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose lines: how many, and which, as merged spans of line numbers from 0."""
    found = line_windows.repeated_lines(_documents(spark, sf_dir))
    runs = F.transform(
        line_windows.spans(F.col("covered")), lambda s: F.concat_ws("-", s["first_line"], s["last_line"])
    )
    return found.select(
        F.col("doc").alias("doc_id"),
        F.size("covered").cast("long").alias("n_removed"),
        F.array_join(runs, ",").alias("removed_lines"),
    )


def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged and repaired: faults, cost, audit and the hash of the result."""
    return dialogue_repair.report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_documents(spark, sf_dir), shingle=4, percent=(85, 100))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_license_scan": op2_license_scan,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_warc_bundles": op7_warc_bundles,
    "op8_token_files": op8_token_files,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_line_dedup": op10_line_dedup,
    "op11_dialogue_repair": op11_dialogue_repair,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_ngram_join": op13_ngram_join,
}
