"""A corpus made ready for training in five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the
columns of `documents`. The last writes token files and returns one row per document from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sievelake.llm import classifier, decontaminate, minhash, mixing, repair
from sievelake.llm.queries import tokenizer_path
from sievelake.llm.storage import keep


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose passages a model learned from `labels` scores 0.5 or more."""
    return classifier.keep_good(docs, classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one of the smallest doc_id. Five words a shingle, similarity 0.8 or more."""
    return minhash.drop_near_duplicates(docs, shingle=5, percent=(80, 100))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of `benchmark`."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet tempered shares of sources, languages and topics."""
    return mixing.sample(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Grammar-compressed token files, read back: doc_id, start, n_tokens, ids_crc32."""
    return repair.round_trip(docs, tokenizer_path(), by_word=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", reject_low_quality),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_passages),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_files),
]

#: Models, signatures and tokens are beyond SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
