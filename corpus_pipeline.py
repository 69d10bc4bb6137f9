"""Training-data pipeline over ``documents``: quality, line dedup, near duplicates, mix, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes each stage's rows as Parquet to the shared folder
and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwell.llm.bpe import token_digests
from listwell.llm.catalog import tokenizer_file, tokenizer_pattern
from listwell.llm.common import shared_folder, table
from listwell.llm.mixing import mixed_documents
from listwell.llm.near_lines import near_lines
from listwell.llm.quality import quality
from listwell.llm.shingle_join import shingle_join


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    good = quality(docs).where("kept").select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.xxhash64("doc_id", "text", "lang") == F.col("k_hash"))
    return docs.join(good, same, "left_semi").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that came earlier; one that had words and has none left goes.

    Null and empty texts stay; rows equal in id and text lose the same lines. See ``near_lines`` for what comes earlier.
    """
    kept = near_lines(docs)
    emptied = F.col("dropped_numbers").isNotNull() & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    n_chars = F.when(F.col("dropped_numbers").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return kept.where(~emptied).withColumn("n_chars", n_chars).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words a shingle, similarity 0.8 or more.

    Of rows equal in id and text one stays. Texts without words are like no other text and stay.
    """
    first = shingle_join(docs, n=5, percent=80).where("first").select(F.col("doc_id").alias("k_id"), F.col("tie").alias("k_tie"))
    keyed = docs.withColumn("k_row_id", F.col("doc_id")).withColumn("k_row_tie", F.xxhash64("text"))
    same = F.col("k_row_id").eqNullSafe(F.col("k_id")) & (F.col("k_row_tie") == F.col("k_tie"))
    return keyed.join(first, same, "left_semi").dropDuplicates(["k_row_id", "k_row_tie"]).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document and pass that the mix takes words from. Nulls, ties and repeats as in ``mixed_documents``."""
    return mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each row: doc_id, n_tokens, ids_sha256, decoded_sha256. Nulls count as empty; rows that repeat are answered alike.

    Workers have other stages behind them, so they remember half as many matches as they do alone.
    """
    return token_digests(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"), tokenizer_pattern(), memo_words=150_000)


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_each),
    ("mix", mix_sources),
    ("tokens", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


#: The mix draws by Spark's 64-bit hash and tokens come from a vocabulary file: no SQL says either.
ORACLE_SQL = None
