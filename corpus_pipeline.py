"""The corpus pipeline: documents through toxicity, near-dedup, repeats, mixing and packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the
last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnlake.llm import mixing, near_dup, packing, suffix_dedup, toxicity
from txnlake.llm.common import arrow_rows, read_table, stored
from txnlake.llm.queries import tokenizer_file

CAPACITY = 2048


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    arrow_rows(spark, 256)
    return toxicity.clean_documents(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, that of the least doc_id."""
    arrow_rows(spark, 256)
    return near_dup.one_of_each(docs)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by strings of 200 bytes that start twice or more are cut out."""
    arrow_rows(spark, 128)
    return suffix_dedup.deduplicated_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target shares; a document taken twice has two rows."""
    arrow_rows(spark, 256)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of CAPACITY tokens."""
    arrow_rows(spark, 128)
    packed = packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), CAPACITY)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_strings),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Learned scores, sketches and tokenizers have no DuckDB form; tests hold stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
