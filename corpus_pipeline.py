"""A corpus pipeline of five stages over ``documents``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  Its result is written as Parquet and reread as the next
stage's ``docs``.  All stages but the last return the columns of ``docs``; the
last adds the token ids and their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.llm.catalog import tokenizer_file
from shroud.llm.common import fresh, table, write_stage
from shroud.llm.decontaminate import decontaminate
from shroud.llm.exact_dedup import exact_dedup
from shroud.llm.quality import good_documents
from shroud.llm.sentencepiece_codec import encode_documents
from shroud.llm.simhash import near_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal text but for the case of A-Z."""
    return exact_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return near_dedup(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and the number of these."""
    ids, number = fresh("token_ids", docs.columns), fresh("n_tokens", docs.columns)
    coded = encode_documents(docs, tokenizer_file("piece_bpe_32k.model"), ids_name=ids)
    return coded.withColumn(number, F.size(ids).cast("long"))


STAGES = [
    ("quality", quality),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("tokens", tokens),
]

# Learned scores and tokenizers can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
