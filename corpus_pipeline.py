"""From raw documents to tokens: toxic documents go, one of each group of near copies stays, repeated strings are cut out,
documents that hold benchmark passages go, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; it is written as Parquet and read again.
All stages but the last return the columns of documents. Empty tables, null columns and repeated rows go through; see the operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from farol.functions.storage import written
from farol.llm import bpe, decontam, simhash, suffixes, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, words=3, radius=2)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(docs, window=200)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, _table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids): the tokens themselves as 32-bit little-endian numbers."""
    return bpe.encode_decode(docs, bpe.vocabulary_text(public_tokenizers.path("byte_bpe_50k.json")), outputs=True).drop("decoded")


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_copies), ("suffix_dedup", cut_repeated_strings),
          ("decontamination", drop_contaminated), ("bpe", tokenize)]
#: No SQL: the stages fit models and sort suffixes. The tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
