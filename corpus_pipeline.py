"""The corpus pipeline: documents through the stages below, each written as Parquet and reread."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm import decontam, jaccard, mixing, queries, tokens_binary, toxicity
from loglens.llm.common import save, table
from loglens.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]



def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or classifier does not reject (see ``op4``)."""
    return toxicity.drop_toxic(spark, docs, table(spark, sf_dir, "labels"))


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest, of each group of similar ones (see ``op9``)."""
    return jaccard.keep_one(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window (see ``op3``)."""
    return decontam.drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix to the sources' weights takes it (see ``op1``)."""
    return mixing.mix_documents(spark, docs, queries.MIX_WEIGHTS, queries.MIX_SHARE, queries.MIX_CAP)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of all documents in coded blocks, read back: place, count and checksum (see ``op6``)."""
    path = tokens_binary.write_tokens(
        spark, docs, fresh_path(spark, "pipeline-tokens"), queries.tokenizer_path(), queries.END_ID
    )
    read = tokens_binary.read_tokens(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_similar),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token-ID output", write_tokens),
]

# The stages learn, hash and tokenize: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(spark, stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
