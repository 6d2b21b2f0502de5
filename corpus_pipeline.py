"""A corpus pipeline of five stages: quality rules, exact copies, near copies, mixing, byte-level BPE."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from donorlens.llm import exact_dedup, mixing, near_dedup, quality_rules
from donorlens.llm.queries import WEIGHTS, bpe_digests, domain, read
from donorlens.session import delete_paths, scratch_scope, written

#: The mixture's tokens as a share of what the stage is given; with one epoch no document is repeated.
MIX_SHARE = 0.9
#: Strings that the encoder remembers, and bytes that it encodes together: its workers stay beside those of the other stages.
REMEMBER = 40_000
CHUNK = 1_000_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs, domain(), WEIGHTS, F.col("total") * MIX_SHARE)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_digests(docs, REMEMBER, CHUNK, apart=True)


STAGES = [("quality rules", quality), ("exact dedup", exact_copies), ("near dedup", near_copies), ("mixing", mixture), ("byte bpe", tokens)]

#: SQL can't express sketches or merges by rank; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again before the next. What a stage wrote on the way is
    deleted with its end, and its input once the next one is written."""
    docs, before = read(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark, cleanup=False) as paths:
            docs = written(spark, partial(stage, spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        delete_paths(spark, before)
        before = paths
    return STAGES[-1][1](spark, docs, sf_dir)
