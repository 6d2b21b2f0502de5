"""The operators as registered queries over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from donorlens.llm import bpe, collocations, exact_dedup, filter_audit, labelled, licences, mixing, near_dedup, quality_model, quality_rules
from donorlens.llm import sharding, toxicity, trie_bpe, urls
from donorlens.llm.oracles import ORACLE_SQL
from donorlens.session import materialize

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
SHARDS = [f"shard-{i:03d}" for i in range(64)]

#: Sources of the hot crawl against curated ones; languages without a weight have 1.
WEIGHTS = {"domain": {"crawl": 3.0, "curated": 5.0}, "lang": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 1.0}, "source": {}}
MIX_SHARE = 0.8
MIX_EPOCHS = 2


def domain() -> F.Column:
    return F.when(F.col("source") == "src0", "crawl").otherwise("curated")


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{table}.parquet")


def op1_near_duplicates(spark, d):
    return near_dedup.near_duplicates(read(spark, d, "documents"))


def op2_byte_bpe(spark, d):
    return bpe_digests(read(spark, d, "documents")).drop("ids")


def bpe_digests(docs: DataFrame, remember: int = bpe.REMEMBER, chunk: int = bpe.CHUNK, apart: bool = False) -> DataFrame:
    """The digests of ``op2_byte_bpe`` and the ids. ``apart``: the ids are written before they are decoded, so that a task has one
    Python worker at a time rather than two."""
    path = public_tokenizers.path(VOCABULARY)
    encoded = bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, remember=remember, chunk=chunk)
    ids = F.col("ids")
    encoded = encoded.select("doc_id", F.size(ids).cast("long").alias("n_tokens"),
                             F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), "ids")
    encoded = materialize(encoded, "bpe-ids") if apart else encoded
    return bpe.decode(encoded, path).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


def op3_exact_dedup(spark, d):
    return exact_dedup.exact_groups(read(spark, d, "documents"), digest_all=True)


def op4_url_filter(spark, d):
    out = urls.judge_urls(read(spark, d, "pages"))
    return out.withColumn("host_words", F.array_join("host_words", " "))


def op5_toxicity(spark, d):
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    model = toxicity.fit(*labelled.sample_labelled(docs, labels, "toxic", labelled.crc_remainder("doc_id", 5) != 0, toxicity.PER_CLASS))
    out = toxicity.score_toxicity(docs, model)
    return out.select("doc_id", (labelled.crc_remainder("doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst")


def op6_quality_rules(spark, d):
    out = quality_rules.judge(read(spark, d, "documents"))
    return out.drop("removed_lines")


def op7_mix(spark, d):
    return mixing.mix(read(spark, d, "documents"), domain(), WEIGHTS, F.col("total") * MIX_SHARE, MIX_EPOCHS)


def op8_licences(spark, d):
    out = licences.scan_licences(read(spark, d, "documents"))
    return out.select("doc_id", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("sentence_ids", "licences", "kinds")])


def op9_shards(spark, d):
    return sharding.place(read(spark, d, "documents").select("doc_id"), "doc_id", SHARDS)


def op10_quality(spark, d):
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    model = quality_model.fit(*labelled.sample_labelled(docs, labels, "quality", labelled.crc_remainder("doc_id", 4) != 2, quality_model.PER_CLASS))
    out = quality_model.score_quality(docs, model)
    return out.select("doc_id", (labelled.crc_remainder("doc_id", 4) == 2).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_trie_bpe(spark, d):
    path = public_tokenizers.path(TOKENIZER)
    encoded = trie_bpe.encode(read(spark, d, "documents").select("doc_id", "text"), path)
    return trie_bpe.decode(encoded, path).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_filter_audit(spark, d):
    rows = filter_audit.failures(read(spark, d, "documents"))
    return filter_audit.audit(filter_audit.with_labels(rows, read(spark, d, "labels")))


def op13_collocations(spark, d):
    return collocations.collocations(read(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (op1_near_duplicates, op2_byte_bpe, op3_exact_dedup, op4_url_filter, op5_toxicity, op6_quality_rules,
                                   op7_mix, op8_licences, op9_shards, op10_quality, op11_trie_bpe, op12_filter_audit, op13_collocations)}
ORACLE = {k: v for k, v in ORACLE_SQL.items() if k in QUERIES}
