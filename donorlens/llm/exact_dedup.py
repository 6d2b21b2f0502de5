"""Exact duplicates by progressive refinement, in DataFrame functions only.

Texts are equal when identical after lower-casing A-Z. Rows are grouped by byte length; rows that share a length are
grouped by the hash of a short prefix; only rows whose (length, prefix) is shared have their whole text hashed
(SHA-256). Each step is a count with partial aggregation over a narrow table, so that a group with a third of all rows
costs one row per task. The texts themselves never move between executors.

Defined cases: a null text counts as the empty text; of equal texts the largest id stays; rows that repeat an id in a
group all count in ``group_size``, and each of them is kept if its id is; a null id stays only in a group that has no
other id; an empty table gives an empty table. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlens.llm.common import BROADCAST_ROWS, ascii_lower, bounded, drop_ids, whole_text
from donorlens.session import materialize

PREFIX_CHARS = 64


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS,
                 digest_all: bool = False, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256. ``text_sha256`` (of the normalised
    text) is null where refinement ended before the whole text was needed, unless ``digest_all`` asks for it."""
    text = whole_text(text_col)
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).alias("len"),
                       F.xxhash64(ascii_lower(F.substring(text, 1, prefix_chars))).alias("prefix"))
    narrow = materialize(base.drop("text"), "exact-narrow")
    lengths = bounded(materialize(narrow.groupBy("len").count().where("count > 1").select("len"), "exact-lengths"))
    keys = materialize(narrow.join(lengths, "len", "left_semi")
                       .groupBy("len", "prefix").count().where("count > 1").select("len", "prefix"), "exact-keys")
    hits = keys.withColumn("hit", F.lit(True))
    digest = F.sha2(ascii_lower(F.col("text")), 256)
    if keys.limit(broadcast_rows + 1).count() <= broadcast_rows:
        rows = base.join(F.broadcast(hits), ["len", "prefix"], "left")
        digest = digest if digest_all else F.when(F.col("hit"), digest)
        rows = rows.select("id", "len", "prefix", "hit", digest.alias("digest"))
    else:  # too many keys to send to each task: texts of a shared length are hashed where they lie rather than moved to a join
        same = base.join(lengths.withColumn("same", F.lit(True)), "len", "left")
        rows = same.select("id", "len", "prefix", (digest if digest_all else F.when(F.col("same"), digest)).alias("digest"))
        rows = rows.join(hits, ["len", "prefix"], "left")
        rows = rows if digest_all else rows.withColumn("digest", F.when(F.col("hit"), F.col("digest")))
    rows = materialize(rows, "exact-digests")
    shared = rows.where("hit")
    groups = (shared.groupBy("len", "prefix", "digest")
              .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"))
    # written first: Spark splits a large group in a join of written tables, but not beside an aggregate of the same stage
    groups = bounded(materialize(groups, "exact-groups"), broadcast_rows)
    out = (shared.join(groups, ["len", "prefix", "digest"], "left")
           .withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")))
           .select("id", "keep_id", F.coalesce("group_size", F.lit(1)).alias("group_size"), "digest"))
    alone = rows.where("hit IS NULL").select("id", F.col("id").alias("keep_id"),
                                             F.lit(1).cast("long").alias("group_size"), "digest")
    return out.unionByName(alone).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Of rows that repeat an id, all stay or all go; rows with a
    null id stay."""
    gone = materialize(exact_groups(docs, id_col, text_col).where("NOT kept").select(id_col), "exact-gone")
    return drop_ids(docs, gone, id_col)
