"""Filter interaction audit: what each filter removes at each step of every order in which the filters can be applied.

A document is known by its mask, the set of filters that it fails, so the corpus is counted by (part, mask) once. The orders
are ranked lexicographically by their Lehmer code. All orders that begin with the same filters have consecutive ranks, so
the orders in which a mask's documents go at a step (none of the filters before is in the mask, this one is) are a few
intervals of ranks. Each (part, mask) count is added where such an interval begins and taken off where it ends; a prefix sum
across the ranks gives what each order removes at each step. All other figures follow from that and the counts.

``failures`` gives the masks of texts for five filters: A short (under ``MIN_WORDS`` words), B repetitive (under
``MIN_DISTINCT`` per cent distinct words), C loud (over ``MAX_UPPER`` per cent of the code points in A-Z), D marks (holds
one of ``MARKS``), E copy (identical to the text of a smaller id anywhere in the table). Copies are told by the SHA-256 of
the text; texts don't move between executors, and the rows of a group of copies are never together: the group's smallest id
comes from partial aggregates, and the join with it is by (digest, id).

Defined cases: a null text is the empty text, which fails A alone unless it is a copy; a null part is the empty string, the
same part as an empty one; a row without an id is never a copy and has no labels; rows that repeat an id with one text
aren't copies of each other, each counts; of several labels of an id one that says 1 suffices; a document without labels
is neither good nor toxic; an empty table gives an empty table. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import string
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from donorlens.llm.common import bounded, whole_text
from donorlens.session import materialize

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50
MAX_UPPER = 2
MARKS = r"[#$%&*|]"
#: Orders are listed one by one: 720 of them.
MAX_FILTERS = 6


def lehmer_rank(order: tuple[int, ...], n: int) -> int:
    """The rank of the first order of 0..n-1 that begins with ``order``: each place adds how many of the unused are
    smaller, times the orders of the places after it."""
    unused, rank = list(range(n)), 0
    for place, x in enumerate(order):
        rank += unused.index(x) * factorial(n - 1 - place)
        unused.remove(x)
    return rank


def intervals(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of the orders in which the mask's documents go at the step. Filter i
    is bit i of a mask; steps count from 1."""
    out = []
    for mask in range(1, 1 << n):
        fails = [i for i in range(n) if mask >> i & 1]
        passes = [i for i in range(n) if not mask >> i & 1]
        for step in range(1, len(passes) + 2):
            for before in permutations(passes, step - 1):
                for last in fails:
                    first = lehmer_rank((*before, last), n)
                    out.append((mask, step, first, first + factorial(n - step)))
    return out


def words(text: Column) -> Column:
    """The words of a text, runs of characters other than space and 0x09-0x0D."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " "), "")


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Documents by id, part and mask: (id, part, mask, count), count being how many equal rows there are."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       whole_text(text_col).alias("text"))
    rows = rows.select("id", "part", "text", words(F.col("text")).alias("words"))
    size, distinct = F.size("words"), F.size(F.array_distinct("words"))
    upper = F.length("text") - F.length(F.translate("text", string.ascii_uppercase, ""))
    fails = [size < MIN_WORDS, 100 * distinct < MIN_DISTINCT * size, 100 * upper > MAX_UPPER * F.length("text"), F.col("text").rlike(MARKS)]
    mask = sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails)), F.lit(0))
    rows = rows.select("id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    rows = materialize(rows.groupBy("digest", "id", "part", "mask").agg(F.count("*").alias("count")), "audit-rows")
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    return rows.join(materialize(first, "audit-first"), ["digest", "id"], "left").select(
        "id", "part", (F.col("mask") + F.when(copy, 1 << len(fails)).otherwise(0)).alias("mask"), "count")


def with_labels(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` with how many of each row's documents are good and toxic."""
    yes = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("long"), F.lit(0).cast("long"))).alias(c)
    marked = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(yes("quality"), yes("toxic"))
    marked = bounded(materialize(marked.where("quality = 1 OR toxic = 1"), "audit-labels"))
    got = lambda c: (F.coalesce(F.col(c), F.lit(0)) * F.col("count"))
    return rows.join(marked, "id", "left").select("part", "mask", "count", got("quality").alias("good"), got("toxic").alias("toxic"))


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from rows of (part, mask, count, good, toxic): kept, removed,
    redundant, unique_fails, good_lost, toxic_lost and shapley."""
    n = len(filters)
    if not 1 <= n <= MAX_FILTERS or len(set(filters)) != n:
        raise ValueError(f"1 to {MAX_FILTERS} different filters, not {filters!r}")
    spark, sums = rows.sparkSession, ("count", "good", "toxic")
    counts = materialize(rows.groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in sums]), "audit-counts")

    spans = F.broadcast(spark.createDataFrame(intervals(n), "mask int, step int, begin int, end int"))
    edge = lambda at, sign: F.struct(F.col(at).alias("rank"), *[(F.col(c) * sign).alias(c) for c in sums])
    edges = counts.join(spans, "mask").select("part", "step", F.explode(F.array(edge("begin", 1), edge("end", -1))).alias("x"))
    edges = edges.select("part", "step", "x.*").groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in sums])

    names = ["".join(filters[i] for i in order) for order in permutations(range(n))]
    ranks = F.array(*[F.struct(F.lit(r).alias("rank"), F.lit(name).alias("filter_order")) for r, name in enumerate(names)])
    parts = counts.groupBy("part").agg(F.sum("count").alias("total"))
    grid = (parts.select("part", "total", F.explode(ranks).alias("r"))
            .select("part", "total", "r.*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
            .withColumn("filter", F.expr("substring(filter_order, step, 1)")))
    along = Window.partitionBy("part", "step").orderBy("rank")
    removed = grid.join(edges, ["part", "step", "rank"], "left").select(
        *grid.columns, *[F.sum(F.coalesce(F.col(c), F.lit(0))).over(along).alias(c) for c in sums])
    removed = materialize(removed, "audit-removed")

    letters = F.array(*[F.struct(F.lit(x).alias("filter"), F.lit(1 << i).alias("bit")) for i, x in enumerate(filters)])
    failing = counts.select("part", "mask", "count", F.explode(letters).alias("f")).select("part", "mask", "count", "f.*")
    failing = failing.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("bit")) > 0, F.col("count")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("bit"), F.col("count")).otherwise(0)).alias("unique_fails"))
    shares = removed.groupBy("part", "filter").agg(F.sum("count").alias("shapley"))
    steps = Window.partitionBy("part", "rank").orderBy("step")
    out = removed.withColumn("kept", F.col("total") - F.sum("count").over(steps))
    out = out.join(failing, ["part", "filter"]).join(shares, ["part", "filter"])
    return out.select("part", "filter_order", "step", "kept", F.col("count").alias("removed"), (F.col("fails") - F.col("count")).alias("redundant"),
                      "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")
