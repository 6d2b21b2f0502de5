"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions only.

Leaves are (domain, lang, source). The token budget flows down the tree: at each node it is split among the children by
their weights; a child takes at most what its whole subtree can give (tokens times ``epochs``), and what it can't take
goes to its siblings by their weights. Only when all children of a node are exhausted is the node itself short, which
its parent hands to the node's own siblings; shortages thus reach siblings before ancestors.

Each leaf then takes its tokens from seeded epochs: an epoch is the leaf's documents in the order of
md5(seed:epoch:id). Whole epochs are taken in full, and of the last one the prefix of documents whose running token
count stays within the leaf's budget. Running counts are exact and need no task with a whole leaf: the order's first
four hex digits cut an epoch into 65,536 slices, slices are summed with partial aggregation, and only the one slice in
which the budget ends is summed row by row. Weights and sums of leaves are rows per source, never per document.

Defined cases: a null text has 0 tokens; documents of 0 tokens are taken with their slice's prefix; a null lang, source or
domain is a branch of its own (written as the empty string); a null id is ordered as the empty string; repeated rows
are documents of their own, and as a tie in the order they are taken or left together with the budget for all; children
without a listed weight have ``DEFAULT_WEIGHT``; an empty table gives an empty table. Other columns play no part.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from donorlens.llm.common import WORD, bounded, drop_ids, whole_text
from donorlens.session import materialize

DEFAULT_WEIGHT = 1.0
SEED = 20
LEVELS = ("domain", "lang", "source")


def n_tokens(text: Column) -> Column:
    """Words of a text."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _weight(level: str, weights: dict[str, float]) -> Column:
    if any(weight < 0 for weight in weights.values()):
        raise ValueError("weights must not be negative")
    out = F.lit(DEFAULT_WEIGHT)
    for name, weight in weights.items():
        out = F.when(F.col(level) == name, F.lit(float(weight))).otherwise(out)
    return out


def _share(nodes: DataFrame, parent: list[str], level: str, weights: dict[str, float]) -> DataFrame:
    """Splits each parent's ``budget`` among the rows of ``nodes`` (one per child, with its ``capacity``): with the
    children in the order of capacity per weight, a child is exhausted if its capacity is at most its share of what
    the ones before it leave; the others share the rest by weight."""
    # what has the weight 0 has no capacity either, so any weight will do for it
    weight = F.coalesce(F.nullif(_weight(level, weights), F.lit(0.0)), F.lit(DEFAULT_WEIGHT))
    nodes = nodes.withColumn("weight", weight).withColumn("ratio", F.col("capacity") / F.col("weight"))
    w = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = w.orderBy("ratio", level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    rest = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))
    nodes = nodes.withColumn("rate", rest / F.sum("weight").over(after))
    # the first child that isn't exhausted sets the rate for all that follow
    nodes = nodes.withColumn("rate", F.min(F.when(F.col("ratio") > F.col("rate"), F.struct("ratio", level, "rate"))).over(w)["rate"])
    share = F.least("capacity", F.coalesce(F.col("rate") * F.col("weight"), F.col("capacity")))
    return nodes.withColumn("budget", share).drop("weight", "ratio", "rate")


def leaf_budgets(leaves: DataFrame, budget: Column, weights: dict[str, dict[str, float]], epochs: int) -> DataFrame:
    """(domain, lang, source, tokens) with each leaf's ``budget`` in whole tokens. ``budget`` is an expression over
    ``total``, the tokens of all leaves. The weight 0 at any level leaves a node out: nothing is taken from it, and its
    share goes to its siblings as that of an exhausted one does."""
    left_out = functools.reduce(lambda a, b: a | b, [_weight(level, weights.get(level, {})) == 0 for level in LEVELS])
    leaves = leaves.withColumn("capacity", F.when(left_out, 0.0).otherwise(F.col("tokens").cast("double") * epochs))
    done = leaves.agg(F.sum("tokens").alias("total")).select(budget.cast("double").alias("budget"))
    for depth, level in enumerate(LEVELS):
        above, here = list(LEVELS[:depth]), list(LEVELS[:depth + 1])
        nodes = leaves.groupBy(*here).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.join(done.select(*above, "budget"), above) if above else nodes.join(F.broadcast(done), F.lit(True))
        done = _share(nodes, above, level, weights.get(level, {}))
    return done.join(leaves.select(*LEVELS, "tokens"), list(LEVELS)).select(
        *LEVELS, "tokens", F.floor(F.col("budget") + 1e-6).cast("long").alias("budget"))


def mix(docs: DataFrame, domain: Column, weights: dict[str, dict[str, float]], budget: Column, epochs: int = 1,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, domain, lang, source, n_tokens, leaf_tokens, leaf_budget and copies, the number of
    epochs that take the document (0: not taken)."""
    branch = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), branch(domain).alias("domain"), branch(F.col(lang_col)).alias("lang"),
                       branch(F.col(source_col)).alias("source"), n_tokens(whole_text(text_col)).alias("n_tokens"))
    rows = materialize(rows, "mix-rows")
    keys = list(LEVELS)
    leaves = rows.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens"))
    plan = leaf_budgets(leaves, budget, weights, epochs)
    plan = plan.withColumn("whole", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)))
    plan = bounded(materialize(plan.withColumn("last", F.col("budget") - F.col("whole") * F.col("tokens")), "mix-plan"))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("whole") + 1).cast("string"),
                              F.coalesce(F.col("id").cast("string"), F.lit(""))))
    rows = rows.join(plan, keys).withColumn("place", order).withColumn("slice", F.substring("place", 1, 4))
    rows = rows.withColumn("place", F.substring("place", 5, 28))
    slices = rows.groupBy(*keys, "slice").agg(F.sum("n_tokens").alias("slice_tokens"), F.first("last").alias("last"))
    upto = F.sum("slice_tokens").over(Window.partitionBy(*keys).orderBy("slice"))
    slices = slices.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("slice_tokens"))
    slices = slices.withColumn("state", F.when(F.col("upto") <= F.col("last"), "all").when(F.col("before") > F.col("last"), "none")
                               .otherwise("part"))
    # of a leaf, whole slices come first, then one partly taken slice; only where they are is told, in a row per leaf
    ends = slices.groupBy(*keys).agg(F.max(F.when(F.col("state") == "all", F.col("slice"))).alias("upto_slice"),
                                     F.min(F.when(F.col("state") == "part", F.struct("slice", "before"))).alias("part"))
    rows = rows.join(bounded(materialize(ends, "mix-ends")), keys)
    inside = F.col("slice") == F.col("part.slice")
    part = rows.where(inside)
    running = F.sum("n_tokens").over(Window.partitionBy(*keys).orderBy("place").rangeBetween(Window.unboundedPreceding, 0))
    part = part.withColumn("taken", (F.col("part.before") + running <= F.col("last")).cast("long"))
    other = rows.where(F.col("part").isNull() | ~inside).withColumn(
        "taken", F.coalesce(F.col("slice") <= F.col("upto_slice"), F.lit(False)).cast("long"))
    return part.unionByName(other).select(
        F.col("id").alias(id_col), F.col("domain"), F.col("lang"), F.col("source"), "n_tokens",
        F.col("tokens").alias("leaf_tokens"), F.col("budget").alias("leaf_budget"), (F.col("whole") + F.col("taken")).alias("copies"))


def take(docs: DataFrame, domain: Column, weights: dict[str, dict[str, float]], budget: Column, seed: int = SEED,
         id_col: str = "doc_id", **kw) -> DataFrame:
    """The rows of ``docs`` that a mixture of one epoch takes, with all their columns. Rows that repeat an id are taken if each
    of them is; rows with a null id are left out if any of them is."""
    left = mix(docs, domain, weights, budget, 1, seed, id_col, **kw).where("copies = 0").select(id_col)
    left = materialize(left, "mix-left")
    out = drop_ids(docs, left, id_col)
    return out.where(F.col(id_col).isNotNull()) if left.where(F.col(id_col).isNull()).limit(1).count() else out
