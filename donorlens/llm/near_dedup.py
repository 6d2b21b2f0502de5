"""Near duplicates: bottom-k sketches from one hash function, inverted lists of the retained values, a union-sketch
estimate as a filter, exact Jaccard similarity as the proof, and connected components of the proven links.

1. Each text becomes its set of distinct word shingles (hashes) and a sketch, the k smallest of them. Texts with equal
   sets form one class, of which one representative goes on; a thousand copies cost one row.
2. Each of the ``LISTED`` smallest retained values has an inverted list of the representatives that hold it. First every
   member is paired with one leader of each of its lists only, so that a list with a third of all rows gives a pair per
   member. The leader is the member whose values have the longest lists: of copies with changes it is the text they
   derive from. Proven links are joined into components.
3. Lists that still hold several components are completed: pairs of members of like size in *different* components with
   at least ``MEET`` common listed values, each pair in one list only: that of the smallest value under which both take part.
   Members of a list's largest component aren't compared with each other. A list of over ``HOT_LIST`` members is
   completed among those members alone of whose listed values over an eighth lie in such lists. The others share
   enough short lists to be found there: of the 16 smallest values of a union, three in four lie in both texts at the
   threshold, so a pair with at most two values in long lists also meets in a short one but for a chance of 2e-7
   (Bin(16, 0.75) <= 2). In long lists two bounds on the intersection come first, both exact. One: of each member's full
   set, the shingles that any other of these members holds are counted; members whose bound is under the threshold leave
   the long lists (not the short ones, where they meet others). Two: each member has a centre, the leader of its long
   lists. What two members of one centre share lies in the centre (what the one holds of it but for what the other lacks)
   or in both their other shingles, of which only those count that several members of the centre hold (for members
   that lie in the centre by half at least). So of copies with too
   many changes to be linked with the centre only those that reach the threshold with each other become pairs.
   No member is ever left out or sampled.
4. A pair's similarity is estimated from the k smallest values of both sketches' union; pairs with under ``FLOOR`` of
   them in common go (a true link does with a chance of 1e-8). The rest is decided on full sets:
   100 * intersection >= 75 * union.

``listed=None`` leaves nothing to these chances, at the price of lists over a quarter of each set.

Defined cases: a null, empty or blank text has no shingles and links with nothing; a text with fewer words than a
shingle is one shingle of all its words; rows that repeat an id are one node, and each comes back; a row with a null id
is in no component and is kept; an empty table gives an empty table. Other columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlens.llm.common import bounded, components, drop_ids, ship
from donorlens.llm.shingles import shingle_set
from donorlens.session import materialize

SHINGLE_WORDS = 5
THRESHOLD = 75
SKETCH = 64
LISTED = 16
HOT_LIST = 128
#: Least number of common listed values of a pair (fewer with a chance of 2e-7 at the threshold).
MEET = 3
FLOOR = 0.42
#: Values held by a task before they go out (4 MB).
FLUSH = 500_000
#: Shingles of a bucket, and the mark of a shingle with several holders.
BUCKET, SEVERAL = 1_000_000, -1
#: Sets of centres are sent to every task up to so many values (32 MB); more are joined by shuffling.
BROADCAST_VALUES = 4_000_000


def _per_text(size: int, sketch: int | None):
    """Over (id, text as bytes): the sketch of each text's shingle set, or the whole set if ``sketch`` is None. A text's
    set is let go before the next one; rows go out after ``FLUSH`` values."""

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            counts, marks, kept, at = [], [], [], [0]
            for i in range(batch.num_rows):
                found = shingle_set(texts[i].as_py() or b"", size)
                counts.append(len(found))
                marks.append(hashlib.blake2b(found, digest_size=16).digest() if len(found) else None)
                kept.append(found if sketch is None else found[:sketch].copy())  # a slice would hold the whole set
                del found
                at.append(at[-1] + len(kept[-1]))
                if at[-1] > FLUSH or i == batch.num_rows - 1:
                    first = i + 1 - len(kept)
                    values = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(kept), pa.int64()))
                    out = pa.RecordBatch.from_arrays(
                        [ids.slice(first, len(kept)), pa.array(counts, pa.int64()), pa.array(marks, pa.binary()), values],
                        names=["id", "n", "mark", "vals"])
                    counts, marks, kept, at = [], [], [], [0]
                    yield out

    return run


def _sets(docs: DataFrame, size: int, sketch: int | None) -> DataFrame:
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)["id"]
    return docs.mapInArrow(_per_text(size, sketch), f"id {kind}, n long, mark binary, vals array<long>")


def _proven(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, threshold: int, k: int,
            name: str) -> DataFrame:
    """The pairs (a, b) that reach the threshold on full sets."""
    side = lambda x: classes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("vals").alias(f"s_{x}"))
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, k)
    common = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), union))
    likely = (pairs.join(side("a"), "a").join(side("b"), "b")
              .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold)
              .where(common >= FLOOR * F.size(union)).select("a", "b"))
    likely = materialize(likely, f"{name}-likely")
    ids = likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id"))).distinct()
    full = materialize(_sets(docs.join(bounded(ids), "id", "left_semi"), size, None).select("id", "vals"), f"{name}-sets")
    side = lambda x: full.select(F.col("id").alias(x), F.col("vals").alias(f"f_{x}"))
    both = likely.join(side("b"), "b").join(side("a"), "a").select(
        "a", "b", F.size(F.array_intersect("f_a", "f_b")).alias("inter"), (F.size("f_a") + F.size("f_b")).alias("total"))
    return materialize(both.where(F.col("inter") * 100 >= (F.col("total") - F.col("inter")) * threshold)
                       .select("a", "b").distinct(), f"{name}-links")


def _several(rest: DataFrame, name: str) -> DataFrame:
    """The members of lists that hold several parts, with the list's size. The sizes are written first: Spark splits a
    hot list in a join of two written tables, but not beside an aggregate of the same stage."""
    sizes = rest.groupBy("value").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("size")).where("lo <> hi")
    return rest.join(materialize(sizes.select("value", "size"), name), "value")


def _grouped(shingles: np.ndarray, holders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles in order, each with its only holder, or ``SEVERAL``."""
    order = np.argsort(shingles, kind="stable")
    shingles, holders = shingles[order], holders[order]
    first = np.flatnonzero(np.r_[True, shingles[1:] != shingles[:-1]]) if len(shingles) else np.zeros(0, dtype=np.int64)
    only = np.diff(np.r_[first, len(shingles)]) == 1
    return shingles[first], np.where(only, holders[first], SEVERAL)


def _dealt(buckets: int):
    """Over (member, own): a row per bucket of the shingles' range and batch, with the batch's distinct shingles and holders."""

    def run(batches):
        for batch in batches:
            own = batch.column(1)
            shingles = own.flatten().to_numpy(zero_copy_only=False)
            holders = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), own.value_lengths().to_numpy(zero_copy_only=False))
            shingles, holders = _grouped(shingles, holders)
            bucket = ((shingles >> 32) * buckets) >> 31  # shingles have 63 bits
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            keep = np.flatnonzero(np.diff(cuts))
            ends = pa.array(np.r_[cuts[keep], len(shingles)] if len(keep) else [0], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keep, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(shingles)), pa.ListArray.from_arrays(ends, pa.array(holders))],
                names=["bucket", "shingles", "holders"])

    return run


def _count_alone(table: pa.Table) -> pa.Table:
    """How many shingles of a bucket each member alone holds."""
    flat = [table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("shingles", "holders")]
    _, holders = _grouped(*flat)
    members, counts = np.unique(holders[holders != SEVERAL], return_counts=True)
    return pa.table({"member": pa.array(members, pa.int64()), "alone": pa.array(counts, pa.int64())})


def _bounds(family: DataFrame, held: DataFrame) -> DataFrame:
    """For each member of long lists (id, centre), what bounds its intersection with others of them.

    ``alone``: its shingles that no other member holds. For members that share at least half of their shingles with their
    centre also ``centre``, ``inside``, how many these are, ``lacks``, the centre's shingles that it doesn't hold (null if these
    are more than ``inside``), and ``beside``, those of its other shingles that another such member of the centre holds too.
    Two such members share, of the centre, what is inside the one and not lacking in the other (at most the lesser ``inside``),
    and what their ``beside`` have in common.

    Shingles are counted in buckets of their range, of about ``BUCKET`` each whatever the number of members: tasks first
    merge the shingles of their own members, so that one that all members hold comes once per batch, and only
    those outside a member's centre are dealt out; the centres' are added once.
    """
    centres = held.join(family.select(F.col("centre").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("centre"), F.col("vals").alias("middle"))
    centres = materialize(centres, "near-centres")
    few = (centres.agg(F.sum(F.size("middle"))).first()[0] or 0) <= BROADCAST_VALUES
    around = family.join(held, "id").join(F.broadcast(centres) if few else centres, "centre", "left").select(
        "id", "centre", F.size(F.array_intersect("vals", "middle")).alias("inside"), F.array_except("vals", "middle").alias("rest"),
        F.array_except("middle", "vals").alias("lacks"))
    around = around.withColumn("lacks", F.when((F.col("inside") >= F.size("rest")) & (F.size("lacks") <= F.col("inside")), F.col("lacks")))
    around = materialize(around.withColumn("member", F.monotonically_increasing_id()), "near-around")
    buckets = 1 + (around.agg(F.sum(F.size("rest"))).first()[0] or 0) // BUCKET
    own = around.select("member", "rest").unionByName(centres.select(F.lit(SEVERAL).cast("long").alias("member"), F.col("middle").alias("rest")))
    dealt = own.mapInArrow(_dealt(buckets), "bucket long, shingles array<long>, holders array<long>")
    alone = dealt.groupBy("bucket").applyInArrow(_count_alone, "member long, alone long").groupBy("member").agg(F.sum("alone").alias("alone"))
    near = around.where(F.col("inside") >= F.size("rest")).select("id", "centre", "inside", "lacks", "rest")
    rest = near.select("id", "centre", F.explode("rest").alias("shingle"))
    common = materialize(rest.groupBy("centre", "shingle").agg(F.count("*").alias("count")).where("count > 1").drop("count"), "near-beside")
    beside = rest.join(common, ["centre", "shingle"]).groupBy("id").agg(F.collect_list("shingle").alias("beside"))
    near = near.drop("rest").join(beside, "id", "left").withColumn("beside", F.coalesce("beside", F.array().cast("array<long>")))
    return (around.select("id", "member").join(alone, "member", "left").select("id", F.coalesce("alone", F.lit(0)).alias("alone"))
            .join(near, "id", "left"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS,
                    threshold: int = THRESHOLD, k: int = SKETCH, hot: int = HOT_LIST, listed: int | None = LISTED) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id reachable over links with a Jaccard
    similarity of at least ``threshold`` per cent) and kept (it is that smallest id). With ``listed=None`` no link is left
    to chance: so many values of a set are listed (a quarter of it) that linked sets share one in any case, and whole
    sets are compared in place of sketches."""
    exact = listed is None
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    sketches = materialize(_sets(rows, size, None if exact else k), "near-sketches")
    k, meet = (1 << 30, 1) if exact else (k, MEET)
    known = sketches.where("n > 0 AND id IS NOT NULL")
    classes = materialize(known.groupBy("mark", "n").agg(F.min("id").alias("id"), F.first("vals").alias("vals")),
                          "near-classes")
    prefix = F.expr(f"CAST(n - CEIL(n * {threshold} / 100) + 1 AS INT)") if exact else F.lit(listed)
    brief = classes.select("id", "n", F.slice("vals", F.lit(1), prefix).alias("listed"))
    postings = brief.select("id", "n", F.size("listed").alias("kept"), F.explode("listed").alias("value"))
    lists = materialize(postings.groupBy("value").agg(F.count("*").alias("members")).where("members > 1"), "near-lists")
    members = materialize(postings.join(lists, "value"), "near-members")
    # a member's weight: how many others it meets per value; that of a text from which others derive is the largest
    weights = members.groupBy("id", "kept").agg((F.sum("members") / F.first("kept")).alias("weight"),
                                                F.sum((F.col("members") > hot).cast("int")).alias("long"))
    weights = materialize(weights, "near-weights")
    often = weights.where("true" if exact else "long * 8 > kept").select("id")
    long = members.where(F.col("members") > hot).join(often, "id", "left_semi")
    completed = members.where(F.col("members") <= hot).unionByName(long).select("id", "value")

    leader = F.min(F.struct((-F.round("weight", 6)).alias("order"), "id", "n")).alias("leader")
    met = materialize(members.join(weights.select("id", "weight"), "id").select("value", "id", "n", "weight"), "near-met")
    leaders = materialize(met.groupBy("value").agg(leader), "near-leaders")
    alike = F.least("n", "leader.n") * 100 >= F.greatest("n", "leader.n") * threshold
    star = met.join(leaders, "value").where("id <> leader.id").where(alike).select(
        F.least("id", "leader.id").alias("a"), F.greatest("id", "leader.id").alias("b"))
    star = materialize(star.distinct(), "near-star")
    links = _proven(star, classes, rows, size, threshold, k, "near-star")
    parts = components(links, "a", "b").withColumnRenamed("node", "id")

    rest = completed.join(parts, "id", "left").join(brief, "id").select("id", "value", "n", "listed", F.coalesce("component", "id").alias("part"))
    ends = materialize(_several(materialize(rest, "near-rest"), "near-sizes"), "near-ends")
    family = (ends.where(F.col("size") > hot).select("id", "value").join(leaders, "value")
              .groupBy("id").agg(F.min("leader").alias("leader")).select("id", F.col("leader.id").alias("centre")))
    family = materialize(family, "near-family-ids")
    ids = family.select("id").unionByName(family.select(F.col("centre").alias("id"))).distinct()
    held = materialize(_sets(rows.join(bounded(ids), "id", "left_semi"), size, None).select("id", "vals"), "near-family")
    shared = _bounds(family, held)
    ends = ends.join(shared, "id", "left").withColumn("shared", F.col("n") - F.col("alone")).drop("alone")
    # the bound is on what members of long lists share with each other: rows of short lists stay
    ends = ends.where((F.col("size") <= hot) | (F.col("shared") * 100 >= F.col("n") * threshold))
    ends = _several(materialize(ends.drop("size"), "near-bound"), "near-open-sizes").drop("size")
    # a pair is emitted under the smallest value under which both still take part: not every listed value is one
    taken = materialize(ends.groupBy("id").agg(F.collect_set("value").alias("taken")), "near-taken")
    # members of a list's largest part have no pairs among themselves: all others meet it and each other
    largest = (ends.groupBy("value", "part").agg(F.count("*").alias("count")).groupBy("value")
               .agg(F.max(F.struct("count", "part")).alias("largest")).select("value", F.col("largest.part").alias("main")))
    ends = ends.join(taken, "id").join(materialize(largest, "near-largest"), "value").withColumn("main", F.col("main") == F.col("part"))
    ends = materialize(ends, "near-open")

    columns = ("id", "part", "n", "listed", "taken", "shared", "centre", "inside", "lacks", "beside", "main")
    left, right = (ends.select("value", *[F.col(c).alias(f"{c}_{x}") for c in columns]) for x in "ab")
    need = (F.col("n_a") + F.col("n_b")) * threshold
    reach = F.coalesce(F.least("shared_a", "shared_b") * (100 + threshold) >= need, F.lit(True))
    apart = F.coalesce(F.col("centre_a") != F.col("centre_b"), F.lit(True))
    both = F.col("lacks_a").isNotNull() & F.col("lacks_b").isNotNull()
    middle = F.when(both, F.col("inside_a") - F.size(F.array_except("lacks_b", "lacks_a"))).otherwise(F.least("inside_a", "inside_b"))
    inner = middle + F.size(F.array_intersect("beside_a", "beside_b"))
    known_apart = F.col("shared_a").isNull() | F.col("shared_b").isNull()
    common = F.array_intersect("listed_a", "listed_b")
    pairs = (left.where("NOT main_a").join(right, "value").where("part_a <> part_b AND (main_b OR id_a < id_b)")
             .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold)
             .where(known_apart | reach).where(known_apart | apart | (inner * (100 + threshold) >= need))
             .where(F.size(common) >= F.least(F.lit(meet), F.size("listed_a"), F.size("listed_b")))
             .where(F.array_min(F.array_intersect("taken_a", "taken_b")) == F.col("value"))
             .select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).join(star, ["a", "b"], "left_anti"))
    more = _proven(materialize(pairs, "near-pairs"), classes, rows, size, threshold, k, "near-rest")
    if more.limit(1).count():
        parts = components(links.unionByName(more), "a", "b").withColumnRenamed("node", "id")

    reached = classes.select("id", "mark", "n").join(parts, "id", "left").select(
        "mark", "n", F.coalesce("component", "id").alias("component_id"))
    out = known.select("id", "mark", "n").join(materialize(reached, "near-reached"), ["mark", "n"], "left").select("id", "n", "component_id")
    other = sketches.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component_id"))
    return out.unionByName(other).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with all their columns."""
    gone = materialize(near_duplicates(docs, id_col, text_col).where("NOT kept").select(id_col), "near-gone")
    return drop_ids(docs, gone, id_col)
