"""Helpers that several operators share: text normalisation, size-checked broadcasts, filtering a wide table by a
narrow decision table, and connected components.
"""

from __future__ import annotations

import string
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from donorlens.session import materialize

#: A table of at most this many narrow rows may be broadcast (about 100 MB as a hash relation); a larger one is
#: joined by shuffling. Both ways give the same rows.
BROADCAST_ROWS = 1_000_000

WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's modules to the executors, once per application, so that Python tasks find them wherever the
    driver was started."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="donorlens-code-")) / "donorlens_code.zip"
        with zipfile.ZipFile(path, "w") as code:
            for module in sorted(root.rglob("*.py")):
                code.write(module, module.relative_to(root.parent))
        context.addPyFile(str(path))
        _SHIPPED.add(context.applicationId)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, with as many underscores before it as make it differ from the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def whole_text(col: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to hold at most ``limit`` rows, else as it is. ``df`` should be a
    written table or a cheap aggregate, as counting runs it."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def narrow(df: DataFrame, array_col: str, rows: int = BROADCAST_ROWS, values: int = 4 * BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it holds at most ``rows`` rows and ``values`` array elements, else as it is."""
    count, held = df.agg(F.count("*"), F.sum(F.size(array_col))).first()
    return F.broadcast(df) if count <= rows and (held or 0) <= values else df


def drop_ids(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is not among ``ids`` (one narrow column of the same name). Rows with a null id
    stay. The texts move between executors only when the ids are too many to broadcast."""
    return docs.join(bounded(ids.distinct()), id_col, "left_anti")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written first: Spark splits a hub in a join of written tables, but not beside an aggregate of the same stage
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "large-star")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "small-star")
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of the links ``(a, b)``: a row (node, component) per node that has a link, component being
    its smallest reachable node. Rounds of large star and small star, each written to the shared folder; the driver
    only sees a count and a checksum of each round. Null ends and self-links are ignored."""
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    seen = None
    while True:
        larger = materialize(_large_star(edges).distinct(), "large-edges")
        edges = materialize(_small_star(larger).where("u <> v").distinct(), "components")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = mark
