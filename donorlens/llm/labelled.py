"""A bounded sample of labelled texts for fitting a model on the driver."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Bytes of text of a label that come to the driver at most.
MAX_BYTES = 16_000_000


def crc_remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def sample_labelled(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, per_class: int, id_col: str = "doc_id",
                    text_col: str = "text", max_bytes: int = MAX_BYTES) -> tuple[list[str], list[int]]:
    """At most ``per_class`` texts and ``max_bytes`` bytes of each label, the first by the MD5 of their id, among the labelled
    ids for which ``learn`` holds. Ids with both labels, without a label or without a row in ``docs`` aren't used; an id
    with several texts gives the least of them. First only ids, labels and sizes are looked at; then the chosen texts are
    read. The order of the result doesn't depend on how the rows lie."""
    marked = labels.where(learn & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("most")).where("label = most").drop("most")
    chosen = None
    for label in (0, 1):
        part = marked.where(F.col("label") == label).orderBy(F.md5(F.col("id").cast("string")), "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sizes = (texts.select("id", F.octet_length("text").alias("size")).join(F.broadcast(chosen), "id")
             .groupBy("id", "label").agg(F.max("size").alias("size")).collect())  # two classes' ids at most
    left, picked = {0: max_bytes, 1: max_bytes}, []
    for r in sorted(sizes, key=lambda r: (hashlib.md5(str(r["id"]).encode()).hexdigest(), r["id"])):
        left[r["label"]] -= r["size"]
        if left[r["label"]] >= 0:
            picked.append((r["id"], r["label"]))
    if not picked:
        return [], []
    spark = docs.sparkSession
    picked = spark.createDataFrame(picked, f"id {dict(texts.dtypes)['id']}, label int")
    rows = texts.join(F.broadcast(picked), "id").groupBy("id", "label").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["id"], r["label"]))
    return [r["text"] for r in rows], [r["label"] for r in rows]


def fit_logistic(x, y, ridge: float = 1e-3, rounds: int = 60) -> tuple[float, float]:
    """Slope and intercept of P(y = 1 | x), by Newton's method with a small ridge on the slope."""
    import numpy as np

    x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
    a = b = 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * x).sum() + ridge * a, (p - y).sum()])
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        size = np.abs(step).max()
        step *= min(1.0, 5.0 / max(size, 1e-12))
        a, b = a - step[0], b - step[1]
        if size < 1e-8:
            break
    return float(a), float(b)
