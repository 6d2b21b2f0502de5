"""Quality by compression: one zstandard dictionary is built from good and one from bad labelled texts. A text is cut into
blocks, each is compressed with either dictionary, and the difference of the two total sizes over the larger one,
passed through a logistic curve, is its score.

The dictionaries are built on the driver from at most ``PER_CLASS`` labelled texts of each class (a documented bound of the
sample), half of which calibrate the curve; every text is scored whole. The model (two dictionaries of ``DICTIONARY`` bytes
and two numbers) is broadcast.

Defined cases: a null or empty text has the difference 0; rows that repeat an id are scored one by one; without both classes
among the labelled texts the score of each text is the share of good ones (0.5 without any); an empty table gives an
empty table. Other columns play no part.
"""

from __future__ import annotations

import dataclasses
import math

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlens.llm.common import ship
from donorlens.llm.labelled import fit_logistic

PER_CLASS = 4000
BLOCK = 1024
DICTIONARY = 64 * 1024
LEVEL = 3


def blocks(text: bytes) -> list[bytes]:
    return [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)]


def _dictionary(texts: list[bytes]) -> bytes:
    material = [x for t in texts for x in blocks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY, material).as_bytes()
    except zstandard.ZstdError:  # too little material to train on: its bytes are the dictionary
        return b"\n".join(material)[:DICTIONARY]


@dataclasses.dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float

    def __post_init__(self):
        self._made = None

    def __getstate__(self):
        return (self.good, self.bad, self.slope, self.intercept)

    def __setstate__(self, state):
        self.good, self.bad, self.slope, self.intercept = state
        self._made = None

    def _compressors(self):
        if self._made is None:
            self._made = [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(d)).compress
                          for d in (self.good, self.bad)]
        return self._made

    def difference(self, text: bytes) -> float:
        """Below 0 if the bad dictionary suits the text better."""
        if not text or not (self.good and self.bad):
            return 0.0
        with_good, with_bad = self._compressors()
        parts = blocks(text)
        good, bad = sum(len(with_good(x)) for x in parts), sum(len(with_bad(x)) for x in parts)
        return (bad - good) / max(good, bad)

    def score(self, text: bytes) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * self.difference(text) + self.intercept))))


def fit(texts: list[str], labels: list[int]) -> CompressionModel:
    """Label 1: good. Of each class, every other text makes the dictionary and the rest calibrate the curve."""
    good, bad = ([t.encode() for t, y in zip(texts, labels, strict=True) if y == c] for c in (1, 0))
    if not good or not bad:
        p = 0.5 if not labels else min(0.999, max(0.001, len(good) / len(labels)))
        return CompressionModel(b"", b"", 0.0, math.log(p / (1 - p)))
    model = CompressionModel(_dictionary(good[::2]), _dictionary(bad[::2]), 0.0, 0.0)
    rest = [(model.difference(t), y) for part, y in ((good, 1), (bad, 0)) for t in part[1::2] or part]
    model.slope, model.intercept = fit_logistic([x for x, _ in rest], [y for _, y in rest])
    return model


def score_quality(docs: DataFrame, model: CompressionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, difference and score (0 to 1, higher: better)."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = held.value
        for batch in batches:
            difference = [fitted.difference(t.as_py() or b"") for t in batch.column(1)]
            score = [1 / (1 + math.exp(-max(-30.0, min(30.0, fitted.slope * x + fitted.intercept)))) for x in difference]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(difference, pa.float64()), pa.array(score, pa.float64())],
                                             names=["id", "difference", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, difference double, score double").withColumnRenamed("id", id_col)
