"""Quality rules: word and repetition rules on each text, then cross-document line frequency.

Base rules: under ``MIN_WORDS`` words, or over 20 % of the words in repeated 5-word windows. Line rule: each
\\n-split line is normalised (A-Z lower-cased, white space runs as one space) and hashed; per host (source), the distinct
documents that hold the line are counted. Lines above ``MAX_DOCS`` documents of a host are removed from its documents;
a document left with under ``MIN_SHARE`` per cent of its words is depleted and rejected.

Documents are told apart by a hash of their whole set of normalised lines with a word: copies (also with lines repeated
or in another order) count once, so a document copied a thousand times doesn't make its lines frequent, and every other
document counts in full, however many lines it shares. A near copy with a line of its own is a document of its own; over
``MAX_DOCS`` of them in a host make their common lines frequent. The limit alone decides. The counts are sums with partial
aggregation by (host, line, document) and (host, line).

Defined cases: a null text has no words (and fails); lines without a word are never counted or removed; a null source
is a host of its own; a row that repeats an id is judged as a row of its own; an empty table gives an empty table.
Texts are read whole. Other columns play no part.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorlens.llm.common import bounded, narrow, ship
from donorlens.llm.shingles import window_hashes, word_hashes
from donorlens.session import materialize

MIN_WORDS = 10
MAX_REPEAT_PCT = 20
MAX_DOCS = 30
MIN_SHARE = 30
#: Lines held by a task before they go out.
FLUSH = 500_000

_SYMBOLS = re.compile(rb"[#*$%&|<>]")


def repeat_words(words: np.ndarray, size: int = 5) -> int:
    """How many words lie in a window of ``size`` words that is found twice or more, the first one included."""
    if len(words) < size:
        return 0
    _, back, counts = np.unique(window_hashes(words, size), return_inverse=True, return_counts=True)
    often = np.flatnonzero(counts[back] > 1)
    if not len(often):
        return 0
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, often, 1)
    np.add.at(edge, often + size, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def measure(text: bytes) -> tuple:
    """Counts of one text, and the hash and word count of each of its lines (0 words: a blank line)."""
    words = word_hashes(text, lower=False)
    inner = text.translate(None, b" \t\n\x0b\x0c\r")
    points = int(np.count_nonzero((np.frombuffer(inner, np.uint8) & 0xC0) != 0x80))
    seen, dup, hashes, sizes = set(), 0, array("q"), array("i")
    for line in text.split(b"\n"):
        parts = line.split()
        sizes.append(len(parts))
        if parts:
            mark = xxhash.xxh3_128_digest(line)
            dup += mark in seen
            seen.add(mark)
        hashes.append(xxhash.xxh3_64_intdigest(b" ".join(parts).lower()) >> 1)
    return (len(words), points, len(_SYMBOLS.findall(text)), dup, repeat_words(words)), hashes, sizes


_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _measure_batches(batches):
    """Rows go out after ``FLUSH`` lines, so that a batch of long texts doesn't pile up."""
    for batch in batches:
        texts, first, counts, at = batch.column(batch.num_columns - 1), 0, [], [0]
        hashes, sizes = array("q"), array("i")
        for i in range(batch.num_rows):
            found, lines, words = measure(texts[i].as_py() or b"")
            counts.append(found)
            hashes.extend(lines)
            sizes.extend(words)
            at.append(len(hashes))
            if len(hashes) > FLUSH or i == batch.num_rows - 1:
                part = batch.slice(first, i + 1 - first)
                arrays = [*part.columns[:-1], *(pa.array([x[k] for x in counts], pa.int64()) for k in range(len(_FIELDS)))]
                ends = pa.array(at, pa.int32())
                arrays += [pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(hashes, np.int64))),
                           pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(sizes, np.int32)))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], *_FIELDS, "lines", "sizes"])
                first, counts, at = i + 1, [], [0]
                hashes, sizes = array("q"), array("i")


def _mark(text_col: str) -> Column:
    """Tells rows with one id but different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          max_docs: int = MAX_DOCS, min_share: int = MIN_SHARE) -> DataFrame:
    """One row per row of ``docs``: id, the five counts, base_failed, removed_words, removed_lines (positions of the lines
    above the limit, from 0) and kept."""
    out = _judged(docs, id_col, text_col, host_col, max_docs, min_share).drop("host", "mark")
    return out.withColumnRenamed("id", id_col)


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str, max_docs: int, min_share: int) -> DataFrame:
    """The columns of ``judge``, the id as ``id``, with the row's host and a hash of its text."""
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
                       _mark(text_col).alias("mark"), F.col(text_col).cast("binary").alias("text"))
    counts = ", ".join(f"{x} long" for x in _FIELDS)
    stats = rows.mapInArrow(_measure_batches, f"id {kind}, host string, mark long, {counts}, lines array<long>, sizes array<int>")
    stats = materialize(stats.withColumn("row", F.monotonically_increasing_id()), "quality-stats")

    worded = F.expr("array_sort(array_distinct(transform(filter(arrays_zip(lines, sizes), x -> x.sizes > 0), x -> x.lines)))")
    own = stats.select("host", worded.alias("own"))
    held = own.select("host", F.xxhash64("own").alias("document"), F.explode("own").alias("line"))
    above = (held.distinct().groupBy("host", "line").agg(F.count("*").alias("documents"))
             .where(F.col("documents") > max_docs).select("host", "line"))
    above = bounded(materialize(above, "quality-lines"))
    lines = stats.select("row", "host", F.explode(F.arrays_zip("lines", "sizes", F.expr("sequence(0, size(lines) - 1)").alias("at"))).alias("x"))
    lines = lines.select("row", "host", F.col("x.lines").alias("line"), F.col("x.sizes").alias("words"), F.col("x.at").alias("at"))
    gone = (lines.where("words > 0").join(above, ["host", "line"], "left_semi").groupBy("row")
            .agg(F.sum("words").alias("removed_words"), F.sort_array(F.collect_list("at")).alias("removed_lines")))
    out = stats.join(gone, "row", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    depleted = 100 * (F.col("n_words") - F.col("removed_words")) < min_share * F.col("n_words")
    return out.select("id", "host", "mark", *_FIELDS, failed.alias("base_failed"), "removed_words", "removed_lines",
                      (~failed & ~depleted).alias("kept"))


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` without the rejected documents and without the lines above the limit, with all columns; the length column
    of a text that lost lines is counted anew. Each row has its own verdict, also rows that share an id or have none."""
    verdicts = _judged(docs, id_col, text_col, host_col, MAX_DOCS, MIN_SHARE).where(~F.col("kept") | (F.col("removed_words") > 0))
    verdicts = verdicts.select(F.col("id").alias("__id"), F.col("host").alias("__host"), F.col("mark").alias("__mark"), F.col("kept").alias("__kept"),
                               F.col("removed_lines").alias("__lines")).dropDuplicates(["__id", "__host", "__mark"])
    verdicts = narrow(materialize(verdicts, "quality-verdicts"), "__lines")
    left = F.concat_ws("\n", F.filter(F.split(F.col(text_col), "\n", -1), lambda _, i: ~F.array_contains("__lines", i)))
    same = (F.col(id_col).eqNullSafe(F.col("__id")) & (F.coalesce(F.col(host_col).cast("string"), F.lit("")) == F.col("__host"))
            & (_mark(text_col) == F.col("__mark")))
    out = docs.join(verdicts, same, "left").where("__kept IS NULL OR __kept")
    changed = F.col("__lines").isNotNull()
    out = out.withColumn(text_col, F.when(changed, left).otherwise(F.col(text_col)))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(changed, F.length(text_col)).otherwise(F.col(length_col)).cast(dict(docs.dtypes)[length_col]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
