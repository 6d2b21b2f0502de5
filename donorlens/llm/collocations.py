"""Phrase collocations by stripes: each prefix keys a counter of the words that come next.

Texts are lower-cased (A-Z), cut at punctuation and line ends into pieces and these into words. Stripes are gathered level by
level: the empty prefix's stripe counts single words, a word's stripe the words after it, a pair's the words after the pair.
A task merges the stripes of its texts, a few MB at a time, and hands over each prefix once with its counter; the counters
are merged elementwise across tasks as rows (prefix, next word, count) by sums with partial aggregation, so that the stripe of a
very frequent prefix lies in many tasks. All else is read off this structure: an entry is the count of the phrase
that prefix and word make, a prefix's own count is its entry one level above, its largest entry is the most frequent longer phrase
that begins with it, and the largest entry by last words the most frequent one that ends with them.

A phrase is no more frequent than its parts, so the next level's stripes only take words (pairs) of ``MIN_COUNT`` and more.
Which ones these are is sent to tasks as a table of ``FILTER_BITS`` bits by hash, of the same size whatever the corpus: bits that
two share let a phrase through in vain, none is ever held back, and all counts are by the words themselves.

A phrase of a = f(phrase) occurrences is scored at each place where it can be cut in two, floor(SCALE * a * a / (f(first part) *
f(rest))) in exact decimals, and the lowest score counts (the earliest cut of equals). Phrases that lie in a longer candidate
with at least ``SUBSUME`` per cent of their occurrences are dropped.

Defined cases: a null text is empty and has no words; a null language is ``und``; repeated rows each count; an empty table
gives an empty table; texts are read whole. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from donorlens.llm.common import bounded, ship
from donorlens.llm.shingles import mix, word_hashes
from donorlens.session import materialize

MIN_COUNT = 10
SUBSUME = 50
TOP = 2000
SCALE = 1_000_000
FILTER_BITS = 1 << 26
#: Bytes of text of one language that a task merges at a time, if pieces allow.
CHUNK = 4_000_000
#: Characters that end a piece.
ENDS = ".,;:!?\n\x0b\x0c\r"

_TABLE = bytes.maketrans((string.ascii_uppercase + "\t" + ENDS).encode(), (string.ascii_lowercase + " " + "\n" * len(ENDS)).encode())
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _ODD + mix(b))


def _held(table: np.ndarray, keys: np.ndarray, lang: str) -> np.ndarray:
    slot = mix(keys ^ _seed(lang)) % np.uint64(64 * len(table))
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _chunk_stripes(blob: bytes, lang: str, size: int, table: np.ndarray | None) -> pa.RecordBatch | None:
    """The stripes of prefixes of ``size - 1`` words: a row per prefix with its next words and their counts."""
    data = np.frombuffer(blob, dtype=np.uint8)
    space = np.concatenate(([True], (data == 32) | (data == 10), [True]))
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    words = word_hashes(blob, lower=False)
    if len(words) < size:
        return None
    piece = np.cumsum(data == 10, dtype=np.int32)[starts]
    beside = piece[:-1] == piece[1:]
    if size == 1:
        at, prefix, keys = np.arange(len(words)), np.zeros(len(words), dtype=np.uint64), words
    elif size == 2:
        often = _held(table, words, lang)
        at = np.flatnonzero(beside & often[:-1] & often[1:])
        prefix, keys = words[at], _pair(words[at], words[at + 1])
    else:
        pairs = _pair(words[:-1], words[1:])
        often = beside & _held(table, pairs, lang)
        at = np.flatnonzero(often[:-1] & often[1:])
        prefix, keys = pairs[at], _pair(pairs[at], words[at + 2])
    if not len(at):
        return None
    _, first, counts = np.unique(keys, return_index=True, return_counts=True)
    order = np.argsort(prefix[first], kind="stable")
    first, counts = first[order], counts[order]
    of = prefix[first]
    cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    heads, last = at[first], at[first] + size - 1
    word = lambda i: blob[starts[i]:ends[i]]
    names = [b" ".join(map(word, range(i, i + size - 1))).decode("utf-8", "replace") for i in heads[cuts].tolist()]
    nexts = pa.array([blob[i:j].decode("utf-8", "replace") for i, j in zip(starts[last].tolist(), ends[last].tolist(), strict=True)], pa.string())
    offsets = pa.array(np.r_[cuts, len(first)], pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(cuts), pa.string()), pa.array(names, pa.string()), pa.ListArray.from_arrays(offsets, nexts),
                                       pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))], names=["lang", "prefix", "next", "count"])


def _stripes(size: int, held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if held is None else held.value
        for batch in batches:
            waiting: dict[str, list[bytes]] = {}
            sizes: dict[str, int] = {}
            for i in range(batch.num_rows):
                lang, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if not text:
                    continue
                waiting.setdefault(lang, []).append(text.translate(_TABLE))
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] > CHUNK:
                    yield from _cut(waiting.pop(lang), lang, size, table)
                    sizes[lang] = 0
            for lang, texts in waiting.items():
                yield from _cut(texts, lang, size, table)

    return run


def _cut(texts: list[bytes], lang: str, size: int, table: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Stripes of the texts, those of very long ones cut at the ends of pieces."""
    blob, at = b"\n".join(texts), 0
    while at < len(blob):
        stop = blob.find(b"\n", at + 2 * CHUNK) if len(blob) - at > 2 * CHUNK else -1
        stop = len(blob) if stop < 0 else stop
        if (out := _chunk_stripes(blob[at:stop], lang, size, table)) is not None:
            yield out
        at = stop + 1


def stripes(docs: DataFrame, size: int, held=None, text_col: str = "text", lang_col: str = "lang", least: int = 1) -> DataFrame:
    """(lang, prefix, next, count) of all phrases of ``size`` words that occur ``least`` times, with ``held`` only of those
    whose parts pass its filter. Entries are merged under one short string each: words, a line break, the language."""
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    found = rows.mapInArrow(_stripes(size, held), "lang string, prefix string, next array<string>, count array<long>")
    entries = found.select("lang", "prefix", F.explode(F.arrays_zip("next", "count")).alias("x"))
    entry = F.concat("prefix", F.lit(" "), "x.next", F.lit("\n"), "lang")
    merged = entries.select(entry.alias("entry"), "x.count").groupBy("entry").agg(F.sum("count").alias("count")).where(F.col("count") >= least)
    words = F.substring_index("entry", "\n", 1)
    last = F.substring_index(words, " ", -1)
    prefix = F.expr("substring(substring_index(entry, '\n', 1), 1, length(substring_index(entry, '\n', 1)) - length(substring_index(substring_index(entry, '\n', 1), ' ', -1)) - 1)")
    lang = F.expr("substring(entry, length(substring_index(entry, '\n', 1)) + 2)")
    return merged.select(lang.alias("lang"), prefix.alias("prefix"), last.alias("next"), "count")


def _slots(size: int, bits: int):
    """Over (lang, phrase): the places of the phrases' bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases: dict[str, list[str]] = {}
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                phrases.setdefault(lang, []).append(phrase)
            for lang, those in phrases.items():
                words = word_hashes("\n".join(those).encode(), lower=False)
                keys = words if size == 1 else _pair(words[::2], words[1::2])
                slot = mix(keys ^ _seed(lang)) % np.uint64(bits)
                bit = (np.uint64(1) << (slot & np.uint64(63))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array(bit)], names=["at", "bit"])

    return run


def bit_filter(phrases: DataFrame, size: int, bits: int = FILTER_BITS):
    """A broadcast table of ``bits`` bits with those of the phrases (lang, phrase) set; at most ``bits / 64`` numbers come to
    the driver."""
    places = phrases.select("lang", "phrase").mapInArrow(_slots(size, bits), "at long, bit long")
    table = np.zeros(bits // 64, dtype=np.uint64)
    found = places.groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    table[found.column("at").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(table)


def _score(left: str, right: str) -> Column:
    wide = lambda c: f"CAST({c} AS DECIMAL(15,0))"
    return F.expr(f"({wide('a')} * {wide('a')} * {SCALE}) div ({wide(left)} * {wide(right)})")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 subsume: int = SUBSUME, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases of two or three words: lang, rank, phrase, a, l, r (the counts of the phrase and of its
    two parts), n (all words) and score, by score and a descending and phrase ascending."""
    level = lambda size, held: stripes(docs, size, held, text_col, lang_col, 1 if size == 1 else min_count)
    single = materialize(level(1, None).select("lang", F.col("next").alias("w1"), F.col("count").alias("f")), "word-counts")
    totals = F.broadcast(single.groupBy("lang").agg(F.sum("f").alias("n")))  # a row per language
    frequent = materialize(single.where(F.col("f") >= min_count), "frequent-words")
    held = bit_filter(frequent.select("lang", F.col("w1").alias("phrase")), 1)
    pairs = level(2, held)
    pairs = materialize(pairs.select("lang", F.col("prefix").alias("w1"), F.col("next").alias("w2"), F.col("count").alias("a")), "frequent-pairs")
    held.unpersist()
    held = bit_filter(pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase")), 2)
    triples = level(3, held)
    first_two = F.split("prefix", " ")
    triples = materialize(triples.select("lang", first_two[0].alias("w1"), first_two[1].alias("w2"), F.col("next").alias("w3"), F.col("count").alias("a")), "frequent-triples")
    held.unpersist()

    often = bounded(frequent)
    word = lambda w, f: often.select("lang", F.col("w1").alias(w), F.col("f").alias(f))
    pair = lambda a, b, f: bounded(pairs.select("lang", F.col("w1").alias(a), F.col("w2").alias(b), F.col("a").alias(f)))
    longer = triples.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    before = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("before"))
    maxima = materialize(longer.join(before, ["lang", "w1", "w2"], "full"), "stripe-maxima")
    longest = F.greatest("longer", "before")
    free = pairs.join(bounded(maxima), ["lang", "w1", "w2"], "left").where(longest.isNull() | (100 * longest < subsume * F.col("a")))
    two = free.join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("l", "r").alias("score"))
    three = (triples.join(word("w1", "l1"), ["lang", "w1"]).join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"])
             .join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(word("w3", "r2"), ["lang", "w3"])
             .withColumn("s1", _score("l1", "r1")).withColumn("s2", _score("l2", "r2")))
    first = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                         F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    scored = two.unionByName(three).withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    sliced = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order)))
    ranked = sliced.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
