"""Toxicity by a subsequence string kernel and a support vector machine on Nyström landmarks.

Two machines read a text's sentences: one their words as strings of letters, one the sentences as strings of words. A word's
features are all subsequences of three letters, contiguous or not,
that span at most ``SPAN`` characters, weighted by ``DECAY`` per character skipped; characters other than letters are gaps.
The kernel of two words is the cosine of these features by place, so that ``l.o-ser`` or ``losser`` stay close to ``loser``.
A run of single letters between spaces is one word too.

Learning (on the driver, from at most ``PER_CLASS`` labelled texts of each class, a documented bound of the sample): the
sentences of clean texts are clean. A word is evidence if its share among toxic texts is
``LIFT`` times that among clean ones and no chance finding (likelihood ratio statistic of ``SURPRISE``, for up to millions
of words); a toxic text's sentence is toxic if it holds evidence, and its other
sentences are left out. Each toxic sentence stands for its evidence words, also with gaps and inserted characters; clean
sentences for their words, those most like toxic ones in several rounds. A linear machine (squared hinge loss) is fitted on the kernels with ``LANDMARKS`` words, whitened
by the landmarks' own kernel matrix. As kernel values are sums over subsequences, the fitted machine is one weight per
subsequence, which is what tasks look up: the same value without a pass over the landmarks.

Toxic texts that no word gives away teach the second machine. Its kernel is that of sentences as strings of words: the
subsequences of two words at most ``REACH`` apart, weighted by ``DECAY`` per word between, so that insults made of harmless
words are told by their order. Evidence is found among pairs as among words; a sentence that holds some is toxic, all
sentences of clean texts (``CLEAN_SENTENCES`` of them at most) are clean.

A sentence's margin is the larger of its worst word's and its own, a text's that of its worst sentence; a logistic curve makes it the
score. Every text is read whole; words of over ``LONG`` characters are scored in overlapping pieces. Tasks remember the margins
of recent words in two generations of at most ``REMEMBER``.

Defined cases: a null, empty or wordless text has the margin of a word without features; rows that repeat an id are scored
one by one; without both classes every score is the share of toxic texts (0 without any); an empty table gives an empty
table. Other columns play no part.
"""

from __future__ import annotations

import dataclasses
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlens.llm.common import ship
from donorlens.llm.labelled import fit_logistic
from donorlens.llm.shingles import mix, shingle_set, word_hashes

PER_CLASS = 3000
SPAN = 7
DECAY = 0.5
SURPRISE = 30.0
LIFT = 20.0
LANDMARKS = 400
ROUNDS = 3
HARD = 1500
LONG = 32
REMEMBER = 300_000
CODES = 64
#: Words that take part in the fit: toxic ones, the most frequent clean ones, a sample of the other clean ones; and how many
#: of the toxic ones also appear disguised.
TOXIC_WORDS, COMMON_WORDS, OTHER_WORDS, DISGUISED_WORDS = 1500, 2000, 6000, 400
#: Words between the two of a pair at most, less one; words of a sentence.
REACH, STRETCH = 3, 32
PAIR_SURPRISE = 40.0
#: Clean sentences that take part in the fit.
CLEAN_SENTENCES = 6000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STOP = b"\x03"
_STOP_HASH = word_hashes(_STOP, lower=False)[0]
#: Ends of sentences become a word of their own; other ASCII marks but those within words are blanks.
_ENDS = bytes(3 if chr(b) in ".!?\n" else 32 if chr(b) in ",;:()[]{}\"" else b for b in range(256))

_MARKS = ".,;:!?"
_SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)|\n")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_]\s){3,}[^\W\d_](?!\S)")
#: Stands before a word and counts as a letter, so that a beginning differs from the same letters further on.
START = "\x02"
_STEPS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]


def words_of(text: str) -> set[str]:
    """The distinct lower-cased words without sentence marks at their ends; runs of single letters count as one word besides."""
    text = text.lower()
    found = {w.strip(_MARKS) or w for w in set(text.split())}
    found.update("".join(x.split()) for x in _SPACED.findall(text))
    return found


def _pieces(word: str) -> list[str]:
    word = START + word
    return [word] if len(word) <= LONG else [word[i:i + LONG] for i in range(0, len(word) - LONG // 2, LONG // 2)]


class Features:
    """Three-letter subsequences of words as numbers under ``CODES ** 3``."""

    def __init__(self, letters: str):
        self.letters = {c: i + 1 for i, c in enumerate(START + letters)}

    def codes(self, words: list[str]) -> np.ndarray:
        """A row per word: 0 for a gap and past its end, ``CODES - 1`` for an unlisted letter."""
        out = np.zeros((len(words), max(map(len, words), default=0) + SPAN), dtype=np.int32)
        get = self.letters.get
        for row, word in zip(out, words, strict=True):
            row[:len(word)] = [get(c) or (CODES - 1 if c.isalpha() else 0) for c in word]
        return out

    def each(self, words: list[str]):
        """For each pair of distances: subsequence numbers (0 where there is none) and their weight."""
        codes = self.codes(words)
        n = codes.shape[1] - SPAN
        for i, j in _STEPS:
            a, b, c = codes[:, :n], codes[:, i:n + i], codes[:, j:n + j]
            yield ((a * CODES + b) * CODES + c) * ((a > 0) & (b > 0) & (c > 0)), DECAY ** (j - 2)

    def sums(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        """For each word, the sum of ``weights`` (by subsequence number, the first one 0) over its features of length one.
        Words of about the same length go together."""
        out = np.zeros(len(words))
        order = sorted(range(len(words)), key=lambda k: len(words[k]))
        for first in range(0, len(order), 4096):
            rows = order[first:first + 4096]
            total, norm = np.zeros(len(rows)), np.zeros(len(rows))
            for found, weight in self.each([words[k] for k in rows]):
                total += weight * weights[found].sum(axis=1)
                norm += weight ** 2 * np.count_nonzero(found, axis=1)
            out[rows] = total / np.sqrt(np.maximum(norm, 1e-12))
        return out

    def table(self, words: list[str], used: np.ndarray) -> np.ndarray:
        """The features of each word, of length one: a row per word, a column per subsequence number in ``used`` (sorted)."""
        out, norm = np.zeros((len(words), len(used) + 1), dtype=np.float32), np.zeros(len(words))
        column = np.full(CODES ** 3, len(used))
        column[used] = np.arange(len(used))
        for found, weight in self.each(words):
            rows, at = np.nonzero(found)
            np.add.at(out, (rows, column[found[rows, at]]), weight)
            norm += weight ** 2 * np.count_nonzero(found, axis=1)
        return out[:, :-1] / np.sqrt(np.maximum(norm, 1e-12)).astype(np.float32)[:, None]


@dataclasses.dataclass
class ToxicityModel:
    letters: str
    weights: np.ndarray | None
    bias: float
    slope: float
    intercept: float
    phrases: Phrases | None = None

    def margins(self, words: list[str]) -> np.ndarray:
        if self.weights is None or not words:
            return np.full(len(words), self.bias)
        pieces = [(k, p) for k, w in enumerate(words) for p in _pieces(w)]
        values = Features(self.letters).sums([p for _, p in pieces], self.weights) + self.bias
        out = np.full(len(words), -np.inf)
        np.maximum.at(out, [k for k, _ in pieces], values)
        return out

    def score(self, margin: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * margin + self.intercept))))


def _disguised(word: str, rng: random.Random) -> list[str]:
    """The word with inserted marks, a mark in one place, and a letter written twice."""
    k = rng.randrange(1, len(word))
    mark = rng.choice("-.*_'+")
    return [mark.join(word), word[:k] + mark + word[k:], word[:k] + word[k - 1] + word[k:]]


def _svm(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, rounds: int = 40) -> np.ndarray:
    """Weights (the last one the bias) of a linear machine with squared hinge loss, by Newton's method; both classes
    weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1))])
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = np.zeros(x.shape[1])
    reg = np.full(x.shape[1], ridge)
    reg[-1] = 1e-9
    for _ in range(rounds):
        slack = 1 - y * (x @ w)
        on = slack > 0
        g = reg * w - 2 * x[on].T @ (cost[on] * slack[on] * y[on])
        h = np.diag(reg) + 2 * (x[on] * cost[on][:, None]).T @ x[on]
        step = np.linalg.solve(h + 1e-10 * np.eye(len(w)), g)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def phrase_pairs(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The subsequences of two words of a text's sentences that are at most ``REACH`` words apart: their hashes, weights and
    sentences, and for each sentence where its words begin. Sentences of over ``STRETCH`` words count as several."""
    marked = text.lower().encode().translate(_ENDS).replace(_STOP, b" " + _STOP + b" ")
    words = word_hashes(marked, lower=False)
    stop = words == _STOP_HASH
    sentence = np.cumsum(stop)
    starts = np.flatnonzero(np.r_[True, stop])  # the word after a stop, or a stop itself in an empty sentence
    stretch = (np.arange(len(words)) - starts[sentence]) // STRETCH
    piece = np.cumsum(np.r_[True, (np.diff(sentence) != 0) | (np.diff(stretch) != 0)])[:len(words)] - 1 if len(words) else np.zeros(0, dtype=np.int64)
    pairs, weights, pieces = [], [], []
    for k in range(1, REACH + 1):
        a, b = words[:-k], words[k:]
        at = np.flatnonzero((sentence[:-k] == sentence[k:]) & ~stop[:-k] & ~stop[k:])
        pairs.append(mix(a[at] * _ODD + mix(b[at])))
        weights.append(np.full(len(at), DECAY ** (k - 1)))
        pieces.append(piece[:-k][at])
    first = np.flatnonzero(np.r_[True, np.diff(piece) != 0]) if len(words) else np.zeros(0, dtype=np.int64)
    return np.concatenate(pairs), np.concatenate(weights), np.concatenate(pieces), first


@dataclasses.dataclass
class Phrases:
    """A linear machine over sentences: a weight per subsequence of two words, as kernel values with the landmarks add up to."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def worst(self, text: str) -> tuple[float, str | None]:
        """The margin of the worst sentence, and its words."""
        pairs, weights, pieces, first = phrase_pairs(text)
        if not len(pairs):
            return self.bias, None
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        value = np.where(self.keys[at] == pairs, self.weights[at], 0.0) * weights
        n = len(first)
        margins = np.bincount(pieces, value, n) / np.sqrt(np.maximum(np.bincount(pieces, weights ** 2, n), 1e-12)) + self.bias
        k = int(np.argmax(margins))
        if margins[k] <= 0:
            return float(margins[k]), None
        words = text.lower().encode().translate(_ENDS).replace(_STOP, b" " + _STOP + b" ").split()
        end = first[k + 1] if k + 1 < n else len(words)
        return float(margins[k]), b" ".join(w for w in words[first[k]:end] if w != _STOP).decode("utf-8", "replace")


def fit_phrases(toxic: list[str], clean: list[str], rng: random.Random) -> Phrases | None:
    """The machine over sentences, learned from toxic texts that no word gives away: subsequences of two words are evidence
    by the same test as words, a toxic text's sentences with evidence are toxic, all sentences of clean texts are clean."""
    if not toxic or not clean:
        return None
    found = [[phrase_pairs(t) for t in part] for part in (clean, toxic)]
    (off, n_off), (on, n_on) = (np.unique(np.concatenate([np.unique(p[0]) for p in part]), return_counts=True) for part in found)
    at = np.minimum(np.searchsorted(off, on), max(0, len(off) - 1))
    beside = np.where(off[at] == on, n_off[at], 0) if len(off) else np.zeros(len(on), dtype=np.int64)
    share = len(toxic) / (len(toxic) + len(clean))
    p = n_on / (n_on + beside)
    with np.errstate(divide="ignore", invalid="ignore"):
        surprise = 2 * (n_on * np.log(p / share) + np.where(beside > 0, beside * np.log((1 - p) / (1 - share)), 0.0))
    evidence = on[(p > share) & (n_on * len(clean) >= LIFT * beside * len(toxic)) & (surprise >= PAIR_SURPRISE)]
    if not len(evidence):
        return None
    bad, good = [], []
    for part, out in zip(found, (good, bad), strict=True):
        for pairs, weights, pieces, first in part:
            order = np.argsort(pieces, kind="stable")
            cuts = np.flatnonzero(np.diff(pieces[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                if out is good or np.isin(pairs[rows], evidence).any():
                    out.append((pairs[rows], weights[rows]))
    good = good if len(good) <= CLEAN_SENTENCES else rng.sample(good, CLEAN_SENTENCES)
    marks = rng.sample(bad, min(len(bad), LANDMARKS // 2)) + rng.sample(good, min(len(good), LANDMARKS // 2))
    used = np.unique(np.concatenate([p for p, _ in marks]))

    def table(part: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.zeros((len(part), len(used)), dtype=np.float32)
        for row, (pairs, weights) in zip(out, part, strict=True):
            at = np.minimum(np.searchsorted(used, pairs), len(used) - 1)
            hit = used[at] == pairs
            np.add.at(row, at[hit], weights[hit] / math.sqrt((weights ** 2).sum()))
        return out

    landmarks = table(marks)
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    keep = values > 1e-4 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    kernel = lambda part: np.vstack([table(part[i:i + 500]) @ landmarks.T for i in range(0, len(part), 500)]).astype(np.float64) @ whiten
    w = _svm(np.vstack([kernel(bad), kernel(good)]), np.r_[np.ones(len(bad)), -np.ones(len(good))])
    return Phrases(used, landmarks.T.astype(np.float64) @ (whiten @ w[:-1]), float(w[-1]))


def distinct_texts(texts: list[str], labels: list[int]) -> tuple[list[str], list[int]]:
    """One text of those with the same shingles, so that copies don't count as findings of their own."""
    seen, out = set(), []
    for text, label in zip(texts, labels, strict=True):
        found = shingle_set(text.encode(), 5)
        mark = (label, hashlib.blake2b(found, digest_size=16).digest()) if len(found) else (label, text)
        if mark not in seen:
            seen.add(mark)
            out.append((text, label))
    return [t for t, _ in out], [y for _, y in out]


def fit(texts: list[str], labels: list[int], seed: int = 1) -> ToxicityModel:
    texts, labels = distinct_texts(texts, labels)
    toxic, clean = ([t for t, y in zip(texts, labels, strict=True) if y == c] for c in (1, 0))
    if not toxic or not clean:
        p = min(0.999, max(0.001, len(toxic) / len(labels))) if labels else 0.001
        return ToxicityModel("", None, 0.0, 0.0, math.log(p / (1 - p)))
    rng = random.Random(seed)
    held = [Counter(w for t in part for w in words_of(t)) for part in (clean, toxic)]
    share = len(toxic) / len(labels)

    def surprise(n: int, m: int) -> float:
        """The likelihood ratio statistic of n toxic and m clean texts with a word, 0 if it is rarer in toxic ones."""
        p = n / (n + m)
        return 0.0 if p <= share else 2 * (n * math.log(p / share) + (m and m * math.log((1 - p) / (1 - share))))

    evidence = [w for w, n in held[1].items() if sum(c.isalpha() for c in w) >= 3 and n * len(clean) >= LIFT * held[0][w] * len(toxic)
                and surprise(n, held[0][w]) >= SURPRISE]
    evidence = sorted(evidence, key=lambda w: (-held[1][w], w))
    known = set(evidence)
    if not evidence:
        p, phrases = len(toxic) / len(labels), fit_phrases(toxic, clean, rng)
        model = ToxicityModel("", None, 0.0 if phrases is None else -1.0, 0.0, math.log(p / (1 - p)), phrases)
        return model if phrases is None else _calibrated(model, toxic[::2], clean[::2])
    # sentences with their labels: 1 with evidence, 0 of clean texts
    positive = Counter(w for t in toxic for s in _SENTENCE.split(t) for w in words_of(s) if w in known)
    negative = Counter(w for t in clean for s in _SENTENCE.split(t) for w in words_of(s))
    positive = [w for w, _ in positive.most_common(TOXIC_WORDS)] or evidence[:TOXIC_WORDS]
    common = [w for w, _ in negative.most_common(COMMON_WORDS)]
    others = sorted(set(negative) - set(common))
    others = rng.sample(others, min(len(others), OTHER_WORDS))
    letters = Counter(c for w, n in negative.items() for c in w * min(n, 3) if c.isalpha()) + Counter(c for w in positive for c in w if c.isalpha())
    letters = "".join(c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))[:CODES - 3])
    features = Features(letters)
    good = [p for w in common + others for p in _pieces(w)]
    bad = [max(_pieces(x), key=len) for k, w in enumerate(positive) for x in (w, *(_disguised(w, rng) if k < DISGUISED_WORDS else ()))]
    marks = positive[:LANDMARKS * 5 // 8]
    marks = [_pieces(w)[0] for w in marks + rng.sample(common + others, min(len(common + others), LANDMARKS - len(marks)))]
    used = np.unique(np.concatenate([found.ravel() for found, _ in features.each(marks)]))
    used = used[used > 0]
    landmarks = features.table(marks, used)
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    keep = values > 1e-4 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])

    def kernel(words: list[str]) -> np.ndarray:
        return np.vstack([features.table(words[i:i + 1000], used) @ landmarks.T for i in range(0, len(words), 1000)]).astype(np.float64) @ whiten

    on, off = kernel(bad), kernel(good)
    every = sorted(negative)
    for _ in range(ROUNDS):
        w = _svm(np.vstack([on, off]), np.r_[np.ones(len(on)), -np.ones(len(off))])
        weights = np.zeros(CODES ** 3)
        weights[used] = landmarks.T @ (whiten @ w[:-1])
        model = ToxicityModel(letters, weights, float(w[-1]), 1.0, 0.0)
        # the clean words most like toxic ones join the next round
        margins = model.margins(every)
        near = [every[k] for k in np.argsort(-margins)[:HARD]]
        off = np.vstack([off, kernel([max(_pieces(x), key=lambda p: features.sums([p], weights)[0]) if len(x) >= LONG else _pieces(x)[0] for x in near])])
    missed = [t for t in toxic if model.margins(sorted(words_of(t))).max(initial=model.bias) <= 0]
    model.phrases = fit_phrases(missed, clean, rng)
    return _calibrated(model, toxic[::2], clean[::2])  # every other text of a class calibrates the curve


def _calibrated(model: ToxicityModel, toxic: list[str], clean: list[str]) -> ToxicityModel:
    texts, labels = toxic + clean, [1] * len(toxic) + [0] * len(clean)
    sets = [words_of(t) for t in texts]
    every = sorted(set().union(*sets))
    memory = dict(zip(every, model.margins(every).tolist(), strict=True))
    worst = [max((memory[x] for x in s), default=model.bias) for s in sets]
    if model.phrases is not None:
        worst = [max(m, model.phrases.worst(t)[0]) for m, t in zip(worst, texts, strict=True)]
    model.slope, model.intercept = fit_logistic(worst, labels, ridge=0.05)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
                   remember: int = REMEMBER) -> DataFrame:
    """One row per row of ``docs``: id, margin, score (0 to 1, higher: toxic) and worst, the word or sentence of the
    highest margin."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted, new, old = held.value, {}, {}
        for batch in batches:
            margins, worst = [], []
            for first in range(0, batch.num_rows, 500):
                texts = [t.as_py() or "" for t in batch.column(1).slice(first, 500)]
                sets = [words_of(t) for t in texts]
                words = set().union(*sets)
                if len(new) + len(words) > remember:
                    old, new = new, {}
                new.update((w, old[w]) for w in words if w in old and w not in new)
                unknown = [w for w in words if w not in new]
                new.update(zip(unknown, fitted.margins(unknown).tolist(), strict=True))
                for text, s in zip(texts, sets, strict=True):
                    word = max(s, key=new.__getitem__, default=None)
                    if word is not None:
                        word = min(w for w in s if new[w] == new[word])
                    margin = fitted.bias if word is None else new[word]
                    if fitted.phrases is not None:
                        other, sentence = fitted.phrases.worst(text)
                        if other > margin:
                            margin, word = other, sentence or word
                    worst.append(word)
                    margins.append(margin)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(margins, pa.float64()),
                                              pa.array([fitted.score(m) for m in margins], pa.float64()), pa.array(worst, pa.string())],
                                             names=["id", "margin", "score", "worst"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, margin double, score double, worst string").withColumnRenamed("id", id_col)
