"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary file.

A text is split by the tokenizer's pattern and each match is encoded separately. Tier one: a minimal perfect hash over
the vocabulary tells a whole pre-token that is a token itself. Tier two, for the misses: the pre-token's bytes are
nodes of a linked list, and a heap gives the adjacent pair of the lowest rank (the leftmost of equals) to merge next.

The vocabulary is read once by the driver, from a path that is a parameter, and broadcast; its size is that of the file.
Each task remembers the latest strings, at most ``REMEMBER`` of them with ``LENGTH`` times as many bytes. Texts are read
whole, at most ``chunk`` bytes of them or one text at a time, so long texts don't pile up.

Defined cases: a null text counts as the empty text, which has no ids and decodes to no bytes; special tokens are
ordinary text; letters and numbers are those of the matcher's Unicode version; rows come back one by one whatever their ids; an empty table gives an empty table. The input's other
columns are passed through.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlens.llm.common import fresh, ship

REMEMBER = 300_000
#: Bytes of the texts that are encoded together.
CHUNK = 4_000_000
#: Ids that are decoded together.
DECODED = 250_000
#: Bytes remembered per string of the limit, on average.
LENGTH = 24
#: Displacements tried at once.
TRIES = 64


class PerfectHash:
    """A minimal perfect hash of n byte strings: each falls in one of n slots. Keys are dealt to buckets by one hash;
    buckets, the fullest first, try displacements until all their keys fall in free slots. A bucket of one key names
    its slot directly."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 2)
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
        if len(np.unique(hashes)) != n:
            raise ValueError("the keys aren't distinct")
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        free = np.ones(n, dtype=bool)
        self.slot_key = np.zeros(n, dtype=np.int64)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        groups = sorted(np.split(order, cuts), key=len, reverse=True) if n else []
        rest = [g for g in groups if len(g) == 1]
        for group in groups[:len(groups) - len(rest)]:
            tries = np.arange(TRIES, dtype=np.uint64)[:, None]
            while True:
                slots = self._slot(hashes[group][None, :], tries)
                fits = free[slots].all(axis=1)
                fits[fits] = (np.diff(np.sort(slots[fits], axis=1), axis=1) > 0).all(axis=1)
                if fits.any():
                    break
                tries = tries + np.uint64(TRIES)
            first = int(np.argmax(fits))
            free[slots[first]] = False
            self.slot_key[slots[first]] = group
            self.shift[bucket[group[0]]] = int(tries[first, 0])
        for group, slot in zip(rest, np.flatnonzero(free), strict=True):
            self.slot_key[slot] = group[0]
            self.shift[bucket[group[0]]] = -slot - 1

    def _slot(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        x = hashes ^ (shift.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(self.n)).astype(np.int64)

    def keys_at(self, keys: list[bytes]) -> np.ndarray:
        """For each key, the number of the only stored key that it can be."""
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
        shift = self.shift[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        return self.slot_key[np.where(shift < 0, -shift - 1, self._slot(hashes, np.maximum(shift, 0)))]


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Vocabulary:
    """Ranks of byte strings; a token's rank is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.keys = list(ranks)
        self.ids = [array("i", [i]).tobytes() for i in ranks.values()]
        self.hash = PerfectHash(self.keys)
        self.mark = xxhash.xxh3_128_hexdigest(b" ".join(self.keys) + b"".join(self.ids))
        #: left id << 32 | right id: the token that the two make
        self.pairs = {ranks[a] << 32 | ranks[b]: i for token, i in ranks.items() for k in range(1, len(token))
                      if (a := token[:k]) in ranks and (b := token[k:]) in ranks}
        self.byte_ids = [ranks.get(bytes([b]), -1) for b in range(256)]

    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token, as 32-bit integers."""
        if not pieces:
            return []
        return [self.ids[at] if self.keys[at] == piece else array("i", self.merge(piece)).tobytes()
                for piece, at in zip(pieces, self.hash.keys_at(pieces).tolist(), strict=True)]

    def merge(self, piece: bytes) -> list[int]:
        get, push, pop, n = self.pairs.get, heapq.heappush, heapq.heappop, len(piece)
        ids = [self.byte_ids[b] for b in piece]  # of the token that begins at a node; None once it is part of another
        after, before = list(range(1, n + 1)), list(range(-1, n))  # the nodes beside a node
        rank = [get(a << 32 | b) for a, b in zip(ids, ids[1:])]  # of the pair that begins at a node; None: no token
        rank.append(None)
        heap = [r << 32 | i for i, r in enumerate(rank) if r is not None]
        heapq.heapify(heap)
        while heap:
            least = pop(heap)
            i = least & 0xFFFFFFFF
            merged = least >> 32
            if rank[i] != merged:
                continue  # the pair has changed since
            gone = after[i]
            stop = after[i] = after[gone]
            ids[i], ids[gone], rank[gone] = merged, None, None
            if stop < n:
                before[stop] = i
                rank[i] = r = get(merged << 32 | ids[stop])
                if r is not None:
                    push(heap, r << 32 | i)
            else:
                rank[i] = None
            if (p := before[i]) >= 0:
                rank[p] = r = get(ids[p] << 32 | merged)
                if r is not None:
                    push(heap, r << 32 | p)
        return [i for i in ids if i is not None]


def _gather(flat: np.ndarray, sizes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` of these sizes and starts, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    at = np.arange(total, dtype=kind)
    at += np.repeat((start - ends + sizes).astype(kind), sizes)
    return flat[at]


class _Memory:
    """Ids by recent string: at most ``limit`` strings with ``LENGTH`` times as many bytes, those of the latest calls;
    ``make`` gives the ids of unknown ones and how many each has. Held in Arrow and numpy, not as an object a string."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.strings = make, limit, pa.array([], pa.string())
        self.flat, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def ids(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct strings, one string's after the other's, and how many each has."""
        at = pc.index_in(strings, value_set=self.strings)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        at = at.fill_null(0).to_numpy().astype(np.int64)
        made, made_sizes = self.make(strings.filter(pa.array(~known)))
        held = len(self.strings)
        at[~known] = held + np.arange(len(made_sizes))
        flat, sizes = np.concatenate([self.flat, made]), np.concatenate([self.sizes, made_sizes])
        start = np.cumsum(sizes) - sizes
        unused = np.ones(held, dtype=bool)
        unused[at[known]] = False
        # the strings of this call, then earlier ones, the latest first
        order = np.concatenate([at, np.flatnonzero(unused)])
        names = pa.concat_arrays([strings, self.strings.filter(pa.array(unused))])
        lengths = np.cumsum(pc.binary_length(names).to_numpy())
        kept = min(self.limit, int(np.searchsorted(lengths, LENGTH * self.limit, side="right")))
        self.strings = names.take(pa.array(np.arange(min(kept, len(names)))))
        order = order[:kept]
        self.flat, self.sizes = _gather(flat, sizes[order], start[order]), sizes[order]
        return _gather(flat, sizes[at], start[at]), sizes[at]


def _distinct(strings: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct strings, and for each string which it is."""
    found = strings.dictionary_encode()
    return found.dictionary, found.indices.to_numpy()


class Encoder:
    """Encodes texts. With ``spaced``, stretches between single spaces are remembered with the ids of all their
    pre-tokens; that holds for patterns of which no match goes on from another character to a space. The distinct
    stretches and pre-tokens of some texts are looked up together."""

    last = None

    def __init__(self, vocabulary: Vocabulary, pattern: str, remember: int = REMEMBER, spaced: bool = True):
        self.find, self.spaced, self.vocabulary = regex.compile(pattern).findall, spaced, vocabulary
        self.pieces = _Memory(self._encode, remember)
        self.stretches = _Memory(self._many, remember // 2)

    @classmethod
    def shared(cls, held, mark: str, *args) -> Encoder:
        """One encoder for all tasks of a Python worker, so that a task goes on with what the last one remembers. The broadcast
        vocabulary is only read if that encoder has another one, by its mark: a worker never holds two."""
        if cls.last is None or cls.last[0] != (mark, *args):
            cls.last = None
            cls.last = (mark, *args), cls(held.value, *args)
        return cls.last[1]

    @classmethod
    def forget(cls) -> None:
        """Frees the encoder of a worker that now does other work; Spark gives idle workers to any task."""
        cls.last = None
        pa.default_memory_pool().release_unused()

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = self.vocabulary.encode_many(pieces.cast(pa.binary()).to_pylist())
        return np.frombuffer(b"".join(ids), dtype=np.int32), np.fromiter(map(len, ids), np.int64, len(ids)) // 4

    def _pieces(self, pieces: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of strings that have so many pre-tokens each, and how many ids each has."""
        distinct, at = _distinct(pa.array(pieces, pa.string()))
        flat, sizes = self.pieces.ids(distinct)
        ends = np.concatenate([[0], np.cumsum(sizes[at])])
        cuts = np.concatenate([[0], np.cumsum(counts)])
        return _gather(flat, sizes[at], (np.cumsum(sizes) - sizes)[at]), np.diff(ends[cuts])

    def _plain(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = list(map(self.find, strings))
        return self._pieces([x for pieces in found for x in pieces], np.fromiter(map(len, found), np.int64, len(found)))

    def _many(self, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches with a space before them; none for those that are empty or have white space at an end."""
        strings = stretches.to_pylist()
        fit = np.fromiter([x != "" and not (x[0].isspace() or x[-1].isspace()) for x in strings], bool, len(strings))
        good = strings if fit.all() else [x for x, f in zip(strings, fit.tolist(), strict=True) if f]
        pieces = self.find(" " + " ".join(good)) if good else []
        first = np.flatnonzero(np.fromiter([x[:1] == " " for x in pieces], bool, len(pieces)))
        if len(first) == len(good):  # a pre-token that begins with a space begins a stretch
            flat, some = self._pieces(pieces, np.diff(np.append(first, len(pieces))))
        else:
            flat, some = self._plain([" " + x for x in good])
        sizes = np.zeros(len(strings), dtype=np.int64)
        sizes[fit] = some
        return flat, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts (no nulls), as 32-bit integers one text's after the other's, and how many each text has."""
        if not self.spaced or not len(texts):
            return self._plain(texts.to_pylist())
        split = pc.split_pattern(texts, " ")
        words, counts = split.flatten(), pc.list_value_length(split).to_numpy().astype(np.int64)
        first = np.cumsum(counts) - counts
        last = first + counts - 1
        inner = np.ones(len(words), dtype=bool)
        inner[first] = inner[last] = False
        distinct, at = _distinct(words.filter(pa.array(inner)))
        flat, sizes = self.stretches.ids(distinct)
        of = np.repeat(np.arange(len(texts)), counts)[inner]
        whole = counts < 3
        whole[of[sizes[at] == 0]] = True  # white space runs on over a space
        heads, tails = words.take(pa.array(first)).to_pylist(), words.take(pa.array(last)).to_pylist()
        plain = []  # of a text: its first and its last word, or all of it and nothing
        for i, (head, tail) in enumerate(zip(heads, tails, strict=True)):
            if whole[i] or head[-1:].isspace() or not tail or tail[0].isspace():
                whole[i] = True
                plain += texts[i].as_py(), ""
            else:
                plain += head, " " + tail
        ends, ends_sizes = self._plain(plain)
        flat, sizes = np.concatenate([flat, ends]), np.concatenate([sizes, ends_sizes])
        number = np.empty(len(words), dtype=np.int64)
        number[inner] = at
        number[last] = len(distinct) + 1 + 2 * np.arange(len(texts))
        number[first] = len(distinct) + 2 * np.arange(len(texts))
        taken = sizes[number]
        taken[np.flatnonzero(inner)[whole[of]]] = 0
        return _gather(flat, taken, (np.cumsum(sizes) - sizes)[number]), np.add.reduceat(taken, first)


def _parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Rows from one to before another, of at most this size together, or one row."""
    ends, begin = np.cumsum(sizes), 0
    while begin < len(ends):
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] - sizes[begin] + most, side="right")))
        yield begin, end
        begin = end


def some_texts(batch: pa.RecordBatch, chunk: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The rows of a batch, some at a time, and their texts, the last column (null: empty): at most ``chunk`` bytes, or one text."""
    texts = batch.column(batch.num_columns - 1).fill_null("").cast(pa.string())
    for begin, end in _parts(pc.binary_length(texts).to_numpy().astype(np.int64), chunk):
        yield batch.slice(begin, end - begin), texts.slice(begin, end - begin)


def offsets(sizes: np.ndarray, width: int = 1) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes) * width]).astype(np.int32)


def _encoder(held, pattern: str, remember: int, spaced: bool, chunk: int = CHUNK, mark: str | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(held, held.value.mark if mark is None else mark, pattern, remember, spaced)
        for batch in batches:
            for part, texts in some_texts(batch, chunk):
                ids, sizes = encoder.encode(texts)
                column = pa.ListArray.from_arrays(pa.array(offsets(sizes)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], column], names=[*batch.schema.names[:-1], "ids"])

    return run


def _decoder(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Encoder.forget()
        blob, start, length = held.value
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            counts = pc.list_value_length(column).fill_null(0).to_numpy().astype(np.int64)
            for begin, end in _parts(counts, DECODED):  # ids to where their bytes lie, then one gather
                part = column.slice(begin, end - begin)
                ids = part.flatten().to_numpy()
                sizes = length[ids]
                at = offsets(sizes)[offsets(counts[begin:end])]
                texts = pa.Array.from_buffers(pa.binary(), end - begin, [None, pa.py_buffer(at), pa.py_buffer(_gather(blob, sizes, start[ids]))])
                if part.null_count:
                    texts = pc.if_else(part.is_valid(), texts, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*batch.slice(begin, end - begin).columns, texts], names=[*batch.schema.names, "decoded"])

    return run


def _token_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in a row, and by id where a token starts and how long it is."""
    start, length = (np.zeros(max(ranks.values(), default=-1) + 1, dtype=np.int64) for _ in range(2))
    at = 0
    for token, i in ranks.items():
        start[i], length[i] = at, len(token)
        at += len(token)
    return np.frombuffer(b"".join(ranks), dtype=np.uint8), start, length


def _clash(docs: DataFrame, *names: str) -> list[str]:
    return [c for c in docs.columns if c.lower() not in names]


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text", remember: int = REMEMBER,
           spaced: bool = True, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with its text replaced by ``ids`` (array of int; a column of that name is replaced too). ``spaced``: see
    ``Encoder``; turn it off for a pattern that needs it. ``chunk``: bytes of the texts that are encoded together."""
    ship(docs.sparkSession)
    vocabulary = Vocabulary(read_ranks(vocabulary_path))
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    keep = _clash(docs, "ids", text_col.lower())
    given = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).cast("string").alias(fresh("__text", docs.columns)))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return given.mapInArrow(_encoder(held, pattern, remember, spaced, chunk, vocabulary.mark), schema)


def decode(encoded: DataFrame, vocabulary_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids (null ids: null); a column of that name is replaced."""
    ship(encoded.sparkSession)
    held = encoded.sparkSession.sparkContext.broadcast(_token_bytes(read_ranks(vocabulary_path)))
    given = encoded.select(*[F.col(f"`{c}`") for c in _clash(encoded, "decoded", ids_col.lower())], F.col(ids_col))
    return given.mapInArrow(_decoder(held), T.StructType([*given.schema.fields, T.StructField("decoded", T.BinaryType())]))
