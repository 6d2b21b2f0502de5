"""Byte-level BPE by the merges of a tokenizer's JSON file: distinct words are encoded together, in a trie.

A text is cut at the strings of the file's added tokens, the stretches between by the splitting pattern. The distinct words of
a batch that aren't remembered are inserted into a trie in byte order and the trie is walked depth first, so that only
the path to the current node is held. Each node has a state: the last token of the encoding of the bytes that lead to
it. A node's state comes from its ancestors' states: it is the one token that ends there and may follow the state of the
node where it starts. So a prefix that words share is encoded once, and a word's encoding is read off its path backwards.
The tokens that end at a node are those of an automaton over all tokens (suffix links), found byte by byte.

One token may follow another if encoding their bytes together gives just the two. That is decided by undoing the merges of the
first token's right edge and the second's left edge, the latest first: at no time may the pair across the border have
been the next to merge. It needs merges that each make a token of their own out of earlier ones, as training gives them;
``read_tokenizer`` checks that, and refuses files with parts this operator doesn't know.

The file is read by the driver (its path is a parameter) and what is built of it broadcast, its size that of the
vocabulary. A task remembers words within the limits of ``bpe.Encoder``; texts are read whole, some at a time.

Defined cases: a null text counts as the empty text, which has no ids and decodes to the empty text; the strings of added
tokens give their ids; repeated rows each come back; an empty table gives an empty table; other columns are passed through,
but for columns named like the results, which are replaced. Letters and numbers are those of the matcher's Unicode version.
"""

from __future__ import annotations

import json
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

from donorlens.llm.bpe import CHUNK, REMEMBER, Encoder, offsets, some_texts
from donorlens.llm.common import fresh, ship

#: Fixed value: the splitting pattern of byte-level tokenizers that name none.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that are decoded together, at least.
DECODED = 1_000_000
#: Pairs of tokens whose order is remembered.
PAIRS = 1_000_000
NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the file: printable ones stand for themselves, the others for those from
    U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + rest.index(b)) for b in range(256)]


class Trie:
    """Encodes words by a vocabulary (token bytes by id) and its merges (pairs of ids, the first to merge first)."""

    def __init__(self, tokens: dict[int, bytes], merges: list[tuple[int, int]]):
        ids = {x: i for i, x in tokens.items()}
        self.single = [ids.get(bytes([b]), -1) for b in range(256)]
        self.born = {i: -1 for i in self.single}
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for r, (a, b) in enumerate(merges):
            made = ids[tokens[a] + tokens[b]]
            if a not in self.born or b not in self.born or made in self.born:
                raise ValueError("each merge must make a new token of earlier ones")
            self.born[made], self.halves[made], self.rank[a << 32 | b] = r, (a, b), r
        if -1 in self.single:
            raise ValueError("every byte must be a token")
        self.mark = xxhash.xxh3_128_hexdigest(repr((sorted(tokens.items()), merges)).encode())
        self.pairs: dict[int, bool] = {}
        # the automaton: a state per prefix of a token, state 0 the empty one
        self.next: dict[int, int] = {}
        spelled = {i: tokens[i] for i in self.born}
        self.size = {i: len(x) for i, x in spelled.items()}
        own: list[int | None] = [None]
        for i, token in spelled.items():
            at = 0
            for b in token:
                step = at << 8 | b
                if step not in self.next:
                    self.next[step] = len(own)
                    own.append(None)
                at = self.next[step]
            own[at] = i
        by_parent: list[list[tuple[int, int]]] = [[] for _ in own]
        for step, to in self.next.items():
            by_parent[step >> 8].append((step & 255, to))
        self.link, self.ends, wave = [0] * len(own), [()] * len(own), [0]
        trie = dict(self.next)
        while wave:  # a level of the tokens' prefixes at a time
            below = []
            for at in wave:
                for b, to in by_parent[at]:
                    back = self.link[at]
                    while at and back and back << 8 | b not in trie:
                        back = self.link[back]
                    self.link[to] = trie.get(back << 8 | b, 0) if at else 0
                    mine = () if own[to] is None else ((own[to], len(spelled[own[to]])),)
                    self.ends[to] = mine + self.ends[self.link[to]]
                    below.append(to)
            wave = below

    def _go(self, at: int, b: int) -> int:
        """The automaton's next state where no token goes on with the byte; remembered."""
        back = at
        while back and back << 8 | b not in self.next:
            back = self.link[back]
        to = self.next.get(back << 8 | b, 0)
        if len(self.next) < 4 * PAIRS:
            self.next[at << 8 | b] = to
        return to

    def may_follow(self, first: int, second: int) -> bool:
        """Whether the bytes of the two tokens are encoded as just these two."""
        a, b, until_a, until_b = first, second, NEVER, NEVER
        while True:
            r = self.rank.get(a << 32 | b, NEVER)
            if r < until_a and r <= until_b:  # of equal pairs the left one goes first
                return False
            if self.born[a] > self.born[b]:
                until_a = self.born[a]
                a = self.halves[a][1]
            elif self.born[b] >= 0:
                until_b = self.born[b]
                b = self.halves[b][0]
            else:
                return True

    def encode_many(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of the distinct words, as 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        step, ends, pairs = self.next.get, self.ends, self.pairs
        states, last, before = [0], [-1], b""  # along the path from the root
        for k in sorted(range(len(words)), key=words.__getitem__):
            word = words[k]
            depth, most = 0, min(len(before), len(word))
            while depth < most and word[depth] == before[depth]:
                depth += 1
            del states[depth + 1:], last[depth + 1:]
            at = states[depth]
            for b in word[depth:]:  # new nodes
                to = step(at << 8 | b)
                at = self._go(at, b) if to is None else to
                depth += 1
                for token, size in ends[at]:
                    if size == depth:
                        break
                    pair = last[depth - size] << 32 | token
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        fits = pairs[pair] = self.may_follow(pair >> 32, token)
                    if fits:
                        break
                states.append(at)
                last.append(token)
            ids = array("i")
            while depth:
                ids.append(last[depth])
                depth -= self.size[last[depth]]
            ids.reverse()
            out[k], before = ids.tobytes(), word
        return out


def read_tokenizer(path: str) -> tuple[dict[int, bytes], list[tuple[int, int]], dict[str, int]]:
    """Token bytes by id, merges as pairs of ids, and the added tokens' ids by their strings."""
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    model, before = given["model"], given["pre_tokenizer"] or {}
    unknown = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    if given["normalizer"] or model["type"] != "BPE" or unknown:
        raise ValueError(f"not a plain byte-level BPE: {unknown or model['type']}")
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        raise ValueError("the splitting step isn't the plain byte-level one")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in given["added_tokens"]):
        raise ValueError("added tokens that take white space or word borders aren't supported")
    added = {t["content"]: t["id"] for t in given["added_tokens"]}
    byte = {c: b for b, c in enumerate(byte_letters())}
    tokens = {i: bytes(map(byte.__getitem__, x)) for x, i in model["vocab"].items() if x not in added}
    pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
    return tokens, [(model["vocab"][a], model["vocab"][b]) for a, b in pairs], added


def _columns(docs: DataFrame, *replaced: str) -> list:
    return [F.col(f"`{c}`") for c in docs.columns if c.lower() not in replaced]


def _with_added(encoder: Encoder, texts: list[str], special: dict[str, bytes], cut) -> list[bytes]:
    """The ids of texts that hold strings of added tokens."""
    found = [[x for x in cut(text) if x] for text in texts]
    ids, sizes = encoder.encode(pa.array([x for parts in found for x in parts if x not in special], pa.string()))
    at = offsets(sizes)
    between = (ids[i:j].tobytes() for i, j in zip(at, at[1:]))
    return [b"".join(special[x] if x in special else next(between) for x in parts) for parts in found]


def _encoder(held, mark: str, added: dict[str, int], pattern: str, remember: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(held, mark, pattern, remember, True)
        special = {x: array("i", [i]).tobytes() for x, i in added.items()}
        strings = "|".join(map(regex.escape, sorted(added, key=len, reverse=True)))
        cut = regex.compile(f"({strings})").split if added else None
        for batch in batches:
            for part, texts in some_texts(batch, CHUNK):
                held_by = np.zeros(len(texts), dtype=bool)
                for x in added:
                    held_by |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
                mixed = np.flatnonzero(held_by)
                ids, sizes = encoder.encode(pc.if_else(pa.array(held_by), "", texts) if len(mixed) else texts)
                if len(mixed):
                    at = offsets(sizes)
                    found = [ids[i:j].tobytes() for i, j in zip(at, at[1:])]
                    for i, x in zip(mixed, _with_added(encoder, texts.take(pa.array(mixed)).to_pylist(), special, cut)):
                        found[i] = x
                    column = pa.array(found, pa.binary())
                else:
                    column = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets(sizes, 4)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], column], names=[*batch.schema.names[:-1], "ids"])

    return run


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", pattern: str = PATTERN, remember: int = REMEMBER) -> DataFrame:
    """``docs`` with its text replaced by ``ids``: the text's ids as little-endian 32-bit integers in a binary column (see
    ``ids_array``)."""
    ship(docs.sparkSession)
    tokens, merges, added = read_tokenizer(tokenizer_path)
    trie = Trie(tokens, merges)
    held = docs.sparkSession.sparkContext.broadcast(trie)
    given = docs.select(*_columns(docs, "ids", text_col.lower()), F.col(text_col).cast("string").alias(fresh("__text", docs.columns)))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("ids", T.BinaryType())])
    return given.mapInArrow(_encoder(held, trie.mark, added, pattern, remember), schema)


def ids_array(col: str = "ids"):
    """The ids of a binary column as an array of int."""
    bytes_of = "hex(substring({0}, 4 * k + {1}, 1))"
    number = ", ".join(bytes_of.format(col, at) for at in (4, 3, 2, 1))
    swapped = F.expr(f"transform(sequence(0, octet_length({col}) div 4 - 1), k -> conv(concat({number}), 16, 10))")
    return F.when(F.octet_length(col) > 0, swapped.cast("array<int>")).otherwise(F.array().cast("array<int>"))


def _decoder(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Encoder.forget()
        blob, start, length = held.value
        for batch in batches:
            given, first, out, size = batch.column(batch.num_columns - 1), 0, [], 0
            for i in range(batch.num_rows):  # from ids to where their bytes lie, then one gather
                text = None
                if given[i].is_valid:
                    ids = np.frombuffer(given[i].as_py(), dtype="<i4")
                    sizes = length[ids]
                    ends = np.cumsum(sizes)
                    at = np.arange(ends[-1] if len(ids) else 0) + np.repeat(start[ids] - ends + sizes, sizes)
                    text = blob[at].tobytes().decode("utf-8", "replace")
                out.append(text)
                size += len(text or "")
                if size > DECODED or i == batch.num_rows - 1:
                    part = batch.slice(first, i + 1 - first)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "decoded"])
                    first, out, size = i + 1, [], 0

    return run


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids (null ids: null); bytes that aren't UTF-8 give U+FFFD."""
    ship(encoded.sparkSession)
    tokens, _, added = read_tokenizer(tokenizer_path)
    spelled = {**tokens, **{i: x.encode() for x, i in added.items()}}
    start, length = (np.zeros(max(spelled) + 1, dtype=np.int64) for _ in range(2))
    at = 0
    for i, x in spelled.items():
        start[i], length[i] = at, len(x)
        at += len(x)
    held = encoded.sparkSession.sparkContext.broadcast((np.frombuffer(b"".join(spelled.values()), dtype=np.uint8), start, length))
    given = encoded.select(*_columns(encoded, "decoded", ids_col.lower()), F.col(ids_col))
    return given.mapInArrow(_decoder(held), T.StructType([*given.schema.fields, T.StructField("decoded", T.StringType())]))
