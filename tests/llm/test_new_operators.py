"""Trie encoding, the filter interaction audit and collocations against the library, brute force and SQL, and their defined cases."""

import hashlib
import itertools
import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from donorlens.llm import collocations, filter_audit, trie_bpe
from donorlens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, id long, part string, mask int, count long, w1 string, ids string, decoded string"


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text, lang, source) with further columns whose names the operators use."""

    def make(rows):
        return spark.createDataFrame([(*r, 7, "x", 1, 5, "x", "x", "x") for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="module")
def trie():
    return trie_bpe.Trie(*trie_bpe.read_tokenizer(TOKENIZER)[:2])


def pieces(rng):
    parts = ["a", "aa", "th", "e", " ", "  ", "\n", "\t", "1", "2", "'s", "'ll", "é", "漢", "😀", "!", "?", "A", "ing", "tion", "x" * 7, "==", " ", "\x85", "\x1c", "abab", "\r\n", " the"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))


def test_trie_states_equal_the_library(trie):
    """The last token of each prefix's encoding, words that share prefixes, and long runs."""
    library = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(3)
    words = {"".join(rng.choice("abceinorst") for _ in range(rng.randint(1, 12))) for _ in range(4000)}
    words |= {w[:k] for w in list(words)[:300] for k in range(1, len(w))} | {"a" * n for n in range(1, 80)} | {"x" * 30_000, "ab" * 9_000}
    words = sorted(words, key=lambda w: hashlib.md5(w.encode()).digest())
    got = [np.frombuffer(x, "<i4").tolist() for x in trie.encode_many([w.encode() for w in words])]
    assert got == [e.ids for e in library.encode_batch(words, add_special_tokens=False)]
    assert trie.encode_many([]) == [] and trie.encode_many([b""]) == [b""]


def test_trie_bpe_equals_the_library_and_round_trips(docs):
    library = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(4)
    texts = [None, "", "<|endoftext|>", "a <|endoftext|><|endoftext|> b", "<|endoftext|", "x" * 5000, "ab " * 9000, "\x00", *(pieces(rng) for _ in range(400))]
    frame = docs([(i, t, "en", "a") for i, t in enumerate(texts)] + [(0, None, None, None)])
    encoded = trie_bpe.encode(frame, TOKENIZER, remember=60)
    assert encoded.columns == [c for c in frame.columns if c not in ("text", "ids")] + ["ids"]
    rows = trie_bpe.decode(encoded, TOKENIZER).withColumn("array", trie_bpe.ids_array()).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        ids = np.frombuffer(r.ids, "<i4").tolist()
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert ids == want == r.array and r.decoded == library.decode(want, skip_special_tokens=False) == (texts[r.doc_id] or "")
    assert trie_bpe.decode(trie_bpe.encode(frame.where("false"), TOKENIZER), TOKENIZER).count() == 0


def test_trie_splitting_of_every_code_point():
    """The matcher and the library agree on what letters, numbers and spaces are, but for code points of later Unicode versions."""
    from tokenizers.pre_tokenizers import ByteLevel

    split, find, other = ByteLevel(add_prefix_space=False), regex.compile(trie_bpe.PATTERN).findall, []
    for c in map(chr, itertools.chain(range(0xD800), range(0xE000, 0x20000))):
        text = f"a{c}b1{c}1 {c}{c} "
        if [text[i:j] for _, (i, j) in split.pre_tokenize_str(text)] != find(text):
            other.append(c)
    assert len(other) < 5000
    # none of them is a letter, number or space of the alphabets that texts use
    assert all(ord(c) > 0x80 and not ("À" <= c <= "ɏ") for c in other)


def test_unfit_tokenizers_are_refused(trie, tmp_path):
    with pytest.raises(ValueError):
        trie_bpe.Trie({0: b"a", 1: b"b", 2: b"ab"}, [(0, 1)])  # bytes without a token
    tokens = {i: bytes([i]) for i in range(256)} | {256: b"ab", 257: b"abc"}
    with pytest.raises(ValueError):
        trie_bpe.Trie(tokens, [(256, ord("c")), (ord("a"), ord("b"))])  # a merge of a later one
    with pytest.raises(ValueError):
        trie_bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))


def test_lehmer_ranks_and_intervals():
    orders = list(itertools.permutations(range(5)))
    assert [filter_audit.lehmer_rank(o, 5) for o in orders] == list(range(120))
    found = Counter()
    for mask, step, begin, end in filter_audit.intervals(5):
        found.update((mask, step, r) for r in range(begin, end))
    want = {(mask, next(s for s, i in enumerate(o, 1) if mask >> i & 1), r) for mask in range(1, 32) for r, o in enumerate(orders)}
    assert set(found) == want and set(found.values()) == {1}


def brute_audit(rows, labels):
    """Every order applied to every document, one after the other."""
    first, good, toxic = {}, Counter(), Counter()
    for i, text, _, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, q, t in labels:
        good[i] |= q == 1
        toxic[i] |= t == 1
    table = []
    for i, text, _, source in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and t in first and first[t] < i}
        table.append((source or "", fails, i is not None and good[i], i is not None and toxic[i]))
    out = {}
    for part in {x[0] for x in table}:
        mine, shapley = [x for x in table if x[0] == part], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = mine
            for step, f in enumerate(order, 1):
                gone, left = [x for x in alive if x[1][f]], [x for x in alive if not x[1][f]]
                redundant = sum(x[1][f] for x in mine) - len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, sum(x[1][f] and sum(x[1].values()) == 1 for x in mine),
                                          sum(x[2] for x in gone), sum(x[3] for x in gone)]
                shapley[f] += len(gone)
                alive = left
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                out[part, order, step].append(shapley[f])
    return out


def test_filter_audit_brute_force(spark, docs):
    rng = random.Random(6)
    texts = [None, "", "A", "a#b", "same words " * 150, "UPPER lower " * 101] + [
        " ".join(rng.choice(["Ab", "cd", "e", "F", "g%", *map(str, range(300))]) for _ in range(rng.choice([5, 199, 200, 260]))) for _ in range(25)]
    rows = [(i, rng.choice(texts), None, rng.choice(["a", "b", "", None, "é"])) for i in range(150)]
    rows += [(None, texts[3], None, "a"), (None, texts[3], None, None), (7, rows[7][1], None, "b"), (7, rows[7][1], None, rows[7][3]), (7, "else", None, "b")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 1), (None, 1, 1), (999, 1, 1)]
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit(filter_audit.with_labels(filter_audit.failures(docs(rows)), marks)).collect()
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in got} == brute_audit(rows, labels)
    nothing = docs(rows).where("false")
    assert filter_audit.audit(filter_audit.with_labels(filter_audit.failures(nothing), marks.where("false"))).count() == 0


def test_filter_audit_of_other_filters(spark):
    rows = spark.createDataFrame([("p", 1, 3, 1, 0), ("p", 3, 2, 0, 1), ("p", 0, 5, 4, 0)], "part string, mask int, count long, good long, toxic long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit.audit(rows, "xy").collect()}
    assert got == {("xy", 1): (5, 5, 0, 3, 1, 1, 8), ("xy", 2): (5, 0, 2, 0, 0, 0, 2), ("yx", 1): (8, 2, 0, 0, 0, 1, 2), ("yx", 2): (5, 3, 2, 3, 1, 0, 8)}
    for wrong in ("", "aa", "abcdefg"):
        with pytest.raises(ValueError):
            filter_audit.audit(rows, wrong)


def brute_collocations(rows, least, top):
    counts, total = {}, Counter()
    for _, text, lang, _ in rows:
        f = counts.setdefault(lang if lang is not None else "und", Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            f.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
            total[lang if lang is not None else "und"] += len(w)
    out = []
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) > 1 and a >= least:
                score, _, l, r = min((Fraction(10**6 * a * a, f[p[:k]] * f[p[k:]]).__floor__(), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                longer = max((f[q] for q in f if len(q) == 3 and len(p) == 2 and f[q] >= least and (q[:2] == p or q[1:] == p)), default=0)
                if 100 * longer < 50 * a or not longer:
                    found.append((score, a, " ".join(p), l, r))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, p, a, l, r, total[lang], s) for i, (s, a, p, l, r) in enumerate(found[:top], 1)]
    return sorted(out)


def test_collocations_brute_force(docs):
    rng = random.Random(8)
    words = ["New", "york", "new", "the", "é", "É", "漢", "x　y", "a-b", "san", "jose", "of", "of"]
    marks = [" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "\x0c", "! "]
    rows = [(i, "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de", None, "und"]), "s") for i in range(60)]
    rows += [(1, "of of of of", "en", "s"), (None, None, "en", None), (3, "", None, None), (4, " . ", "fr", None), (5, "hot " * 5000, "en", "s")]
    for least, top in ((10, 2000), (2, 25)):
        got = [tuple(r) for r in collocations.collocations(docs(rows), min_count=least, top=top).collect()]
        assert sorted(got) == brute_collocations(rows, least, top)
    assert collocations.collocations(docs(rows).where("false")).count() == 0


def test_scores_beyond_64_bits(spark):
    frame = spark.createDataFrame([(3_000_000_000_000, 4_000_000_000_000, 5_000_000_000_000)], "a long, l long, r long")
    assert frame.select(collocations._score("l", "r")).first()[0] == 450_000


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_collocations"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, (tuple(r[c] for c in want.columns) for r in got.collect()))) == sorted(map(repr, want.fetchall()))


def test_op11_digests(spark):
    library, texts = Tokenizer.from_file(TOKENIZER), {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op11_trie_bpe"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest, hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_trie_bpe_workers_hold_one_vocabulary_and_give_it_up_to_decode():
    import pyarrow as pa

    tokens, merges, added = trie_bpe.read_tokenizer(TOKENIZER)
    trie = trie_bpe.Trie(tokens, merges)

    class Held:
        reads = 0

        @property
        def value(self):
            Held.reads += 1
            return trie

    spelled = {**tokens, **{i: x.encode() for x, i in added.items()}}

    class Spelled:
        value = (np.frombuffer(b"".join(spelled[i] for i in sorted(spelled)), dtype=np.uint8),
                 np.cumsum([0, *(len(spelled[i]) for i in sorted(spelled))])[:-1], np.array([len(spelled[i]) for i in sorted(spelled)]))

    assert sorted(spelled) == list(range(len(spelled)))
    texts = ["ab cd ef", "", None, "é x\n" * 900_000, "ab"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    trie_bpe.Encoder.forget()
    for _ in range(2):  # as tasks of two runs, each with a broadcast of its own
        out = list(trie_bpe._encoder(Held(), trie.mark, added, trie_bpe.PATTERN, 100)(iter([batch])))
    assert Held.reads == 1 and trie_bpe.Encoder.last[1].vocabulary is trie
    back = list(trie_bpe._decoder(Spelled)(iter(out)))
    assert trie_bpe.Encoder.last is None
    assert [x for part in back for x in part.column("decoded").to_pylist()] == [t or "" for t in texts]
