"""Odd inputs, bounds and registered queries of the training-data operators."""

import base64
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from donorlens.llm import exact_dedup, labelled, licences, mixing, near_dedup, quality_rules, sharding, shingles, toxicity
from donorlens.llm.queries import QUERIES, SHARDS
from tests.llm.test_llm import brute_components, copies, docs, words  # noqa: F401 - docs is a fixture

SF = "/root/testdata/sf0.001"


def rows_of(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def test_near_duplicates_without_chance(docs):  # noqa: F811
    texts = copies(random.Random(21))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs(texts), hot=5, listed=None).collect()}
    assert got == brute_components(texts)


def test_near_duplicates_of_a_large_family(docs):  # noqa: F811
    """Variants of one text around the threshold, so that most pairs of two variants are no links."""
    rng = random.Random(22)
    base, texts = words(rng, 120).split(), []
    for _ in range(150):
        variant = list(base)
        for k in rng.sample(range(len(variant)), rng.randint(1, 7)):
            variant[k] = rng.choice(["same", "other", words(rng, 1) + "q"])
        texts.append(" ".join(variant))
    texts = list(enumerate(texts + [" ".join(base)]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs(texts), hot=16).collect()}
    assert got == brute_components(texts)


def test_bounds_of_family_members(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BUCKET", 40)  # many buckets
    rng = random.Random(23)
    sets = {i: sorted(rng.sample(range(1, 400), rng.randint(5, 60))) for i in range(40)}
    for i in range(5, 40):
        sets[i] = sorted({*rng.sample(sets[i % 5], len(sets[i % 5]) * 3 // 4), *rng.sample(range(1, 400), 6)})
    spread = {x: int(shingles.mix(np.array([x], dtype=np.uint64))[0] >> np.uint64(1)) for x in range(1, 400)}
    held = spark.createDataFrame([(i, [spread[x] for x in s]) for i, s in sets.items()], "id long, vals array<long>")
    family = spark.createDataFrame([(i, i % 5) for i in sets], "id long, centre long")
    got = {r.id: r for r in near_dedup._bounds(family, held).collect()}
    near = {i for i in sets if 2 * len(set(sets[i]) & set(sets[i % 5])) >= len(sets[i])}
    for i, s in sets.items():
        others = set().union(*(sets[j] for j in sets if j != i))
        # the centres' shingles count as held by others
        assert got[i].alone == len(set(s) - others - set().union(*(sets[c] for c in range(5))))
        if i in near:
            rest = set(s) - set(sets[i % 5])
            beside = {spread[x] for x in rest if any(x in set(sets[j]) - set(sets[j % 5]) for j in near if j != i and j % 5 == i % 5)}
            assert (got[i].centre, got[i].inside, set(got[i].beside)) == (i % 5, len(s) - len(rest), beside)
        else:
            assert got[i].centre is None


def test_a_batch_of_long_texts_is_not_held():
    rng = random.Random(24)
    vocabulary = [words(rng, 1) for _ in range(5000)]
    texts = [" ".join(rng.choices(vocabulary, k=3000)).encode() for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(900)), pa.array(texts * 3, pa.binary())], names=["id", "text"])
    tracemalloc.start()
    out = sum(b.num_rows for b in near_dedup._per_text(5, 64)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out == 900 and peak < 6_000_000  # whole sets of 900 texts are 21 MB


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    rng = random.Random(25)
    texts = [b" ".join(bytes(rng.choices(b"abC\xc3\xa9", k=rng.choice([1, 5, 63, 64, 65, 200]))) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    whole = [shingles.word_hashes(t) for t in texts]
    monkeypatch.setattr(shingles, "BLOCK", 64)
    for t, want in zip(texts, whole, strict=True):
        got = shingles.word_hashes(t)
        assert len(got) == len(t.split()) and (got == want).all()


def test_exact_groups_do_not_depend_on_the_number_of_keys(docs):  # noqa: F811
    texts = [(i, t) for i, t in enumerate(["ab", "AB", "cd", "x" * 99, "x" * 98 + "y", "alone here", None, ""])]
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    few, many = (rows_of(exact_dedup.exact_groups(docs(texts), broadcast_rows=n), *columns) for n in (1_000_000, 0))
    assert few == many and dict((r[0], r[4]) for r in few)[5] is None


def test_clean_documents_judges_rows_that_share_an_id_by_themselves(docs):  # noqa: F811
    rng = random.Random(26)
    notice = words(rng, 9)
    many = [(i, notice + "\n" + words(rng, 40)) for i in range(40)]
    clean = words(rng, 60) + "\n" + words(rng, 30)
    odd = [(3, clean), (3, "too short"), (None, clean + " end"), (None, "short")]
    got = [(r.doc_id, r.text) for r in quality_rules.clean_documents(docs(many + odd)).collect()]
    assert (3, clean) in got and (3, many[3][1].split("\n")[1]) in got and (None, clean + " end") in got
    assert len(got) == 42


def test_licences_by_any_id_name(docs):  # noqa: F811
    for name in ("line", "rule0", "sentence"):
        frame = docs([(1, "Released under the MIT License.")]).withColumnRenamed("doc_id", name)
        r = licences.scan_licences(frame, id_col=name).first()
        assert (r[name], r.licences) == (1, ["MIT"])


def test_mixture_weight_of_zero_leaves_out(spark):
    leaves = spark.createDataFrame([("x", "en", "a", 100), ("x", "en", "b", 1000), ("x", "de", "c", 1000), ("y", "en", "d", 1000)],
                                   "domain string, lang string, source string, tokens long")
    got = {r.source: r.budget for r in mixing.leaf_budgets(leaves, F.lit(1500), {"source": {"a": 0.0}, "lang": {"de": 0}}, 1).collect()}
    assert got == {"a": 0, "b": 750, "c": 0, "d": 750}
    got = {r.source: r.budget for r in mixing.leaf_budgets(leaves, F.lit(900), {"domain": {"x": 0.0, "y": 0.0}}, 1).collect()}
    assert set(got.values()) == {0}
    with pytest.raises(ValueError):
        mixing.leaf_budgets(leaves, F.lit(900), {"domain": {"x": -1.0}}, 1)


def test_sharding_with_clashing_columns(spark, tmpdir_run):
    frame = spark.createDataFrame([(1, 5, "x", 9)], "key long, place_slot int, shard string, slot int")
    r = sharding.place(frame, "key", SHARDS).first()
    assert r.place_slot == 5 and r.shard in SHARDS and frame.columns[0] in r.asDict()
    sharding.write_shards(spark.range(500).withColumnRenamed("id", "key"), f"{tmpdir_run}/out", "key", SHARDS[:4], files_per_shard=2)
    back = spark.read.parquet(f"{tmpdir_run}/out")
    assert back.count() == 500 and {r.shard for r in back.select("shard").distinct().collect()} <= set(SHARDS[:4])
    assert sharding.place(frame.where("false"), "key", SHARDS).count() == 0


def test_labelled_sample_is_bounded_in_texts_and_bytes(spark, docs):  # noqa: F811
    frame = docs([(1, f"t{i}") for i in range(500)] + [(i, "x" * 100) for i in range(2, 30)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)] * 3 + [(7, 0), (40, 1)], "doc_id long, toxic int")
    everything = F.lit(True)
    texts, ys = labelled.sample_labelled(frame, labels, "toxic", everything, 3)
    assert len(texts) <= 6 and ys.count(0) <= 3 and ys.count(1) <= 3
    texts, ys = labelled.sample_labelled(frame, labels, "toxic", everything, 100)
    assert len(texts) == 28 and texts[0] == "t0"  # one text of the repeated id; 7 has both labels
    texts, ys = labelled.sample_labelled(frame, labels, "toxic", everything, 100, max_bytes=500)
    assert sum(len(t) for t, y in zip(texts, ys, strict=True) if y == 0) <= 500
    assert labelled.sample_labelled(frame, labels.where("false"), "toxic", everything, 3) == ([], [])


def test_toxic_phrases_of_harmless_words(docs):  # noqa: F811
    rng = random.Random(27)
    vocabulary = [words(rng, 1) + "k" for _ in range(300)]
    insults, rows = [rng.sample(vocabulary, 3) for _ in range(3)], []
    for i in range(800):
        sentences = [" ".join(rng.choices(vocabulary, k=rng.randint(4, 12))) for _ in range(rng.randint(3, 8))]
        if i % 2:
            sentences[rng.randrange(len(sentences))] += " " + " ".join(rng.choice(insults))
        rows.append((i, ". ".join(sentences) + ".", i % 2))
    model = toxicity.fit([t for _, t, _ in rows[:600]], [y for _, _, y in rows[:600]])
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs([r[:2] for r in rows[600:]] + [(-1, None), (-2, ". ! ?")]), model).collect()}
    assert sum((got[i].score >= 0.5) == (y == 1) for i, _, y in rows[600:]) >= 190
    assert got[-1].score < 0.5 and got[-2].score < 0.5
    shared = " ".join(vocabulary[:200])
    assert len(toxicity.distinct_texts([f"{words(rng, 100)} {shared}" for _ in range(50)] * 2, [1] * 100)[0]) == 50


@pytest.mark.parametrize("name, column, divisor, rest, bar", [("op5_toxicity", "toxic", 5, 0, 0.5), ("op10_quality", "quality", 4, 2, 0.7)])
def test_scored_queries(spark, name, column, divisor, rest, bar):
    got = QUERIES[name](spark, SF).collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in got} == ids and len(got) == len(ids)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % divisor == rest) and 0 <= r.score <= 1 and r.predicted == (r.score >= bar)


def test_op2_digests(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op2_byte_bpe"](spark, SF).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_op6_counts_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op6_quality_rules"](spark, SF).collect():
        t = texts[r.doc_id]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        inside = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)} if len(set(windows)) < len(windows) else set()
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 10 or 100 * len(inside) > 20 * len(w)) and not (r.kept and r.base_failed)


def test_pipeline_stages_of_an_empty_table(spark):
    nothing = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0


def test_bounds_give_what_two_members_of_a_centre_share(spark):
    rng = random.Random(31)
    sets = {0: set(range(60))}
    for i in range(1, 30):
        sets[i] = {*rng.sample(range(60), rng.choice([25, 35, 45, 55])), *rng.sample(range(100, 110), 4)}
    held = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id long, vals array<long>")
    family = spark.createDataFrame([(i, 0) for i in sets], "id long, centre long")
    got = {r.id: r for r in near_dedup._bounds(family, held).collect()}
    known = [i for i in sets if got[i].lacks is not None]
    assert known == [i for i in sets if 2 * len(sets[i] & sets[0]) >= 60]
    assert all(set(got[i].lacks) == sets[0] - sets[i] for i in known)
    for i in known:
        for j in known:
            if i < j:
                shared = got[i].inside - len(set(got[j].lacks) - set(got[i].lacks)) + len(set(got[i].beside) & set(got[j].beside))
                assert shared == len(sets[i] & sets[j])
