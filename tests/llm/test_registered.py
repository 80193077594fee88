"""The registered queries against brute force on the smallest tables, folds included, and the edges of three operators."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from test_operators import frame, slow_components, slow_fingerprint

from tilewright.llm import lattice_sampling, packing, queries, simhash, token_counts
from tilewright.llm.word_tokens import WordTokenizer

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang").collect()]


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_op2_counts_and_base_scores(spark, documents):
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t, _ in documents}
    counts = Counter(w for i, own in tokens.items() if fold(i, 10) for w in own)
    n, v = counts.total(), len(counts)
    rows = queries.op2_subword_lm(spark, FOLDER).collect()
    assert len(rows) == len(documents)
    for r in rows:
        own = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (fold(r["doc_id"], 10) == 0, len(own), sum(counts[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own))
        assert np.isfinite(r["score"]) and r["score"] < 0


def test_op3_samples_decode_to_their_texts(spark, documents):
    texts, by_doc = {i: t or "" for i, t, _ in documents}, Counter()
    for r in queries.op3_lattice_sampling(spark, FOLDER).collect():
        by_doc[r["doc_id"]] += 1
        assert lattice_sampling.decode(r["ids"]) == texts[r["doc_id"]] and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    assert set(by_doc) == set(texts) and max(by_doc.values()) == 2


def test_op5_folds_and_accuracy(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op5_language_id(spark, FOLDER).collect()}
    langs = {i: lang for i, _, lang in documents}
    assert rows.keys() == langs.keys() and all(r["held_out"] == (fold(i, 4) == 2) and 0 <= r["score"] <= 1 for i, r in rows.items())
    judged = [r["lang_pred"] == langs[i] for i, r in rows.items() if r["held_out"] and langs[i] is not None and r["lang_pred"] != "und"]
    assert len(judged) > 20 and np.mean(judged) > 0.95


def test_op6_fingerprints_and_components(spark, documents):
    ids, prints = [i for i, *_ in documents], [slow_fingerprint(t) for _, t, _ in documents]
    expected = slow_components(ids, prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op6_simhash(spark, FOLDER).collect()}
    assert got == {i: (f"{p:016x}", expected[i]) for i, p in zip(ids, prints)}


def test_op7_and_op8_tokens(spark, documents):
    words = WordTokenizer(packing.VOCABULARY)
    encoded = {i: words.tokenizer.encode(t or "", add_special_tokens=False).ids for i, t, _ in documents}
    lengths = Counter(len(x) for x in encoded.values())
    assert {r["n_tokens"]: r["n_docs"] for r in queries.op7_token_counts(spark, FOLDER).collect()} == dict(lengths)
    ends, places = Counter(), {}
    for r in sorted(queries.op8_packing(spark, FOLDER).collect(), key=lambda r: (r["doc_id"], r["start"])):
        ids = np.array([*encoded[r["doc_id"]], 2], "<u4")
        assert r["start"] == ends[r["doc_id"]] and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        ends[r["doc_id"]] += r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert ends == {i: len(x) + 1 for i, x in encoded.items()}
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 4096
    assert len(places) == -(-sum(ends.values()) // 4096)


def test_op10_recall_and_scores(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, m = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    got, hits = {}, []
    for r in queries.op10_permutation_index(spark, FOLDER).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = (r["rank"], r["score"])
    assert got.keys() == {i for i in ids.tolist() if i % 50 == 0}
    for query, own in got.items():
        score = m @ m[ids == query][0]
        assert sorted(k for k, _ in own.values()) == [1, 2, 3, 4, 5] and all(s == pytest.approx(score[ids == i][0]) for i, (_, s) in own.items())
        hits += [i in own for i in ids[np.argsort(-np.where(ids == query, -9, score))[:5]]]
    assert np.mean(hits) >= 0.95


# Null ids and repeated rows


def edge_rows():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdef", k=4)) for _ in range(40)]
    text = " ".join(rng.choices(words, k=60))
    other = " ".join(rng.choices(words, k=60))
    return [(None, text), (None, text), (None, other), (5, text), (5, text), (3, text + " x"), (None, None), (None, ""), (9, None), (9, None), (-4, " \t")], text, other


def test_samples_of_null_and_repeated_ids(spark):
    rows, text, _ = edge_rows()
    found = lattice_sampling.sample_encodings(frame(spark, rows)).collect()
    got = Counter((r["doc_id"], r["sample_no"], tuple(r["ids"])) for r in found)
    assert {lattice_sampling.decode(list(ids)) for _, _, ids in got} == {t or "" for _, t in rows}
    twice = [n for (i, _, ids), n in got.items() if lattice_sampling.decode(list(ids)) == text]
    assert set(twice) == {2} and len(twice) == 4  # rows of one id and text have equal samples: two for null, two for 5
    assert sorted(n for (i, _, ids), n in got.items() if not ids) == [2, 2]


def test_components_of_null_and_repeated_ids(spark):
    rows, text, other = edge_rows()
    got = Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.simhash_components(frame(spark, rows)).collect())
    print_of = {t: f"{slow_fingerprint(t):016x}" for _, t in rows}
    assert sum(got.values()) == len(rows)
    assert got[None, print_of[other], None] == 1  # null ids alone
    near = 3 if bin(slow_fingerprint(text) ^ slow_fingerprint(text + " x")).count("1") <= 3 else 5
    assert got[None, print_of[text], near] == got[5, print_of[text], near] == 2
    assert got[None, "0" * 16, -4] == 2 and got[9, "0" * 16, -4] == 2 and got[-4, "0" * 16, -4] == 1


def test_packing_of_null_and_repeated_ids(spark):
    rows, *_ = edge_rows()
    found = packing.pack_documents(frame(spark, rows), length=16, with_ids=True).collect()
    words = WordTokenizer(packing.VOCABULARY)
    stream = [t for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])) for t in r["ids"]]
    expected = Counter(tuple([*words.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for _, t in rows)
    got, own = Counter(), []
    for t in stream:
        own.append(t)
        if t == 2:
            got[tuple(own)] += 1
            own = []
    assert got == expected and not own
    assert Counter(r["doc_id"] for r in found if r["start"] == 0) == Counter(i for i, _ in rows)
    histogram = {r["n_tokens"]: r["n_docs"] for r in token_counts.length_histogram(frame(spark, rows)).collect()}
    assert histogram == dict(Counter(len(k) - 1 for k in expected.elements()))
