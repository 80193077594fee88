"""The ten operators against brute force, and their defined results for nulls, empties, ties, repeats and clashing names."""

import hashlib
import itertools
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tilewright.llm import exact_dedup, language_id, lattice_sampling, near_copies, packing, permutation_index, queries, simhash, slots, subword_lm, substring_dedup, suffix_family, token_counts
from tilewright.llm.components import components
from tilewright.llm.word_tokens import WordTokenizer

SCHEMA = "doc_id long, text string, kept string, slot int, bucket string, word string, print string, key string"
LONG_WORD = "x" * 5000


def make_texts(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(120)]
    passage = " ".join(rng.choices(vocabulary, k=40))
    texts = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(0, 120))
        if i % 4 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = passage.split()
        texts.append(" ".join(words) + ("\n\t" if i % 7 == 0 else "."))
    texts += texts[:10] + [None, None, "", " ", "\n", "a", "A  b", LONG_WORD, LONG_WORD + " " + passage, "word " * 3000, passage.replace(" ", "\n")]
    return texts


@pytest.fixture(scope="module")
def rows():
    texts = make_texts()
    ids = list(range(100, 100 + len(texts)))
    random.Random(3).shuffle(ids)
    return list(zip(ids, texts))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "no", 7, "b", "w", "p", "k") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# 1: exact dedup


def expected_copies(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return sorted((i, max(g), len(g), i == max(g), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows for g in [groups[t or ""]])


def test_exact_dedup(docs, rows, empty):
    found = exact_dedup.exact_dedup(docs, min_chars=16, max_chars=64)
    assert sorted(map(tuple, found.collect())) == expected_copies(rows)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_tells_colliding_chunks_apart(docs, rows):
    found = exact_dedup.exact_dedup(docs, min_chars=16, max_chars=64, chunk_hash=lambda c: F.pmod(F.xxhash64(c), F.lit(3)))
    assert sorted(map(tuple, found.collect())) == expected_copies(rows)


def test_exact_dedup_of_null_and_repeated_ids(spark):
    found = exact_dedup.exact_dedup(frame(spark, [(None, "a"), (1, "a"), (1, "a"), (None, "b"), (None, "b")]))
    got = sorted((tuple(r)[:4] for r in found.collect()), key=str)
    assert got == sorted([(None, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True), (None, None, 2, True), (None, None, 2, True)], key=str)


def test_chunks_cover_the_text_and_realign_after_an_insertion(spark):
    text = "".join(make_texts()[3:30]).replace(" ", " \n", 40)
    pattern = exact_dedup.chunk_pattern(16, 64)
    a, b = (spark.range(1).select(F.regexp_extract_all(F.lit(t), F.lit(pattern), F.lit(0))).first()[0] for t in (text, "zz" + text))
    assert "".join(a) == text and "".join(b) == "zz" + text and all(len(c) <= 64 for c in a)
    assert a[-1] == b[-1] and len(set(a) & set(b)) > len(a) // 2


def test_exact_dedup_is_native(docs):
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEvalPython", "Arrow")


# 2: LM scoring


def test_lattice_probability_is_the_sum_over_segmentations():
    pieces = ((b"a", False), (b"b", False), (b"ab", False), (b"a", True), (b"b", True), (b"ab", True), (b"ba", True))
    p = np.array([0.2, 0.1, 0.15, 0.15, 0.1, 0.2, 0.1])
    lattice = subword_lm.Lattice(pieces, np.log(p))

    def total(word):
        whole = sum(q for (w, ends), q in zip(pieces, p) if ends and w == word)
        return whole + sum(q * total(word[len(w) :]) for (w, ends), q in zip(pieces, p) if not ends and word.startswith(w) and len(w) < len(word))

    words = [b"a", b"ab", b"abba", b"aabab", b"ab" * 40]
    got = lattice.log_probabilities(words)
    assert got[:4] == pytest.approx([np.log(total(w)) for w in words[:4]])
    assert got[4] == pytest.approx(lattice._forward_one(words[4])[-1])
    assert lattice.log_probabilities([b"c"])[0] == -np.inf
    counts = lattice.expected_counts([b"ab"], np.array([2.0]))
    one, two = 0.2 * 0.1, 0.2
    assert counts == pytest.approx([2 * one / (one + two), 0, 0, 0, 2 * one / (one + two), 2 * two / (one + two), 0])


@pytest.mark.parametrize("word", [b"ab" * 30, b"a" * 49, b"abba" * 13 + b"b", b"c" * 50, b"ab" * 5])
def test_expected_counts_of_long_words(word):
    pieces = ((b"a", False), (b"b", False), (b"ab", False), (b"a", True), (b"b", True), (b"ab", True), (b"ba", True))
    p = np.array([0.2, 0.1, 0.15, 0.15, 0.1, 0.2, 0.1])

    def total(at, step):
        """(sum of products, its derivative by the log of each piece's weight) of the spellings from ``at``."""
        if at not in step:
            whole, parts = 0.0, np.zeros(len(p))
            for k, (w, ends) in enumerate(pieces):
                stop = at + len(w)
                if word[at:stop] != w or ends != (stop == len(word)):
                    continue
                t, d = (1.0, np.zeros(len(p))) if ends else total(stop, step)
                whole, parts = whole + p[k] * t, parts + p[k] * (d + t * np.eye(len(p))[k])
            step[at] = whole, parts
        return step[at]

    whole, parts = total(0, {})
    got = subword_lm.Lattice(pieces, np.log(p)).expected_counts([word], np.array([3.0])) if whole or len(word) > 48 else 0
    assert got == pytest.approx(3 * parts / whole if whole else np.zeros(len(p)))


@pytest.mark.parametrize("total", [4e6, 4e9, 1e13])
def test_words_of_rare_pieces_do_not_underflow(total):
    """Groups of words give what the recursion in logs gives, however small the pieces' probabilities are."""
    pieces = subword_lm.read_pieces()
    lattice = subword_lm.Lattice(pieces, np.log(np.where(np.arange(len(pieces)) % 9, 0.1, 0.1 + total / len(pieces)) / total))
    rng = random.Random(4)
    words = [bytes(rng.choices(range(1, 256), k=n)) for n in (1, 5, 17, 40, 47, 48, 48, 60)] + [b"\x01" * 48, b"the" * 16, b"\xff\x02" * 24]
    logs = [lattice._forward_one(w)[-1] for w in words]
    assert np.isfinite(logs).all()
    assert lattice.log_probabilities(words) == pytest.approx(logs, rel=1e-12)
    alone = np.zeros(len(lattice.scores))
    for w in words:
        lattice._expect_one(w, 2.0, alone)
    assert lattice.expected_counts(words, np.full(len(words), 2.0)) == pytest.approx(alone[:-1], rel=1e-9, abs=1e-12)
    assert alone.sum() > len(words)


def test_a_long_word_takes_little_memory():
    import tracemalloc

    pieces = subword_lm.read_pieces()
    lattice = subword_lm.Lattice(pieces, np.full(len(pieces), -np.log(len(pieces))))
    word, out = bytes(random.Random(1).choices(b"abcdefgh01", k=100_000)), np.zeros(len(lattice.scores))
    tracemalloc.start()
    lattice._expect_one(word, 1.0, out)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40 * len(word) and out.sum() > 10_000


def test_scores_of_documents(docs, rows, empty):
    fold = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    found = {r["doc_id"]: r for r in subword_lm.score_documents(docs, fold, rounds=1, most_frequent=50).collect()}
    counts = Counter()
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in rows}
    for i, own in tokens.items():
        if not held[i]:
            counts.update(own)
    n, v = counts.total(), len(counts)
    for i, own in tokens.items():
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(own), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own))
        assert np.isfinite(r["score"]) and r["score"] < 0
    again = {r["doc_id"]: r["score"] for r in subword_lm.score_documents(docs, fold, rounds=1, most_frequent=1).collect()}
    assert all(again[i] == pytest.approx(found[i]["score"]) for i in again)  # the copied words change nothing
    assert subword_lm.score_documents(empty, fold).count() == 0


def test_score_is_the_model_by_brute_force(spark):
    """Discounted counts, three rounds of expectation maximisation and the sum over all spellings, over small words."""
    rng = random.Random(6)
    kinds = ["".join(rng.choices("abcdé", k=rng.randint(1, 5))) for _ in range(30)] + ["x" * 60]
    texts = {i: " ".join(rng.choices(kinds, k=rng.randint(0, 12))) for i in range(60)}
    held = {i: i % 4 == 0 for i in texts}
    texts[0] += " onlyhere A"
    pieces = subword_lm.read_pieces()
    number = {p: n for n, p in enumerate(pieces)}

    def sums(word, weights):
        """The sum over all spellings, and each piece's expected number of uses."""
        n, alpha = len(word), [1.0] + [0.0] * len(word)
        edges = [(i, j, number[k]) for j in range(1, n + 1) for i in range(j) if (k := (word[i:j], j == n)) in number]
        for i, j, p in edges:
            alpha[j] += alpha[i] * weights[p]
        beta = [0.0] * n + [1.0]
        for i, j, p in sorted(edges, key=lambda e: -e[0]):
            beta[i] += weights[p] * beta[j]
        return alpha[n], [(p, alpha[i] * weights[p] * beta[j] / alpha[n]) for i, j, p in edges]

    counts = Counter(w for i, t in texts.items() if not held[i] for w in t.lower().encode().split())
    n_docs = sum(not h for h in held.values())
    n_train = counts.total() + n_docs
    once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
    discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
    weights = 1 / (2.0 + np.arange(len(pieces)))
    weights /= weights.sum()
    for _ in range(3):
        new = np.full(len(pieces), 0.1)
        for w in counts:
            for p, share in sums(w, weights)[1]:
                new[p] += share
        weights = new / new.sum()
    score = lambda w: np.log10((max(0, counts[w] - discount) if counts[w] else 0) / n_train + discount * len(counts) / n_train * sums(w, weights)[0])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    for r in subword_lm.score_documents(docs, F.col("doc_id") % 4 == 0).collect():
        expected = sum(score(w) for w in texts[r["doc_id"]].lower().encode().split()) + np.log10(n_docs / n_train)
        assert r["score"] == pytest.approx(expected, rel=1e-9)


def test_scores_without_training_rows(spark):
    found = subword_lm.score_documents(frame(spark, [(1, "a b"), (None, None), (1, "a b")]), F.lit(True)).collect()
    assert len(found) == 3 and all(r["train_tokens"] == 0 and r["n_known"] == 0 and np.isfinite(r["score"]) for r in found)


def test_every_byte_can_be_spelled():
    pieces = subword_lm.read_pieces()
    lattice = subword_lm.Lattice(pieces, np.full(len(pieces), -np.log(len(pieces))))
    assert np.isfinite(lattice.log_probabilities([bytes([b]) for b in range(256)] + ["né𝄞".encode()])).all()


# 3: SentencePiece encoding and decoding


def all_segmentations(table, text):
    data, out = b" " + text.encode(), []

    def go(i, ids, weight):
        if i == len(data):
            out.append((tuple(ids), weight))
        for j in range(i + 1, len(data) + 1):
            if (p := table.pieces.get(data[i:j])) is not None:
                go(j, [*ids, p], weight + table.weights[p])
        w = len(data[i:].decode("utf-8", "ignore")[:1].encode()) if i < len(data) and data[i] & 0xC0 != 0x80 else 0
        if w and data[i : i + w] not in table.pieces:
            own = [table.single[b] for b in data[i : i + w]]
            go(i + w, ids + own, weight + sum(table.weights[p] for p in own))

    go(0, [], 0.0)
    return out


@pytest.mark.parametrize("together_below", [-40.0, -0.5, 0.0])
@pytest.mark.parametrize("text", ["the an", "a  b", "a\n𝄞b"])
def test_samples_without_replacement_have_the_right_distribution(text, together_below):
    table = lattice_sampling.CompiledChunks(lattice_sampling.MODEL)
    options = all_segmentations(table, text)
    p = np.exp([w for _, w in options])
    p = dict(zip([s for s, _ in options], p / p.sum()))
    n = 20_000
    keys = np.random.default_rng(5).integers(0, 1 << 63, n, dtype=np.uint64)
    samples = lattice_sampling.sample_segmentations(table, [text] * n, keys, 3, together_below)
    pairs = Counter((tuple(s[0][3].tolist()), tuple(s[1][3].tolist())) for s in samples)
    for a in p:
        for b in p:
            expected = p[a] * p[b] / (1 - p[a]) if a != b else 0
            assert abs(pairs[a, b] / n - expected) < 0.02
    for s in samples[:100]:
        ids = [tuple(x[3].tolist()) for x in s]
        assert len(set(ids)) == len(ids) == min(3, len(p))
        assert [x[0] for x in s] == sorted((x[0] for x in s), reverse=True)
        assert all(x[1] == pytest.approx(np.log(p[i]), abs=1e-4) for x, i in zip(s, ids))
    # Each sample weighted by probability over inclusion estimates a sum over all segmentations without bias.
    assert np.mean([sum(np.exp(x[1] - x[2]) for x in s) for s in samples]) == pytest.approx(1, abs=0.02)


def test_sampling_round_trip(docs, rows, spark, empty):
    found = lattice_sampling.sample_encodings(docs, k=3).collect()
    texts = dict(rows)
    by_doc = {}
    for r in found:
        assert lattice_sampling.decode(r["ids"]) == (texts[r["doc_id"]] or "")
        assert r["n_ids"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        by_doc.setdefault(r["doc_id"], []).append(tuple(r["ids"]))
    assert by_doc.keys() == texts.keys() and all(len(set(x)) == len(x) <= 3 for x in by_doc.values())
    assert all(len(by_doc[i]) == 1 for i, t in rows if not t)
    again = lattice_sampling.sample_encodings(docs.repartition(1), k=3).collect()
    assert {(r["doc_id"], r["sample_no"], tuple(r["ids"])) for r in again} == {(r["doc_id"], r["sample_no"], tuple(r["ids"])) for r in found}
    assert lattice_sampling.sample_encodings(empty).count() == 0


def test_texts_with_one_segmentation_give_it_alone(spark):
    texts = ["𝄞", "\U000127ac", "𩋝 𦅊", "릍"] * 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = lattice_sampling.sample_encodings(docs, k=3).collect()
    assert {r["doc_id"]: lattice_sampling.decode(r["ids"]) for r in found} == dict(enumerate(texts)) and len(found) == len(texts)
    assert all(r["log_prob"] == r["log_inclusion"] == 0 for r in found)


def test_long_chunks_are_compiled_as_short_ones():
    chunks = [c.encode() for c in ("internationalisation", "a", "né𝄞", "1234567890", "릍릍a릍", "-=" * 20)] + [b" " * 30 + b"the"]
    for c in chunks:
        short, long = (lattice_sampling.CompiledChunks(lattice_sampling.MODEL, 10_000) for _ in range(2))
        short._add(len(c) + 1, [c], short._edges(len(c) + 1, [c]))
        long._add_long(c)
        assert short.known == long.known and short.n == long.n
        for name in ("next", "piece"):
            assert (getattr(short, name)[: short.n] == getattr(long, name)[: long.n]).all()
        assert long.cdf[: long.n] == pytest.approx(short.cdf[: short.n], abs=1e-13)
        assert np.exp(long.log_q[: long.n]) == pytest.approx(np.exp(short.log_q[: short.n]), rel=1e-6)


def test_memory_of_a_text_without_spaces_is_bounded():
    text = "".join(random.Random(6).choices("etaoinshrdlu", k=50_000))
    table, keys = lattice_sampling.CompiledChunks(lattice_sampling.MODEL, 500_000), np.array([7], np.uint64)
    tracemalloc.start()
    try:
        (found,) = lattice_sampling.sample_segmentations(table, [text], keys, 2)
        assert tracemalloc.get_traced_memory()[1] < 400 * len(text)
    finally:
        tracemalloc.stop()
    assert len(found) == 2 and all(lattice_sampling.decode(x[3].tolist()) == text for x in found)


def test_texts_without_spaces_are_learned_a_few_at_a_time(spark):
    rng = random.Random(4)
    texts = {i: "".join(rng.choices("etaoinshrdlu", k=400_000)) for i in range(4)} | {4: "the end"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    found = lattice_sampling.sample_encodings(docs).collect()
    assert len(found) == 10 and all(lattice_sampling.decode(r["ids"]) == texts[r["doc_id"]] for r in found)


def test_sampled_ids_decode_in_a_table(docs, rows, spark):
    assert dict(queries.op3_lattice_sampling(spark, "/root/testdata/sf0.001").dtypes)["ids"] == "array<int>"
    texts = dict(rows)
    found = lattice_sampling.decode_encodings(lattice_sampling.sample_encodings(docs)).collect()
    assert {r["doc_id"] for r in found} == texts.keys() and all(r["text"] == (texts[r["doc_id"]] or "") for r in found)
    odd = spark.createDataFrame([(1, None), (2, []), (3, [10**6]), (4, [-1]), (5, [None])], "n int, ids array<int>")
    assert {r["n"]: r["text"] for r in lattice_sampling.decode_encodings(odd).collect()} == {1: None, 2: "", 3: None, 4: None, 5: None}


# 4 and 9: repeated passages


def cover(units, first, size, doc_id):
    covered = np.zeros(len(units) + 1, int)
    for p in range(len(units) - size + 1):
        if first[units[p : p + size]] < doc_id:
            covered[p] += 1
            covered[p + size] -= 1
    return np.cumsum(covered[:-1]) > 0


def first_ids(units_of, size):
    first = {}
    for i, units in sorted(units_of.items()):
        for p in range(len(units) - size + 1):
            first.setdefault(units[p : p + size], i)
    return first


@pytest.mark.parametrize(("window", "start", "run_bytes"), [(13, 7, 100), (13, 2, 1500), (3, 3, 100)])
def test_substring_dedup(docs, rows, window, start, run_bytes):
    found = {r["doc_id"]: r for r in substring_dedup.remove_repeats(docs, window=window, start=start, slot_bytes=3000, bucket_bytes=400, run_bytes=run_bytes).collect()}
    words = {i: tuple((t or "").encode().split()) for i, t in rows}
    first = first_ids(words, window)
    for i, own in words.items():
        gone = cover(own, first, window, i)
        kept = b" ".join(w for w, g in zip(own, gone) if not g)
        r = found[i]
        assert (r["n_words"], r["n_removed"], r["kept_text"].encode()) == (len(own), gone.sum(), kept)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert any(r["n_removed"] for r in found.values())


def test_substring_dedup_keeps_columns(docs, rows, empty):
    found = substring_dedup.remove_repeats(docs, keep_columns=True)
    assert found.columns == [*docs.columns, "n_removed"] and found.count() == len(rows)
    texts = dict(rows)
    assert all(r["text"] == texts[r["doc_id"]] for r in found.where("n_removed = 0").collect())
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_level_lengths_double():
    assert substring_dedup.level_lengths(13, 7) == [7, 13]
    assert substring_dedup.level_lengths(13, 1) == [1, 2, 4, 7, 13]
    assert substring_dedup.level_lengths(5, 5) == [5]


def test_substring_dedup_tells_words_of_one_pattern_apart(spark):
    """Words that collide under any polynomial hash modulo 2**64."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    tail = " ".join(f"w{i}" for i in range(12))
    found = substring_dedup.remove_repeats(frame(spark, [(1, f"{word} {tail}"), (2, f"{word.translate(str.maketrans('ab', 'ba'))} {tail}"), (3, f"{word} {tail}")]))
    assert {r["doc_id"]: r["n_removed"] for r in found.collect()} == {1: 0, 2: 0, 3: 13}


def test_repeats_of_negative_null_and_repeated_ids(spark, empty):
    words = " ".join(random.Random(2).choices(["alpha", "beta", "gamma", "delta"], k=20))
    given = [(-5, words), (7, words), (7, words), (None, words), (None, None), (None, words), (8, "")]
    n_bytes = len(words)
    for slot_bytes in (1, 1 << 20):
        found = substring_dedup.remove_repeats(frame(spark, given), slot_bytes=slot_bytes, run_bytes=1).collect()
        assert sorted((str(r["doc_id"]), r["n_removed"]) for r in found) == [("-5", 0), ("7", 20), ("7", 20), ("8", 0), ("None", 0), ("None", 20), ("None", 20)]
        found = suffix_family.remove_repeated_bytes(frame(spark, given), slot_bytes=slot_bytes, run_bytes=1).collect()
        assert sorted((str(r["doc_id"]), r["n_removed"]) for r in found) == [("-5", 0), ("7", n_bytes), ("7", n_bytes), ("8", 0), ("None", 0), ("None", n_bytes), ("None", n_bytes)]
    assert suffix_family.remove_repeated_bytes(empty).count() == 0


def expected_bytes(rows, length):
    texts = {i: (t or "").encode() for i, t in rows}
    first = first_ids(texts, length)
    return {i: cover(own, first, length, i) for i, own in texts.items()}, texts


@pytest.mark.parametrize(("length", "gram", "n_batches", "run_bytes"), [(50, 16, 4, 100), (50, 16, 1, 2000), (12, 4, 3, 100), (9, 8, 2, 500)])
def test_suffix_family(docs, rows, length, gram, n_batches, run_bytes):
    found = suffix_family.remove_repeated_bytes(docs, length=length, gram=gram, n_batches=n_batches, slot_bytes=2000, bucket_bytes=400, run_bytes=run_bytes)
    found = {r["doc_id"]: r for r in found.collect()}
    covered, texts = expected_bytes(rows, length)
    for i, own in texts.items():
        gone = covered[i]
        kept = bytes(b for b, g in zip(own, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        r = found[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == (len(own), gone.sum(), spans, kept)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_slots_hold_long_documents_and_survive_any_partitioning(spark):
    """Documents beyond a slot and beyond the pieces in which words are read, with a passage at a piece's edge."""
    rng = random.Random(8)
    passage = " ".join(rng.choices(["kilo", "lima", "mike", "november", "oscar"], k=60))
    filler = lambda n: " ".join(f"{rng.getrandbits(40):x}" for _ in range(n))
    given = [(1, passage), (2, f"{filler(95_320)} {passage} {filler(50_000)} {passage} {filler(10)}"), (3, filler(20))]
    n_words = {i: len(t.split()) for i, t in given}
    for n in (1, 3):
        found = {r["doc_id"]: r for r in substring_dedup.remove_repeats(frame(spark, given).repartition(n), slot_bytes=100_000).collect()}
        assert {i: (r["n_words"], r["n_removed"]) for i, r in found.items()} == {1: (60, 0), 2: (n_words[2], 120), 3: (20, 0)}
        assert found[2]["kept_text"] == given[1][1].replace(f" {passage}", "")
        found = {r["doc_id"]: r for r in suffix_family.remove_repeated_bytes(frame(spark, given).repartition(n), slot_bytes=100_000).collect()}
        assert {i: (r["n_removed"] >= 2 * len(passage), r["n_spans"]) for i, r in found.items()} == {1: (False, 0), 2: (True, 2), 3: (False, 0)}


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_batches_may_arrive_in_any_order(order):
    """Each batch is scanned with what is left of those before it; owners fall and rise."""
    rng, length, gram = np.random.default_rng(3), 12, 4
    texts = [bytes(rng.choice(list(b"ab"), 40)) for _ in range(9)]
    passage = bytes(rng.choice(list(b"cd"), 20))
    texts = [t[:20] + passage[i % 4 :] + t[20:] if i % 2 else t for i, t in enumerate(texts)]
    covered, _ = expected_bytes(list(enumerate(t.decode() for t in texts)), length)
    parts, kept, told = {}, None, {}
    for b in order:
        own = texts[3 * b : 3 * b + 3]
        table = pa.table([pa.array(range(3 * b, 3 * b + 3)), pa.array([t.decode() for t in own])], ["doc_id", "text"])
        slot = suffix_family.SlotBytes(table, [slots.pack_steps(a) for a in suffix_family.find_anchors(*suffix_family.padded(own), length, gram)], length, gram)
        every = np.arange(len(slot.anchors))
        rows_ = slot.rows(every)
        first, which = suffix_family.distinct_rows(rows_)
        least = np.full(len(first), 99)
        np.minimum.at(least, which, slot.ids[slot.doc])
        parts[b] = (slot, which, least)
        fields = [rows_[first], least, np.full(len(first), b), np.arange(len(first)), np.zeros(len(first), np.uint64)]
        if kept is not None:
            fields = [np.concatenate(x) for x in zip(kept, fields)]
        at = suffix_family.byte_order(fields[0])
        entries = suffix_family.Entries(*(f[at] for f in fields), length, gram)
        found = entries.scan()
        for s, n, f in zip(entries.slot.tolist(), entries.number.tolist(), found.tolist()):
            told[s, n] = told.get((s, n), 0) | f
        left = found != entries.every()
        kept = [entries.rows[left], entries.owner[left], entries.slot[left], entries.number[left], found[left]]
    for b, (slot, which, least) in parts.items():
        bits = np.array([told[b, n] for n in range(len(least))], np.uint64)[which]
        bits = np.where(slot.ids[slot.doc] > least[which], suffix_family.all_strings(slot.low, slot.high), bits)
        starts, stops = slot.spans(np.arange(len(slot.anchors)), bits)
        gone = np.zeros(slot.firsts[-1], bool)
        for x, y in zip(starts, stops):
            gone[x:y] = True
        assert (gone == np.concatenate([covered[i] for i in range(3 * b, 3 * b + 3)])).all()


def test_levels_merge_geometrically(spark, docs, monkeypatch):
    sizes = []
    merge = suffix_family.merge_batch
    monkeypatch.setattr(suffix_family, "merge_batch", lambda runs, levels, merged, *rest: sizes.append((len(levels), merged)) or merge(runs, levels, merged, *rest))
    suffix_family.remove_repeated_bytes(docs, n_batches=8, slot_bytes=2000)
    assert sizes == [(0, 0), (1, 1), (1, 0), (2, 2), (1, 0), (2, 1), (2, 0), (3, 3)]


# 5: language identification


def test_language_id(spark):
    rng = random.Random(4)
    syllables = {"aa": ["ba", "be", "bi", "lo"], "bb": ["tsch", "krr", "nk", "po"], "cc": ["éa", "ço", "ù", "né"], "dd": ["ng", "wa", "zi", "mu"]}
    rows = []
    for i in range(400):
        lang = rng.choice(list(syllables))
        rows.append((i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(rng.randint(5, 40))), lang))
    rows += [(400, None, "aa"), (401, "", None), (402, "12 !!", "bb"), (403, "baba lolo", None)]
    docs = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double").repartition(3)
    model = language_id.fit_language_model(docs, F.col("doc_id") % 4 != 2, most_per_language=30)
    assert model.languages == sorted(syllables)
    found = {r["doc_id"]: r for r in language_id.identify_language(docs, model).collect()}
    held = [(i, lang) for i, _, lang in rows[:400] if i % 4 == 2]
    assert sum(found[i]["lang_pred"] == lang for i, lang in held) / len(held) > 0.95
    assert [(found[i]["lang_pred"], found[i]["score"], found[i]["ambiguous"]) for i in (400, 401, 402)] == [("und", 0.0, False)] * 3
    assert found[403]["lang_pred"] == "aa" and all(0 <= r["score"] <= 1 for r in found.values())
    kept = language_id.identify_language(docs, model, keep_columns=True)
    assert kept.columns == [*docs.columns, "lang_pred", "score", "ambiguous"] and kept.count() == len(rows)
    none = language_id.fit_language_model(docs, F.lit(False))
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify_language(docs, none).collect()} == {("und", 0.0)}
    one = language_id.fit_language_model(docs.where("lang = 'cc'"), F.lit(True))
    assert language_id.identify_language(docs.where("doc_id = 403"), one).first()["lang_pred"] == "cc"
    assert language_id.identify_language(docs.where("false"), model).count() == 0


@pytest.mark.parametrize("n", [2, 4, 6, 9, 30])
def test_codewords_differ_in_several_bits(n):
    code = language_id.codewords(n)
    least = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
    assert least >= (1 if n == 2 else 4)


def test_language_decoding_by_brute_force(spark):
    """The least trusted logistic loss over all codewords, its share, and the flag, computed bit by bit."""
    rng, names = np.random.default_rng(2), [f"l{i}" for i in range(7)]
    code = language_id.codewords(7)
    bits = code.shape[1]
    trust = rng.random(bits)
    model = language_id.LanguageModel(names, code, rng.standard_normal((language_id.DIMS, bits)), rng.standard_normal(bits), trust / trust.sum())
    texts = [(i, t) for i, t in enumerate(["abc", "Ünder the sea", "x", "1 2 3", None, "", "the " * 500, "ab ab ba", "zz top"])] + [(7, "ab ab ba"), (None, "abc")]
    found = language_id.identify_language(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    assert len(found) == len(texts)
    for (i, text), r in zip(sorted(texts, key=str), sorted(found, key=lambda r: str((r["doc_id"], dict(texts).get(r["doc_id"]))))):
        assert r["doc_id"] == i
        if not text or not any(map(str.isalpha, text)):
            assert (r["lang_pred"], r["score"], r["ambiguous"]) == ("und", 0.0, False)
            continue
        x = language_id.features(text)
        losses = []
        for word in code:
            loss = 0.0
            for b in range(bits):
                margin = sum(x[d] * model.weights[d, b] for d in np.flatnonzero(x)) + model.offsets[b]
                loss += model.trust[b] * np.log1p(np.exp(-margin * word[b]))
            losses.append(loss)
        shares = np.exp(-4.0 * np.array(losses))
        shares /= shares.sum()
        assert r["lang_pred"] == names[int(np.argmin(losses))] and r["score"] == pytest.approx(shares.max()) and r["ambiguous"] == (shares.max() < 0.6)


# 6: SimHash near-dedup


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, doc in enumerate(ids):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return {doc: least[root(i)] for i, doc in enumerate(ids)}


def test_simhash(docs, rows, empty):
    found = {r["doc_id"]: r for r in simhash.simhash_components(docs).collect()}
    ids, prints = [i for i, _ in rows], [slow_fingerprint(t) for _, t in rows]
    expected = slow_components(ids, prints)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in found.items()} == {i: (f"{p:016x}", expected[i]) for i, p in zip(ids, prints)}
    assert simhash.simhash_components(empty).count() == 0


@pytest.mark.parametrize("hot_rows", [100_000, 3])
def test_covering_tables_miss_no_pair(spark, hot_rows):
    rng = random.Random(8)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        p = rng.getrandbits(64)
        for _ in range(12):  # chains of neighbours
            prints.add(p)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                p ^= 1 << b
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.print_links(spark.createDataFrame(signed, "print long").repartition(3), 3, hot_rows)
    roots = {r["node"] % (1 << 64): r["root"] for r in components(links).collect()}
    expected = slow_components(prints, prints)
    for p in prints:
        for q in prints[:60]:
            assert (expected[p] == expected[q]) == (p == q or (p in roots and q in roots and roots[p] == roots[q]))
    masks = simhash.covering_masks(3)
    for _ in range(2000):
        differing = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not m & differing for m in masks)


@pytest.mark.parametrize("all_pairs", [32, 3])
def test_near_copies_are_those_of_brute_force(spark, empty, all_pairs, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefghijklmnopqrst", k=100)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, "") for i in range(2)] + [(None, None), (None, texts[0])]
    for i in range(60):
        words = texts[i % 6 if i < 20 else 0].split()
        words[rng.randrange(100)] = words[rng.randrange(100)] = "new"
        rows.append((200 + i, " ".join(words)))
    links = near_copies.similar_links
    monkeypatch.setattr(near_copies, "similar_links", lambda *a: links(*a, all_pairs=all_pairs))
    found = {(r["doc_id"], r["text_hash"]): r["component_id"] for r in near_copies.near_copies(frame(spark, rows)).collect()}
    sets = [set(near_copies.shingle_set(t).tolist()) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    ids = [i for i, _ in rows]
    want = {i: min((ids[j] for j in g if ids[j] is not None), default=None) for g in slow_groups(range(len(rows)), pairs) for i in g}
    assert Counter(found.values()) == Counter(want.values()) and all(found[k] == want[ids.index(k[0])] for k in found if k[0] is not None)
    assert near_copies.near_copies(empty).count() == 0


@pytest.mark.parametrize("block", [1024, 7])
def test_hubs_lose_no_link_of_a_bucket(spark, monkeypatch, block):
    """All texts in one bucket: close copies of a text, and pairs of which only one is similar to it."""
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(400)]

    def changed(words, places):
        return [f"new{rng.random()}" if i in places else w for i, w in enumerate(words)]

    texts = [base] + [changed(base, {rng.randrange(400)}) for _ in range(45)]
    for i in range(12):
        inner = changed(base, set(range(i, 400, 57)))
        texts += [inner, changed(inner, set(range(i + 28, 400, 57)))]
    texts = [" ".join(t) for t in texts]
    sets = [set(near_copies.shingle_set(t).tolist()) for t in texts]
    pairs = [(j, i) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert all((i, i + 1) in pairs and (0, i) in pairs and (0, i + 1) not in pairs for i in range(46, 70, 2))
    monkeypatch.setattr(near_copies, "_buckets", lambda *_: spark.createDataFrame([(0, 0, i, len(s)) for i, s in enumerate(sets)], "t int, key long, print long, size long"))
    links = near_copies.similar_links(spark.createDataFrame(list(enumerate(texts)), "print long, text string").repartition(3), 0.8, 5)
    found = {tuple(r) for r in links.collect()}
    assert found <= set(pairs)
    assert slow_groups(range(len(texts)), found) == slow_groups(range(len(texts)), pairs)


def test_links_of_a_large_group_grow_with_its_texts(spark, monkeypatch):
    """Copies of a text of which many pairs are just under the threshold: few are compared, and the classes are those of all pairs."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    texts = [base] + [[f"new{rng.random()}" if rng.random() < 0.02 else w for w in base] for _ in range(160)]
    texts = [" ".join(t) for t in texts]
    sets = [set(near_copies.shingle_set(t).tolist()) for t in texts]
    shares = {(j, i): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(texts)) for j in range(i)}
    pairs = [p for p, share in shares.items() if share >= 0.8]
    assert len([s for s in shares.values() if 0.6 <= s < 0.8]) > 3000
    monkeypatch.setattr(near_copies, "_buckets", lambda *_: spark.createDataFrame([(0, 0, i, len(s)) for i, s in enumerate(sets)], "t int, key long, print long, size long"))
    found = [tuple(r) for r in near_copies.similar_links(spark.createDataFrame(list(enumerate(texts)), "print long, text string").repartition(3), 0.8, 5).collect()]
    assert set(found) <= set(pairs) and len(found) < 6 * len(texts)
    assert slow_groups(range(len(texts)), found) == slow_groups(range(len(texts)), pairs)


@pytest.mark.parametrize("block", [1024, 7])
def test_blocks_of_a_bucket_miss_no_similar_pair(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rng = random.Random(3)
    base = [rng.choices("abcdefghijklmnop", k=150) for _ in range(4)]
    texts = []
    for i in range(40):
        words = list(base[i % 4])
        for _ in range(rng.choice([0, 1, 2, 8])):
            words[rng.randrange(150)] = f"new{rng.random()}"
        texts.append((i, " ".join(words)))
    sets = [set(near_copies.shingle_set(t).tolist()) for _, t in texts]
    left = [(t, 5, i, len(sets[i])) for t in (0, 1) for i in range(t, 40)] + [(2, 6, 39, len(sets[39]))]
    found = near_copies._agreeing(spark.createDataFrame(left, "t int, key long, print long, size long").repartition(3), spark.createDataFrame(texts, "print long, text string"), 0.8, 5)
    found = {tuple(r) for r in found.collect()}
    alike = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(40) for j in range(i + 1, 40)}
    assert {p for p, s in alike.items() if s >= 0.8} <= found and all(alike[p] > 0.4 for p in found)


def test_large_buckets_link_the_same():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    prints = np.unique(np.concatenate([base, *(base ^ (np.uint64(1) << np.uint64(b)) for b in range(0, 60, 3))]))
    join = lambda links: slow_groups(prints.tolist(), links)
    assert join(simhash.links_within(prints, 3)) == join(simhash.links_within(prints, 3, direct=10))
    assert len(simhash.links_within(prints, 3, direct=10)) < len(prints)


def slow_groups(nodes, links):
    group = {n: {n} for n in nodes}
    for a, b in links:
        both = group[a] | group[b]
        for n in both:
            group[n] = both
    return {frozenset(g) for g in group.values()}


def test_components_of_chains_and_stars(spark, empty):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 80)] + [(7, 7), (60, 50), (60, 50)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    got = {r["node"]: r["root"] for r in found.collect()}
    assert found.count() == len(got)
    assert got == {i: 0 for i in [*range(51), 60]} | {1000 + i: 1000 for i in range(80)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 7: token counts


def test_token_counts(docs, rows, empty):
    words = WordTokenizer(token_counts.VOCABULARY)
    lengths = sorted(len(words.tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in rows)
    histogram = token_counts.length_histogram(docs).cache()
    for r in histogram.collect():
        n = r["n_tokens"]
        assert (r["n_docs"], r["n_tokens_total"]) == (lengths.count(n), n * lengths.count(n))
        assert r["docs_at_least"] == sum(x >= n for x in lengths) and r["tokens_at_least"] == sum(x for x in lengths if x >= n)
        assert r["truncated_total"] == sum(min(x, n) for x in lengths)
        assert r["share_at_most"] == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    assert {r["n_tokens"] for r in histogram.collect()} == set(lengths)
    limits = [0, 1, 50, 10**6]
    assert [r["total"] for r in token_counts.truncated_totals(histogram, limits).collect()] == [sum(min(x, n) for x in lengths) for n in limits]
    assert [r["n_tokens"] for r in token_counts.length_quantiles(histogram, [0.5, 1.0]).collect()] == [lengths[-(-len(lengths) // 2) - 1], lengths[-1]]
    none = token_counts.length_histogram(empty)
    assert none.count() == 0 and token_counts.truncated_totals(none, [5]).first()["total"] == 0


@pytest.mark.parametrize("most_words", [5, 100_000])
def test_word_tokens_are_the_tokenizers(rows, most_words):
    words = WordTokenizer(token_counts.VOCABULARY, most_words)
    odd = ["İstanbul Foo, bar!!! x=≠ a'sb don't <|endoftext|>z  q 12.5kg \x1f a\x1cb ΑΣ. ß ﬁ é é.", "!!", "a., b,, c,d", "<|ENDOFTEXT|>", "中文, 日本。"]
    for text in [t for _, t in rows] + odd:
        assert np.frombuffer(words.ids(text), "<u2").tolist() == words.tokenizer.encode(text or "", add_special_tokens=False).ids


# 8: packing


def test_packing(docs, rows, empty):
    words = WordTokenizer(packing.VOCABULARY)
    ids = {i: np.append(np.frombuffer(words.ids(t), "<u2").astype("<u4"), 2).astype("<u4") for i, t in rows}
    found = packing.pack_documents(docs, length=64, with_ids=True).collect()
    at, places = {}, {}
    for r in sorted(found, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        piece = own[r["start"] : r["start"] + r["length"]]
        assert r["start"] == at.get(r["doc_id"], 0) and r["doc_tokens"] == len(own) and r["ids"] == piece.tolist()
        assert r["ids_crc32"] == zlib.crc32(piece.tobytes())
        at[r["doc_id"]] = r["start"] + r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert at == {i: len(x) for i, x in ids.items()}
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
    full = [sum(n for _, n in own) for own in places.values()]
    assert max(full) <= 64 and sum(x < 64 for x in full) <= 1  # only the last sequence is padded
    assert packing.pack_documents(empty).count() == 0


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 2), (4, 2)])
def test_hilbert_keys_walk_the_grid_in_unit_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = packing.hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


# 10: approximate nearest neighbours


def test_permutation_index(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, rng.standard_normal(16).tolist()) for i in range(600)]
    vectors += [(600 + i, vectors[3][1]) for i in range(40)]  # many copies
    vectors += [(700, None), (701, [0.0] * 16), (702, [float("nan")] * 16), (703, [None] + [1.0] * 15), (704, [1.0]), (None, [1.0] * 16), (705, [1e30] * 16), (706, [2e-30] * 16)]
    table = spark.createDataFrame([(*v, 1.5) for v in vectors], "vec_id long, embedding array<float>, score double").repartition(4)
    found = permutation_index.permutation_search(table, F.col("vec_id") % 10 == 0, n_pivots=32, post_in=6, read_from=16, rerank_share=0.3, block_rows=100)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    good = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in vectors if i is not None and v and len(v) == 16 and i not in (701, 702, 703)]
    ids, m = np.array([i for i, _ in good]), np.array([v for _, v in good])
    m /= np.abs(m).max(axis=1, keepdims=True)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    hits = total = 0
    assert got.keys() == {i for i in ids.tolist() if i % 10 == 0}
    for query, own in got.items():
        score = m @ m[ids == query][0]
        order = [k for k in np.lexsort((ids, -score.round(12))) if ids[k] != query][:5]
        assert len(own) == 5 and [r for *_, r in own] == [1, 2, 3, 4, 5] and query not in [i for i, *_ in own]
        assert all(s == pytest.approx(score[ids == i][0]) for i, s, _ in own)
        hits, total = hits + len({ids[k] for k in order} & {i for i, *_ in own}), total + 5
    assert hits / total > 0.9
    assert [i for i, *_ in got[600]] == [3, 601, 602, 603, 604]  # equal vectors by id
    few = permutation_index.permutation_search(table.where("vec_id < 3"), F.col("vec_id") == 0)
    assert sorted(r["vec_id"] for r in few.collect()) == [1, 2]
    assert permutation_index.permutation_search(table.where("false"), F.lit(True)).count() == 0


def test_vectors_of_every_length_repeated_ids_and_ties(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.standard_normal(8 if i % 3 else 5).tolist()) for i in range(300)]
    rows += [(300, [1.0, 2.0]), (301, [2.0, 4.0]), (302, [3.0]), (303, [])]
    rows += [(7, rows[10][1]), (7, [-x for x in rows[10][1]]), (10, rows[11][1]), (1000, rows[10][1]), (1001, rows[10][1])]
    for kind in ("float", "double", "int"):
        own = [(i, [int(9 * x) for x in v] if kind == "int" else v) for i, v in rows]
        table = spark.createDataFrame(own, f"vec_id long, embedding array<{kind}>").repartition(3)
        found = permutation_index.permutation_search(table, F.col("vec_id") % 5 == 0, n_pivots=16, read_from=16, rerank_share=1.0, block_rows=50).collect()
        m = [(i, np.array(v, np.float32 if kind == "float" else np.float64).astype(np.float64)) for i, v in own]
        m = [(i, v / np.linalg.norm(v)) for i, v in m if len(v) and np.linalg.norm(v)]
        got = {}
        for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        for query in {i for i, _ in m if i % 5 == 0}:
            best = {}
            for u in (v for i, v in m if i == query):
                for i, v in m:
                    if i != query and len(v) == len(u):
                        best[i] = max(best.get(i, -9), float(u @ v))
            expected = sorted(best.items(), key=lambda x: (-round(x[1], 9), x[0]))[:5]
            assert [(i, round(s, 6)) for i, s in sorted(got.get(query, []), key=lambda x: (-round(x[1], 9), x[0]))] == [(i, round(s, 6)) for i, s in expected]


def test_recall_and_hot_copies(spark):
    """Settings of the registered query: recall at 5 against brute force, also where a third of the vectors are one point, and for any block size."""
    rng = np.random.default_rng(9)
    base = rng.standard_normal((1500, 24)).astype(np.float32)
    base[1000:] = base[7]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id long, embedding array<float>").repartition(4)
    u = base.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    for block_rows in (8192, 40):
        found = permutation_index.permutation_search(table, F.col("vec_id") % 50 == 0, block_rows=block_rows).collect()
        hits = total = 0
        for query in range(0, 1500, 50):
            score = u @ u[query]
            score[query] = -9
            least = np.sort(score)[-5]
            own = [r["score"] for r in found if r["query_id"] == query]
            assert len(own) == 5
            hits, total = hits + sum(s >= least - 1e-12 for s in own), total + 5
        assert hits / total > 0.9
