"""Vector codes, exact products and conversation trees against brute force, and their defined results at the edges."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tilewright.llm import bit_sliced, lloyd_codes, prefix_tree, queries

VECTORS = "vec_id long, embedding array<double>, label int, x string, pack long, code string, row_block int, score string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, "c", 2, "s") for i, v, label in rows], VECTORS).repartition(3)


def some_rows(n=300, dim=8, seed=5):
    rng = random.Random(seed)
    rows = [(i, [round(rng.gauss(0, 1), 3) for _ in range(dim)], rng.choice([1, 2, None])) for i in range(n)]
    rows += [(i, list(rows[7][1]), 1) for i in range(n, n + 150)]  # a third of all are one vector
    rows += [(900, None, 1), (901, [], 2), (902, [1.0, None] * 4, 1), (903, [math.nan] + [0.0] * 7, 1), (904, [math.inf] * 8, 1), (905, [0.0] * 8, None)]
    rows += [(3, list(rows[3][1]), 2), (3, [0.5] * 8, 1), (None, [0.25] * 8, None), (-20, [-1.5] * 8, 1), (906, [1.0, 2.0], 1)]
    rng.shuffle(rows)
    return rows


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def lloyd_by_hand(rows, scale, n_parts, n_entries, rounds):
    good = sorted((r for r in rows if usable(r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(r[1]) for r in good) // n_parts) * n_parts
    x = np.array([[math.floor(scale * c) for c in r[1]] + [0] * (width - len(r[1])) for r in good]).reshape(len(good), n_parts, -1)
    books = x[:n_entries].transpose(1, 0, 2).copy()
    near = lambda p: (((x[:, p, None] - books[p][None]) ** 2).sum(axis=2)).argmin(axis=1)
    for _ in range(rounds):
        for p in range(n_parts):
            own = near(p)
            for e in set(own):
                books[p, e] = x[own == e, p].sum(axis=0) // (own == e).sum()
    codes = np.stack([near(p) for p in range(n_parts)], axis=1)
    errors = [int(sum(((x[i, p] - books[p][c]) ** 2).sum() for p, c in enumerate(own))) for i, own in enumerate(codes)]
    of_label = collections.Counter()
    for r, e in zip(good, errors):
        of_label[r[2]] += e
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted((repr((r[0], "".join(f"{c:02x}" for c in own), e, of_label[r[2]], digest)) for r, own, e in zip(good, codes, errors)))


@pytest.mark.parametrize(("n_parts", "n_entries", "rounds", "pack_rows"), [(4, 16, 4, 4096), (3, 300, 2, 7), (1, 5, 3, 50), (4, 16, 0, 50)])
def test_lloyd_codes(spark, n_parts, n_entries, rounds, pack_rows):
    rows = some_rows()
    got = lloyd_codes.lloyd_codes(vectors(spark, rows), scale=16, n_parts=n_parts, n_entries=n_entries, rounds=rounds, pack_rows=pack_rows).collect()
    if n_entries <= 256:
        assert sorted(repr(tuple(r)) for r in got) == lloyd_by_hand(rows, 16, n_parts, n_entries, rounds)
    else:
        assert {len(r["code"]) for r in got} == {3 * n_parts}


def test_lloyd_codes_of_floats_and_of_few(spark):
    df = spark.createDataFrame([(1, [0.1, 0.2], None), (0, [0.1, -0.2], None)], "vec_id long, embedding array<float>, label string")
    got = sorted(map(tuple, lloyd_codes.lloyd_codes(df, n_parts=2).collect()))
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [(0, "0000", 0, 0), (1, "0001", 0, 0)]
    assert got[0][4] == hashlib.sha256(b"102,102,-205,204").hexdigest()
    assert lloyd_codes.lloyd_codes(df.limit(0)).collect() == [] == lloyd_codes.lloyd_codes(df.where("false")).collect()
    nothing = lloyd_codes.lloyd_codes(df.withColumn("embedding", F.slice("embedding", 1, 0))).collect()
    assert [(r["code"], r["error"]) for r in nothing] == [("00000000", 0)] * 2


def test_only_changed_parts_contribute(spark):
    rows = [r for r in some_rows() if usable(r[1])]
    packs = lloyd_codes.pack_vectors(vectors(spark, rows), "vec_id", "embedding", "label", 16, 4, 16, 50)
    books = packs.first.astype(np.int64).reshape(-1, 4, 2).transpose(1, 0, 2)
    first = lloyd_codes.assign_round(packs, None, books)
    total = lambda df: df.agg(F.sum("n_changed"), F.sum(F.size("places"))).first()
    assert total(first)[0] == 4 * len(rows)
    again = lloyd_codes.assign_round(packs, first, books)
    assert tuple(total(again)) == (0, 0)
    moved = books.copy()
    moved[2, 0] += 5  # one part's codebook moves: only its entries may get contributions
    changed = lloyd_codes.assign_round(packs, first, moved)
    places = {p for r in changed.select("places").collect() for p in r["places"]}
    assert places and all(p // (16 * 3) == 2 for p in places) and 0 < total(changed)[0] < len(rows)
    plan = changed.sparkSession.createDataFrame([], "i int")._jdf  # the state meets its vectors without a shuffle
    joined = packs.table.select("pack", "x").join(first.select("pack", "codes").hint("shuffle_hash"), "pack")
    assert plan is not None and "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_nearest_is_exact_for_large_components():
    rng = np.random.default_rng(1)
    x, entries = rng.integers(-(2**24), 2**24, (50, 16)), rng.integers(-(2**24), 2**24, (9, 16))
    assert (lloyd_codes.nearest(x, entries) == ((x[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert lloyd_codes.scaled(np.array([1e300, -1e300, 0.999]), np.array([3]), 4, 1024).tolist() == [[2**24, -(2**24), 1022, 0]]


# exact products


def products_by_hand(rows, k, scale):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v, _ in rows if i is not None and usable(v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in good if i % 20 == 0}:
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))[:k]
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize(("block_rows", "block_queries", "k"), [(16384, 512, 20), (70, 4, 5), (16, 512, 200)])
def test_top_products(spark, block_rows, block_queries, k):
    rows = some_rows() + [(20, [0.1] * 8, 1), (40, list(some_rows()[0][1] or [1.0] * 8), 1), (60, [], None)]
    got = bit_sliced.top_products(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=k, block_rows=block_rows, block_queries=block_queries)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == products_by_hand(rows, k, 64)


def test_top_products_of_nothing_and_of_huge(spark):
    rows = vectors(spark, [(0, [1e300, -1.0], 1), (1, [1e300, 2.0], 1), (2, None, 1)])
    found = bit_sliced.top_products(rows, F.col("vec_id") == 0).collect()
    assert [(r["vec_id"], r["score"] > 2**60) for r in found] == [(1, True)]
    assert bit_sliced.top_products(rows.where("false"), F.lit(True)).collect() == []
    assert bit_sliced.top_products(rows, F.lit(None).cast("boolean")).collect() == []
    assert bit_sliced.top_products(rows.where("vec_id = 0"), F.lit(True)).collect() == []


@given(st.integers(0, 2**40) | st.integers(-(2**40), 0))
def test_signed_digits_add_up_and_are_sparse(weight):
    digits = bit_sliced.signed_digits(weight)
    assert sum(s << p for s, p in digits) == weight
    assert all(b - a > 1 for (_, a), (_, b) in zip(digits, digits[1:]))


@settings(deadline=None)
@given(st.integers(1, 200), st.integers(0, 6), st.integers(1, 30), st.integers(0, 2**31))
def test_slices_give_products_and_best_rows(n, dim, k, seed):
    rng = np.random.default_rng(seed)
    x, q = rng.integers(-9, 9, (n, dim)), rng.integers(-40, 40, dim)
    least, widths, slices = bit_sliced.slice_rows(x)
    score, constant = bit_sliced.score_slices(q, least, widths, slices, ~slices)
    assert bit_sliced.read_scores(score, np.arange(n), constant) == (x @ q).tolist()
    allowed = rng.integers(0, 2, n).astype(np.uint8)
    bits = np.zeros(-(-n // 64) * 8, np.uint8)
    bits[: -(-n // 8)] = np.packbits(allowed, bitorder="little")
    rows = bit_sliced.top_rows(score, bits.view(np.uint64), k)
    assert sorted(rows.tolist()) == sorted(sorted(np.flatnonzero(allowed), key=lambda i: (-(x[i] @ q), i))[:k])


# conversation trees

TURNS = "conv_id long, turn long, role string, text string, path string, node string, depth string, base int"


def turn_key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def tree_of(sequences):
    """Nodes of ``{conv: sequence of (role, text)}``."""
    members, children, leaves, saved = collections.defaultdict(list), collections.defaultdict(set), collections.Counter(), collections.Counter()
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[: d - 1]].add(s[:d])
    for s, own in members.items():
        for d in range(len(s) + 1):
            saved[s[:d]] += (len(own) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
            leaves[s[:d]] += not children[s]
    ends = {s: ",".join(map(str, sorted(c for c in own if sequences[c] == s))) for s, own in members.items()}
    return sorted(repr((min(own), len(s), min(members[s[:-1]]) if s else None, len(own), len(children[s]), leaves[s], saved[s], hashlib.sha256(ends[s].encode()).hexdigest())) for s, own in members.items())


def rebuilt_by_hand(rows):
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, turn_key(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:])
    return out


def some_turns(seed=2):
    rng = random.Random(seed)
    rows = []
    for c in [*range(140), *range(-45, -1, 3), 10**12]:
        if c % 20 == 0 and c % 60:
            continue  # some bases are absent
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "user", None, "1"]), rng.choice(["a", "a b", "", None, " \t", ":a"])))
    rows += [(c, t, "user", f"same words {t}") for c in range(200, 380) if c % 20 for t in range(6)]  # one conversation for half of all; no bases
    rows += [(500, t, "user", "long " * (t % 3)) for t in range(300)] + [(501, t, "user", "long " * (t % 3)) for t in range(260)]
    rows += [rows[4], rows[4], (None, 0, "user", "nobody's"), (7, 3, "user", "x"), (7, 3, "user", "w")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("ranges", [1, 4, 23])
def test_conversation_tree(spark, ranges):
    rows = some_turns()
    turns = spark.createDataFrame([(*r, "p", "n", "d", 1) for r in rows], TURNS).repartition(3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefix_tree.conversation_tree(turns)
        assert got.columns == prefix_tree.NODES
        assert sorted(repr(tuple(r)) for r in got.collect()) == tree_of(rebuilt_by_hand(rows))
        assert prefix_tree.conversation_tree(turns.where("false")).collect() == []
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_conversations_without_turns_are_members_of_the_root(spark):
    few = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3][:2]
    rows = [(c, 0, "user", "gone") for c in few]
    got = prefix_tree.conversation_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [tuple(r) for r in got] == [(few[0], 0, None, 2, 0, 1, 0, hashlib.sha256(f"{few[0]},{few[1]}".encode()).hexdigest())]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text("ab", max_size=5), min_size=1, max_size=14), st.randoms(use_true_random=False))
def test_ranges_may_be_cut_anywhere(texts, rng):
    """Trees of ranges, seams merged, edges expanded by hand, against nodes by brute force."""
    sequences = {i: tuple(("user", x) for x in t) for i, t in enumerate(texts)}
    paths = sorted((b"".join(bytes.fromhex(turn_key(*t)) for t in s), i) for i, s in sequences.items())
    words = {i: [1] * len(s) for i, s in sequences.items()}
    cuts = sorted(rng.sample(range(len(paths) + 1), min(3, len(paths))))
    points, seams, pieces = [], [], collections.defaultdict(list)
    for no, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(paths)])):
        tree, rows = prefix_tree.RangeTree(no), []
        for path, i in paths[a:b]:
            rows += tree.add(i, path, words[i])
        for r in [*rows, *tree.finish()]:
            r |= {"range_no": no}
            (points if r["kind"] == "point" else seams if r["kind"] == "seam" else pieces[r["node"]]).append(r)
    merged = prefix_tree.merge_seams(seams)
    ids = {r["node"]: r["conv_id"] for r in merged}
    out = [(r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], hashlib.sha256(b",".join(p["ends"] for p in pieces[r["node"]])).hexdigest()) for r in merged]
    for r in points:
        up, sums = ids[r["parent"]] if r.get("parent") else r["parent_conv_id"], r["edge_sums"]
        for place in range(len(sums) + 1):
            last = place == len(sums)
            saved = r["saved_tokens"] + (0 if last else (r["n_convs"] - 1) * sums[place])
            out.append((r["conv_id"], r["depth"] - len(sums) + place, up if not place else r["conv_id"], r["n_convs"], r["n_children"] if last else 1, r["n_leaves"], saved, r["ends_sha256"] if last else prefix_tree.NOTHING))
    assert sorted(map(repr, out)) == tree_of(sequences)


def test_points_are_branches_ends_and_leaves_only(spark):
    """A long chain that nothing leaves is one edge."""
    rows = [(c, t, "user", f"{c % 2} {t}") for c in (1001, 1002, 1003, 1004) for t in range(50)]
    paths = prefix_tree.rebuilt_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    tree = prefix_tree.compressed_tree(paths.coalesce(1))
    points = tree.where("kind = 'point'").collect()
    assert all(r["n_children"] != 1 or r["ends_sha256"] != prefix_tree.NOTHING for r in points)
    assert prefix_tree.common_depth(b"a" * 160, b"a" * 96 + b"b" * 64) == 6 and prefix_tree.common_depth(b"", b"a" * 16) == 0


def test_registered_queries_have_sql():
    assert {"op11_lloyd_codes", "op12_bit_sliced", "op13_prefix_tree"} <= set(queries.ORACLE_SQL) & set(queries.QUERIES)
