"""The pipeline's stages on small planted tables."""

import random

import corpus_pipeline
import duckdb
import pytest
from tilewright.llm import queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    return " ".join("".join(rng.choices(["th", "er", "an", "in", "on", "st"], k=rng.randint(1, 4))) for _ in range(n))


def planted(spark):
    rng = random.Random(1)
    texts = [sentence(rng, 80) for _ in range(40)]
    passage = sentence(rng, 60)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(100, texts[0], "en", "s", 1), (101, texts[0], "en", "s", 1), (102, f"{texts[1]} {passage}", "en", "s", 1), (103, f"{passage} {texts[2]}", "en", "s", 1)]
    rows += [(104, None, "en", "s", None), (105, "123 %%", None, None, 6), (106, passage, "en", None, 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), texts, passage


def test_stages(spark, tmp_path):
    docs, texts, passage = planted(spark)
    step = dict(corpus_pipeline.STAGES)
    told = step["language_id"](spark, docs, "")
    assert told.columns == docs.columns
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in told.collect()} == {104, 105}
    single = step["exact_dedup"](spark, docs, "")
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in single.collect()} == {0, 100}
    near = step["simhash_near_dedup"](spark, docs, "")
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in near.collect()}
    assert {100, 101} <= gone and len(gone) <= 4
    cut = {r["doc_id"]: r for r in step["substring_dedup"](spark, docs, "").collect()}
    assert cut[102]["text"] == passage and cut[1]["text"] == texts[1] and cut[102]["n_chars"] == len(passage)
    assert 103 not in cut and 106 not in cut and 100 not in cut and cut[104]["text"] is None  # nothing was left of those
    packed = step["packing"](spark, docs, "")
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}


def words_changed(rng, text, n):
    words = text.split()
    for i in range(n):
        words[(2 * i + 1) * len(words) // (2 * n)] = f"new{rng.random()}"
    return " ".join(words)


def test_near_copies_barely_over_the_threshold_go(spark):
    rng = random.Random(2)
    base = [sentence(rng, 500) for _ in range(12)]
    # 10 of 500 words changed: 446 of 546 shingles in common (0.82); 16: 416 of 576 (0.72).
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, words_changed(rng, t, 10)) for i, t in enumerate(base)]
    rows += [(200, words_changed(rng, base[0], 16)), (None, "all alone here now then"), (7, "another text of the id seven")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).repartition(3)
    near = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, "").collect()
    assert {(r["doc_id"], r["text"]) for r in near} == {r for r in rows if r[0] is None or r[0] < 100 or r[0] == 200}


def test_run(spark, tmp_path):
    docs, texts, _ = planted(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path))
    ids = {r["doc_id"] for r in packed.collect()}
    assert {0, 100, 104, 105} & ids == set() and set(range(1, 40)) - {2} <= ids and 101 in ids


def test_stages_on_repeated_rows_null_ids_and_clashing_names(spark):
    """Each stage: columns named like its own, none called n_chars, repeated rows and ids, null ids; and no rows at all."""
    rng = random.Random(5)
    long = sentence(rng, 500)
    near = words_changed(rng, long, 10)
    rows = [(1, long), (1, long), (2, long), (3, "once only here"), (3, "once only here"), (3, "another text of three"), (None, "without an id"), (None, "without an id"), (None, long), (4, near), (4, near), (None, None), (9, None), (9, ""), (10, " ")]
    extra = ["n_removed", "removed", "lang_pred", "score", "ambiguous", "kept", "kept_hash", "stays_id", "stays_hash", "n", "slot", "own_0", "text_hash"]
    docs = spark.createDataFrame([(i, t, "en", *["x"] * len(extra)) for i, t in rows], "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in extra)).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    got = {name: step(spark, docs, "") for name, step in stages.items()}
    assert all(got[n].columns == docs.columns for n in stages if n != "packing")
    assert sorted(((r["doc_id"], r["text"]) for r in got["exact_dedup"].collect()), key=str) == sorted([(2, long), (3, "once only here"), (3, "another text of three"), (None, "without an id"), (4, near), (9, got["exact_dedup"].where("doc_id = 9").first()["text"]), (10, " ")], key=str)
    left = {(r["doc_id"], r["text"]) for r in got["simhash_near_dedup"].collect()}
    assert {(1, long), (3, "once only here"), (3, "another text of three"), (None, "without an id")} <= left and not {(2, long), (4, near), (None, long)} & left
    assert got["simhash_near_dedup"].count() == len(left)
    assert got["packing"].where("start = 0").count() == len(rows)
    assert got["substring_dedup"].count() <= len(rows) and {r["n_removed"] for r in got["substring_dedup"].collect()} == {"x"}
    assert all(step(spark, docs.where("false"), "").count() == 0 for step in stages.values())


def similar(a, b):
    sets = []
    for t in (a, b):
        w = (t or "").lower().split()
        sets.append({" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    return len(sets[0] & sets[1]) >= 0.8 * len(sets[0] | sets[1])


def test_stages_against_brute_force(spark):
    """Copies, near copies and repeated passages of a small table, stage by stage."""
    rng = random.Random(9)
    base = [sentence(rng, rng.randint(30, 120)) for _ in range(25)]
    passage = sentence(rng, 40)
    texts = base + base[:6] + [words_changed(rng, t, 1) for t in base[3:12]] + [f"{t} {passage}" for t in base[12:20]] + ["short text", "short text"]
    rng.shuffle(texts)
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    last = {t: i for i, t in enumerate(texts)}
    once = stages["exact_dedup"](spark, docs, "").cache()
    assert {r["doc_id"] for r in once.collect()} == set(last.values())
    root = {i: i for i in last.values()}
    for i in sorted(root):
        for j in sorted(root):
            if i < j and similar(texts[i], texts[j]):
                a, b = root[i], root[j]
                root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    near = stages["simhash_near_dedup"](spark, once, "").cache()
    assert {r["doc_id"] for r in near.collect()} == set(root.values()) != set(root)
    first = {}
    for i in sorted(set(root.values())):
        words = texts[i].split()
        for p in range(len(words) - 12):
            first.setdefault(tuple(words[p : p + 13]), i)
    expected = {}
    for i in sorted(set(root.values())):
        words = texts[i].split()
        gone = {q for p in range(len(words) - 12) if first[tuple(words[p : p + 13])] < i for q in range(p, p + 13)}
        if len(gone) < len(words):
            expected[i] = " ".join(w for q, w in enumerate(words) if q not in gone)
    cut = stages["substring_dedup"](spark, near, "")
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()} == {i: (t, len(t)) for i, t in expected.items()}
    assert any(len(t) < len(texts[i]) for i, t in expected.items())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_queries_run_on_the_small_tables(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    rows = df.collect()
    assert rows and len(set(df.columns)) == len(df.columns)
    if name in queries.ORACLE_SQL:
        duck = duckdb.connect()
        for table in ("documents", "embeddings", "conversations"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
        found = duck.execute(queries.ORACLE_SQL[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == sorted(df.columns)
        assert sorted(map(repr, found.fetchall())) == sorted(repr(tuple(r[n] for n in names)) for r in rows)
