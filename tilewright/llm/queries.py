"""The operators as registered queries over the synthetic tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm.bit_sliced import top_products
from tilewright.llm.exact_dedup import exact_dedup
from tilewright.llm.language_id import fit_language_model, identify_language
from tilewright.llm.lattice_sampling import sample_encodings
from tilewright.llm.lloyd_codes import lloyd_codes
from tilewright.llm.packing import pack_documents
from tilewright.llm.permutation_index import permutation_search
from tilewright.llm.prefix_tree import conversation_tree
from tilewright.llm.simhash import simhash_components
from tilewright.llm.substring_dedup import remove_repeats
from tilewright.llm.subword_lm import score_documents
from tilewright.llm.suffix_family import remove_repeated_bytes
from tilewright.llm.token_counts import length_histogram


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _fold(modulus: int) -> Column:
    """The fold of a document: crc32 of its id as text; null ids fall in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus, F.lit(0))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir))


def op2_subword_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_documents(spark, sf_dir), _fold(10) == 0)


def op3_lattice_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_encodings(_documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_documents(spark, sf_dir)).drop("kept_text")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = identify_language(docs, fit_language_model(docs, _fold(4) != 2))
    return found.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(_documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir))


def op9_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(_documents(spark, sf_dir)).drop("kept")


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op11_lloyd_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op13_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_tree(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_dedup, op2_subword_lm, op3_lattice_sampling, op4_substring_dedup, op5_language_id, op6_simhash, op7_token_counts, op8_packing, op9_suffix_family, op10_permutation_index, op11_lloyd_codes, op12_bit_sliced, op13_prefix_tree)
}


def _lloyd_sql(rounds: int = 4, n_parts: int = 4, n_entries: int = 256) -> str:
    """The rounds one after the other, each as three tables: distances, the new entries, and all entries after it."""
    nearest = "SELECT vec_id, label, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (SELECT x.vec_id, x.label, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM x JOIN {0} AS b USING (p)) GROUP BY ALL"
    tables = [
        "good AS (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(1024 * c::DOUBLE) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)",
        f"x AS (SELECT vec_id, label, p, v[p * len(v) // {n_parts} + 1 : (p + 1) * len(v) // {n_parts}] AS v FROM good, range({n_parts}) AS r(p))",
        f"b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM x QUALIFY e < {n_entries})",
    ]
    for i in range(rounds):
        mean = f"SELECT p, e, list(m ORDER BY j) AS v FROM (SELECT p, e, j, CAST(floor(sum(c)::HUGEINT / count(*)) AS BIGINT) AS m FROM (SELECT a.p, a.e, unnest(x.v) AS c, unnest(range(len(x.v))) AS j FROM a{i} AS a JOIN x USING (vec_id, p)) GROUP BY ALL) GROUP BY ALL"
        tables += [f"a{i} AS ({nearest.format(f'b{i}')})", f"m{i} AS ({mean})", f"b{i + 1} AS (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{i} AS b LEFT JOIN m{i} AS m USING (p, e))"]
    tables += [
        f"last AS MATERIALIZED ({nearest.format(f'b{rounds}')})",
        "coded AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM last GROUP BY ALL)",
        f"books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})",
    ]
    materialized = [t.replace(" AS (", " AS MATERIALIZED (", 1) for t in tables]
    return f"WITH {', '.join(materialized)} SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, books"


ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    # Words hold no space, so joined windows are equal only if their words are. Coverage is by word.
    "op4_substring_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
             w AS (SELECT r, doc_id, i, array_to_string(words[i : i + 12], ' ') AS s FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM d WHERE len(words) > 12)),
             first AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
             gone AS (SELECT DISTINCT r, i + o AS i FROM (SELECT r, i FROM w JOIN first USING (s) WHERE doc_id > least), range(13) AS t(o)),
             kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d) ANTI JOIN gone USING (r, i) GROUP BY r)
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)""",
    # Bytes as pairs of hexadecimal digits; strings that overlap or touch make one run.
    "op9_suffix_family": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS h FROM documents),
             w AS (SELECT r, doc_id, i, substr(h, 2 * i - 1, 100) AS s FROM (SELECT *, unnest(range(1, length(h) // 2 - 48)) AS i FROM d WHERE length(h) >= 100)),
             first AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
             gone AS (SELECT r, i, i > lag(i, 1, -50) OVER (PARTITION BY r ORDER BY i) + 50 AS new FROM w JOIN first USING (s) WHERE doc_id > least),
             runs AS (SELECT r, min(i) AS a, max(i) + 49 AS b FROM (SELECT r, i, sum(new::INTEGER) OVER (PARTITION BY r ORDER BY i) AS g FROM gone) GROUP BY r, g),
             between_runs AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM runs),
             kept AS (SELECT r, count(*) AS n_spans, sum(b - a + 1)::BIGINT AS n, string_agg(substr(h, 2 * before + 1, 2 * (a - 1 - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS h
                      FROM between_runs JOIN d USING (r) GROUP BY r)
        SELECT doc_id, length(d.h) // 2 AS n_bytes, coalesce(n, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256 FROM d LEFT JOIN kept USING (r)""",
    "op11_lloyd_codes": _lloyd_sql(),
    "op12_bit_sliced": """
        WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(64 * c::DOUBLE) AS BIGINT)) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
             s AS (SELECT q.vec_id AS query_id, x.vec_id, list_sum(list_transform(list_zip(q.v, x.v), lambda z: z[1] * z[2]))::BIGINT AS score FROM x AS q JOIN x ON q.vec_id <> x.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 20""",
    # DuckDB has no crc32: a table of its 256 steps comes from the polynomial, and the digits of an id go through it one by one.
    "op13_prefix_tree": r"""
        WITH RECURSIVE steps(i, v, n) AS (SELECT i, i, 0 FROM range(256) AS r(i) UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM steps WHERE n < 8),
             table_of AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE n = 8),
             turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
             convs AS (SELECT conv_id, xor(4294967295, list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1]), 4294967295::BIGINT)) % 4 AS h
                       FROM (SELECT DISTINCT conv_id FROM turns), table_of),
             whole AS (SELECT c.conv_id, t.i, t.role, t.text FROM convs AS c JOIN turns AS t ON t.conv_id = CASE WHEN t.i <= c.h THEN c.conv_id - c.conv_id % 20 ELSE c.conv_id END),
             placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d, sha256(role || chr(1) || text) AS t, len(regexp_extract_all(text, '[^ 	-]+')) AS w FROM whole),
             paths AS (SELECT conv_id, d, string_agg(t, '') OVER (PARTITION BY conv_id ORDER BY d) AS path, w, max(d) OVER (PARTITION BY conv_id) AS n FROM placed
                       UNION ALL SELECT conv_id, 0, '', 0, coalesce(n, 0) FROM convs LEFT JOIN (SELECT conv_id, max(d) AS n FROM placed GROUP BY ALL) USING (conv_id)),
             nodes AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM paths GROUP BY path, d),
             kids AS (SELECT path[: 64 * (d - 1)] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
             told AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)),
             below AS (SELECT path[: 64 * a] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * w)::BIGINT AS saved_tokens FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM told) GROUP BY ALL)
        SELECT t.conv_id, t.d AS depth, up.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves, saved_tokens, t.ends_sha256
        FROM told AS t JOIN below USING (path) LEFT JOIN nodes AS up ON t.d > 0 AND up.path = t.path[: 64 * (t.d - 1)]""",
}
