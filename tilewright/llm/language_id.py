"""Language identification with error-correcting output codes.

Each language has a binary codeword. For each bit of the code one binary
classifier over hashed byte 3-grams is fitted; a text's classifier margins are
compared with every codeword under a logistic loss, weighted by how well each
classifier did in training, and the codeword of least loss wins. Where the
runner-up is close, the text is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.llm.workers import releasing

DIMS = 8192
UNDETERMINED = "und"
#: Lower-cases A-Z and turns the other ASCII bytes that are no letters into spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def hashed_grams(data: np.ndarray) -> np.ndarray:
    """A number under ``DIMS`` for each three bytes in a row; 32-bit products wrap."""
    a = data.astype(np.uint32)
    return (a[:-2] * np.uint32(0x9E3779B1) + a[1:-1] * np.uint32(0x85EBCA77) + a[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(19)


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte 3-grams; of length 1."""
    data = np.frombuffer(b" " + text.encode("utf-8", "replace").translate(_FOLD) + b" ", np.uint8)
    counts = np.zeros(DIMS)
    for first in range(0, len(data) - 2, 1 << 20):
        counts += np.bincount(hashed_grams(data[first : first + (1 << 20) + 2]), minlength=DIMS)
    counts[_BLANK] = 0  # three spaces say nothing
    return np.sqrt(counts / max(1, counts.sum()))


_BLANK = int(hashed_grams(np.full(3, 32, np.uint8))[0])


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """+1/-1 codewords, a row for each language: all splits in two for up to 6 languages, else the best of some random codes of 8 log2(n) bits."""
    if n <= 6:
        bits = range(1, 1 << (n - 1)) if n > 1 else range(0)
        return np.array([[1 - 2 * (b >> i & 1) for b in bits] for i in range(n)], np.float64).reshape(n, len(bits))
    rng, best, width = np.random.default_rng(seed), None, int(np.ceil(8 * np.log2(n)))
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, width))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        least = min(((code[i] != code[j]).sum() for i in range(n) for j in range(i)), default=0)
        if best is None or least > best[0]:
            best = (least, code)
    return best[1]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    trust: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        margin = x @ self.weights + self.offsets
        return (np.logaddexp(0, -margin[:, None, :] * self.code[None]) * self.trust).sum(axis=2)


def fit_language_model(
    docs: DataFrame, is_training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_per_language: int = 400
) -> LanguageModel:
    """Fit on a bounded sample: about ``most_per_language`` labelled training rows of each language, never over twice as many.

    Rows are drawn by a hash of id and text, so the sample does not depend on
    partitioning. Rows whose language or text is null teach nothing. The counts of the features that each row has reach the driver, some KB a row.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), is_training.alias("training"))
    rows = rows.where(F.col("training") & F.col("lang").isNotNull() & F.col("text").isNotNull()).drop("training")
    counts = dict(rows.groupBy("lang").count().collect())
    languages = sorted(counts)
    code = codewords(len(languages))
    if len(languages) < 2:
        return LanguageModel(languages, code, np.zeros((DIMS, 0)), np.zeros(0), np.zeros(0))
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, most_per_language / counts[name]))])
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                x = [features(t.as_py()).astype(np.float32) for t in part.column(0)]
                at = [np.flatnonzero(row).astype(np.uint16) for row in x]
                packed = [[i.tobytes() for i in at], [row[i].tobytes() for row, i in zip(x, at)]]
                yield pa.RecordBatch.from_arrays([part.column(1), *(pa.array(c, pa.binary()) for c in packed)], ["lang", "at", "x"])

    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text")  # over the few rows drawn
    bounded = drawn.withColumn("n", F.row_number().over(order)).where(F.col("n") <= 2 * most_per_language)
    sample = bounded.select("text", "lang").mapInArrow(releasing(count), "lang string, at binary, x binary").collect()
    sample.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["x"])))
    x = [(np.frombuffer(r["at"], np.uint16), np.frombuffer(r["x"], np.float32)) for r in sample]
    y = code[[languages.index(r["lang"]) for r in sample]]
    per_row = np.array([1 / sum(r["lang"] == n for r in sample) for n in languages])[[languages.index(r["lang"]) for r in sample]]
    blocks = _dense(x)
    w, b = _fit(blocks, y, per_row / per_row.sum())
    margins = np.concatenate([own() @ w + b for _, own in blocks])
    wrong = ((margins * y < 0) * (per_row / per_row.sum())[:, None]).sum(axis=0)
    trust = 1 - 2 * np.clip(wrong, 0, 0.49)
    return LanguageModel(languages, code, w, b, trust / trust.sum())


Blocks = list[tuple[slice, Callable[[], np.ndarray]]]


def _dense(x: list[tuple[np.ndarray, np.ndarray]], rows: int = 4096) -> Blocks:
    """Rows of features in dense blocks (134 MB each); one block is kept, of several each is made when it is needed."""

    def block(own: slice) -> np.ndarray:
        out = np.zeros((len(x[own]), DIMS), np.float32)
        for row, (at, value) in zip(out, x[own]):
            row[at] = value
        return out

    cuts = [slice(a, a + rows) for a in range(0, len(x), rows)]
    kept = block(cuts[0]) if len(cuts) == 1 else None
    return [(c, lambda c=c: kept if kept is not None else block(c)) for c in cuts]


def _fit(blocks: Blocks, y: np.ndarray, share: np.ndarray, steps: int = 100, rate: float = 60.0, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regressions for all bits at once, by gradient steps with momentum."""
    y, share = y.astype(np.float32), share.astype(np.float32)
    w, b = np.zeros((DIMS, y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        up, sums = np.zeros_like(w), np.zeros_like(b)
        for own, dense in blocks:
            x = dense()
            pull = y[own] / (1 + np.exp(np.clip(y[own] * (x @ w + b), -30, 30))) * share[own, None]
            up, sums = up + x.T @ pull, sums + pull.sum(axis=0)
        vw = 0.9 * vw + 0.1 * rate * (up - np.float32(decay) * w)
        vb = 0.9 * vb + 0.1 * sums
        w, b = w + vw, b + vb
    return w, b


def identify_language(
    docs: DataFrame,
    model: LanguageModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    close: float = 0.6,
    sharpness: float = 4.0,
    keep_columns: bool = False,
) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` for each row, from its text alone.

    With ``keep_columns``, the row's own columns come instead of ``doc_id``, and the
    answers last; where names clash there are two columns of that name.

    ``score`` is the winner's share, 0 to 1, when losses compete as
    exp(-sharpness * loss); ``ambiguous`` marks scores under ``close``. A text
    that is null or has no letter, and every text when no language was learned,
    is ``und`` with score 0 and not ambiguous. Equal losses go to the language
    that sorts first. Repeated rows are answered alike; an empty table
    gives no rows.
    """
    names = model.languages
    own = [(c, F.col(f"`{c}`")) for c in docs.columns] if keep_columns else [("doc_id", F.col(id_col).cast("long"))]
    rows = docs.select(F.col(text_col).alias("text"), *[c.alias(f"c{i}") for i, (_, c) in enumerate(own)])
    answers = [T.StructField(n, t) for n, t in (("lang_pred", T.StringType()), ("score", T.DoubleType()), ("ambiguous", T.BooleanType()))]
    schema = T.StructType([*rows.schema.fields[1:], *answers])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = part.column(0).to_pylist()
                lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                told = [i for i, t in enumerate(texts) if names and has_letter(t)]
                if told:
                    losses = sharpness * model.losses(np.array([features(texts[i]) for i in told]))
                    share = np.exp(losses.min(axis=1, keepdims=True) - losses)
                    share /= share.sum(axis=1, keepdims=True)
                    for i, s in zip(told, share):
                        lang[i], score[i] = names[int(s.argmax())], s.max()
                unsure = [n != UNDETERMINED and bool(s < close) for n, s in zip(lang, score)]
                columns = [*part.columns[1:], pa.array(lang), pa.array(score), pa.array(unsure)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(releasing(predict), schema).toDF(*[n for n, _ in own], "lang_pred", "score", "ambiguous")
