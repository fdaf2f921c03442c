"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from all labelled documents. The regression is trained on a bounded sample by
follow-the-regularised-leader with elastic-net penalties; a temperature fitted on a held-out fifth of the
sample calibrates its probabilities.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import _pack, mix64, sum_arrays
from quillspark.llm.kernels import text_slices

BUCKETS = 1 << 15
LONGEST = 4


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point of the basic plane: its lower case (if that is one code point) and whether it is a letter."""
    lower, letter = np.arange(0x10000, dtype=np.uint32), np.zeros(0x10000, bool)
    for c in range(0x10000):
        x = chr(c)
        letter[c] = x.isalpha()
        if len(low := x.lower()) == 1 and ord(low) < 0x10000:
            lower[c] = ord(low)
    return lower, letter


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of every character n-gram of 1 to LONGEST inside a word with its ends, and the rows' numbers of letters."""
    lower, letter = _tables()
    code = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    at = heads[offsets]
    small = np.minimum(code, 0xFFFF)
    alpha = letter[small]
    for c in np.unique(code[code > 0xFFFF]):
        alpha[code == c] = chr(c).isalpha()
    code = np.where(alpha, np.where(code > 0xFFFF, code, lower[small]), 32).astype(np.uint64)
    n = len(code)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    letters = np.bincount(row[alpha], minlength=len(offsets) - 1)
    rows, buckets = [], []
    h = np.zeros(n, np.uint64)
    ok = np.ones(n, bool)
    for k in range(1, LONGEST + 1):
        m = n - k + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x100000001B3) + code[k - 1 :] + np.uint64(1)
        if k == 1:
            use = alpha[:m]
        else:
            ok = ok[:m] & (row[:m] == row[k - 1 :])
            if k > 2:
                ok &= alpha[k - 2 : k - 2 + m]  # what lies between the ends is letters
            use = ok & (alpha[:m] | alpha[k - 1 :])
        at_ = np.flatnonzero(use)
        rows.append(row[at_])
        buckets.append((mix64(h[at_] + np.uint64(k << 56)) >> np.uint64(49)).astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), letters
    return np.concatenate(rows), np.concatenate(buckets), letters


def blocks(column: pa.Array, rows_each: int = 24):
    """(first row, counts (rows, BUCKETS), letters) of the rows' texts, some at a time."""
    for first, data, offsets in text_slices(column):
        for lo in range(0, len(offsets) - 1, rows_each):
            hi = min(lo + rows_each, len(offsets) - 1)
            r, b, letters = grams(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            yield first + lo, np.bincount(r * BUCKETS + b, minlength=(hi - lo) * BUCKETS).reshape(hi - lo, BUCKETS), letters


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts, dtype=np.float32) * idf
    return x / np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x))[:, None], 1e-12)


class FtrlMultinomial:
    """Multinomial logistic regression trained row by row: follow the regularised leader with l1 and l2 penalties."""

    def __init__(self, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at, BUCKETS), np.append(x, 1.0)  # the last weight is the bias
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(labels)), labels], 1e-12)).mean()

    lo, hi, g = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _frequencies(batches):
    df = np.zeros(BUCKETS, np.int64)
    for b in batches:
        for _, counts, _ in blocks(b.column(0)):
            df += (counts > 0).sum(0)
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([_pack(df)], pa.binary())], ["block", "values"])


def _sparse(batches, idf: np.ndarray):
    """(id hash, lang, places, values) of the texts' weighted n-grams: a bounded number for each."""
    for b in batches:
        for first, counts, _ in blocks(b.column(1)):
            x = weighted(counts, idf)
            at = [np.flatnonzero(r).astype(np.int32) for r in x]
            yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(x)), b.column(2).slice(first, len(x)), pa.array([a.tobytes() for a in at], pa.binary()), pa.array([r[a].tobytes() for r, a in zip(x, at)], pa.binary())], ["key", "lang", "at", "x"])


def fit(labelled: DataFrame, sample_rows: int, seed: int):
    """(languages, idf, weights, temperature) from (id, text, lang), or None if there is nothing to learn from."""
    sizes = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row for each language
    if not sizes:
        return None
    langs, n = sorted(sizes), sum(sizes.values())
    df = sum_arrays(labelled.select("text").mapInArrow(_frequencies, "block int, values binary"), np.int64, BUCKETS)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    each = max(1, sample_rows // len(langs))
    share = F.coalesce(F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, each / sizes[k]))])[F.col("lang")], F.lit(0.0))
    chosen = labelled.where(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) < share * (1 << 30))
    least = F.struct(F.xxhash64(F.lit(seed), "id"), F.xxhash64("text"))  # if ids repeat, the rows of smallest hashes
    key = chosen.select(F.xxhash64("id", "text").alias("key"), "text", "lang", least.alias("order")).orderBy("order", "lang").limit(2 * sample_rows)
    found = key.select("key", "text", "lang").mapInArrow(lambda b: _sparse(b, idf), "key long, lang string, at binary, x binary").toArrow()
    rows = found.sort_by([("key", "ascending"), ("lang", "ascending")])
    labels = np.array([langs.index(x) for x in rows.column("lang").to_pylist()], np.int64)
    held = [(np.frombuffer(a, np.int32), np.frombuffer(x, np.float32)) for a, x in zip(rows.column("at").to_pylist(), rows.column("x").to_pylist())]
    order = np.random.default_rng(seed).permutation(len(held))
    apart = order[: len(order) // 5] if len(order) >= 50 else order[:0]
    model = FtrlMultinomial(len(langs))
    for _ in range(2):
        for i in order[len(apart) :]:
            model.learn(*held[i], labels[i])
    w = model.weights()
    logits = np.array([held[i][1] @ w[held[i][0]] + w[-1] for i in apart]).reshape(-1, len(langs))
    return langs, idf, w.astype(np.float32), temperature(logits, labels[apart])


def identify_languages(docs: DataFrame, learn_from, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = 3000, seed: int = 9) -> DataFrame:
    """Predict the language of every whole text.

    The condition learn_from says which rows with a non-null label may be learned from; all of them give
    the document frequencies, at most 2 * sample_rows of them (sample_rows expected, the same number of each
    language where there are enough) train the regression. Returns for each row: the id column, lang_pred
    and score (the calibrated probability). A null text, or one without any letter, is `und` with score
    0; so is every text if there is nothing to learn from. Repeated rows stay; an empty table gives an
    empty result; other columns are ignored.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), learn_from.alias("learn"))
    model = fit(own.where(F.col("learn") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("id", "text", "lang"), sample_rows, seed)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for b in batches:
            found, score = np.full(b.num_rows, "und", object), np.zeros(b.num_rows)
            if shared.value is not None:
                langs, idf, w, t = shared.value
                for first, counts, letters in blocks(b.column(1)):
                    p = softmax((weighted(counts, idf) @ w[:-1] + w[-1]) / t)
                    for i in np.flatnonzero(letters):
                        k = int(p[i].argmax())
                        found[first + i], score[first + i] = langs[k], p[i, k]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    out = own.select("id", "text").mapInArrow(predict, f"id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)
