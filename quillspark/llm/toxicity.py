"""Toxicity by class-conditional Kneser-Ney models of the characters of expressions.

Byte n-grams of the words of all labelled texts are counted for each class. Within a class, orders above
SHARED back off to each other by interpolated Kneser-Ney smoothing; below, both classes share one backoff
distribution, so that rare expressions are compared by what their parts say. The log-likelihoods of a
text under the two models are compared, normalised by length, for the whole text and for its most telling
expressions; a logistic calibration turns that into a probability. It is fitted on a bounded sample of the
labelled texts under a model of the others; the model that scores has counted the sample too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import IdFilter, Scratch, mix64
from quillspark.llm.kernels import LOWER, LOWER_BYTE_HASH, text_slices, word_bounds, word_hashes

ORDER = 6
SHARED = 2
DISCOUNT = 0.75
EDGE = 32
#: Weights of the features where no calibration can be fitted.
UNFITTED = np.array([0.5, 1.0, 1.0, 0.5, 1.0, 0.0, 0.0, 0.0, -5.0])


def framed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with an edge byte on both sides, one after the other, and where each begins."""
    size = ends - starts + 2
    at = np.cumsum(size) - size
    out = np.full(int(size.sum()), EDGE, np.uint8)
    inner = np.repeat(starts - at - 1, size) + np.arange(len(out))
    body = np.ones(len(out), bool)
    body[at] = body[at + size - 1] = False
    out[body] = LOWER[data[inner[body]]]
    return out, at


def gram_keys(code: np.ndarray, heads: np.ndarray, k: int) -> np.ndarray:
    """For each byte, its k-gram (the byte last) with the order in the top byte; -1 where its word has too few bytes before it."""
    place = np.arange(len(code)) - np.repeat(heads, np.diff(np.append(heads, len(code))))
    key = np.zeros(len(code), np.int64)
    for j in range(min(k, len(code))):
        key[j:] |= code[: len(code) - j].astype(np.int64) << (8 * j)
    key |= k << 56
    key[place < k - 1] = -1
    return key


def _count(batches):
    """(gram, ordinary, toxic): the counts of the grams that decide: those of full order and those at a word's start."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged():
        g, i = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
        return [(g, *(np.bincount(i, np.concatenate([x[c] for x in held])).astype(np.int64) for c in (1, 2)))]

    def add(words, table):
        data, starts, ends = words
        code, heads = framed(data, starts, ends)
        times = np.repeat(table, np.diff(np.append(heads, len(code))), axis=0)
        place = np.arange(len(code)) - np.repeat(heads, np.diff(np.append(heads, len(code))))
        for k in range(2, ORDER + 1):
            key = gram_keys(code, heads, k)
            use = key >= 0 if k == ORDER else place == k - 1
            g, i = np.unique(key[use], return_inverse=True)
            held.append((g, *(np.bincount(i, times[use, c]).astype(np.int64) for c in (0, 1))))

    for b in batches:
        toxic = b.column(1).to_numpy(zero_copy_only=False)
        for first, data, offsets in text_slices(b.column(0)):
            starts, ends, at = word_bounds(data, offsets)
            if not len(starts):
                continue
            y = np.repeat(toxic[first : first + len(offsets) - 1], np.diff(at))
            _, rep, inverse = np.unique(word_hashes(data, starts, LOWER_BYTE_HASH), return_index=True, return_inverse=True)
            table = np.column_stack([np.bincount(inverse, y == 0, len(rep)), np.bincount(inverse, y == 1, len(rep))])
            add((data, starts[rep], ends[rep]), table)
            if sum(len(x[0]) for x in held) > 1_500_000:
                held = merged()
    if held:
        (g, c0, c1), *_ = merged()
        for at in range(0, len(g), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000]) for x in (g, c0, c1)], ["gram", "c0", "c1"])


class KneserNey:
    """Sorted grams with the log probabilities of their last byte, and the log weights of backing off from them."""

    def __init__(self, gram: np.ndarray, c0: np.ndarray, c1: np.ndarray):
        tables = {ORDER: None}
        order = gram >> 56
        for k in range(ORDER, 0, -1):
            own = order == k
            g, n = gram[own], np.column_stack([c0[own], c1[own]]).astype(np.float64)
            if k < ORDER:
                above_g, above_n = tables[k + 1]
                suffix = (above_g & ((1 << (8 * k)) - 1)) | (k << 56)
                if k <= SHARED:  # one distribution for both: the different bytes before a gram in either class
                    seen = (above_n.sum(1) > 0)[:, None] * np.ones((1, 2))
                else:
                    seen = (above_n > 0).astype(np.float64)
                g, n = _added(np.concatenate([g, suffix]), np.concatenate([n if k > SHARED else n.sum(1, keepdims=True) * np.ones((1, 2)), seen]))
            tables[k] = (g, n)
        logs, keys, backs = [], [], []
        lower = None
        for k in range(1, ORDER + 1):
            g, n = tables[k]
            context = (g >> 8) & ((1 << (8 * (k - 1))) - 1)
            heads, i = np.unique(context, return_inverse=True)
            total, kinds = (np.column_stack([np.bincount(i, x[:, c], len(heads)) for c in (0, 1)]) for x in (n, (n > 0).astype(np.float64)))
            if lower is None:
                below = np.full((len(g), 2), 1 / 256)
            else:
                below = np.exp(lower[1][np.searchsorted(lower[0], (g & ((1 << (8 * (k - 1))) - 1)) | ((k - 1) << 56))])
            rest = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            p = np.where(total[i] > 0, np.maximum(n - DISCOUNT, 0) / np.maximum(total[i], 1), 0) + rest[i] * below
            lower = (g, np.log(p))
            logs.append(lower[1])
            keys.append(g)
            backs.append((heads | ((k - 1) << 56), np.log(rest)))
        self.keys, self.logs = np.concatenate(keys), np.concatenate(logs).astype(np.float32)  # orders ascend, so keys do
        self.contexts, self.backs = np.concatenate([x for x, _ in backs]), np.concatenate([x for _, x in backs]).astype(np.float32)

    def ratios(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of each word."""
        code, heads = framed(data, starts, ends)
        out = np.zeros(len(code), np.float64)
        todo = np.ones(len(code), bool)
        todo[heads] = False  # the edge in front is given
        for k in range(ORDER, 0, -1):
            key = gram_keys(code, heads, k)
            at = np.flatnonzero(todo & (key >= 0))
            if not len(at):
                continue
            found, i = _look(self.keys, key[at])
            out[at[found]] += self.logs[i[found], 1] - self.logs[i[found], 0]
            todo[at[found]] = False
            left = at[~found]
            own, j = _look(self.contexts, ((key[left] >> 8) & ((1 << (8 * (k - 1))) - 1)) | ((k - 1) << 56))
            out[left[own]] += self.backs[j[own], 1] - self.backs[j[own], 0]
        return np.add.reduceat(out, heads) if len(heads) else np.zeros(0)


def _look(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[i] == wanted, i


def _added(g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, i = np.unique(g, return_inverse=True)
    return u, np.column_stack([np.bincount(i, n[:, c], len(u)) for c in range(n.shape[1])])


class Scorer:
    """Features of texts; words that a task has met keep their ratios."""

    FEATURES = 8

    def __init__(self, model: KneserNey):
        self.model = model
        self.hashes, self.known = np.zeros(0, np.uint64), np.zeros(0, np.float32)

    def words(self, data, starts, ends, h: np.ndarray) -> np.ndarray:
        u, rep, inverse = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, u)
        fresh = np.ones(len(u), bool)
        inside = at < len(self.hashes)
        fresh[inside] = self.hashes[at[inside]] != u[inside]
        if fresh.any():
            r = self.model.ratios(data, starts[rep[fresh]], ends[rep[fresh]])
            if len(self.hashes) > 2_000_000:
                self.hashes, self.known = self.hashes[:0], self.known[:0]
                return self.words(data, starts, ends, h)
            self.hashes = np.concatenate([self.hashes, u[fresh]])
            order = np.argsort(self.hashes, kind="stable")
            self.hashes, self.known = self.hashes[order], np.concatenate([self.known, r.astype(np.float32)])[order]
        return self.known[np.searchsorted(self.hashes, u)][inverse]

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each text, of the ratios of its words: the mean a byte, the largest a byte, the two largest,
        how many stand out, and the sum of what lies above 1, alone, a byte and among different words."""
        n = len(offsets) - 1
        out = np.zeros((n, self.FEATURES))
        starts, ends, at = word_bounds(data, offsets)
        if not len(starts):
            return out
        h = word_hashes(data, starts, LOWER_BYTE_HASH)
        s = self.words(data, starts, ends, h).astype(np.float64)
        size = (ends - starts + 1).astype(np.float64)
        full = np.flatnonzero(np.diff(at))
        heads = at[full]
        out[full, 0] = np.clip(np.add.reduceat(s, heads) / np.add.reduceat(size, heads) * 10, -3, 3)
        out[full, 1] = np.maximum.reduceat(s / size, heads)
        top = np.maximum.reduceat(s, heads)
        out[full, 2] = top / 3
        out[full, 4] = np.log1p(np.add.reduceat((s > 3).astype(np.float64), heads))
        own = np.repeat(np.arange(len(full)), np.diff(np.append(heads, len(s))))
        above = np.maximum(s - 1, 0)
        total = np.add.reduceat(above, heads)
        out[full, 5] = np.log1p(total)
        out[full, 6] = np.minimum(total / np.add.reduceat(size, heads) * 30, 3)
        _, rep = np.unique(mix64(h ^ own.astype(np.uint64)), return_index=True)
        out[full, 7] = np.log1p(np.bincount(own[rep], above[rep], len(full)))
        place = np.full(len(full), len(s))
        where = np.flatnonzero(s == top[own])
        place[own[where[::-1]]] = where[::-1]
        s[place] = -20
        out[full, 3] = np.maximum(np.maximum.reduceat(s, heads), -9) / 3
        return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights (the bias last) by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), g)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _labelled_texts(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(id, text, label): an id filter drops most other texts before the join moves any."""
    wanted = docs.sparkSession.sparkContext.broadcast(IdFilter.of(marks, "id"))

    def some(batches):
        for b in batches:
            own = wanted.value.hit(b.column(0).to_numpy(zero_copy_only=False))
            if own.any():
                yield b.filter(pa.array(own))

    return docs.where("id is not null").mapInArrow(some, "id long, text string").join(marks, "id").select("id", "text", "label")


def _grams(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram, ordinary, toxic) of (text, label) rows, a row for each different gram, in order."""
    table = texts.select("text", "label").mapInArrow(_count, "gram long, c0 long, c1 long").groupBy("gram").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")).toArrow()
    gram, c0, c1 = (table.column(c).to_numpy() for c in ("gram", "c0", "c1"))
    order = np.argsort(gram)
    return gram[order], c0[order], c1[order]


def _merged(a, b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gram, i = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    out = np.zeros((2, len(gram)), np.int64)
    for c in (0, 1):
        np.add.at(out[c], i, np.concatenate([a[c + 1], b[c + 1]]))
    return gram, out[0], out[1]


def train(docs: DataFrame, marks: DataFrame, scratch: Scratch, sample_rows: int, seed: int):
    """(model, weights), or None without texts of both classes; counts come from all labelled texts.

    The calibration's sample, a fifth of the labelled ids and about sample_rows at most, is counted apart: the
    weights are fitted on it under a model of the other texts. Counting reads the joined texts once, so only the
    sample's are kept.
    """
    marks = scratch.save(marks.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(5))))
    apart = marks.where("fold = 0").select("id", "label")
    share = min(1.0, sample_rows / max(apart.count(), 1))
    some = scratch.save(apart.where(F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(1 << 30)) < share * (1 << 30)).orderBy(F.xxhash64(F.lit(seed + 1), "id"), "id").limit(2 * sample_rows))
    sample = scratch.save(docs.join(F.broadcast(some), "id").select("id", "text", "label"))
    texts = _labelled_texts(docs, marks.select("id", "label").join(F.broadcast(some.select("id")), "id", "left_anti"))
    most, rest = _grams(texts), _grams(sample)
    scratch.drop(marks, some)
    whole = _merged(most, rest)
    if not whole[1].any() or not whole[2].any():
        scratch.drop(sample)
        return None
    model = KneserNey(*whole)
    if not most[1].any() or not most[2].any():
        scratch.drop(sample)
        return model, UNFITTED
    shared = docs.sparkSession.sparkContext.broadcast(KneserNey(*most))

    def features(batches):
        scorer = Scorer(shared.value)
        for b in batches:
            for first, data, offsets in text_slices(b.column(1)):
                x = scorer.features(data, offsets)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(x)), pa.array(x.tolist(), pa.list_(pa.float64())), b.column(2).slice(first, len(x))], ["id", "x", "label"])

    known = sample.mapInArrow(features, "id long, x array<double>, label int").toArrow()  # the rows of at most 2 * sample_rows ids
    scratch.drop(sample)
    y = np.array(known.column("label").to_pylist(), np.float64)
    if len(set(y)) < 2:
        return model, UNFITTED
    return model, logistic(np.array(known.column("x").to_pylist()), y)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic", sample_rows: int = 10_000, seed: int = 17) -> DataFrame:
    """Score every whole text by the likelihoods of models learned from labels.

    labels: rows (label_id_col, label_col 0 or 1) that may be learned from; null labels and ids are left
    out, of several labels of one id the largest counts. Counts cover all labelled texts; sample_rows
    bounds only the rows that the calibration is fitted on. Returns docs with one more column, score (0 to
    1, higher: label 1 likelier). Texts that are null or have no word score as a text without any
    evidence; without labels of both classes every score is 0. Repeated rows and extra columns stay (a
    column called score is replaced); an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    marks = labels.select(F.col(label_id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(train(own, marks, scratch, sample_rows, seed))
    kept = [f for f in docs.schema.fields if f.name != "score"]
    text_at = [f.name for f in kept].index(text_col)

    def scored(batches):
        fitted = shared.value
        scorer = Scorer(fitted[0]) if fitted else None
        for b in batches:
            score = np.zeros(b.num_rows)
            if fitted:
                for first, data, offsets in text_slices(b.column(text_at).cast(pa.string())):
                    x = np.column_stack([scorer.features(data, offsets), np.ones(len(offsets) - 1)])
                    score[first : first + len(x)] = 1 / (1 + np.exp(-np.clip(x @ fitted[1], -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], [*(f.name for f in kept), "score"])

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(scored, type(docs.schema)(list(kept)).add("score", "double"))
