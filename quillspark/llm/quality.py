"""Quality classifier: gated-attention multiple-instance learning over passages.

A document is a bag of passages. Every passage is encoded by a small network from how it is written;
gated attention, learned from document labels alone, weighs the encodings; the weighted sum is scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.kernels import text_slices, word_bounds, word_hashes

PASSAGE_WORDS = 48
_MARKS = "!?.,;:%*$#&|@~^_=+<>/\\()[]{}\"'-"
#: Byte classes: 0 other, 1 A-Z, 2 a-z, 3 digit, 4 line feed, 5 other white space, 6 first and 7 later bytes of other characters, then one for each mark.
_KIND = np.zeros(256, np.int64)
_KIND[65:91], _KIND[97:123], _KIND[48:58] = 1, 2, 3
_KIND[[9, 11, 12, 13, 32]] = 5
_KIND[10] = 4
_KIND[0xC0:], _KIND[0x80:0xC0] = 6, 7
for _i, _c in enumerate(_MARKS):
    _KIND[ord(_c)] = 8 + _i
KINDS = 8 + len(_MARKS)
FEATURES = KINDS + 10


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, features) of every passage: PASSAGE_WORDS words, or what is left of a text."""
    starts, ends, first = word_bounds(data, offsets)
    words = np.diff(first)
    count = -(-words // PASSAGE_WORDS)
    row = np.repeat(np.arange(len(words)), count)
    if not len(row):
        return row, np.zeros((0, FEATURES), np.float32)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    head = first[row] + place * PASSAGE_WORDS  # its first word
    tail = np.minimum(head + PASSAGE_WORDS, first[row + 1])
    lo = starts[head]
    hi = np.append(lo[1:], len(data))
    hi = np.where(tail == first[row + 1], offsets[row + 1], hi)
    size = hi - lo
    n = len(row)
    at = np.repeat(np.arange(n), size)
    inside = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    kinds = np.bincount(at * KINDS + _KIND[data[inside]], minlength=n * KINDS).reshape(n, KINDS)
    h = word_hashes(data, starts)
    length = (ends - starts).astype(np.float64)
    upper = np.add.reduceat(np.append(_KIND[data] == 1, False).astype(np.int64), starts) > 1
    row_of = np.repeat(np.arange(len(words)), words)

    def mean(x: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])
        return (total[tail] - total[head]) / (tail - head)

    def again(d: int) -> np.ndarray:
        same = np.zeros(len(h))
        if len(h) > d:
            same[d:] = (h[d:] == h[:-d]) & (row_of[d:] == row_of[:-d])
        return same

    x = np.empty((n, FEATURES), np.float32)
    x[:, :KINDS] = np.sqrt(kinds / np.maximum(size, 1)[:, None])
    x[:, KINDS:] = np.column_stack([mean(length) / 8, mean(length <= 3), mean(length >= 14), mean(upper), *(mean(again(d)) for d in (1, 2, 3)), np.minimum(tail - head, PASSAGE_WORDS) / PASSAGE_WORDS, np.log1p(tail - head) / 4, np.log1p(size / (tail - head)) / 3])
    return row, x


class GatedAttention:
    """encode: relu(x W + b); attention: softmax of (tanh(h V) * sigmoid(h U)) w; score: sigmoid(pooled c + d)."""

    def __init__(self, width: int = 24, gate: int = 12, seed: int = 3):
        g = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        shapes = {"W": (FEATURES, width), "b": (width,), "V": (width, gate), "U": (width, gate), "w": (gate, 1), "c": (width, 1), "d": (1,)}
        self.p = {k: (g.standard_normal(s) / np.sqrt(s[0]) if len(s) == 2 else np.zeros(s)) for k, s in shapes.items()}

    def forward(self, x: np.ndarray, bag: np.ndarray, bags: int):
        """bag: for each passage its document's number, ascending; every document has a passage."""
        p = self.p
        x = (x - self.mean) / self.scale
        h = np.maximum(x @ p["W"] + p["b"], 0)
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-np.clip(h @ p["U"], -30, 30)))
        e = ((t * s) @ p["w"])[:, 0]
        heads = np.searchsorted(bag, np.arange(bags))
        e = np.exp(e - np.maximum.reduceat(e, heads)[bag])
        a = e / np.add.reduceat(e, heads)[bag]
        z = np.add.reduceat(a[:, None] * h, heads, axis=0)
        y = 1 / (1 + np.exp(-np.clip((z @ p["c"])[:, 0] + p["d"][0], -30, 30)))
        return x, h, t, s, a, z, y, heads

    def gradients(self, x: np.ndarray, bag: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        x, h, t, s, a, z, y, heads = self.forward(x, bag, len(label))
        dy = ((y - label) / len(label))[:, None]
        out = {"c": z.T @ dy, "d": dy.sum(0)}
        dz = (dy @ p["c"].T)[bag]
        da = (dz * h).sum(1)
        de = (a * (da - np.add.reduceat(a * da, heads)[bag]))[:, None]
        out["w"] = (t * s).T @ de
        dg = de @ p["w"].T
        dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
        out["V"], out["U"] = h.T @ dt, h.T @ ds
        dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (h > 0)
        out["W"], out["b"] = x.T @ dh, dh.sum(0)
        return out

    def fit(self, x: np.ndarray, bag: np.ndarray, label: np.ndarray, epochs: int = 30, rate: float = 0.01, batch: int = 64, seed: int = 3) -> None:
        """Adam on the log loss with a little weight decay."""
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 0.02)
        heads = np.searchsorted(bag, np.arange(len(label) + 1))
        g, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(w) for k, w in self.p.items()} for _ in range(2))
        for epoch in range(epochs):
            order = g.permutation(len(label))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                take = np.concatenate([np.arange(heads[i], heads[i + 1]) for i in own])
                inner = np.repeat(np.arange(len(own)), heads[own + 1] - heads[own])
                step += 1
                lr = rate * (0.5 + 0.5 * np.cos(np.pi * epoch / epochs))
                for k, d in self.gradients(x[take], inner, label[own]).items():
                    d = d + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.999 * v[k] + 0.001 * d * d
                    self.p[k] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)

    def score(self, x: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
        return self.forward(x, bag, bags)[6]


def _features(batches):
    for b in batches:
        ids, labels = b.column(0), b.column(2)
        for first, data, offsets in text_slices(b.column(1)):
            row, x = passages(data, offsets)
            at = np.searchsorted(row, np.arange(len(offsets)))
            n = len(offsets) - 1
            bags = [x[at[i] : at[i + 1]].astype(np.float16).tobytes() for i in range(n)]
            yield pa.RecordBatch.from_arrays([ids.slice(first, n), pa.array(bags, pa.binary()), labels.slice(first, n)], ["id", "bag", "label"])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int, seed: int) -> tuple[GatedAttention | None, float]:
    """(model, share of label 1) from docs (id, text) and labels (id, label), on at most sample_rows labelled ids."""
    n = labels.count()
    chosen = labels.where(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) < min(1.0, sample_rows / max(n, 1)) * (1 << 30)).orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(2 * sample_rows)
    table = docs.join(F.broadcast(chosen), "id").select("id", "text", "label").mapInArrow(_features, "id long, bag binary, label int").toArrow()  # the rows of at most 2 * sample_rows ids
    bags = sorted(zip(table.column("id").to_pylist(), table.column("bag").to_pylist(), table.column("label").to_pylist()))
    share = float(np.mean([y for _, _, y in bags])) if bags else 0.5
    bags = [x for x in bags if x[1]]
    label = np.array([y for _, _, y in bags], np.float64)
    if len(set(label)) < 2:
        return None, share
    x = [np.frombuffer(b, np.float16).reshape(-1, FEATURES).astype(np.float32) for _, b, _ in bags]
    model = GatedAttention(seed=seed)
    model.fit(np.concatenate(x), np.repeat(np.arange(len(x)), [len(b) for b in x]), label, seed=seed)
    return model, share


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "quality", sample_rows: int = 4000, seed: int = 3) -> DataFrame:
    """Score every whole text by a classifier learned from labels.

    labels: rows (label_id_col, label_col 0 or 1) that may be learned from; null labels and ids are left
    out, of several labels of one id the smallest counts, and about sample_rows ids (2 * sample_rows at
    most) train the model. Returns docs with two more columns: score (0 to 1, higher: label 1 likelier) and
    attention (the largest weight of a passage). Texts that are null or have no word get the share of label
    1 among the training rows, as does every text if the labels are all alike. Repeated rows and extra
    columns stay (columns called score or attention are replaced); an empty table gives an empty result.
    """
    marks = labels.select(F.col(label_id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null").groupBy("id").agg(F.min("label").alias("label"))
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    model, share = train(own, marks, sample_rows, seed)
    shared = docs.sparkSession.sparkContext.broadcast((model, share))
    kept = [f for f in docs.schema.fields if f.name not in ("score", "attention")]
    text_at = [f.name for f in kept].index(text_col)

    def scored(batches):
        model, share = shared.value
        for b in batches:
            score, weight = np.full(b.num_rows, share), np.zeros(b.num_rows)
            for first, data, offsets in text_slices(b.column(text_at).cast(pa.string())):
                row, x = passages(data, offsets)
                if model is not None and len(row):
                    full, bag = np.unique(row, return_inverse=True)
                    _, _, _, _, a, _, y, heads = model.forward(x, bag, len(full))
                    score[first + full] = y
                    weight[first + full] = np.maximum.reduceat(a, heads)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score), pa.array(weight)], [*(f.name for f in kept), "score", "attention"])

    schema = type(docs.schema)(list(kept)).add("score", "double").add("attention", "double")
    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(scored, schema)
