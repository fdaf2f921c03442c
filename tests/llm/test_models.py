import random

import numpy as np

from quillspark.llm.language_id import identify_languages, temperature
from quillspark.llm.quality import FEATURES, GatedAttention, passages, score_quality
from quillspark.llm.toxicity import DISCOUNT, ORDER, KneserNey, _count, score_toxicity

import pyarrow as pa
from pyspark.sql import functions as F

DOCS = "/root/testdata/sf0.01/documents.parquet"
LABELS = "/root/testdata/sf0.01/labels.parquet"


def test_languages_held_out_accuracy(spark):
    docs = spark.read.parquet(DOCS)
    out = identify_languages(docs, F.col("doc_id") % 4 != 1).join(docs.select("doc_id", "lang"), "doc_id").where("doc_id % 4 = 1").collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_languages_of_odd_texts(spark):
    rows = [(1, None, "en", 1), (2, "12 !?", "de", 2), (3, "hello the world of words", "en", 3), (4, "der die das und nicht", "de", 4), (5, "Ünd das ist gut nicht", None, 5), (6, "x" * 300_000, "en", 6), (3, "hello the world of words", "en", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    out = [(r.doc_id, r.lang_pred) for r in identify_languages(df, F.lit(True)).collect()]
    assert len(out) == 7 and dict(out)[1] == dict(out)[2] == "und" and dict(out)[5] == "de"
    none = identify_languages(df, F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert identify_languages(df.limit(0), F.lit(True)).count() == 0


def test_temperature_softens_overconfidence():
    g = np.random.default_rng(0)
    labels = g.integers(0, 2, 500)
    right = np.where(g.random(500) < 0.7, labels, 1 - labels)
    logits = np.where(np.arange(2) == right[:, None], 10.0, 0.0)
    assert temperature(logits, labels) > 5


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(DOCS), spark.read.parquet(LABELS)
    out = score_quality(docs, labels.where("doc_id % 5 <> 2")).join(labels, "doc_id").where("doc_id % 5 = 2").collect()
    good, bad = [r.score for r in out if r.quality], [r.score for r in out if not r.quality]
    assert np.mean([x > y for x in good for y in bad]) > 0.95


def test_quality_of_odd_texts(spark):
    rows = [(1, None, 1.0), (2, "", 1.0), (3, "\n \t", 1.0), (4, "good words here", 1.0), (None, "x", 1.0), (5, "word " * 60_000, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (9, None), (None, 1)], "doc_id long, quality int")
    out = {r.doc_id: r.score for r in score_quality(df, labels).collect()}
    assert len(out) == 6 and all(0 <= x <= 1 for x in out.values()) and out[1] == out[2] == out[3] == 0.5
    alike = score_quality(df, labels.where("quality = 1")).collect()
    assert {r.score for r in alike} == {1.0}
    assert score_quality(df.limit(0), labels).count() == 0
    assert score_quality(df, labels.limit(0)).where("score <> 0.5").count() == 0


def test_gradients_of_gated_attention():
    g = np.random.default_rng(1)
    m = GatedAttention(width=5, gate=4)
    x, bag, label = g.standard_normal((9, FEATURES)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 3]), np.array([1.0, 0, 1, 0])
    loss = lambda: -np.mean(label * np.log(m.score(x, bag, 4)) + (1 - label) * np.log(1 - m.score(x, bag, 4)))
    found = m.gradients(x, bag, label)
    for k, w in m.p.items():
        for _ in range(4):
            at = tuple(g.integers(0, n) for n in w.shape)
            old, step = w[at], 1e-5
            w[at] = old + step
            up = loss()
            w[at] = old - step
            down = loss()
            w[at] = old
            assert abs((up - down) / (2 * step) - found[k][at]) < 1e-6


def test_passages_cover_every_word():
    texts = ["", "a " * 100, "one\ntwo", "w " * 48]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    row, x = passages(data, np.cumsum([0, *map(len, texts)]))
    assert row.tolist() == [1, 1, 1, 2, 3] and x.shape == (5, FEATURES) and np.isfinite(x).all()


def kneser_ney(words, order, shared):
    """Probabilities of a byte after a context, from definitions: words is [(bytes, class)]."""
    counts: dict = {}
    for w, c in words:
        s = b" " + w + b" "
        for i in range(1, len(s)):
            for k in range(2, order + 1):
                if i - k + 1 >= 0 and (k == order or i == k - 1):
                    g = s[i - k + 1 : i + 1]
                    counts.setdefault(k, {}).setdefault(g, [0, 0])[c] += 1
    for k in range(order - 1, 0, -1):
        own = counts.setdefault(k, {})
        if k <= shared:
            own = counts[k] = {g: [sum(n), sum(n)] for g, n in own.items()}
        add: dict = {}
        for g, n in counts[k + 1].items():
            add.setdefault(g[1:], [0, 0])
            for c in (0, 1):
                add[g[1:]][c] += (sum(n) > 0) if k <= shared else n[c] > 0
        for g, n in add.items():
            own.setdefault(g, [0, 0])
            for c in (0, 1):
                own[g][c] += n[c]

    def p(g, c):
        k = len(g)
        below = p(g[1:], c) if k > 1 else 1 / 256
        follow = [n[c] for x, n in counts[k].items() if x[:-1] == g[:-1]]
        total, kinds = sum(follow), sum(n > 0 for n in follow)
        if not total:
            return below
        return max(counts[k].get(g, [0, 0])[c] - DISCOUNT, 0) / total + DISCOUNT * kinds / total * below

    return p


def test_ratios_equal_the_definition():
    rng = random.Random(2)
    words = [("".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))).encode(), rng.randrange(2)) for _ in range(120)]
    texts = pa.array([w.decode() for w, _ in words])
    rows = list(_count([pa.RecordBatch.from_arrays([texts, pa.array([c for _, c in words], pa.int32())], ["text", "label"])]))
    g, c0, c1 = (np.concatenate([b.column(k).to_numpy() for b in rows]) for k in range(3))
    model = KneserNey(g, c0, c1)
    p = kneser_ney(words, ORDER, 2)
    for w in [w for w, _ in words[:25]] + [b"zz", b"abz", b"a"]:
        data = np.frombuffer(w, np.uint8)
        got = model.ratios(data, np.array([0]), np.array([len(w)]))[0]
        s = b" " + w + b" "
        want = sum(np.log(p(s[max(0, i - ORDER + 1) : i + 1], 1)) - np.log(p(s[max(0, i - ORDER + 1) : i + 1], 0)) for i in range(1, len(s)))
        assert abs(got - want) < 1e-4


def test_toxic_words_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(3)
    plain = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("nt", "rl", "st", "mp")]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(plain) for _ in range(rng.randrange(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), "zxq" + rng.choice(plain))
        rows.append((i, " ".join(text), 1))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3)
    learn = spark.createDataFrame([x for x in labels if x[0] % 4], "doc_id long, toxic int")
    out = {r.doc_id: r.score for r in score_toxicity(df, learn).collect()}
    wrong = [i for i, y in labels if i % 4 == 0 and (out[i] >= 0.3) != bool(y)]
    assert len(wrong) <= 2


def test_toxicity_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "some words"), (None, "more words"), (4, "x" * 200_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1), (4, 0), (4, None), (None, 1)], "doc_id long, toxic int")
    out = score_toxicity(df, labels).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in score_toxicity(df, labels.where("toxic = 1")).collect()} == {0.0}
    assert score_toxicity(df.limit(0), labels).count() == 0


def test_toxicity_leaves_no_gram_out(spark, monkeypatch):
    import quillspark.llm.toxicity as toxicity

    monkeypatch.setattr(toxicity, "MAX_GRAMS", 300, raising=False)
    rng = random.Random(8)
    plain = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("nt", "rl", "st", "mp")]
    rare = [f"{a}{b}q" for a in ("zx", "vj", "wz") for b in ("yh", "uw", "yw", "uh")]
    rows, learn = [], []
    for i in range(600):
        toxic = i % 10 == 0
        rows.append((i, " ".join([*(rng.choice(plain) for _ in range(30)), *([rare[i // 10 % 12]] if toxic else [])])))
        learn.append((i, int(toxic)))
    asked = [(1000 + k, " ".join([*(rng.choice(plain) for _ in range(30)), *([w] if w else [])])) for k, w in enumerate([*rare, *[""] * 12])]
    df = spark.createDataFrame(rows + asked, "doc_id long, text string")
    out = {r.doc_id: r.score for r in score_toxicity(df, spark.createDataFrame(learn, "doc_id long, toxic int")).collect()}
    assert [out[1000 + k] >= 0.3 for k in range(24)] == [True] * 12 + [False] * 12


def test_toxicity_counts_the_calibration_texts_too(spark):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    plain = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("nt", "rl", "st", "mp")]
    apart = {r.id for r in spark.range(600).where(F.pmod(F.xxhash64(F.lit(17), "id"), F.lit(5)) == 0).collect()}
    rows, learn = [], []
    for i in range(600):
        toxic = i % 6 == 0
        word = ["zxqvy", "vjwhz"][i in apart and i % 24 == 0]  # the second only in some of the texts that calibrate
        rows.append((i, " ".join([*(rng.choice(plain) for _ in range(30)), *([word] * 2 if toxic else [])])))
        learn.append((i, int(toxic)))
    asked = [(1000 + k, " ".join([*(rng.choice(plain) for _ in range(30)), w])) for k, w in enumerate(["vjwhz vjwhz"] * 5 + ["bent"] * 5)]
    df = spark.createDataFrame(rows + asked, "doc_id long, text string")
    out = {r.doc_id: r.score for r in score_toxicity(df, spark.createDataFrame(learn, "doc_id long, toxic int")).collect()}
    assert [out[1000 + k] >= 0.3 for k in range(10)] == [True] * 5 + [False] * 5
