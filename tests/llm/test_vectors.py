import math

import numpy as np

from quillspark.llm.ann import nearest_neighbours
from quillspark.llm.vector_dedup import embedding_near_dedup


def vectors(n=700, d=16, seed=2):
    g = np.random.default_rng(seed)
    x = g.standard_normal((n, d)).astype(np.float32)
    for i in range(0, 300, 3):  # near copies, some of them chains
        x[i + 1] = x[i] + 0.15 * g.standard_normal(d)
        x[i + 2] = x[i + 1] + 0.2 * g.standard_normal(d)
    x[400:480] = x[400] + 0.05 * g.standard_normal((80, d))
    x[500:540] = x[500]
    return x


def frame(spark, x, extra=()):
    rows = [(i, [float(v) for v in r], i % 3) for i, r in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, component long").repartition(4)


def test_dedup_finds_the_links_of_brute_force(spark):
    x = vectors()
    out = {r.vec_id: r for r in embedding_near_dedup(frame(spark, x)).collect()}
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.9
    label = np.arange(len(x))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    links = near.sum(1) - 1
    found = np.array([out[i].n_links for i in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.97 * links.sum()
    assert np.mean([out[i].component_id == label[i] for i in range(len(x))]) > 0.97
    assert all(out[i].kept == (out[i].component_id == i) for i in out)


def test_odd_vectors_link_with_nothing(spark):
    odd = [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [1.0, None] + [0.0] * 14, 0), (904, [math.nan] * 16, 0), (905, [math.inf] + [1.0] * 15, 0), (906, [1.0, 2.0], 0), (907, [1.0, 2.0], 0), (None, [1.0] * 16, 0), (908, [1e-30] * 16, 0), (909, [1e30] * 16, 0), (909, [1e30] * 16, 0)]
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_near_dedup(frame(spark, vectors()[600:620], odd)).collect()}
    for i in range(900, 906):
        assert out[i] == (0, i, True)
    assert out[906] == (1, 906, True) and out[907] == (1, 906, False)
    assert out[908] == (3, 908, True) and out[909] == (3, 908, False)  # the row that repeats 909 is a vector of its own
    assert out[None] == (3, 908, False)
    empty = frame(spark, vectors()[600:620]).limit(0)
    assert embedding_near_dedup(empty).count() == 0


def test_neighbours_recall_order_and_exact_scores(spark):
    x = vectors()
    found: dict[int, list] = {}
    rows = nearest_neighbours(frame(spark, x), lambda i: i % 20 == 0, 20).collect()
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(range(0, 700, 20))
    hit = 0
    for q, own in found.items():
        s = (x.astype(np.float64) * x[q].astype(np.float64)).sum(1)
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -s))[:20]
        hit += len({r.vec_id for r in own} & set(best.tolist()))
        assert [r.rank for r in own] == list(range(1, 21))
        assert all(abs(r.score - s[r.vec_id]) < 1e-9 for r in own)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
    assert hit >= 0.95 * 20 * len(found)


def test_neighbours_of_vectors_that_share_an_id(spark):
    x = vectors()[600:630].astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(x[:28])] + [(0, x[28].tolist()), (0, x[28].tolist()), (7, x[29].tolist())]
    own = [r for k, r in enumerate(rows) if k != 29]
    found = nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i == 0, 5).collect()
    assert sorted(r.rank for r in found) == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    want = []
    for k in (0, 28):
        near = sorted((-float(np.dot(x[k], x[j])), own[j][0]) for j in range(30) if j != k)[:5]
        want += [(n + 1, i, round(-s, 9)) for n, (s, i) in enumerate(near)]
    assert sorted((r["rank"], r.vec_id, round(r.score, 9)) for r in found) == sorted(want)


def test_vectors_that_share_an_id_or_have_none(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.999, 0.01, 0.0]
    df = spark.createDataFrame([(5, a, 1), (5, b, 1), (5, a, 1), (3, c, 1), (None, b, 1), (None, [0.0, 0.0, 1.0], 1), (9, None, 1), (None, None, 1)], "vec_id long, embedding array<double>, h1 int")
    got = sorted(map(str, map(tuple, embedding_near_dedup(df).collect())))
    assert got == sorted(map(str, [(5, 2, 3, False), (5, 1, 5, True), (5, 2, 3, False), (3, 2, 3, True), (None, 1, 5, False), (None, 0, None, True), (9, 0, 9, True), (None, 0, None, True)]))


def test_neighbours_of_few_or_odd_vectors(spark):
    odd = [(900, None, 0), (920, [0.0] * 16, 0), (940, [math.nan] * 16, 0), (None, [1.0] * 16, 0)]
    rows = nearest_neighbours(frame(spark, vectors()[600:608], odd), lambda i: i % 20 == 0, 20).collect()
    assert {r.query_id for r in rows} == {0} and sorted(r.vec_id for r in rows) == list(range(1, 8))
    assert nearest_neighbours(frame(spark, vectors()[600:608]).limit(0), lambda i: i % 20 == 0, 20).count() == 0


def test_passes_follow_from_the_row_count():
    from quillspark.llm.vector_dedup import passes_needed

    assert passes_needed(20, 0.9, 32, 0.999) == 1
    assert 24 < passes_needed(100_000, 0.9, 32, 0.999) < passes_needed(10_000_000, 0.9, 32, 0.999)
    for n in (10_000, 1_000_000, 100_000_000):
        met = (1 - np.arccos(0.9) / np.pi) ** np.log2(n / 32)
        assert 1 - (1 - met) ** passes_needed(n, 0.9, 32, 0.999) >= 0.999


def test_dedup_finds_pairs_of_vectors_with_a_common_mean(spark):
    g = np.random.default_rng(5)
    n, d = 1500, 48
    z = g.standard_normal((n, d))
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    noise = g.standard_normal((n, d))
    noise -= (noise * z).sum(1, keepdims=True) * z
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    mean = np.zeros(d)
    mean[0] = 1.8
    x = np.concatenate([z + mean, np.cos(0.88) * z + np.sin(0.88) * noise + mean])
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = y @ y.T >= 0.9
    np.fill_diagonal(near, False)
    out = {r.vec_id: r.n_links for r in embedding_near_dedup(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    found, true = sum(out.values()), int(near.sum())
    assert true > 2000 and 0.995 * true <= found <= true
