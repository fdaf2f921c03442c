import random
import re

from quillspark.llm.mixing import mix_sources, take_mix


def targets(sizes: dict, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8")))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), {}
    while True:
        rest = total - sum(full.values())
        open_ = [s for s in order if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return {**full, **share}
        full |= {s: 2.0 * sizes[s] for s in over}


def corpus():
    rng = random.Random(5)
    rows = []
    for i in range(900):
        source = rng.choice(["a", "a", "a", "b", "é", "Z", None])
        text = rng.choice([None, "", "x y\tz", " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(1, 200)))])
        rows.append((i, text, source, 0))
    return rows + [(5, "same words here", "b", 0)] * 3


def test_targets_sizes_and_takes(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long").repartition(4)
    out = mix_sources(df).collect()
    assert len(out) == len(rows)
    of = {}
    for i, text, source, _ in rows:
        of.setdefault(source, []).append(len(re.findall(r"[^\x20\x09-\x0D]+", text or "")))
    want = targets({s: sum(x) for s, x in of.items()})
    source_of = {i: s for i, _, s, _ in rows[:900] if i != 5}
    taken: dict = {}
    for r in out:
        assert r.taken in (0, r.size, 2 * r.size)
        if r.doc_id in source_of:
            s = source_of[r.doc_id]
            assert r.source_size == sum(of[s]) and abs(r.target - want[s]) < 1e-6
        taken.setdefault((r.source_size, r.target), 0)
        taken[r.source_size, r.target] += r.taken
    for (_, target), words in taken.items():
        assert abs(words - target) <= 3
    again = mix_sources(df.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_mix_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c", "s", 9), (2, "d e", "s", 8), (3, None, None, 7)], "doc_id long, text string, source string, copies long")
    rows = take_mix(df).collect()
    assert all(r.text is not None for r in rows) and take_mix(df).columns == df.columns
    assert mix_sources(df.limit(0)).count() == 0
    assert take_mix(df.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, "", "s"), (2, None, "t")], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mix_sources(blank).collect()] == [(0, 0.0, 0)] * 2


def test_duals_equal_a_plain_solver(spark):
    """The rates against gradient descent's fixed point: the conditions of the optimum, from definitions."""
    import math

    import numpy as np
    from quillspark.llm.mixing import RIDGE

    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * int(math.exp(rng.gauss(2 + k, 0.8)) + 1)), "abcd"[k]) for k in range(4) for i in range(k * 200, k * 200 + 150)]
    out = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=1.0).collect()
    size, rate, target = (np.array([getattr(r, c) for r in out], float) for c in ("size", "rate", "target"))
    source = np.array([rows_of[r.doc_id] for r in out]) if (rows_of := {i: s for i, _, s in rows}) else None
    mean = (size * np.log(size)).sum() / size.sum()
    spread = math.sqrt((size * np.log(size) ** 2).sum() / size.sum() - mean**2)
    z1 = np.clip((np.log(size) - mean) / spread, -3, 3)
    z = np.column_stack([z1, z1 * z1 - 1])
    assert len({round(x, 6) for x in rate[source == "b"]}) > 5  # documents of a source are tilted by their length
    mu, x = np.zeros(2), {s: 0.0 for s in "abcd"}
    goal = (size[:, None] * z).sum(0) * sum({(s, t) for s, t in zip(source, target)} and [t for _, t in {(s, t) for s, t in zip(source, target)}]) / size.sum()
    full = {s: abs(target[source == s][0] - 2 * size[source == s].sum()) < 1e-6 for s in "abcd"}
    for _ in range(4000):  # sources by bisection, the length multipliers by gradient steps
        r = np.zeros(len(size))
        for s in "abcd":
            own = source == s
            lo, hi = -30.0, 30.0
            for _ in range(60):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if (size[own] * np.minimum(2, np.exp(mid + z[own] @ mu))).sum() < target[own][0] else (lo, mid)
            r[own] = 2.0 if full[s] else np.minimum(2, np.exp(lo + z[own] @ mu))
        gradient = (size[:, None] * z * r[:, None]).sum(0) - goal + RIDGE * size.sum() * mu
        if np.abs(gradient).max() < 1e-6 * size.sum():
            break
        mu -= 0.3 * gradient / size.sum()
    assert np.abs(r - rate).max() < 1e-3
    for s in "abcd":
        assert abs((size * rate)[source == s].sum() - target[source == s][0]) < 1e-5 * target[source == s][0]


def test_shared_ids_other_ids_and_private_names(spark):
    rows = [("b", "one two three", None, 1), ("b", "one two", None, 2), (None, "x y z w", None, 3), (None, "x y z w", None, 4), ("c", None, "s", 5), ("d", "word " * 300_000, "s", 6)]
    df = spark.createDataFrame([(i, t, s, n, n, n) for i, t, s, n in rows], "doc_id string, text string, source string, _key int, _copies int, _rank int")
    out = take_mix(df)
    assert out.columns == df.columns
    got: dict = {}
    for r in out.select("_key").collect():
        got[r._key] = got.get(r._key, 0) + 1
    want: dict = {}
    for r in mix_sources(df).collect():
        want[r.size] = want.get(r.size, 0) + r.copies
    assert (got.get(1, 0), got.get(2, 0), got.get(3, 0) + got.get(4, 0), got.get(6, 0)) == (want[3], want[2], want[4], want[300_000])
    assert 5 not in got and max(got.values()) <= 2
