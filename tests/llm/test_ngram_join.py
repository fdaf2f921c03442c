import random
import re

from quillspark.llm.ngram_join import ngram_jaccard_join


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or {tuple(words)}


def brute(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(a), root(b)
                label[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, i = [], 0
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 12, 40, 90, 300]))]
        for _ in range(rng.choice([1, 1, 2, 3, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((i, rng.choice([" ", "\n", "\t "]).join(copy)))
            i += 1
    rng.shuffle(rows)
    return rows


def check(spark, rows, k, percent):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_join(df, k=k, percent=percent).collect()}
    assert out == brute(rows, k, percent)


def test_equals_brute_force(spark):
    check(spark, corpus(), 3, 90)


def test_default_parameters(spark):
    check(spark, corpus(8, 40), 5, 80)


def test_nulls_blanks_case_and_ties(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One Two"), (5, "one\ttwo "), (6, "ONE"), (7, "É x y"), (8, "é x y"), (9, "a b c d e f"), (10, "A b c d e F"), (11, "one")]
    check(spark, rows, 3, 90)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, node long, block int, n long")
    assert ngram_jaccard_join(empty).columns == ["doc_id", "n_shingles", "component_id"]
    assert ngram_jaccard_join(empty).count() == 0
    df = spark.createDataFrame([(5, "a b c d e f g", 1, 2, 3), (4, "a b c d e f g", 1, 2, 3), (4, "a b c d e f g", 1, 2, 3), (None, "a b", 1, 1, 1)], empty.schema)
    assert sorted((tuple(r) for r in ngram_jaccard_join(df).collect()), key=str) == [(4, 3, 4), (4, 3, 4), (5, 3, 4), (None, 1, None)]


def test_rows_that_share_an_id_and_ids_of_other_types(spark):
    a, b = "one two three four five six seven", "a b c d e f g h"
    df = spark.createDataFrame([("x", a, 1), ("x", b, 2), ("c", b, 3), (None, a, 4), ("y", None, 5), ("y", "", 6)], "doc_id string, text string, _gone int")
    assert sorted((tuple(r) for r in ngram_jaccard_join(df).collect()), key=str) == sorted([("x", 3, "x"), ("x", 4, "c"), ("c", 4, "c"), (None, 3, "x"), ("y", 0, "y"), ("y", 0, "y")], key=str)


def test_a_block_of_more_sets_than_a_cell(spark, monkeypatch):
    import quillspark.llm.ngram_join as n

    monkeypatch.setattr(n, "CELL", 25)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            copy[rng.randrange(60, 120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    check(spark, rows, 3, 90)


def test_a_long_text(spark):
    long = " ".join(f"w{i % 300_000}" for i in range(800_000))
    check(spark, [(1, long), (2, long + " more"), (3, "w1 w2 w3")], 3, 90)


def test_common_shingles_make_no_block_of_unlike_sets(spark, monkeypatch):
    """Sets of which each shingle is in many others: only those with an equal part are compared, and no link is lost."""
    import quillspark.llm.ngram_join as n

    placed = []
    inner = n.linked_in_blocks
    monkeypatch.setattr(n, "linked_in_blocks", lambda rows, *a: placed.append(rows.count()) or inner(rows, *a))
    rng = random.Random(9)
    rows = []
    for i in range(0, 700, 2):
        base = [rng.choice("abcdef") for _ in range(rng.randrange(40, 130))]
        copy = list(base)
        copy[rng.randrange(len(copy))] = rng.choice("abcdef")
        rows += [(i, " ".join(base)), (i + 1, " ".join(copy if i % 20 == 0 else [rng.choice("abcdef") for _ in base]))]
    check(spark, rows, 3, 90)
    assert placed[0] < 150  # 700 with stars around common shingles


def test_sets_that_link_have_an_equal_part():
    import numpy as np

    from quillspark.llm.ngram_join import part_keys, size_classes

    g = np.random.default_rng(4)
    for percent in (50, 80, 90, 95):
        classes, linked = size_classes(percent), 0
        for _ in range(1500):
            n = int(g.integers(1, 400))
            a = np.unique(g.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
            left = int(g.integers(0, (100 - percent) * n // 100 + 1))
            b = np.unique(np.concatenate([a[left:], g.integers(0, 2**63, int(g.integers(0, (100 - percent) * n // 100 + 1)), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * len(np.union1d(a, b)) and len(np.union1d(a, b)) > both:
                linked += 1
                assert len(np.intersect1d(part_keys(a, percent, classes), part_keys(b, percent, classes)))
        assert linked > 100
