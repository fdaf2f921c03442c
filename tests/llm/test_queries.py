"""The registered queries over whole tables: rows, hold-outs, cuts and columns of their contracts."""

import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{SF}/{n}.parquet").collect() for n in ("documents", "labels", "embeddings")}


def run(spark, name):
    return entry.queries()[name](spark, SF)


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.mark.parametrize("name, modulo, out, label", [("op2_toxicity", 4, 2, "toxic"), ("op3_quality", 5, 0, "quality")])
def test_scores(spark, tables, name, modulo, out, label):
    rows = run(spark, name).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in tables["documents"])
    assert all(r.held_out == (fold(r.doc_id, modulo) == out) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    truth = {r.doc_id: r[label] for r in tables["labels"]}
    good, bad = ([r.score for r in rows if truth.get(r.doc_id) == y] for y in (1, 0))
    assert np.mean([x > y for x in good for y in bad]) > 0.9  # learned and held-out rows together: the table is small


def test_languages(spark, tables):
    rows = run(spark, "op9_language_id").collect()
    lang = {r.doc_id: r.lang for r in tables["documents"]}
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert len(rows) == len(lang) and len(held) > 20 and np.mean(held) > 0.9


def test_mix_secrets_and_lines(spark, tables):
    docs = {r.doc_id: r for r in tables["documents"]}
    mix = run(spark, "op4_mixing").collect()
    assert len(mix) == len(docs) and all(r.taken <= 2 * r.size for r in mix)
    by: dict = {}
    for r in mix:
        by.setdefault(docs[r.doc_id].source, [r.target, 0])[1] += r.taken
    assert abs(sum(t for t, _ in by.values()) - 1.5 * sum(r.size for r in mix)) < 1 and all(abs(n - t) <= max(5, 0.02 * t) for t, n in by.values())  # a source has ten documents here
    secrets = run(spark, "op5_secret_scan").collect()
    plain = (r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]{6,})""", r"(AKIA[A-Z0-9]{16,})", r"([0-9a-f]{24,})")
    assert len(secrets) == len(docs)
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex) for r in secrets} == {i: tuple(len(re.findall(x, d.text, re.A)) for x in plain) for i, d in docs.items()}
    lines = run(spark, "op1_line_dedup").collect()
    assert all(r.n_lines == docs[r.doc_id].text.count("\n") + 1 for r in lines) and sum(r.n_dropped for r in lines) > 0 and len(lines) == len(docs)


def test_vectors(spark, tables):
    x = np.array([r.embedding for r in tables["embeddings"]], float)
    ids = np.array([r.vec_id for r in tables["embeddings"]])
    found: dict = {}
    for r in run(spark, "op6_nearest_neighbours").collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(found) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, own in found.items():
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        hits += len(own & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(found)
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (y @ y.T >= 0.9).sum(1) - 1
    dedup = {r.vec_id: r.n_links for r in run(spark, "op8_vector_dedup").collect()}
    assert len(dedup) == len(ids) and all(dedup[i] <= n for i, n in zip(ids.tolist(), near)) and sum(dedup.values()) >= 0.97 * near.sum()


def test_pieces_and_groups(spark, tables):
    pieces = run(spark, "op7_packing").collect()
    of: dict = {}
    for r in pieces:
        of[r.doc_id] = of.get(r.doc_id, 0) + r.length
    assert all(of[r.doc_id] == r.doc_tokens for r in pieces) and len(of) == len(tables["documents"])
    groups = {r.doc_id: r.component_id for r in run(spark, "op10_ngram_jaccard_join").collect()}
    first: dict = {}
    for r in sorted(tables["documents"], key=lambda r: r.doc_id):
        assert groups[r.doc_id] == groups[first.setdefault(r.text, r.doc_id)]
