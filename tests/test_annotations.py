import json

import pytest
from pyspark.sql import functions as F

from quillspark.functions import text as t
from quillspark.operators import annotations as a
from quillspark.operators import dedup, gold

NOTE = "schema_version string, record_id string, reviewer_id string, mode string, field string, status string, acceptable array<string>, human_value string, confidence double, created_at int"


def test_payloads(spark):
    records = spark.createDataFrame([("r1", "some words", ["hook"])], "record_id string, clean_transcript string, roles array<string>")
    proposals = spark.createDataFrame([("r1", "a topic")], "record_id string, proposal string")
    blind = json.loads(a.review_payloads(records, "blind", proposals).first().payload)
    assert "proposal" not in blind and blind["source"] == {"transcript": "some words", "roles": ["hook"]} and "topic" in blind["fields"]
    assert json.loads(a.review_payloads(records, "assisted", proposals).first().payload)["proposal"] == "a topic"
    assert json.loads(a.review_payloads(records, "assisted").first().payload)["proposal"] == "{}"
    with pytest.raises(ValueError):
        a.review_payloads(records, "open")


def test_problems_adjudication_and_freezing(spark):
    good = ("1.0.0", "r1", "p", "blind", "topic", "value", ["x"], None, 0.5, 1)
    rows = [good, ("2.0.0", *good[1:]), ("1.0.0", None, "", "open", "topic", "maybe", None, None, None, 1), (*good[:6], None, None, 1.5, 1), (*good[:5], "unknown", None, None, None, 1)]
    df = spark.createDataFrame(rows, NOTE)
    assert [len(r.problems) for r in df.select(a.annotation_problems().alias("problems")).collect()] == [0, 1, 4, 2, 0]
    notes = spark.createDataFrame([good, (*good[:2], "q", *good[3:6], ["y"], None, 0.5, 2)], NOTE)
    rulings = spark.createDataFrame([("r1", "topic", "lead", "value", ["z"])], "record_id string, field string, resolver_id string, status string, acceptable array<string>")
    ruled = a.adjudicated(rulings, notes)
    r = ruled.first()
    assert (r.source_reviewers, r.reviewer_count) == (["p", "q"], 2)
    assert gold.resolved(notes, ruled).first().acceptable == ["z"]
    with pytest.raises(Exception, match="unsupported status"):
        a.adjudicated(rulings.withColumn("status", F.lit("odd")), notes).collect()
    entries = spark.createDataFrame([("r1", "h1")], "record_id string, source_content_hash string")
    first, again = a.frozen(entries, notes, ruled).collect(), a.frozen(entries, notes.repartition(3), ruled).collect()
    assert {x.manifest_id for x in first} == {x.manifest_id for x in again} and len(first) == 5
    assert {x.manifest_id for x in first} != {x.manifest_id for x in a.frozen(entries, notes.limit(1), ruled).collect()}


def test_ablation(spark):
    rows = spark.createDataFrame([("a", "how to bake in one step"), ("b", "nothing here")], "record_id string, clean_transcript string")
    rows = rows.withColumns({"hook_mechanisms": F.array().cast("array<struct<mechanism:string,confidence:double>>"), "roles": F.array(F.lit("hook")), "words_per_second": F.lit(2.0), "person_usage": F.lit("x"), "vocabulary": F.lit("y")})
    labels = spark.createDataFrame([("a", "content_objective", "value", ["educate"]), ("b", "content_objective", "value", ["inform"]), ("b", "topic", "unknown", None)], "record_id string, field string, status string, acceptable array<string>")
    out = {r.variant: r for r in a.ablation(rows, labels).collect()}
    assert set(out) == {"transcript", "structure", "delivery", "full", "full_with_client"}
    assert all((r.record_count, r.input_tokens, r.failed_requests, r.content_objective_acceptance) == (2, 24, 0, 0.5) for r in out.values())


def test_compatibility_characters_are_composed(spark):
    df = spark.createDataFrame([(1, "ﬁnd\u00a0 the ＡＢＣ ①"), (2, "find the ABC 1"), (3, None)], "id int, text string")
    rows = {r.id: r for r in df.select("id", t.clean(F.col("text")).alias("c"), t.normalized(F.col("text")).alias("n")).collect()}
    assert rows[1].c == rows[2].c == "find the ABC 1" and rows[1].n == "find the abc 1" and rows[3].c is None
    ids = {r.source: (r.transcript_sha256, r.simhash) for r in dedup.identities(df.where("id < 3"), F.col("id"), "text").collect()}
    assert ids["1"] == ids["2"]


def test_named_concepts(spark):
    text = "Well So McDonald opened. Let NASA and Ann Lee Van Dyke go. An apple, The End, nasa NASA."
    assert spark.createDataFrame([(text,)], "x string").select(t.named_concepts(F.col("x")).alias("c")).first().c == ["Well So McDonald", "Let NASA", "Ann Lee Van", "Dyke", "An", "The End", "NASA"]
