import pytest
from pyspark.sql import functions as F

from quillspark.operators import suitability as s

SCHEMA = "key string, word_count int, sentence_count int, hooks array<string>, hook_confidence double, n_beats int, has_cta boolean, words_per_second double"
CASES = [
    ("full_script", (100, 5, ["question"], 0.7, 1, False, 2.5), "eligible"),
    ("full_script", (90, 4, [], 0.0, 1, False, 2.5), "marginal"),
    ("full_script", (50, 2, [], 0.0, 1, False, 2.5), "marginal"),
    ("full_script", (10, 1, [], 0.0, 1, False, 2.5), "ineligible"),
    ("full_script", (0, 0, [], 0.0, 0, False, None), "ineligible"),
    ("full_script", (120, 3, ["question"], 0.7, 1, False, 6.5), "ineligible"),
    ("hook", (20, 1, ["question"], 0.75, 1, False, 2.5), "eligible"),
    ("hook", (15, 1, ["question"], 0.3, 1, False, 2.5), "marginal"),
    ("hook", (6, 1, ["question"], 0.6, 1, False, 2.5), "marginal"),
    ("hook", (30, 1, [], 0.0, 1, False, 2.5), "ineligible"),
    ("continuation", (60, 3, [], 0.0, 1, False, 2.5), "eligible"),
    ("continuation", (35, 2, [], 0.0, 1, False, 2.5), "marginal"),
    ("continuation", (15, 1, [], 0.0, 1, False, 2.5), "ineligible"),
    ("structure", (10, 1, [], 0.0, 3, False, 2.5), "eligible"),
    ("structure", (40, 1, ["question"], 0.7, 1, False, 2.5), "eligible"),
    ("structure", (15, 1, [], 0.0, 1, False, 2.5), "ineligible"),
    ("section", (20, 1, [], 0.0, 1, False, 2.5), "eligible"),
    ("section", (10, 1, [], 0.0, 1, False, 2.5), "marginal"),
    ("section", (5, 1, [], 0.0, 1, False, 2.5), "ineligible"),
    ("cta", (20, 1, [], 0.0, 1, True, 2.5), "eligible"),
    ("cta", (20, 1, [], 0.0, 1, False, 2.5), "ineligible"),
    ("measurable_style", (50, 1, [], 0.0, 1, False, 2.5), "eligible"),
    ("measurable_style", (25, 1, [], 0.0, 1, False, 2.5), "marginal"),
    ("measurable_style", (10, 1, [], 0.0, 1, False, 2.5), "ineligible"),
]


def test_tiers(spark):
    rows = [(str(i), *values) for i, (_, values, _) in enumerate(CASES)]
    got = {(r.key, r.objective): r.tier for r in s.exploded(s.assess(spark.createDataFrame(rows, SCHEMA)), "key").collect()}
    for i, (objective, _, tier) in enumerate(CASES):
        assert got[str(i), objective] == tier, CASES[i]


@pytest.fixture
def corpus(spark):
    good, some, silent = (100, 5, ["question"], 0.7, 3, True, 2.5), (45, 2, [], 0.0, 1, False, 2.5), (0, 0, [], 0.0, 0, False, None)
    return s.assess(spark.createDataFrame([(str(i), *(good if i < 5 else some if i < 15 else silent)) for i in range(30)], SCHEMA))


def test_reports(corpus):
    r = s.report(corpus).first()
    assert (r.total_sources, r.with_spoken_transcript, r.script_transcript_rate, r.any_script_eligible, r.full_script_eligible) == (30, 15, 0.5, 15, 5)
    cells = {(x.objective, x.tier): x.n for x in s.crosstab(corpus).collect()}
    assert len(cells) == 21 and cells["full_script", "eligible"] == 5 and cells["cta", "marginal"] == 0
    top = s.reason_histogram(corpus, 2).collect()
    assert top[0].reason == "no_spoken_transcript" and top[0].n == 15 * 7
    assert {x.tag: x.n for x in s.routing_histogram(corpus).collect()} == {"script": 15, "editing": 30, "audio": 30, "visual_color": 30}
    assert {x.p: x.value for x in s.floor_percentiles(corpus, "word_count").collect()} == {10: 0, 25: 0, 50: 0, 75: 45, 90: 100, 95: 100}
    assert {x.p: x.value for x in s.floor_percentiles(corpus.limit(0), "word_count").collect()} == dict.fromkeys((10, 25, 50, 75, 90, 95), 0)


def test_gaps_recommendation_projection(corpus):
    gaps = s.gaps(s.report(corpus), s.floor_percentiles(corpus, "word_count"))
    assert {x.dimension for x in gaps.collect() if x.open} == {"full_script_eligible_rate", "hook_example_count", "cta_example_count", "structure_example_count", "median_transcript_length", "p75_transcript_length"}
    assert s.recommendation(gaps).first().recommendation == "A"
    assert s.recommendation(gaps.withColumn("open", F.lit(False))).first().recommendation == "B"
    assert s.projection(s.report(corpus)).first().projected_full_script_eligible == 1250


def test_primary_reasons_and_silent_reports(spark, corpus):
    assert corpus.where("key = '29'").first().primary_reasons == ["no_spoken_transcript", "cta_absent"]
    reports = spark.createDataFrame([(10.0, (True, True, False, False), True), (2.0, (True, False, False, True), False)], "duration double, flags struct<editing:boolean,audio:boolean,color:boolean,captions:boolean>, has_audio boolean")
    out = s.assess_silent(reports, s.subsystem_results(F.col("duration"), F.col("flags"), F.col("has_audio"))).collect()
    assert [[(x.subsystem, x.tier) for x in r.subsystems] for r in out] == [[("editing", "eligible"), ("audio", "eligible"), ("visual_color", "ineligible")], [("editing", "ineligible"), ("audio", "ineligible"), ("visual_color", "eligible")]]
    assert [r.routing_tags for r in out] == [["audio", "editing"], ["visual_color"]]
    rows = spark.createDataFrame([("a",)] * 7 + [("b",)] * 3, "kind string")
    assert [(r.kind, r.measured) for r in s.archetype_gaps(rows, "kind").collect()] == [("a", 0.7)]
