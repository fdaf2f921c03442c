import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillspark.functions.hashing import simhash64_of
from quillspark.operators import dedup, gold, leakage, outcomes, registry, search, training
from quillspark.operators.reconstruction import RULES, staged
from quillspark.plans import corpus
from quillspark.plans.components import components


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(0, 90), rng.randrange(0, 90)) for _ in range(60)]
    label = {i: i for i in range(200)}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    nodes = spark.range(200).select(F.col("id").alias("node"))
    out = components(spark.createDataFrame(edges, "a long, b long"), nodes)
    assert {r.node: r.component for r in out.collect()} == label


def test_first_occurrences_is_the_sequential_loop(spark):
    rng = random.Random(2)
    rows = [(i, f"a{rng.randrange(12)}", f"b{rng.randrange(12)}") for i in range(80)]
    seen, kept = set(), {}
    for i, a, b in rows:
        kept[i] = not {("a", a), ("b", b)} & seen
        if kept[i]:
            seen |= {("a", a), ("b", b)}
    out = dedup.first_occurrences(spark.createDataFrame(rows, "o int, a string, b string"), "o", "a", "b")
    assert {r.o: r.kept for r in out.collect()} == kept


def test_groups_splits_and_leaks(spark):
    texts = {"s1": "A simple line, of words!", "s2": "a simple line of words", "s3": "something else entirely here", "s4": "derived from the third one now", "s5": ""}
    docs = spark.createDataFrame([(k, v, "s3" if k == "s4" else None) for k, v in texts.items()], "s string, text string, parent string")
    ids = dedup.identities(docs, F.col("s"), "text", F.col("parent"))
    out = {r.source: r for r in dedup.with_split(dedup.group_ids(ids, 8), "salt").collect()}
    assert out["s1"].group_id == out["s2"].group_id != out["s3"].group_id == out["s4"].group_id
    assert len({r.group_id for r in out.values()}) == 3 and all(r.split in dedup.SPLITS for r in out.values())
    members = spark.createDataFrame([("x", "t1", "g", "train"), ("y", "t1", "g", "test"), ("z", None, "h", "test")], "source_content_hash string, transcript_sha256 string, near_duplicate_group string, split string")
    assert sorted((r.kind, r.value) for r in dedup.cross_split_leaks(members).collect()) == [("near_duplicate_group", "g"), ("transcript_sha256", "t1")]
    left = dedup.gold_exclusions(ids, ids.where("source = 's1'"), 3)
    assert sorted(r.source for r in left.collect()) == ["s3", "s4", "s5"]
    assert dedup.eligible_for(docs, "performance_learning").first().reason.startswith("missing")


def test_near_pairs_is_brute_force_up_to_three_bits(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(20)]
    values = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(0, 6))) for b in base for _ in range(4)]
    rows = [(f"k{i:03d}", v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    label = list(range(len(values)))
    for _ in values:
        for a in range(len(values)):
            for b in range(a):
                if bin(values[a] ^ values[b]).count("1") <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    pairs = dedup.near_pairs(spark.createDataFrame(rows, "source string, simhash long"))
    out = components(pairs, spark.createDataFrame(rows, "node string, x long").select("node"))
    assert {r.node: r.component for r in out.collect()} == {f"k{i:03d}": f"k{label[i]:03d}" for i in range(len(values))}
    assert simhash64_of([]) == -1


def test_capped_sample_is_the_greedy_loop(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        cluster = rng.randrange(6)
        rows.append((f"e{i:03d}", f"c{cluster}", f"c{cluster}s{rng.randrange(3)}", rng.choice(["x", "y"]), rng.choice([0.1, 0.5, 0.9])))
    by_cluster, by_source, want = Counter(), Counter(), {}
    for k, c, s, o, q in sorted(rows, key=lambda r: (-r[4], r[0])):
        reason = None
        if by_cluster[c, o] >= 5:
            reason = "sampling_cluster_cap"
        if by_source[s, o] >= 2:
            reason = "sampling_source_cap"
        want[k] = reason
        if not reason:
            by_cluster[c, o] += 1
            by_source[s, o] += 1
    df = spark.createDataFrame(rows, "k string, c string, s string, o string, q double")
    out = training.capped_sample(df, "s", "c", "o", "q", "k", 2, 5).collect()
    assert {r.k: r.selected for r in out} == {k: v is None for k, v in want.items()}
    assert {r.k: r.reason for r in out} == want


def test_leakage_cases(spark):
    target = "this is a very specific sentence that nobody else would ever say in quite this way"
    rows = spark.createDataFrame([(1, target, target), (2, "cooking, educate, tutorial", target), (3, "", ""), (4, "a very specific sentence that nobody else would say", target)], "id int, c string, t string")
    out = {r.id: r.m for r in rows.select("id", leakage.leakage(F.col("c"), F.col("t")).alias("m")).collect()}
    assert out[1].severity == "high" and out[1].longest_run == 16 and out[1].rejected
    assert out[2].severity == "none" and out[3].severity == "none" and out[3].shared_5gram_share == 0
    assert out[4].longest_run == 8 and out[4].severity == "high"


def test_script_checks(spark):
    section = "array<struct<role:string,start_seconds:double,end_seconds:double>>"
    rows = spark.createDataFrame(
        [("good", "word " * 50, 20.0, ["bad phrase"], [("hook", 0.0, 3.0), ("body", 3.0, 20.0)], "act now", "please act now", [("r1", "h1")]), ("poor", "a BAD phrase", 60.0, ["bad phrase"], [("hook", 3.0, 1.0)], "act", "", [("r9", "h9")])],
        f"id string, spoken_script string, desired_duration double, banned array<string>, sections {section}, desired_cta string, cta string, evidence array<struct<record_id:string,source_content_hash:string>>",
    )
    none = spark.createDataFrame([], "id string, source string, shared long, share double, longest struct<token_count:int,phrase:string>")
    out = leakage.evaluate_scripts(rows, none, spark.createDataFrame([("r1",)], "record_id string")).collect()
    failed = {k: {r.name for r in out if r.id == k and r.status == "fail"} for k in ("good", "poor")}
    assert failed["good"] == set()
    assert failed["poor"] == {"estimated_duration_compliance", "banned_pattern_compliance", "section_timestamp_validity", "required_section_coverage", "cta_contract_compliance", "retrieval_reference_integrity"}


def test_gold_metrics(spark):
    labels = spark.createDataFrame([("r1", "topic", "value", ["A "]), ("r2", "topic", "unknown", None), ("r3", "topic", "value", ["b"]), ("r4", "topic", "partial", None), ("r5", "topic", "not_inferable", None), ("r6", "topic", "value", ["c"])], "record_id string, field string, status string, acceptable array<string>")
    briefs = spark.createDataFrame([("r1", "topic", ["a"], 0.9), ("r2", "topic", None, None), ("r3", "topic", ["x"], 0.7), ("r4", "topic", ["y"], 0.2), ("r5", "topic", ["z"], 1.0), ("r6", "topic", None, None)], "record_id string, field string, value array<string>, confidence double")
    rows = gold.judged(labels, briefs)
    assert {r.record_id: r.outcome for r in rows.collect()} == {"r1": "accepted", "r2": "correct_abstention", "r3": "wrong", "r4": "partial", "r5": "unsupported_inference", "r6": "unnecessary_abstention"}
    m = gold.field_metrics(rows).first()
    assert (m.total, m.acceptance_rate, m.unsupported_inference_rate) == (6, 0.1667, 0.1667)
    bands = {r.bucket: (r.total, r.accepted) for r in gold.band_calibration(rows).collect()}
    assert bands == {"high": (2, 1), "medium": (1, 0), "low": (1, 0), "unknown": (2, 0)}
    assert gold.expected_calibration_error(gold.numeric_calibration(rows)).first()[0] == pytest.approx((0.45 * 2 + 0.7 + 0.2) / 4)
    gates = {r.gate: r.passed for r in gold.quality_gates(gold.field_metrics(rows), 100, 0).collect()}
    assert gates["minimum_human_reviewed_sources"] and not gates["topic_acceptance"] and not gates["false_cta_inference"] and len(gates) == 8


def test_agreement_anomalies_projection(spark):
    a = spark.createDataFrame([("r", "p", "f", "value", ["x", "y"]), ("r", "q", "f", "value", ["Y", "x"]), ("s", "p", "f", "value", ["x"]), ("s", "q", "f", "unknown", None), ("t", "p", "f", "value", ["x"])], "record_id string, reviewer_id string, field string, status string, acceptable array<string>")
    r = gold.agreement(a).first()
    assert (r.compared, r.exact, r.inferability) == (2, 1, 1) and gold.agreement(a, list_order=True).first().exact == 0
    b = spark.createDataFrame([(f"r{i}", "topic", "same" if i < 4 else "other", 0.5, "model_inference", ["s"] if i else []) for i in range(6)], "record_id string, field string, value string, confidence double, evidence_type string, sources array<string>")
    found = Counter(r.category for r in gold.anomalies(b).collect())
    assert found == {"generic_topic_collapse": 4, "empty_evidence": 1}
    assert gold.anomaly_rate(gold.anomalies(b), b).first().anomaly_rate == 0.6667
    pilot = spark.createDataFrame([(10, 30, 1000, 500)], "records long, requests long, input_tokens long, output_tokens long")
    assert {r.band: (r.requests, r.cost) for r in gold.cost_projection(pilot, 7500).collect()} == {"low": (18000, None), "expected": (22500, None), "high": (29250, None)}


def test_stratified_sample_is_the_sequential_loop(spark):
    rng = random.Random(5)
    rows = [(f"h{i:03d}", [f"d={rng.choice('ab')}", f"w={rng.choice('xyz')}"]) for i in range(60)]
    left, seen, want = dict(rows), Counter(), []
    while len(want) < 12:
        best = min(left, key=lambda k: (sum(seen[x] for x in left[k]), k))
        seen.update(left.pop(best))
        want.append(best)
    out = gold.stratified_sample(spark.createDataFrame(rows, "source_content_hash string, strata array<string>"), 12)
    assert [r.source_content_hash for r in out.orderBy("place").collect()] == want


def test_outcomes(spark):
    schema = "schema_version string, report_id string, platform string, account_context_id string, published_at string, measured_at string, measurement_window_hours double, metrics map<string,double>, rights struct<training_allowed:boolean,basis:string>, cohort_normalization struct<cohort_key:string,method:string,cohort_size:int>"
    good = ("1.0.0", "r", "p", "a", "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", 24.0, {"views": 10.0, "completion_rate": 0.5, "other": -3.0}, (True, "owner"), None)
    change = lambda **k: tuple(k.get(n, v) for n, v in zip([c.split()[0] for c in schema.split(", ")], good))
    rows = [good, change(metrics={"skip_rate": 1.2}), change(measured_at="2023-01-01T00:00:00Z"), change(metrics={"views": 1.5}), change(published_at="soon"), change(rights=(None, " ")), change(cohort_normalization=("k", "m", 0))]
    out = [len(r.problems) for r in outcomes.checked(spark.createDataFrame(rows, schema)).collect()]
    assert out == [0, 1, 1, 1, 1, 2, 1]


def test_registry(spark):
    reports = spark.createDataFrame([(i, "train" if i < 8 else "test", f"a{i}") for i in range(10)], "id int, split string, artifact string")
    taken = spark.createDataFrame([(0, "consumed"), (1, "reserved"), (2, "consumed")], "id int, status string")
    runs = spark.createDataFrame([(1, "r1", "done"), (2, "r2", "failed")], "id int, run_id string, state string")
    assert registry.active_run(runs).first().run_id == "r2" and registry.active_run(runs.where("id = 1")).first().run_id is None
    options = dict(rights_allowed=True, least_new=2, most_new=3, replay_percent=50, seed="s")
    with pytest.raises(ValueError):
        registry.propose_run(reports, taken, runs, "id", F.col("artifact"), **options)
    members = registry.propose_run(reports, taken, runs.where("id = 1"), "id", F.col("artifact"), **options).collect()
    assert sorted((r.id, r.role) for r in members) == [(0, "replay"), (2, "replay"), (3, "new"), (4, "new"), (5, "new"), (8, "evaluation"), (9, "evaluation")]
    with pytest.raises(KeyError):
        registry.point_lookup(reports, "id", 99, "split")
    fresh = spark.createDataFrame([(0, "x"), (11, "y"), (11, "y")], "id int, status string")
    assert [r.id for r in registry.append_new(taken, fresh, ["id"]).collect()] == [11]


def test_search(spark):
    rows = [("r1", "h1", "garden tools for small gardens", "yt", 20.0, ["question"], ["hook:question"]), ("r2", "h2", "garden tools for small gardens today", "yt", 30.0, ["question"], ["hook:question", "edit:cut"]), ("r3", "h3", "cooking pasta at home", "yt", 90.0, ["authority"], ["hook:authority"]), ("r4", "h1", "tools and paint", "tt", 10.0, [], [])]
    df = spark.createDataFrame(rows, "record_id string, source_content_hash string, text string, platform string, duration_seconds double, hooks array<string>, fingerprint array<string>").withColumn("devices", F.array().cast("array<string>")).withColumn("vector", F.lit(None).cast("array<double>"))
    got = lambda **k: [r.record_id for r in search.search(df, search.SearchQuery(**k)).orderBy("place").collect()]
    assert got(text="small garden tools") [0] in ("r1", "r2") and "r3" not in got(text="small garden tools")
    assert got(platform="tt") == ["r4"] and got(max_duration_seconds=25.0, platform="yt") == ["r1"]
    assert got(hook_mechanisms=("authority",)) == ["r3"] and got(exclude_source_hashes=("h1",)) == ["r2", "r3"]
    assert got(structural_fingerprint=("hook:question",))[:2] == ["r1", "r2"]
    assert [r.record_id for r in search.structurally_similar(df, "r1", 3).collect()] == ["r2", "r3"]
    with pytest.raises(ValueError):
        search.SearchQuery(top_k=0)


def test_reconstruction_retries_caches_and_fails_closed(spark):
    rows = spark.createDataFrame([("a", "how to bake in one step"), ("b", "nothing"), ("c", "boom")], "record_id string, clean_transcript string")
    rows = rows.withColumns({"hook_mechanisms": F.array().cast("array<struct<mechanism:string,confidence:double>>"), "roles": F.array(F.lit("hook")), "words_per_second": F.lit(2.0), "person_usage": F.lit("x"), "vocabulary": F.lit("y")})

    def adapter(request, stage):
        if request["transcript"] == "boom":
            raise RuntimeError("no")
        return {"content_objective": ("educate", 0.62)} if "how to" in request["transcript"] and stage == "objective_format" else {}

    fields, results = staged(rows, adapter=adapter)
    assert [(r.record_id, r.field, r.value, r.accepted) for r in fields.collect()] == [("a", "content_objective", "educate", True)]
    assert results.where("error is not null").count() == 3
    again, _ = staged(rows.where("record_id <> 'c'"), cache=results.where("error is null"), adapter=adapter)
    assert again.count() == 1 and len(RULES) == 2


def test_training_dataset_end_to_end(spark):
    body = "Why do you stop here? {0} Because the garden number {0} needs water and light every single day of spring.\nThen we look at {0} more plants with care and time.\nFinally we choose {0} and act on the plan today."
    docs = spark.createDataFrame([(i, body.format(f"plant{i} rose{i * 3} fern{i * 7} moss{i * 11}"), "topic", "en") for i in range(12)] + [(90, body.format("plant1 rose3 fern7 moss11"), "topic", "en"), (91, " ", "t", "en")], "doc_id int, text string, topic string, lang string")
    made = corpus.training_dataset(docs, topic=F.col("topic"), language=F.col("lang"), per_source=2)
    examples = made.examples.collect()
    assert len({r.key for r in examples}) == 12 and {r.objective for r in examples} >= {"full_script_sft", "hook_sft", "continuation_sft", "structure_sft", "section_sft", "style_sft"}
    assert len({r.example_id for r in examples}) == len(examples)
    gates = {r.gate: r.passed for r in made.gates.collect()}
    assert len(gates) == 14 and gates["zero_cross_split_duplicate_leakage"] and not gates["sufficient_human_inspection"]
    assert training.readiness_status(made.gates).first().status == "not_training_ready"
    assert made.manifests.count() >= 1


def test_leakage_names_each_measure_once(spark):
    """n-grams of both texts are made once a row, not once for each use; no measure depends on the way."""
    assert str(leakage.leakage(F.col("c"), F.col("t"))).count("slice(") == 2
    rng = random.Random(5)
    some = lambda n: " ".join(rng.choice("ab cd ef gh ij kl mn op qr".split()) + rng.choice(["", "", "", ".", "…", "?"]) for _ in range(n))
    rows = [(i, c, c[: rng.randrange(60)] + some(rng.randrange(30))) for i in range(60) for c in [some(rng.randrange(30))]] + [(60, None, "a"), (61, "a", None), (62, "", "")]
    got = spark.createDataFrame(rows, "id int, c string, t string").select("id", leakage.leakage(F.col("c"), F.col("t")).alias("m"), leakage.leakage(F.col("c"), F.col("t"), exact_run=False).alias("w")).collect()
    for r in got:  # the way without runs skips nothing
        assert [r.m[k] for k in ("token_set_jaccard", "shared_5gram_share", "exact_sentences")] == [r.w[k] for k in ("token_set_jaccard", "shared_5gram_share", "exact_sentences")]
    assert sum(r.m.shared_5gram_share > 0 for r in got) > 5 and any(r.m.exact_sentences for r in got)


def test_training_dataset_is_dealt_to_tasks(spark, monkeypatch):
    """A table in one file doesn't make one task; repeated rows aren't multiplied."""
    docs = spark.createDataFrame([(i, f"Opening line {i}.\nSome words of body {i} here.") for i in range(40)] + [(0, "Opening line 0.\nSome words of body 0 here.")], "doc_id long, text string").coalesce(1)
    tasks, materialised = [], corpus.materialised
    monkeypatch.setattr(corpus, "materialised", lambda df: (tasks.append(df.rdd.getNumPartitions()), materialised(df))[1])
    made = corpus.training_dataset(docs).examples
    assert tasks[0] >= 4 and max(tasks[1:]) >= 4
    assert made.where("key = 0 and objective = 'hook_sft'").count() == 2
