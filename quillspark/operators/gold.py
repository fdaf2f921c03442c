"""Gold sets: strata, diversity-first selection, agreement, field metrics, confusion, calibration, anomalies, gates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions.hashing import hex64, simhash64
from quillspark.functions.text import composed, normalized
from quillspark.operators.training import bucketed

# Fixed values.
ABSTAINING = ("unknown", "not_inferable", "ambiguous", "reject")
QUALITATIVE = ("partial", "wrong", "too_broad", "too_narrow", "too_vague", "too_detailed", "leakage")
OUTCOMES = ("accepted", *QUALITATIVE, "correct_abstention", "unnecessary_abstention", "unsupported_inference")
GATES = {"minimum_human_reviewed_sources": 100, "topic_acceptance": 0.90, "central_idea_acceptance": 0.85, "objective_acceptance": 0.80, "format_acceptance": 0.80, "unsupported_audience_inference": 0.05, "false_cta_inference": 0.02}
BANDS = (("high", 0.8), ("medium", 0.6), ("low", float("-inf")))
CALIBRATION_EDGES = (0.2, 0.4, 0.6, 0.8)
CORE_FIELDS = ("topic", "central_idea", "target_audience", "content_objective", "content_format", "tone", "desired_outcome", "cta_intent")
COLLAPSE = {"topic": ("generic_topic_collapse", 0.5), "target_audience": ("identical_audience_everywhere", 0.5), "content_objective": ("objective_collapse", 0.8), "content_format": ("format_collapse", 0.8)}


def strata(duration: Column, words: Column, rate: Column, hook: Column, roles: Column, confidence: Column, complexity: Column, has_cta: Column) -> Column:
    """The eight strata of a record as an array of dimension=value strings."""
    parts = {
        "duration": bucketed(duration, (20, 45, 75), ("short", "medium", "long", "very_long")),
        "word_count": bucketed(words, (60, 140, 250), ("very_short", "short", "medium", "long")),
        "speaking_rate": bucketed(rate, (1.8, 2.8, 3.8), ("slow", "typical", "fast", "very_fast")),
        "hook": F.coalesce(hook, F.lit("none")),
        "structure": F.when(F.size(roles) > 0, F.array_join(F.slice(roles, 1, 3), "+")).otherwise("unknown"),
        "transcript_confidence": bucketed(confidence, (0.6, 0.85), ("low", "medium", "high")),
        "semantic_complexity": bucketed(complexity, (80, 180, 320), ("low", "medium", "high", "very_high")),
        "cta": F.when(has_cta, "present").otherwise("absent_or_unknown"),
    }
    return F.array(*[F.concat(F.lit(f"{k}="), v) for k, v in parts.items()])


def stratified_sample(records: DataFrame, count: int, source: str = "source_content_hash", column: str = "strata") -> DataFrame:
    """count records, each time the one whose strata are least represented so far, ties to the smaller source; adds place from 1.

    Of records with the same strata only the count smallest sources can be chosen, so the sequential loop
    sees count rows for each different combination of strata, however many records there are.
    """
    rank = F.row_number().over(Window.partitionBy(F.array_join(column, "|")).orderBy(source))
    few = records.where(F.col(source).isNotNull()).withColumn("_r", rank).where(F.col("_r") <= count).select(source, column)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        groups: dict[tuple[str, ...], list[str]] = {}
        for s, x in zip(rows[source], rows[column]):
            groups.setdefault(tuple(x), []).append(s)
        for own in groups.values():
            own.sort(reverse=True)
        seen: dict[str, int] = {}
        out = []
        while groups and len(out) < count:
            best = min(groups, key=lambda g: (sum(seen.get(x, 0) for x in g), groups[g][-1]))
            out.append(groups[best].pop())
            for x in best:
                seen[x] = seen.get(x, 0) + 1
            if not groups[best]:
                del groups[best]
        return pd.DataFrame({source: out, "place": range(1, len(out) + 1)})

    kind = records.schema[source].dataType.simpleString()
    chosen = few.groupBy().applyInPandas(choose, f"{source} {kind}, place int")
    return records.join(chosen, source)


def gold_entries(sample: DataFrame, text: str) -> DataFrame:
    """What a gold manifest keeps of each record: no text, only hashes."""
    body = normalized(F.col(text))
    return sample.select("record_id", "source_content_hash", F.sha2(body, 256).alias("transcript_sha256"), hex64(simhash64(composed(F.col(text)))).alias("transcript_simhash64"), "strata")


def selection_id(entries: DataFrame) -> DataFrame:
    """A digest of a selection's sources in order; the selection is at most as long as was asked for."""
    lines = F.array_join(F.array_sort(F.collect_list("source_content_hash")), "\n")
    return entries.agg(F.concat(F.lit("goldsel:"), F.substring(F.sha2(lines, 256), 1, 16)).alias("selection_id"), F.count(F.lit(1)).alias("entries"))


def training_exclusions(entries: DataFrame) -> DataFrame:
    """(kind, value): sorted different hashes to keep out of training."""
    long = entries.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("source_content_hash", "transcript_sha256", "transcript_simhash64")])))
    return long.where("value is not null").distinct().orderBy("kind", "value")


def label_outcome(predicted: Column, status: Column, acceptable: Column) -> Column:
    """How a prediction (array of values, null to abstain) stands to a label."""
    low = lambda v: F.lower(F.trim(v))
    match = F.size(F.array_intersect(F.transform(predicted, low), F.transform(F.coalesce(acceptable, F.array().cast("array<string>")), low))) > 0
    return (
        F.when(status.isin(*ABSTAINING), F.when(predicted.isNull(), "correct_abstention").otherwise("unsupported_inference"))
        .when(predicted.isNull(), "unnecessary_abstention")
        .when(status == "accepted", "accepted")
        .when(status.isin(*QUALITATIVE), status)
        .when(match, "accepted")
        .otherwise("wrong")
    )


def judged(labels: DataFrame, predictions: DataFrame) -> DataFrame:
    """Labels (record_id, field, status, acceptable) of records that have predictions (record_id, field, value, confidence), with outcome."""
    known = labels.join(predictions.select("record_id").distinct(), "record_id", "left_semi")
    return known.join(predictions.select("record_id", "field", F.col("value").alias("predicted"), "confidence"), ["record_id", "field"], "left").withColumn("outcome", label_outcome(F.col("predicted"), F.col("status"), F.col("acceptable")))


def field_metrics(rows: DataFrame) -> DataFrame:
    """For each field the outcomes' counts and five rates."""
    counts = rows.groupBy("field").agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES], F.count(F.lit(1)).alias("total"))
    rate = lambda c, name: F.round(F.col(c) / F.col("total"), 4).alias(name)
    return counts.select("*", rate("accepted", "acceptance_rate"), rate("unsupported_inference", "unsupported_inference_rate"), rate("unsupported_inference", "false_inference_rate"), rate("correct_abstention", "correct_abstention_rate"), rate("unnecessary_abstention", "unnecessary_abstention_rate"))


def simple_metrics(rows: DataFrame) -> DataFrame:
    """The simpler evaluation: an abstention where a value was due is wrong."""
    o = F.when(F.col("outcome") == "unsupported_inference", "false_inference").when(F.col("outcome").isin("accepted", "correct_abstention"), F.col("outcome")).otherwise("wrong")
    return rows.groupBy("field").agg(*[F.count_if(o == k).alias(k) for k in ("accepted", "wrong", "correct_abstention", "false_inference")])


def confusion(pairs: DataFrame, field: str = "field", prediction: str = "prediction", truth: str = "truth") -> DataFrame:
    return pairs.groupBy(field, prediction, truth).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(counts: DataFrame, field: str = "field", prediction: str = "prediction", truth: str = "truth") -> DataFrame:
    """Precision, recall and F1 of each class, each rounded to 4 places before it is used."""
    said = counts.groupBy(field, F.col(prediction).alias("label")).agg(F.sum("n").alias("predicted_count"))
    real = counts.groupBy(field, F.col(truth).alias("label")).agg(F.sum("n").alias("truth_count"))
    hits = counts.where(F.col(prediction) == F.col(truth)).select(field, F.col(truth).alias("label"), F.col("n").alias("true_positives"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    rows = said.join(real, [field, "label"], "full").join(hits, [field, "label"], "left").select(field, "label", *[zero(c) for c in ("truth_count", "predicted_count", "true_positives")])
    part = lambda of: F.when(F.col(of) > 0, F.round(F.col("true_positives") / F.col(of), 4)).otherwise(0.0)
    rows = rows.withColumn("precision", part("predicted_count")).withColumn("recall", part("truth_count"))
    both = F.col("precision") + F.col("recall")
    return rows.withColumn("f1", F.when(both > 0, F.round(2 * F.col("precision") * F.col("recall") / both, 4)).otherwise(0.0))


def macro_f1(classes: DataFrame, field: str = "field") -> DataFrame:
    return classes.groupBy(field).agg(F.round(F.sum(F.col("f1").cast("decimal(10,4)")).cast("double") / F.count(F.lit(1)), 4).alias("macro_f1"), F.count(F.lit(1)).alias("label_count"))


def _calibration(rows: DataFrame, bucket: Column) -> DataFrame:
    accepted = F.count_if(F.col("outcome") == "accepted")
    out = rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("total"), accepted.alias("accepted"), F.avg("confidence").alias("_c"))
    out = out.withColumn("acceptance_rate", F.round(F.col("accepted") / F.col("total"), 4)).withColumn("mean_confidence", F.round("_c", 4)).drop("_c")
    return out.withColumn("calibration_gap", F.round(F.abs(F.col("mean_confidence") - F.col("acceptance_rate")), 4))


def band_calibration(rows: DataFrame) -> DataFrame:
    """By confidence band: high, medium, low, unknown."""
    c = F.col("confidence")
    return _calibration(rows, F.when(c.isNull(), "unknown").when(c >= 0.8, "high").when(c >= 0.6, "medium").otherwise("low"))


def numeric_calibration(rows: DataFrame) -> DataFrame:
    """By fifths of the confidence; the last one holds 1."""
    return _calibration(rows.where("confidence >= 0 and confidence < 1.01"), bucketed(F.col("confidence"), (*CALIBRATION_EDGES, 1.01), ("0.0-0.2", "0.2-0.4", "0.4-0.6", "0.6-0.8", "0.8-1.0")))


def expected_calibration_error(numeric: DataFrame) -> DataFrame:
    return numeric.agg(F.round(F.sum(F.col("calibration_gap") * F.col("total")) / F.sum("total"), 4).alias("expected_calibration_error"))


def errors(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("outcome").isin("accepted", "correct_abstention")).select("record_id", "field", "outcome", "predicted", "confidence")


def agreement(annotations: DataFrame, list_order: bool = False) -> DataFrame:
    """For each field: record-fields with two reviewers or more, and how many agree exactly and on inferability.

    annotations: (record_id, reviewer_id, field, status, acceptable). A reviewer's last row counts.
    """
    values = F.coalesce("acceptable", F.array().cast("array<string>"))
    low = F.transform(values, lambda v: F.lower(F.trim(v)))
    said = F.concat_ws("|", "status", F.array_join(low if list_order else F.array_sort(low), ","))
    one = annotations.select("record_id", "reviewer_id", "field", said.alias("_s"), (~F.col("status").isin(*ABSTAINING)).alias("_i")).dropDuplicates(["record_id", "reviewer_id", "field"])
    pairs = one.groupBy("record_id", "field").agg(F.count(F.lit(1)).alias("reviewers"), F.count_distinct("_s").alias("answers"), F.count_distinct("_i").alias("kinds")).where("reviewers >= 2")
    out = pairs.groupBy("field").agg(F.count(F.lit(1)).alias("compared"), F.count_if(F.col("answers") == 1).alias("exact"), F.count_if(F.col("kinds") == 1).alias("inferability"))
    return out.withColumn("exact_rate", F.round(F.col("exact") / F.col("compared"), 4)).withColumn("inferability_rate", F.round(F.col("inferability") / F.col("compared"), 4))


def latest_annotations(annotations: DataFrame, at: str = "created_at") -> DataFrame:
    """The latest row of each record, reviewer, mode and field."""
    keys = ["record_id", "reviewer_id", "mode", "field"]
    last = Window.partitionBy(*keys).orderBy(F.desc(at))
    return annotations.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")


def resolved(annotations: DataFrame, adjudications: DataFrame, at: str = "created_at") -> DataFrame:
    """One label for each record and field: the adjudicated one, else the first annotation's."""
    first = annotations.groupBy("record_id", "field").agg(F.min_by(F.struct("status", "acceptable"), F.struct(at, "reviewer_id")).alias("_a"))
    ruled = adjudications.select("record_id", "field", F.struct("status", "acceptable").alias("_r"))
    return first.join(ruled, ["record_id", "field"], "left").select("record_id", "field", F.coalesce("_r", "_a").alias("_l")).select("record_id", "field", "_l.*")


def quality_gates(metrics: DataFrame, reviewed: int, high_leakage: int | None, fixture: bool = False, thresholds: dict[str, float] = GATES) -> DataFrame:
    """(gate, passed): a metric that is missing fails its gate. metrics: field_metrics()."""
    value = lambda field, column: F.max(F.when(F.col("field") == field, F.col(column)))
    at_least = lambda f, k: F.coalesce(value(f, "acceptance_rate") >= thresholds[k], F.lit(False))
    at_most = lambda f, k: F.coalesce(value(f, "unsupported_inference_rate") <= thresholds[k], F.lit(False))
    row = metrics.agg(
        at_least("topic", "topic_acceptance").alias("topic_acceptance"),
        at_least("central_idea", "central_idea_acceptance").alias("central_idea_acceptance"),
        at_least("content_objective", "objective_acceptance").alias("objective_acceptance"),
        at_least("content_format", "format_acceptance").alias("format_acceptance"),
        at_most("target_audience", "unsupported_audience_inference").alias("unsupported_audience_inference"),
        at_most("cta_intent", "false_cta_inference").alias("false_cta_inference"),
    ).withColumns({"minimum_human_reviewed_sources": F.lit(reviewed >= thresholds["minimum_human_reviewed_sources"] and not fixture), "zero_high_severity_leakage": F.lit(high_leakage == 0)})
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("gate"), F.col(c).alias("passed")) for c in row.columns])))


def anomalies(briefs: DataFrame) -> DataFrame:
    """(record_id, category) of briefs in long form (record_id, field, value, confidence, evidence_type, sources).

    A value that too large a share of the records has, repeated or overlong ideas, all core fields
    filled, near-certain confidences and inferences without evidence.
    """
    n = briefs.agg(F.count_distinct("record_id").alias("records"))
    known = briefs.where("value is not null")
    counts = known.groupBy("field", "value").agg(F.count(F.lit(1)).alias("c")).crossJoin(F.broadcast(n))  # one row
    category = F.create_map(*[F.lit(x) for k, (c, _) in COLLAPSE.items() for x in (k, c)])
    share = F.create_map(*[F.lit(x) for k, (_, s) in COLLAPSE.items() for x in (k, s)])
    common = counts.where((F.col("records") >= 5) & F.col("field").isin(*COLLAPSE) & (F.col("c") / F.col("records") > share[F.col("field")])).select("field", "value", category[F.col("field")].alias("category"))
    again = counts.where("field = 'central_idea' and value <> '' and c > 1").select("field", "value", F.lit("repeated_central_idea").alias("category"))
    shared = known.join(common.union(again), ["field", "value"]).select("record_id", "category")
    core = briefs.where(F.col("field").isin(*CORE_FIELDS))
    words = F.size(F.filter(F.split("value", r"\s+"), lambda w: w != ""))
    long = known.where((F.col("field") == "central_idea") & (words > 32)).select("record_id", F.lit("central_idea_too_long").alias("category"))
    full = core.where("value is not null").groupBy("record_id").agg(F.count_distinct("field").alias("k")).where(F.col("k") == len(CORE_FIELDS)).select("record_id", F.lit("all_core_fields_filled").alias("category"))
    sure = core.where("confidence >= 0.98").select("record_id", F.lit("suspiciously_high_confidence").alias("category")).distinct()
    bare = core.where((F.col("evidence_type") == "model_inference") & (F.size("sources") == 0)).select("record_id", F.lit("empty_evidence").alias("category"))
    return shared.union(long).union(full).union(sure).union(bare)


def anomaly_rate(found: DataFrame, briefs: DataFrame) -> DataFrame:
    n = briefs.agg(F.count_distinct("record_id").alias("records"))
    return found.agg(F.count(F.lit(1)).alias("anomaly_count"), F.count_distinct("record_id").alias("_r")).crossJoin(n).select("anomaly_count", F.when(F.col("records") > 0, F.round(F.col("_r") / F.col("records"), 4)).otherwise(0.0).alias("anomaly_rate"))


def contamination(outputs: DataFrame) -> DataFrame:
    """(record_id, field, outputs): fields whose output differs between client contexts. outputs: (record_id, context_id, field, value)."""
    return outputs.groupBy("record_id", "field").agg(F.count_distinct(F.coalesce("value", F.lit("\0"))).alias("outputs")).where("outputs > 1")


def pilot_summary(briefs: DataFrame) -> DataFrame:
    """Records, those with a topic or central idea, and abstentions by field group."""
    per = briefs.groupBy("record_id").agg(F.bool_or(F.col("field").isin("topic", "central_idea") & F.col("value").isNotNull()).alias("usable"), F.count_if(F.col("value").isNull()).alias("abstentions"))
    return per.agg(F.count(F.lit(1)).alias("records"), F.count_if("usable").alias("usable"), F.coalesce(F.sum("abstentions"), F.lit(0)).alias("abstentions"))


def cost_projection(pilot: DataFrame, sources: int, input_price: float = 0.0, output_price: float = 0.0) -> DataFrame:
    """Low, expected and high projections of requests, tokens and cost from averages of a pilot (records, requests, input_tokens, output_tokens)."""
    bands = pilot.sparkSession.createDataFrame([("low", 0.8), ("expected", 1.0), ("high", 1.3)], "band string, factor double")
    scaled = lambda c: F.bround(F.col(c) / F.col("records") * sources * F.col("factor"), 0).cast("long")
    rows = pilot.where("records > 0").crossJoin(F.broadcast(bands)).select("band", *[scaled(c).alias(c) for c in ("requests", "input_tokens", "output_tokens")])  # three rows
    priced = input_price > 0 or output_price > 0
    cost = F.round(F.col("input_tokens") / 1e6 * input_price + F.col("output_tokens") / 1e6 * output_price, 4) if priced else F.lit(None).cast("double")
    return rows.withColumn("cost", cost)
