"""Outcome records: what is wrong with each, and an idempotent append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
COUNTS = ("views", "reach", "plays", "likes", "comments", "shares", "saves", "total_interactions", "follows", "profile_visits")
NOT_NEGATIVE = ("total_watch_time_seconds", "average_watch_time_seconds")
RATES = ("completion_rate", "three_second_view_rate", "skip_rate")
VERSION = "1.0.0"


def metric_problems(metrics: Column) -> Column:
    """Broken rules over a map of metrics; metrics that aren't there break none."""
    bad = []
    for name in COUNTS:
        v = F.try_element_at(metrics, F.lit(name))
        bad.append(F.when((v < 0) | (v != F.floor(v)) | F.isnan(v), F.lit(f"{name}: not a count")))
    for name in NOT_NEGATIVE:
        v = F.try_element_at(metrics, F.lit(name))
        bad.append(F.when((v < 0) | F.isnan(v), F.lit(f"{name}: negative")))
    for name in RATES:
        v = F.try_element_at(metrics, F.lit(name))
        bad.append(F.when((v < 0) | (v > 1), F.lit(f"{name}: not between 0 and 1")))
    return F.array_compact(F.array(*bad))


def problems() -> Column:
    """Broken rules of an outcome row as an array, empty for a valid one."""
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    published, measured = (F.try_to_timestamp(F.col(c)) for c in ("published_at", "measured_at"))
    norm = F.col("cohort_normalization")
    rules = [
        (F.coalesce(F.col("schema_version") != VERSION, F.lit(True)), "unsupported schema version"),
        *[(blank(c), f"{c}: empty") for c in ("report_id", "platform", "account_context_id")],
        (published.isNull(), "published_at: not a timestamp"),
        (measured.isNull(), "measured_at: not a timestamp"),
        (measured < published, "measured before published"),
        (F.coalesce(F.col("measurement_window_hours") <= 0, F.lit(True)), "measurement_window_hours: not positive"),
        (F.col("metrics").isNull(), "metrics: missing"),
        (F.col("rights.training_allowed").isNull(), "rights.training_allowed: not boolean"),
        (F.coalesce(F.trim(F.col("rights.basis")), F.lit("")) == "", "rights.basis: empty"),
        (norm.isNotNull() & ((F.coalesce(norm["cohort_key"], F.lit("")) == "") | (F.coalesce(norm["method"], F.lit("")) == "")), "cohort_normalization: no key or method"),
        (norm.isNotNull() & F.coalesce(norm["cohort_size"] <= 0, F.lit(True)), "cohort_size: not positive"),
    ]
    own = F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in rules]))
    return F.concat(own, F.coalesce(metric_problems(F.col("metrics")), F.array().cast("array<string>")))


def checked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("problems", problems())


OUTCOME_KEY = ["report_id", "platform", "account_context_id", "measured_at"]
