"""Suitability of records for seven script objectives and three subsystems, and what a corpus lacks.

Everything is columns: one CASE ladder for each objective, an array of results a row, aggregates over
the exploded array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions.text import let

# Fixed values.
OBJECTIVES = ("full_script", "hook", "continuation", "structure", "section", "cta", "measurable_style")
TIERS = ("eligible", "marginal", "ineligible")
SUBSYSTEMS = ("editing", "audio", "visual_color")
FASTEST_SPEECH = 5.0
TARGETS = {"transcript_rate": 0.40, "full_script_rate": 0.20, "hook": 30, "cta": 10, "structure": 15, "archetype": 0.60, "p50": 30, "p75": 80}


def _result(objective: str, tier: Column, reasons: Column) -> Column:
    return F.struct(F.lit(objective).alias("objective"), tier.alias("tier"), reasons.alias("reasons"))


def _reasons(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in pairs]))


EVIDENCE = ("word_count", "sentence_count", "hooks", "hook_confidence", "n_beats", "has_cta", "words_per_second")


def objective_results(e: Column) -> Column:
    """array of (objective, tier, reasons) from a struct of the EVIDENCE fields."""
    w, s, beats, conf = e["word_count"], e["sentence_count"], e["n_beats"], e["hook_confidence"]
    hook = F.size(e["hooks"]) > 0
    real_hook = F.exists(e["hooks"], lambda h: (h != "") & (h != "none"))
    silent = w == 0
    rep = F.coalesce(e["words_per_second"] > FASTEST_SPEECH, F.lit(False))
    none = F.array().cast("array<string>")
    quiet = F.array(F.lit("no_spoken_transcript"))

    def ladder(eligible: Column, marginal: Column) -> Column:
        return F.when(silent, "ineligible").when(eligible, "eligible").when(marginal, "marginal").otherwise("ineligible")

    def why(eligible: Column, marginal: Column, if_marginal: Column, otherwise: Column, if_silent: Column = quiet) -> Column:
        return F.when(silent, if_silent).when(eligible, none).when(marginal, if_marginal).otherwise(otherwise)

    long = (w >= 80) & (s >= 3) & ~rep
    full, half = long & (hook | (beats >= 2)), long | ((w >= 40) & (s >= 2) & ~rep)
    full_reasons = F.when(long, F.array(F.lit("insufficient_structure"))).otherwise(F.array(F.lit("transcript_too_sparse_for_full_script")))
    good_hook, some_hook = (w >= 10) & real_hook & (conf >= 0.5), (w >= 5) & real_hook
    go_on, part = (w >= 60) & (s >= 3), (w >= 30) & (s >= 2)
    plan, outline = (beats >= 3) | ((w >= 40) & hook), (beats >= 2) | ((w >= 20) & hook)
    never = F.lit(False)
    return F.array(
        _result("full_script", ladder(full, half), why(full, half, full_reasons, _reasons((rep, "repetitive_or_nonlinguistic"), (w < 40, "transcript_too_sparse_for_full_script"), (s < 2, "insufficient_sentence_count")))),
        _result("hook", ladder(good_hook, some_hook), why(good_hook, some_hook, F.array(F.when(conf < 0.5, "no_reliable_hook").otherwise("coherent_short_hook_only")), _reasons((~real_hook, "no_reliable_hook"), (w < 5, "transcript_too_sparse_for_full_script")))),
        _result("continuation", ladder(go_on, part), why(go_on, part, F.array(F.lit("transcript_too_short_for_continuation")), _reasons((w < 30, "continuation_opening_insufficient"), (s < 2, "insufficient_sentence_count")))),
        _result("structure", ladder(plan, outline), why(plan, outline, F.array(F.lit("insufficient_structure")), F.array(F.lit("insufficient_structure")))),
        _result("section", ladder(w >= 20, w >= 8), why(w >= 20, w >= 8, F.array(F.lit("useful_for_section_only")), F.array(F.lit("transcript_too_sparse_for_full_script")))),
        _result("cta", ladder(e["has_cta"], never), why(e["has_cta"], never, none, F.array(F.lit("cta_absent")), F.array(F.lit("no_spoken_transcript"), F.lit("cta_absent")))),
        _result("measurable_style", ladder(w >= 50, w >= 20), why(w >= 50, w >= 20, F.array(F.lit("style_evidence_insufficient")), F.array(F.lit("style_evidence_insufficient")))),
    )


def subsystem_results(duration: Column, flags: Column, has_audio: Column) -> Column:
    """array of (subsystem, tier, reasons) from a report's duration, eligibility flags (struct) and audio track."""
    flag = lambda k: F.coalesce(flags[k], F.lit(False))
    d, audio = F.coalesce(duration, F.lit(0.0)), F.coalesce(has_audio, F.lit(True))
    editing = F.when(flag("editing") & (d >= 3), "eligible").when(d >= 3, "marginal").otherwise("ineligible")
    sound = F.when(flag("audio") & audio & (d >= 3), "eligible").when(~audio, "ineligible").otherwise("marginal")
    colour = F.when(flag("color") | flag("captions"), "eligible").otherwise("ineligible")
    unless = lambda tier, reason: F.when(tier == "eligible", F.array().cast("array<string>")).otherwise(F.array(reason))
    rows = (("editing", editing, F.lit("duration_too_short")), ("audio", sound, F.when(~audio, "no_audio_track").otherwise("marginal_duration")), ("visual_color", colour, F.lit("insufficient_visual_evidence")))
    return F.array(*[F.struct(F.lit(k).alias("subsystem"), tier.alias("tier"), unless(tier, r).alias("reasons")) for k, tier, r in rows])


def unknown_subsystems() -> Column:
    """What is known of the subsystems without the raw report."""
    return F.array(*[F.struct(F.lit(k).alias("subsystem"), F.lit("marginal").alias("tier"), F.array(F.lit("raw_report_unavailable")).alias("reasons")) for k in SUBSYSTEMS])


def assess(records: DataFrame, subsystems: Column | None = None) -> DataFrame:
    """records with objectives, subsystems, any_eligible, any_marginal, primary_reasons and routing_tags."""
    out = records.withColumn("objectives", let(F.struct(*EVIDENCE), objective_results)).withColumn("subsystems", unknown_subsystems() if subsystems is None else subsystems)
    has = lambda tier: F.exists("objectives", lambda o: o["tier"] == tier)
    out = out.withColumn("any_eligible", has("eligible")).withColumn("any_marginal", has("marginal"))
    tags = F.transform(F.filter("subsystems", lambda s: s["tier"] != "ineligible"), lambda s: s["subsystem"])
    tags = F.when(F.col("any_eligible") | F.col("any_marginal"), F.array_append(tags, F.lit("script"))).otherwise(tags)
    return out.withColumn("primary_reasons", primary_reasons(F.col("objectives"))).withColumn("routing_tags", F.array_sort(F.array_distinct(tags)))


def primary_reasons(objectives: Column, most: int = 3) -> Column:
    """The commonest reasons of ineligible objectives; ties go to the one that came first."""
    return let(F.flatten(F.transform(F.filter(objectives, lambda o: o["tier"] == "ineligible"), lambda o: o["reasons"])), lambda said: _commonest(said, most))


def _commonest(said: Column, most: int) -> Column:
    ranked = F.transform(F.array_distinct(said), lambda r: F.struct((-F.size(F.filter(said, lambda x: x == r))).alias("n"), F.array_position(said, r).alias("at"), r.alias("reason")))
    return F.slice(F.transform(F.array_sort(ranked), lambda x: x["reason"]), 1, most)


def assess_silent(reports: DataFrame, subsystems: Column) -> DataFrame:
    """Valid reports without a transcript: no objective is possible, the subsystems may be."""
    nothing = F.array(*[_result(o, F.lit("ineligible"), F.array(F.lit("no_spoken_transcript"))) for o in OBJECTIVES])
    out = reports.withColumn("word_count", F.lit(0)).withColumn("objectives", nothing).withColumn("subsystems", subsystems)
    out = out.withColumn("any_eligible", F.lit(False)).withColumn("any_marginal", F.lit(False)).withColumn("primary_reasons", F.array(F.lit("no_spoken_transcript")))
    return out.withColumn("routing_tags", F.array_sort(F.transform(F.filter("subsystems", lambda s: s["tier"] != "ineligible"), lambda s: s["subsystem"])))


def exploded(assessed: DataFrame, *keys: str) -> DataFrame:
    """A row for each record and objective."""
    return assessed.select(*keys, F.explode("objectives").alias("o")).select(*keys, "o.objective", "o.tier", "o.reasons")


def crosstab(assessed: DataFrame) -> DataFrame:
    """Records by objective and tier; all 21 cells are there."""
    spark = assessed.sparkSession
    cells = spark.createDataFrame([(o, t) for o in OBJECTIVES for t in TIERS], "objective string, tier string")
    counts = exploded(assessed).groupBy("objective", "tier").agg(F.count(F.lit(1)).alias("n"))
    return cells.join(counts, ["objective", "tier"], "left").select("objective", "tier", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def reason_histogram(assessed: DataFrame, most: int = 20) -> DataFrame:
    """The commonest reasons, whatever the tier; ties by name."""
    counts = exploded(assessed).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "reason").limit(most)


def routing_histogram(assessed: DataFrame) -> DataFrame:
    return assessed.select(F.explode("routing_tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def subsystem_counts(assessed: DataFrame) -> DataFrame:
    """Eligible records of each subsystem."""
    rows = assessed.select(F.explode("subsystems").alias("s"))
    return rows.groupBy(F.col("s.subsystem").alias("subsystem")).agg(F.count_if(F.col("s.tier") == "eligible").alias("eligible"))


def floor_percentiles(df: DataFrame, value: str, percents: tuple[int, ...] = (10, 25, 50, 75, 90, 95)) -> DataFrame:
    """(p, value): the value at place floor(p / 100 * (n - 1)); 0 for an empty table.

    Values are counted first, so the ordered pass sees each different value once.
    """
    spark = df.sparkSession
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = counts.withColumn("upto", F.sum("c").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.sum("c").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    wanted = spark.createDataFrame([(p,) for p in percents], "p int")
    place = F.floor(F.col("p") / 100 * (F.col("n") - 1))
    found = upto.join(F.broadcast(wanted)).where(F.col("upto") > place).groupBy("p").agg(F.min("v").alias("value"))
    return wanted.join(found, "p", "left").select("p", F.coalesce("value", F.lit(0)).alias("value"))


def _is_eligible(objective: str) -> Column:
    return F.exists("objectives", lambda x: (x["objective"] == objective) & (x["tier"] == "eligible"))


def report(assessed: DataFrame) -> DataFrame:
    """One row of corpus totals."""
    n = F.count(F.lit(1))
    spoken = F.count_if(F.col("word_count") > 0)
    return assessed.agg(
        n.alias("total_sources"), spoken.alias("with_spoken_transcript"), (n - spoken).alias("without_spoken_transcript"),
        F.when(n > 0, F.round(spoken / n, 4)).otherwise(0.0).alias("script_transcript_rate"),
        F.count_if("any_eligible").alias("any_script_eligible"), F.count_if(F.col("any_eligible") | F.col("any_marginal")).alias("any_script_marginal_or_eligible"),
        *[F.count_if(_is_eligible(o)).alias(f"{o}_eligible") for o in OBJECTIVES],
    )


def gaps(totals: DataFrame, percentiles: DataFrame) -> DataFrame:
    """(dimension, severity, measured, target, open, hint): the seven rules of what a corpus lacks.

    totals: the row of report(); percentiles: the rows of floor_percentiles().
    """
    at = percentiles.agg(F.max(F.when(F.col("p") == 50, F.col("value"))).alias("p50"), F.max(F.when(F.col("p") == 75, F.col("value"))).alias("p75"))
    n = F.col("total_sources")
    rate = lambda c: F.when(n > 0, F.col(c) / n).otherwise(0.0)
    rules = (
        ("script_transcript_coverage", "high", rate("with_spoken_transcript"), TARGETS["transcript_rate"], "prefer_voice_over_broll_creators"),
        ("full_script_eligible_rate", "high", rate("full_script_eligible"), TARGETS["full_script_rate"], "prefer_scripted_educational_commentary"),
        ("hook_example_count", "medium", F.col("hook_eligible"), TARGETS["hook"], "target_strong_hook_formats"),
        ("cta_example_count", "medium", F.col("cta_eligible"), TARGETS["cta"], "target_cta_bearing_creators"),
        ("structure_example_count", "medium", F.col("structure_eligible"), TARGETS["structure"], "target_structured_scripted_content"),
        ("median_transcript_length", "high", F.col("p50"), TARGETS["p50"], "prefer_longer_spoken_content"),
        ("p75_transcript_length", "medium", F.col("p75"), TARGETS["p75"], "increase_scripted_content_percentage"),
    )
    rows = F.array(*[F.struct(F.lit(d).alias("dimension"), F.lit(s).alias("severity"), F.round(m.cast("double"), 4).alias("measured"), F.lit(float(x)).alias("target"), (m < x).alias("open"), F.lit(h).alias("hint")) for d, s, m, x, h in rules])
    return totals.crossJoin(at).select(F.inline(rows))  # one row each


def archetype_gaps(df: DataFrame, archetype: str) -> DataFrame:
    """Archetypes with more than the largest share wanted."""
    counts = df.groupBy(archetype).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return counts.select(archetype, F.round(share, 4).alias("measured"), share.alias("_s")).where(F.col("_s") > TARGETS["archetype"]).drop("_s")


def recommendation(gap_rows: DataFrame) -> DataFrame:
    """A: improve acquisition first; C: both; B: scale volume."""
    high, any_ = F.count_if((F.col("severity") == "high") & F.col("open")), F.count_if("open")
    return gap_rows.agg(any_.alias("gap_count"), high.alias("high_severity_gap_count"), F.when(high >= 2, "A").when(any_ > 0, "C").otherwise("B").alias("recommendation"))


def projection(totals: DataFrame, target_total: int = 7500) -> DataFrame:
    """Eligible records to expect among target_total sources like these."""
    n = F.col("total_sources")
    names = {"any_script_eligible": "projected_script_eligible", "full_script_eligible": "projected_full_script_eligible", "hook_eligible": "projected_hook_eligible", "cta_eligible": "projected_cta_eligible"}
    return totals.where(n > 0).select(F.lit(target_total).alias("target_total_sources"), *[F.bround(F.col(c) / n * target_total, 0).cast("long").alias(a) for c, a in names.items()])
