"""Rule detectors over text columns: hook mechanisms, retention devices, sections, density windows, delivery.

A rule is (name, expression on the lower-cased text, confidence); the tables hold fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions import text as t

# Fixed values.
HOOK_RULES = (
    ("question", r"\?", 0.97),
    ("curiosity", r"\b(did you know|what if|here's why|the secret|you won't believe)\b", 0.72),
    ("direct_promise", r"\b(how to|you can|you will|i'll show|this will)\b", 0.70),
    ("identity_callout", r"\b(if you|for (?:every|any|all)|people who|creators|founders|parents)\b", 0.68),
    ("contrarian_claim", r"\b(stop|never|wrong|myth|actually|truth)\b", 0.64),
    ("authority", r"\b(richest|expert|professor|doctor|nobel|award|founder|ceo)\b", 0.62),
    ("pain_problem", r"\b(terrible|problem|pain|struggle|mistake|danger|threat)\b", 0.66),
    ("story_opening", r"\b(i was|when i|years ago|one day|this happened)\b", 0.70),
)
RETENTION_RULES = (
    ("rhetorical_or_prompt_question", r"\?", 0.68),
    ("contrast", r"\b(but|however|yet|instead|although)\b", 0.82),
    ("example_or_proof", r"\b(for example|for instance|such as|like)\b", 0.76),
    ("direct_address", r"\b(you|your|you're)\b", 0.90),
    ("specificity", r"\b(the only|the one|exactly|specifically|\d+)\b", 0.73),
    ("stakes_language", r"\b(worse|terrible|consequences|risk|lose|danger|threat)\b", 0.67),
)
FALLBACK_HOOK_CONFIDENCE = 0.45
EXAMPLE_MARK = r"\b(for example|for instance|such as)\b"


def fired(text: Column, rules, name: str) -> Column:
    """array of struct(name, confidence) of the rules that match, in the table's order."""
    low = F.lower(text)
    hits = [F.when(low.rlike(f"(?U){pattern}"), F.struct(F.lit(rule).alias(name), F.lit(confidence).alias("confidence"))) for rule, pattern, confidence in rules]
    return F.array_compact(F.array(*hits))


def hook_mechanisms(text: Column, rules=HOOK_RULES) -> Column:
    return fired(text, rules, "mechanism")


def retention_devices(parts: Column, rules=RETENTION_RULES) -> Column:
    """(sentence, device, confidence) over an array of sentences; sentences count from 0."""
    each = F.transform(parts, lambda s, i: F.transform(fired(s, rules, "device"), lambda d: F.struct(i.alias("sentence"), d["device"].alias("device"), d["confidence"].alias("confidence"))))
    return F.flatten(each)


def no_mechanisms() -> Column:
    """What the analyzer that never infers anything returns."""
    return F.array().cast("array<struct<mechanism:string,confidence:double>>")


def hook_confidence(mechanisms: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(mechanisms, lambda m: m["confidence"])), F.lit(0.0))


def sections_or_first_sentence(sections: Column, parts: Column) -> Column:
    """Given sections, or the first sentence as a hook of low confidence; sections are structs (role, text, confidence)."""
    first = F.when(F.size(parts) > 0, F.array(F.struct(F.lit("hook").alias("role"), F.element_at(parts, 1).alias("text"), F.lit(FALLBACK_HOOK_CONFIDENCE).alias("confidence"))))
    return F.when(F.size(sections) > 0, sections).otherwise(F.coalesce(first, F.array().cast("array<struct<role:string,text:string,confidence:double>>")))


def first_with_role(sections: Column, *roles: str) -> Column:
    return F.try_element_at(F.filter(sections, lambda s: s["role"].isin(*roles)), F.lit(1))


def all_with_role(sections: Column, *roles: str) -> Column:
    return F.filter(sections, lambda s: s["role"].isin(*roles))


def hook_section(sections: Column) -> Column:
    return F.coalesce(first_with_role(sections, "hook"), F.try_element_at(sections, F.lit(1)))


def fingerprint(roles: Column, mechanisms: Column, devices: Column, edits: Column) -> Column:
    """The sorted set of structural tokens."""
    mark = lambda p, x: F.transform(x, lambda v: F.concat(F.lit(p), v))
    return F.array_sort(F.array_distinct(F.concat(mark("section:", roles), mark("hook:", mechanisms), mark("retention:", devices), mark("edit:", edits))))


def density_windows(sentences: DataFrame, durations: DataFrame, key: str, width: float = 10.0) -> DataFrame:
    """Counts by tumbling media-time window: words, sentences, questions, numbers, examples; empty windows stay.

    sentences: (key, start, text); durations: (key, duration). A sentence belongs to the window of its start.
    """
    spine = durations.where("duration > 0").select(key, "duration", F.explode(F.sequence(F.lit(0).cast("long"), (F.ceil(F.col("duration") / width) - 1).cast("long"))).alias("window"))
    low = F.lower("text")
    counted = sentences.groupBy(key, F.floor(F.col("start") / width).cast("long").alias("window")).agg(
        F.sum(F.size(t.tokens(F.col("text")))).alias("word_count"),
        F.count(F.lit(1)).alias("sentence_count"),
        F.count_if(F.contains("text", F.lit("?"))).alias("question_count"),
        F.sum(t.number_count(F.col("text"))).alias("number_count"),
        F.count_if(low.rlike(f"(?U){EXAMPLE_MARK}")).alias("example_count"),
    )
    counts = ("word_count", "sentence_count", "question_count", "number_count", "example_count")
    joined = spine.join(counted, [key, "window"], "left")
    return joined.select(key, (F.col("window") * width).alias("start_seconds"), F.least(F.col("duration"), (F.col("window") + 1) * width).alias("end_seconds"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])


def pace_transitions(windows: DataFrame, key: str, at: str, rate: str, least: float = 60.0) -> DataFrame:
    """Changes of a rate of least or more from one window to the next; windows without a rate are skipped."""
    before = F.lag(rate).over(Window.partitionBy(key).orderBy(at))
    moved = windows.where(F.col(rate).isNotNull() & ~F.isnan(rate)).withColumn("_change", F.col(rate) - before)
    return moved.where(F.abs("_change") >= least).select(key, at, F.col("_change").alias("change"), F.when(F.col("_change") > 0, "faster").otherwise("slower").alias("direction"))


def cadence(sentences: DataFrame, key: str) -> DataFrame:
    """Words a second of each timed sentence (key, sentence, start, end, text)."""
    n = F.size(t.tokens(F.col("text")))
    return sentences.where("end > start").select(key, "sentence", F.round("start", 4).alias("start_seconds"), F.round("end", 4).alias("end_seconds"), n.alias("word_count"), F.round(n / (F.col("end") - F.col("start")), 3).alias("words_per_second"))


def nearest_boundary(events: DataFrame, boundaries: DataFrame, key: str, event: str, at: str, order: str, within: float) -> DataFrame:
    """The boundary nearest to each event of the same key, within a distance; ties go to the smaller order.

    An as-of join: boundaries are bucketed by the distance, an event looks at its own and the two
    neighbouring buckets by equality, so that no key is joined with itself as a whole.
    """
    own = events.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(at) / within) - 1, F.floor(F.col(at) / within) + 1)))
    other = boundaries.select(key, F.floor(F.col(at) / within).alias("_bucket"), F.col(at).alias("_at"), F.col(order).alias("_order"))
    distance = F.abs(F.col(at) - F.col("_at"))
    found = own.join(other, [key, "_bucket"]).where(distance <= within)
    return found.groupBy(key, event, at).agg(F.min(F.struct(distance.alias("distance"), F.col("_order"))).alias("_best")).select(key, event, at, F.col("_best._order").alias("boundary"), F.col("_best.distance").alias("distance"))


def compiled(docs: DataFrame, key: str, text: str, source_hash: Column, duration: Column | None = None, hook_rules=HOOK_RULES, retention_rules=RETENTION_RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """One record of script intelligence for each text; line feeds part its beats.

    Only what can be derived from the text is filled; nothing is inferred beyond the rules. Columns to keep come last.
    """
    parts, body = t.sentences(F.col("_clean")), F.col("_clean")
    base = docs.withColumn("_clean", t.clean(F.col(text))).withColumn("_sentences", parts).withColumn("_tokens", t.lower_tokens(body))
    beats = F.filter(F.transform(F.split(F.col(text), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    hook = F.coalesce(F.try_element_at(F.col("beats"), F.lit(1)), F.lit(""))
    seconds = F.lit(None).cast("double") if duration is None else duration
    rows = base.select(
        F.col(key).alias("key"),
        F.concat(F.lit("sir:"), source_hash, F.lit(":1.0.0")).alias("record_id"),
        source_hash.alias("source_content_hash"),
        body.alias("clean_transcript"),
        F.array_join("_tokens", " ").alias("normalized_transcript"),
        F.size("_tokens").alias("spoken_word_count"),
        t.word_count(body).alias("word_count"),
        t.sentence_count(body).alias("sentence_count"),
        seconds.alias("duration_seconds"),
        F.when(seconds > 0, F.round(F.size("_tokens") / seconds, 4)).alias("words_per_second"),
        beats.alias("beats"),
        t.sentence_statistics(F.col("_sentences")).alias("sentence_length_distribution"),
        t.vocabulary(F.col("_tokens")).alias("vocabulary"),
        t.person_usage(F.col("_tokens")).alias("person_usage"),
        t.density(t.question_count(F.col("_sentences")), F.col("_sentences")).alias("question_density"),
        t.density(t.imperative_count(F.col("_sentences")), F.col("_sentences")).alias("imperative_density"),
        t.short_sentence_share(F.col("_sentences")).alias("short_sentence_share"),
        t.number_count(body).alias("numerical_reference_count"),
        retention_devices(F.col("_sentences"), retention_rules).alias("retention_devices"),
        *keep,
    )
    rows = rows.withColumn("hook_text", hook).withColumn("hook_mechanisms", hook_mechanisms(F.col("hook_text"), hook_rules))
    redundancy = F.round(1 - F.col("vocabulary.type_token_ratio"), 4)
    return rows.withColumn("hook_confidence", hook_confidence(F.col("hook_mechanisms"))).withColumn("n_beats", F.size("beats")).withColumn("redundancy_proxy", redundancy).withColumn("has_cta", F.lit(False))
