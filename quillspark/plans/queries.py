"""Registered queries over the driver's tables, each with SQL that gives the same rows where SQL can.

Word lists and rules are parameters of the operators; where the stock ones never occur in a table,
a query passes others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text as t
from quillspark.functions.hashing import hash_embedding, sha_split
from quillspark.operators import annotations, dedup, gold, leakage, outcomes, reconstruction, registry, rules, search, service, suitability, training
from quillspark.plans import corpus
from quillspark.sources import sinks

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# SQL fragments.
_TOKENS = "list_transform(regexp_extract_all(text, '[A-Za-z0-9]+(?:[''’][A-Za-z]+)?'), lambda w: lower(replace(w, '’', '''')))"
_CLEAN = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
_WORDS = f"len(list_filter(string_split({_CLEAN}, ' '), lambda w: w <> ''))"
_SENTENCES = f"CASE WHEN {_CLEAN} = '' THEN 0 ELSE 1 + len(regexp_extract_all({_CLEAN}, '[.!?] ')) END"
_PARTS = f"string_split(regexp_replace({_CLEAN}, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1))"
_BEATS = "len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''))"


def _in(*words: str) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _bounded(pattern: str) -> str:
    return f"(^|[^\\p{{L}}\\p{{N}}_])({pattern})([^\\p{{L}}\\p{{N}}_]|$)".replace("'", "''")


#: Hook and retention rules with words that the tables have.
HOOKS = (*rules.HOOK_RULES, ("local_opening", r"\b(the|der|die|le|la|el|que)\b", 0.55))
DEVICES = (*rules.RETENTION_RULES, ("local_contrast", r"\b(was|not|mit|pour|con)\b", 0.60))
_HOOK_SQL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(hook), '{_bounded(p[3:-3]) if p.startswith('\\b(') else '\\?'}') THEN {{'mechanism': '{n}', 'confidence': {c}::DOUBLE}} END" for n, p, c in HOOKS) + "], lambda x: x IS NOT NULL)"

_ASSESSED = f"""
WITH base AS (SELECT doc_id, {_WORDS} AS w, {_SENTENCES} AS s, {_BEATS} AS b, coalesce(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1], '') AS hook FROM documents),
ev AS (SELECT *, {_HOOK_SQL} AS hooks FROM base),
e AS (SELECT doc_id, w, s, b, len(hooks) > 0 AS h, coalesce(list_max(list_transform(hooks, lambda x: x.confidence)), 0) AS c FROM ev),
o AS (
 SELECT doc_id, w, 'full_script' AS objective, CASE WHEN w = 0 THEN 'ineligible' WHEN w >= 80 AND s >= 3 AND (h OR b >= 2) THEN 'eligible' WHEN (w >= 80 AND s >= 3) OR (w >= 40 AND s >= 2) THEN 'marginal' ELSE 'ineligible' END AS tier,
  CASE WHEN w = 0 THEN ['no_spoken_transcript'] WHEN w >= 80 AND s >= 3 AND (h OR b >= 2) THEN [] WHEN w >= 80 AND s >= 3 THEN ['insufficient_structure'] WHEN w >= 40 AND s >= 2 THEN ['transcript_too_sparse_for_full_script'] ELSE list_filter([CASE WHEN w < 40 THEN 'transcript_too_sparse_for_full_script' END, CASE WHEN s < 2 THEN 'insufficient_sentence_count' END], lambda x: x IS NOT NULL) END AS reasons FROM e
 UNION ALL SELECT doc_id, w, 'hook', CASE WHEN w = 0 THEN 'ineligible' WHEN w >= 10 AND h AND c >= 0.5 THEN 'eligible' WHEN w >= 5 AND h THEN 'marginal' ELSE 'ineligible' END,
  CASE WHEN w = 0 THEN ['no_spoken_transcript'] WHEN w >= 10 AND h AND c >= 0.5 THEN [] WHEN w >= 5 AND h THEN [CASE WHEN c < 0.5 THEN 'no_reliable_hook' ELSE 'coherent_short_hook_only' END] ELSE list_filter([CASE WHEN NOT h THEN 'no_reliable_hook' END, CASE WHEN w < 5 THEN 'transcript_too_sparse_for_full_script' END], lambda x: x IS NOT NULL) END FROM e
 UNION ALL SELECT doc_id, w, 'continuation', CASE WHEN w = 0 THEN 'ineligible' WHEN w >= 60 AND s >= 3 THEN 'eligible' WHEN w >= 30 AND s >= 2 THEN 'marginal' ELSE 'ineligible' END,
  CASE WHEN w = 0 THEN ['no_spoken_transcript'] WHEN w >= 60 AND s >= 3 THEN [] WHEN w >= 30 AND s >= 2 THEN ['transcript_too_short_for_continuation'] ELSE list_filter([CASE WHEN w < 30 THEN 'continuation_opening_insufficient' END, CASE WHEN s < 2 THEN 'insufficient_sentence_count' END], lambda x: x IS NOT NULL) END FROM e
 UNION ALL SELECT doc_id, w, 'structure', CASE WHEN w = 0 THEN 'ineligible' WHEN b >= 3 OR (w >= 40 AND h) THEN 'eligible' WHEN b >= 2 OR (w >= 20 AND h) THEN 'marginal' ELSE 'ineligible' END,
  CASE WHEN w = 0 THEN ['no_spoken_transcript'] WHEN b >= 3 OR (w >= 40 AND h) THEN [] ELSE ['insufficient_structure'] END FROM e
 UNION ALL SELECT doc_id, w, 'section', CASE WHEN w = 0 THEN 'ineligible' WHEN w >= 20 THEN 'eligible' WHEN w >= 8 THEN 'marginal' ELSE 'ineligible' END,
  CASE WHEN w = 0 THEN ['no_spoken_transcript'] WHEN w >= 20 THEN [] WHEN w >= 8 THEN ['useful_for_section_only'] ELSE ['transcript_too_sparse_for_full_script'] END FROM e
 UNION ALL SELECT doc_id, w, 'cta', 'ineligible', CASE WHEN w = 0 THEN ['no_spoken_transcript', 'cta_absent'] ELSE ['cta_absent'] END FROM e
 UNION ALL SELECT doc_id, w, 'measurable_style', CASE WHEN w = 0 THEN 'ineligible' WHEN w >= 50 THEN 'eligible' WHEN w >= 20 THEN 'marginal' ELSE 'ineligible' END,
  CASE WHEN w = 0 THEN ['no_spoken_transcript'] WHEN w >= 50 THEN [] ELSE ['style_evidence_insufficient'] END FROM e)
"""


def _assessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.assessed(read(spark, sf_dir, "documents"), hook_rules=HOOKS)


@query(_ASSESSED + ", cells AS (SELECT * FROM (SELECT unnest(['full_script','hook','continuation','structure','section','cta','measurable_style']) AS objective) CROSS JOIN (SELECT unnest(['eligible','marginal','ineligible']) AS tier)) SELECT cells.objective, cells.tier, count(o.doc_id)::BIGINT AS n FROM cells LEFT JOIN o ON o.objective = cells.objective AND o.tier = cells.tier GROUP BY ALL")
def suitability_crosstab(spark, sf_dir):
    return suitability.crosstab(_assessed(spark, sf_dir))


@query(_ASSESSED + "SELECT doc_id, objective, tier, array_to_string(reasons, ',') AS reasons FROM o")
def suitability_per_doc(spark, sf_dir):
    rows = suitability.exploded(_assessed(spark, sf_dir), "key")
    return rows.select(F.col("key").alias("doc_id"), "objective", "tier", F.array_join("reasons", ",").alias("reasons"))


@query(_ASSESSED + "SELECT reason, count(*)::BIGINT AS n FROM (SELECT unnest(reasons) AS reason FROM o) GROUP BY 1 ORDER BY n DESC, reason LIMIT 20")
def reason_histogram(spark, sf_dir):
    return suitability.reason_histogram(_assessed(spark, sf_dir))


@query(_ASSESSED + ", d AS (SELECT doc_id, bool_or(tier <> 'ineligible') AS ok FROM o GROUP BY 1) SELECT tag, count(*)::BIGINT AS n FROM (SELECT unnest(CASE WHEN ok THEN ['script','editing','audio','visual_color'] ELSE ['editing','audio','visual_color'] END) AS tag FROM d) GROUP BY 1")
def routing_tags(spark, sf_dir):
    return suitability.routing_histogram(_assessed(spark, sf_dir))


@query(_ASSESSED + ", d AS (SELECT doc_id, any_value(w) AS w, bool_or(tier = 'eligible') AS e, bool_or(tier <> 'ineligible') AS m FROM o GROUP BY 1) SELECT count(*)::BIGINT AS total_sources, count(*) FILTER (w > 0)::BIGINT AS with_spoken_transcript, count(*) FILTER (e)::BIGINT AS any_script_eligible, count(*) FILTER (m)::BIGINT AS any_script_marginal_or_eligible, (SELECT count(*)::BIGINT FROM o WHERE objective = 'hook' AND tier = 'eligible') AS hook_eligible FROM d")
def corpus_report(spark, sf_dir):
    return suitability.report(_assessed(spark, sf_dir)).select("total_sources", "with_spoken_transcript", "any_script_eligible", "any_script_marginal_or_eligible", "hook_eligible")


@query(f"WITH c AS (SELECT {_WORDS} AS w FROM documents), l AS (SELECT list_sort(list(w)) AS v FROM c) SELECT p::INT AS p, v[(floor(p / 100.0 * (len(v) - 1)))::BIGINT + 1]::INT AS value FROM l, (SELECT unnest([10, 25, 50, 75, 90, 95]) AS p)")
def word_count_percentiles_floor(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(t.word_count(t.clean(F.col("text"))).alias("w"))
    return suitability.floor_percentiles(docs, "w")


@query(_ASSESSED + f", n AS (SELECT count(*) AS n, list_sort(list(w)) AS v FROM base), k AS (SELECT count(*) FILTER (objective = 'hook') AS hook, count(*) FILTER (objective = 'structure') AS st, count(*) FILTER (objective = 'full_script') AS fs, count(*) FILTER (objective = 'cta') AS cta FROM o WHERE tier = 'eligible'), m AS (SELECT unnest([{{'dimension': 'full_script_eligible_rate', 'open': fs / n < 0.2}}, {{'dimension': 'script_transcript_coverage', 'open': (SELECT count(*) FROM base WHERE w > 0) / n < 0.4}}, {{'dimension': 'hook_example_count', 'open': hook < 30}}, {{'dimension': 'cta_example_count', 'open': cta < 10}}, {{'dimension': 'structure_example_count', 'open': st < 15}}, {{'dimension': 'median_transcript_length', 'open': v[floor(0.5 * (n - 1))::BIGINT + 1] < 30}}, {{'dimension': 'p75_transcript_length', 'open': v[floor(0.75 * (n - 1))::BIGINT + 1] < 80}}]) AS r FROM n, k) SELECT r.dimension AS dimension, r.open AS open FROM m")
def corpus_gaps(spark, sf_dir):
    rows = _assessed(spark, sf_dir)
    return suitability.gaps(suitability.report(rows), suitability.floor_percentiles(rows, "word_count")).select("dimension", "open")


@query(f"WITH d AS (SELECT doc_id, {_TOKENS} AS w FROM documents) SELECT doc_id, len(w)::INT AS token_count, len(list_distinct(w))::INT AS unique_token_count, len(list_filter(w, lambda x: length(x) >= 8))::INT AS long_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS characters FROM d")
def vocabulary_stats(spark, sf_dir):
    w = F.col("w")
    docs = read(spark, sf_dir, "documents").select("doc_id", t.lower_tokens(F.col("text")).alias("w")).select("doc_id", t.vocabulary(w).alias("v"), F.size(F.filter(w, lambda x: F.length(x) >= 8)).alias("long_words"), t.total(F.transform(w, F.length)).alias("characters"))
    return docs.select("doc_id", "v.token_count", "v.unique_token_count", "long_words", "characters")


_PERSONS = {"first_person_count": t.FIRST_PERSON, "second_person_count": t.SECOND_PERSON, "third_person_count": t.THIRD_PERSON}


@query(f"WITH d AS (SELECT doc_id, {_TOKENS} AS w FROM documents) SELECT doc_id, " + ", ".join(f"len(list_filter(w, lambda x: list_contains({_in(*v)}, x)))::INT AS {k}" for k, v in _PERSONS.items()) + " FROM d")
def person_usage(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", t.person_usage(t.lower_tokens(F.col("text"))).alias("p")).select("doc_id", "p.*")


_LEXICON = (*t.EMOTIONAL, "the", "und", "que", "les")


@query(f"WITH d AS (SELECT doc_id, {_TOKENS} AS w FROM documents) SELECT doc_id, array_to_string(list_sort(list_filter(list_distinct(w), lambda x: list_contains({_in(*_LEXICON)}, x))), ',') AS found FROM d")
def lexicon_matches(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(t.matches_in(t.lower_tokens(F.col("text")), _LEXICON), ",").alias("found"))


@query(f"SELECT doc_id, token, count(*)::BIGINT AS n FROM (SELECT doc_id, unnest({_TOKENS}) AS token FROM documents) WHERE length(token) >= 4 GROUP BY 1, 2 HAVING count(*) >= 3")
def repeated_tokens(spark, sf_dir):
    return t.repeated_tokens(read(spark, sf_dir, "documents"), "doc_id", "text")


_STARTERS = (*t.IMPERATIVE_STARTERS, "the", "of", "in", "le", "de")


@query(f"WITH d AS (SELECT doc_id, {_PARTS} AS parts FROM documents), s AS (SELECT doc_id, unnest(parts) AS text FROM d) SELECT doc_id, count(*) FILTER (list_contains({_in(*_STARTERS)}, ({_TOKENS})[1]))::INT AS imperatives, count(*)::INT AS sentences FROM s GROUP BY 1")
def imperative_density(spark, sf_dir):
    parts = read(spark, sf_dir, "documents").select("doc_id", t.sentences(t.clean(F.col("text"))).alias("s"))
    return parts.select("doc_id", t.imperative_count(F.col("s"), _STARTERS).alias("imperatives"), F.size("s").alias("sentences"))


@query(f"WITH d AS (SELECT doc_id, {_PARTS} AS parts FROM documents), s AS (SELECT doc_id, unnest(parts) AS text FROM d), n AS (SELECT doc_id, len({_TOKENS}) AS k FROM s) SELECT doc_id, count(*)::INT AS sentences, count(*) FILTER (k <= 8)::INT AS short, min(k)::INT AS least, max(k)::INT AS most, quantile_disc(k, 0.9)::INT AS p90 FROM n WHERE k > 0 GROUP BY 1")
def sentence_lengths(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", t.sentences(t.clean(F.col("text"))).alias("s"))
    rows = rows.select("doc_id", t.sentence_statistics(F.col("s")).alias("st"), F.size(F.filter(F.transform("s", lambda x: F.size(t.tokens(x))), lambda n: (n > 0) & (n <= 8))).alias("short"))
    return rows.where("st.count > 0").select("doc_id", F.col("st.count").alias("sentences"), "short", F.col("st.min_words").alias("least"), F.col("st.max_words").alias("most"), F.col("st.p90_words").cast("int").alias("p90"))


@query()
def numeric_refs(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", t.number_count(F.col("text")).alias("numbers"))


_PHRASES = ("the", "of", "and", "that", "pour")


@query("SELECT doc_id, transition, n FROM (SELECT doc_id, p AS transition, len(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: w = p))::INT AS n FROM documents, (SELECT unnest(['the','of','and','that','pour']) AS p)) WHERE n > 0")
def transitions(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", F.inline(t.transition_markers(F.col("text"), _PHRASES)))
    return rows.select("doc_id", "transition", F.col("count").alias("n"))


@query(f"WITH base AS (SELECT doc_id, coalesce(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1], '') AS hook FROM documents), e AS (SELECT doc_id, unnest({_HOOK_SQL}) AS m FROM base) SELECT doc_id, m.mechanism AS mechanism, m.confidence AS confidence FROM e")
def hook_rules(spark, sf_dir):
    rows = corpus.records_of(read(spark, sf_dir, "documents"), hook_rules=HOOKS)
    return rows.select(F.col("key").alias("doc_id"), F.inline("hook_mechanisms"))


_DEVICE_SQL = " UNION ALL ".join(f"SELECT conv_id, turn, '{n}' AS device, {c}::DOUBLE AS confidence FROM conversations WHERE regexp_matches(lower(text), '{_bounded(p[3:-3]).replace('\\d', '[0-9]') if p.startswith('\\b(') else '\\?'}')" for n, p, c in DEVICES)


@query(_DEVICE_SQL)
def retention_rules(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", rules.fired(F.col("text"), DEVICES, "device").alias("d"))
    return rows.select("conv_id", "turn", F.inline("d"))


@query(f"WITH s AS (SELECT conv_id, turn * 4.0 AS start, text, {_TOKENS} AS w FROM conversations), d AS (SELECT conv_id, (max(turn) + 1) * 4.0 AS duration FROM conversations GROUP BY 1), spine AS (SELECT conv_id, duration, unnest(range(0, ceil(duration / 10)::BIGINT)) AS win FROM d), c AS (SELECT conv_id, floor(start / 10)::BIGINT AS win, sum(len(w)) AS words, count(*) AS sents FROM s GROUP BY 1, 2) SELECT spine.conv_id, (spine.win * 10.0)::DOUBLE AS start_seconds, least(duration, (spine.win + 1) * 10.0)::DOUBLE AS end_seconds, coalesce(words, 0)::BIGINT AS word_count, coalesce(sents, 0)::BIGINT AS sentence_count FROM spine LEFT JOIN c ON c.conv_id = spine.conv_id AND c.win = spine.win")
def density_windows(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").withColumn("start", F.col("turn") * 4.0)
    durations = turns.groupBy("conv_id").agg(((F.max("turn") + 1) * 4.0).alias("duration"))
    return rules.density_windows(turns, durations, "conv_id").select("conv_id", "start_seconds", "end_seconds", "word_count", "sentence_count")


@query("WITH d AS (SELECT user_id, date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts))::BIGINT AS day, count(*)::DOUBLE AS n FROM events GROUP BY 1, 2), l AS (SELECT *, n - lag(n) OVER (PARTITION BY user_id ORDER BY day) AS change FROM d) SELECT user_id, day, change, CASE WHEN change > 0 THEN 'faster' ELSE 'slower' END AS direction FROM l WHERE abs(change) >= 2")
def pace_transitions(spark, sf_dir):
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long")
    daily = read(spark, sf_dir, "events").groupBy("user_id", day.alias("day")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return rules.pace_transitions(daily, "user_id", "day", "n", 2.0)


@query("WITH e AS (SELECT user_id, event_id, epoch_us(ts) / 1000000.0 AS at FROM events WHERE event_type = 'error'), b AS (SELECT user_id, event_id, epoch_us(ts) / 1000000.0 AS at FROM events WHERE event_type = 'view'), p AS (SELECT e.user_id, e.event_id, b.event_id AS boundary, row_number() OVER (PARTITION BY e.user_id, e.event_id ORDER BY abs(e.at - b.at), b.event_id) AS r FROM e JOIN b ON b.user_id = e.user_id AND abs(e.at - b.at) <= 7200) SELECT user_id, event_id, boundary FROM p WHERE r = 1")
def nearest_boundary(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0)
    found = rules.nearest_boundary(events.where("event_type = 'error'").select("user_id", "event_id", "at"), events.where("event_type = 'view'"), "user_id", "event_id", "at", "event_id", 7200.0)
    return found.select("user_id", "event_id", "boundary")


@query()
def exact_dup_two_key(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.sha2(t.normalized(F.col("text")), 256).alias("body"), F.concat_ws(":", "source", "n_chars").alias("size_key"))
    return dedup.first_occurrences(docs, "doc_id", "body", "size_key").select("doc_id", "kept")


@query("SELECT sha256(text) AS content, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY 1")
def first_writer_wins(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("content"), "doc_id", "source")
    return registry.first_writer_wins(docs, "content", "doc_id")


@query("WITH b AS (SELECT doc_id, ('0x' || substr(sha256('s1:' || sha256(text)), 1, 8))::BIGINT % 100 AS b FROM documents) SELECT doc_id, CASE WHEN b < 90 THEN 'train' WHEN b < 95 THEN 'validation' ELSE 'test' END AS split FROM b")
def universal_split_sha(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", sha_split(F.sha2("text", 256), "s1", dedup.SPLITS).alias("split"))


_GRAMS = "list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [] END)"
_OVERLAP = f"WITH d AS (SELECT doc_id, {_TOKENS} AS w FROM documents), b AS (SELECT item_id, {_TOKENS} AS w FROM benchmark), dg AS (SELECT doc_id, unnest({_GRAMS}) AS g FROM d), bg AS (SELECT item_id, unnest({_GRAMS}) AS g FROM b), size AS (SELECT item_id, count(*) AS k FROM bg GROUP BY 1), p AS (SELECT item_id, doc_id, count(*)::BIGINT AS shared FROM bg JOIN dg USING (g) GROUP BY 1, 2) "


@query(_OVERLAP + "SELECT item_id, doc_id, shared, k::BIGINT AS candidate_ngrams FROM p JOIN size USING (item_id)")
def ngram5_overlap_benchmark(spark, sf_dir):
    return leakage.shared_ngrams(read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "documents"), "item_id", "doc_id").select("item_id", "doc_id", "shared", "candidate_ngrams")


@query(_OVERLAP + "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM p JOIN size USING (item_id) WHERE shared * 5 >= k)")
def gold_exclusion_ngram(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    hits = leakage.shared_ngrams(read(spark, sf_dir, "benchmark"), docs, "item_id", "doc_id").where("shared * 5 >= candidate_ngrams")
    return docs.select("doc_id").join(hits, "doc_id", "left_anti")


@query()
def longest_phrase_benchmark(spark, sf_dir):
    rows = leakage.overlapping(read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "documents"), "item_id", "doc_id")
    return rows.select("item_id", "doc_id", "shared", F.col("longest.token_count").alias("tokens"), F.col("longest.phrase").alias("phrase"))


@query(f"WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), f AS (SELECT doc_id, l[1] AS a, array_to_string(l[2:], chr(10)) AS b FROM d), k AS (SELECT doc_id, {_TOKENS.replace('text', 'a')} AS wa, {_TOKENS.replace('text', 'b')} AS wb FROM f), g AS (SELECT doc_id, wa, wb, {_GRAMS.replace('(w)', '(wa)').replace('w[', 'wa[')} AS ga, {_GRAMS.replace('(w)', '(wb)').replace('w[', 'wb[')} AS gb FROM k) SELECT doc_id, len(wa)::INT AS conditioning_tokens, len(wb)::INT AS target_tokens, len(list_intersect(ga, gb))::INT AS shared, len(list_intersect(list_distinct(wa), list_distinct(wb)))::INT AS common_words FROM g")
def leakage_of_openings(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("l"))
    rows = docs.select("doc_id", t.lower_tokens(F.element_at("l", 1)).alias("a"), t.lower_tokens(F.array_join(F.slice("l", F.lit(2), F.size("l")), "\n")).alias("b"))
    return rows.select("doc_id", F.size("a").alias("conditioning_tokens"), F.size("b").alias("target_tokens"), F.size(F.array_intersect(t.ngrams(F.col("a"), 5), t.ngrams(F.col("b"), 5))).alias("shared"), F.size(F.array_intersect(F.array_distinct("a"), F.array_distinct("b"))).alias("common_words"))


@query()
def leakage_severity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("l"))
    rows = docs.select("doc_id", leakage.leakage(F.element_at("l", 1), F.array_join(F.slice("l", F.lit(2), F.size("l")), "\n")).alias("leakage"))
    return rows.select("doc_id", "leakage.severity", "leakage.longest_run", "leakage.token_set_jaccard", "leakage.shared_5gram_share")


@query()
def lsh_pairs(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return dedup.near_pairs(dedup.identities(docs, F.lpad(F.col("doc_id").cast("string"), 12, "0"), "text"))


@query()
def near_dup_groups(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    groups = dedup.group_ids(dedup.identities(docs, F.lpad(F.col("doc_id").cast("string"), 12, "0"), "text"))
    return dedup.with_split(groups, "salt")


@query("WITH m AS (SELECT sha256(text) AS value, CASE WHEN ('0x' || substr(sha256('s2:' || doc_id::VARCHAR), 1, 8))::BIGINT % 100 < 90 THEN 'train' WHEN ('0x' || substr(sha256('s2:' || doc_id::VARCHAR), 1, 8))::BIGINT % 100 < 95 THEN 'validation' ELSE 'test' END AS split FROM documents) SELECT 'transcript_sha256' AS kind, value, count(DISTINCT split)::BIGINT AS splits FROM m GROUP BY 2 HAVING count(DISTINCT split) > 1")
def cross_split_leak(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    members = docs.select(F.sha2("text", 256).alias("transcript_sha256"), sha_split(F.col("doc_id").cast("string"), "s2", dedup.SPLITS).alias("split"))
    return dedup.cross_split_leaks(members, ("transcript_sha256",))


_TERMS = "['licensed', 'under', 'the', 'apache', 'license']"


@query(f"WITH d AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents), n AS (SELECT count(*) AS n, avg(len(w)) AS average FROM d), p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) WHERE list_contains({_TERMS}, term) GROUP BY 1, 2), f AS (SELECT term, greatest(ln((n - count(*) + 0.5) / (count(*) + 0.5)), 1e-6) AS idf FROM p, n GROUP BY term, n), s AS (SELECT p.doc_id, sum(idf * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * len(w) / average))) AS score, count(*)::BIGINT AS matched FROM p JOIN f USING (term) JOIN d ON d.doc_id = p.doc_id, n GROUP BY 1) SELECT doc_id, matched, round(score, 6) AS score FROM s ORDER BY round(score, 9) DESC, doc_id LIMIT 50")
def bm25_topk(spark, sf_dir):
    index, lengths = search.postings(read(spark, sf_dir, "documents"), "doc_id", "text")
    hits = search.bm25(index, lengths, "doc_id", search.query_tokens("licensed under the apache license"))
    return hits.orderBy(F.desc(F.round("score", 9)), "doc_id").limit(50).select("doc_id", "matched", F.round("score", 6).alias("score"))


@query("WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id, list_cosine_similarity(embedding::DOUBLE[], (SELECT v FROM q)::DOUBLE[]) AS score FROM embeddings) SELECT vec_id, round(score, 6) AS score FROM s ORDER BY round(score, 9) DESC, vec_id LIMIT 25")
def cosine_topk(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    q = vectors.where("vec_id = 0").select("embedding")
    return search.cosine_topk(vectors, "vec_id", "embedding", q, 25).select("vec_id", F.round("score", 6).alias("score"))


@query()
def mmr_topk(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    q = vectors.where("vec_id = 0").select("embedding")
    hits = search.cosine_topk(vectors, "vec_id", "embedding", q, 500).join(vectors, "vec_id").select(F.col("vec_id").cast("string").alias("record_id"), "score", F.col("embedding").cast("array<double>").alias("vector"))
    return search.diversified(hits, 20, 0.3).select("record_id", "place")


_PRINT = "list_sort(list_distinct(list_concat(['source:' || source, 'lang:' || lang], list_transform(range(0, least(4, len(string_split(text, chr(10))))), lambda i: 'beat:' || i::VARCHAR))))"


def _fingerprints(spark, sf_dir):
    beats = F.transform(F.sequence(F.lit(0), F.least(F.lit(3), F.size(F.split("text", "\n")) - 1)), lambda i: F.concat(F.lit("beat:"), i))
    mark = F.array_sort(F.array_distinct(F.concat(F.array(F.concat(F.lit("source:"), "source"), F.concat(F.lit("lang:"), "lang")), beats)))
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), F.col("source").alias("source_content_hash"), mark.alias("fingerprint"))


@query(f"WITH f AS (SELECT doc_id, source, {_PRINT} AS p FROM documents), q AS (SELECT source AS s0, p AS p0 FROM f WHERE doc_id = 3), s AS (SELECT doc_id AS record_id, source, s0, len(list_intersect(p, p0)) / len(list_distinct(list_concat(p, p0))) AS score FROM f, q WHERE doc_id <> 3 ORDER BY score DESC, record_id LIMIT 40) SELECT record_id, score FROM s WHERE source <> s0")
def structural_jaccard_topk(spark, sf_dir):
    return search.structurally_similar(_fingerprints(spark, sf_dir), 3, 40).select("record_id", "score")


_HYBRID = "the apache license and the warranty"


@query()
def hybrid_search(spark, sf_dir):
    rows = corpus.records_of(read(spark, sf_dir, "documents"), hook_rules=HOOKS)
    records = rows.select(F.col("key").cast("string").alias("record_id"), "source_content_hash", F.col("clean_transcript").alias("text"), "hooks", F.transform("retention_devices", lambda d: d["device"]).alias("devices"), F.array(F.concat(F.lit("beats:"), F.col("n_beats"))).alias("fingerprint"), hash_embedding(F.col("clean_transcript")).alias("vector"))
    return search.search(records, search.SearchQuery(text=_HYBRID, structural_fingerprint=("beats:3",), top_k=20)).select("record_id", "place", F.round("score", 6).alias("score"))


@query("WITH a AS (SELECT doc_id, source, lang, n_chars, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) AS r FROM documents), b AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS k FROM a WHERE r <= 5) SELECT d.doc_id, b.doc_id IS NOT NULL AS selected FROM documents d LEFT JOIN (SELECT * FROM b WHERE k <= 60) b ON b.doc_id = d.doc_id")
def capped_sample(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn("cluster", F.lit("all"))
    return training.capped_sample(docs, "source", "cluster", "lang", "n_chars", "doc_id", 5, 60).select("doc_id", "selected")


def _predictions(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), t.word_count(t.clean(F.col("text"))).alias("w"))
    fields = F.array(
        F.struct(F.lit("quality").alias("field"), F.when(F.col("w") >= 20, F.array(F.when(F.col("w") >= 100, "1").otherwise("0"))).alias("value"), ((F.col("w") % 100) / 100).alias("confidence")),
        F.struct(F.lit("toxic").alias("field"), F.array(F.lit("0")).alias("value"), F.when(F.col("w") >= 50, F.lit(0.75)).alias("confidence")),
    )
    return docs.select("record_id", F.inline(fields))


def _labels(spark, sf_dir):
    labels = read(spark, sf_dir, "labels")
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.when(F.col("doc_id") % 9 == 0, "ambiguous").otherwise("value").alias("status"), F.array(F.col(c).cast("string")).alias("acceptable")) for c in ("quality", "toxic")])
    return labels.select(F.col("doc_id").alias("record_id"), F.inline(fields))


_JUDGED = f"""WITH p AS (SELECT doc_id, {_WORDS} AS w FROM documents), j AS (
 SELECT l.doc_id AS record_id, 'quality' AS field, l.quality::VARCHAR AS truth, CASE WHEN w >= 100 THEN '1' WHEN w >= 20 THEN '0' END AS predicted, (w % 100) / 100 AS confidence FROM labels l JOIN p USING (doc_id)
 UNION ALL SELECT l.doc_id, 'toxic', l.toxic::VARCHAR, '0', CASE WHEN w >= 50 THEN 0.75 END FROM labels l JOIN p USING (doc_id)),
r AS (SELECT *, CASE WHEN record_id % 9 = 0 THEN CASE WHEN predicted IS NULL THEN 'correct_abstention' ELSE 'unsupported_inference' END WHEN predicted IS NULL THEN 'unnecessary_abstention' WHEN predicted = truth THEN 'accepted' ELSE 'wrong' END AS outcome FROM j) """


#: Outcomes and the rates that count them.
_RATES = (("accepted", "acceptance_rate"), ("unsupported_inference", "unsupported_inference_rate"), ("unsupported_inference", "false_inference_rate"), ("correct_abstention", "correct_abstention_rate"), ("unnecessary_abstention", "unnecessary_abstention_rate"))


def _judged(spark, sf_dir):
    return gold.judged(_labels(spark, sf_dir), _predictions(spark, sf_dir))


@query(_JUDGED + "SELECT field, count(*) FILTER (outcome = 'accepted')::BIGINT AS accepted, count(*) FILTER (outcome = 'wrong')::BIGINT AS wrong, count(*) FILTER (outcome = 'unsupported_inference')::BIGINT AS unsupported_inference, count(*) FILTER (outcome = 'unnecessary_abstention')::BIGINT AS unnecessary_abstention, count(*) FILTER (outcome = 'correct_abstention')::BIGINT AS correct_abstention, count(*)::BIGINT AS total, " + ", ".join(f"round(count(*) FILTER (outcome = '{o}') / count(*), 4) AS {n}" for o, n in _RATES) + " FROM r GROUP BY 1")
def field_metrics(spark, sf_dir):
    return gold.field_metrics(_judged(spark, sf_dir)).select("field", "accepted", "wrong", "unsupported_inference", "unnecessary_abstention", "correct_abstention", "total", *[n for _, n in _RATES])


@query(_JUDGED + "SELECT field, count(*) FILTER (outcome = 'accepted')::BIGINT AS accepted, count(*) FILTER (outcome IN ('wrong', 'unnecessary_abstention'))::BIGINT AS wrong, count(*) FILTER (outcome = 'correct_abstention')::BIGINT AS correct_abstention, count(*) FILTER (outcome = 'unsupported_inference')::BIGINT AS false_inference FROM r GROUP BY 1")
def simple_gold_metrics(spark, sf_dir):
    return gold.simple_metrics(_judged(spark, sf_dir))


def _pairs(spark, sf_dir):
    return _judged(spark, sf_dir).where("status = 'value'").select("field", F.coalesce(F.element_at("predicted", 1), F.lit("abstain")).alias("prediction"), F.element_at("acceptable", 1).alias("truth"))


_CONFUSION = _JUDGED + ", c AS (SELECT field, coalesce(predicted, 'abstain') AS prediction, truth, count(*)::BIGINT AS n FROM r WHERE record_id % 9 <> 0 GROUP BY 1, 2, 3) "


@query(_CONFUSION + "SELECT field, prediction, truth, n FROM c")
def confusion_matrix(spark, sf_dir):
    return gold.confusion(_pairs(spark, sf_dir))


_CLASSES = _CONFUSION + ", a AS (SELECT field, prediction AS label, sum(n) AS k FROM c GROUP BY 1, 2), b AS (SELECT field, truth AS label, sum(n) AS k FROM c GROUP BY 1, 2), k AS (SELECT coalesce(a.field, b.field) AS field, coalesce(a.label, b.label) AS label, coalesce(b.k, 0)::BIGINT AS truth_count, coalesce(a.k, 0)::BIGINT AS predicted_count, coalesce(c.n, 0)::BIGINT AS true_positives FROM a FULL JOIN b ON a.field = b.field AND a.label = b.label LEFT JOIN c ON c.field = coalesce(a.field, b.field) AND c.prediction = coalesce(a.label, b.label) AND c.truth = c.prediction), pr AS (SELECT *, CASE WHEN predicted_count > 0 THEN round(true_positives / predicted_count, 4) ELSE 0.0::DOUBLE END AS precision, CASE WHEN truth_count > 0 THEN round(true_positives / truth_count, 4) ELSE 0.0::DOUBLE END AS recall FROM k), m AS (SELECT *, CASE WHEN precision + recall > 0 THEN round(2 * precision * recall / (precision + recall), 4) ELSE 0.0::DOUBLE END AS f1 FROM pr) "


@query(_CLASSES + "SELECT * FROM m")
def class_counts(spark, sf_dir):
    return gold.class_metrics(gold.confusion(_pairs(spark, sf_dir)))


@query(_CLASSES + "SELECT field, round(sum(f1::DECIMAL(10, 4))::DOUBLE / count(*), 4) AS macro_f1, count(*)::BIGINT AS label_count FROM m GROUP BY 1")
def macro_f1(spark, sf_dir):
    return gold.macro_f1(gold.class_metrics(gold.confusion(_pairs(spark, sf_dir))))


_CALIBRATED = "count(*)::BIGINT AS total, count(*) FILTER (outcome = 'accepted')::BIGINT AS accepted, round(count(*) FILTER (outcome = 'accepted') / count(*), 4) AS acceptance_rate, round(avg(confidence), 4) AS mean_confidence, round(abs(round(avg(confidence), 4) - round(count(*) FILTER (outcome = 'accepted') / count(*), 4)), 4) AS calibration_gap FROM r GROUP BY 1"


@query(_JUDGED + "SELECT CASE WHEN confidence IS NULL THEN 'unknown' WHEN confidence >= 0.8 THEN 'high' WHEN confidence >= 0.6 THEN 'medium' ELSE 'low' END AS bucket, " + _CALIBRATED)
def calibration_bands(spark, sf_dir):
    return gold.band_calibration(_judged(spark, sf_dir))


@query(_JUDGED + "SELECT round(sum(calibration_gap * total) / sum(total), 4) AS expected_calibration_error FROM (SELECT CASE WHEN confidence < 0.2 THEN '0' WHEN confidence < 0.4 THEN '2' WHEN confidence < 0.6 THEN '4' WHEN confidence < 0.8 THEN '6' ELSE '8' END AS bucket, " + _CALIBRATED.replace("FROM r", "FROM r WHERE confidence >= 0 AND confidence < 1.01") + ")")
def calibration_error(spark, sf_dir):
    return gold.expected_calibration_error(gold.numeric_calibration(_judged(spark, sf_dir)))


@query("WITH a AS (SELECT doc_id, 'quality' AS field, 'r1' AS who, quality AS v FROM labels UNION ALL SELECT doc_id, 'quality', 'r2', CASE WHEN doc_id % 4 = 0 THEN 1 - quality ELSE quality END FROM labels UNION ALL SELECT doc_id, 'toxic', 'r1', toxic FROM labels UNION ALL SELECT doc_id, 'toxic', 'r2', toxic FROM labels WHERE doc_id % 2 = 0), p AS (SELECT doc_id, field, count(*) AS k, count(DISTINCT v) AS d FROM a GROUP BY 1, 2 HAVING count(*) >= 2) SELECT field, count(*)::BIGINT AS compared, count(*) FILTER (d = 1)::BIGINT AS exact, round(count(*) FILTER (d = 1) / count(*), 4) AS exact_rate FROM p GROUP BY 1")
def agreement(spark, sf_dir):
    labels = read(spark, sf_dir, "labels")
    row = lambda who, field, v: labels.select(F.col("doc_id").alias("record_id"), F.lit(who).alias("reviewer_id"), F.lit(field).alias("field"), F.lit("value").alias("status"), F.array(v.cast("string")).alias("acceptable"))
    q, x = F.col("quality"), F.col("toxic")
    rows = row("r1", "quality", q).union(row("r2", "quality", F.when(F.col("doc_id") % 4 == 0, 1 - q).otherwise(q))).union(row("r1", "toxic", x)).union(row("r2", "toxic", x).where("record_id % 2 = 0"))
    return gold.agreement(rows).select("field", "compared", "exact", "exact_rate")


@query()
def stratified_sample(spark, sf_dir):
    rows = corpus.records_of(read(spark, sf_dir, "documents"), hook_rules=HOOKS)
    words = F.col("spoken_word_count")
    strata = gold.strata(F.lit(None).cast("double"), words, F.lit(None).cast("double"), F.try_element_at("hooks", F.lit(1)), F.transform("beats", lambda _: F.lit("body")), F.lit(None).cast("double"), words, F.col("has_cta"))
    return gold.stratified_sample(rows.select("source_content_hash", strata.alias("strata")), 50).select("source_content_hash", "place")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def unreserved_reports(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("report"), "o_custkey", "o_orderstatus")
    taken = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("report"))
    return registry.unreserved(orders, taken, "report", F.col("o_orderstatus") == "F").select(F.col("report").alias("o_orderkey"), "o_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O') ORDER BY sha256('seed:' || o_orderkey::VARCHAR) LIMIT 100")
def replay_semi(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("report"))
    used = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("report"), "l_linestatus")
    return registry.replay_sample(orders, used, "report", F.col("l_linestatus") == "O", F.col("report").cast("string"), "seed", 100).select(F.col("report").alias("o_orderkey"))


@query("SELECT l_orderkey, count(*) FILTER (l_returnflag = 'A')::BIGINT AS new_count, count(*) FILTER (l_returnflag = 'N')::BIGINT AS replay_count, count(*) FILTER (l_returnflag = 'R')::BIGINT AS evaluation_count FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def role_pivot(spark, sf_dir):
    role = F.when(F.col("l_returnflag") == "A", "new").when(F.col("l_returnflag") == "N", "replay").otherwise("evaluation")
    members = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("dataset_id"), role.alias("role"))
    versions = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("dataset_id"), F.col("o_custkey").alias("owner"))
    runs = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("owner")).join(versions, "owner").select("dataset_id", F.col("dataset_id").alias("id"))
    return registry.run_details(runs, versions, members).select(F.col("dataset_id").alias("l_orderkey"), "new_count", "replay_count", "evaluation_count")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL OR l.quality = 0")
def pending_compile_anti(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id")
    done = read(spark, sf_dir, "labels").select("doc_id", F.col("doc_id").alias("record_id"), "quality")
    return registry.pending(docs, done, "doc_id", F.col("quality") == 0)


@query("SELECT count(*) FILTER (quality = 1)::BIGINT AS ready, count(*) FILTER (quality = 0)::BIGINT AS failed, count(*) FILTER (quality IS NULL)::BIGINT AS pending FROM documents LEFT JOIN labels USING (doc_id)")
def compile_counts(spark, sf_dir):
    done = read(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "ready").otherwise("failed").alias("status"))
    return registry.compile_counts(read(spark, sf_dir, "documents").select("doc_id"), done, "doc_id")


@query("SELECT event_type AS state, count(*)::BIGINT AS n FROM events GROUP BY 1")
def state_counts(spark, sf_dir):
    return registry.state_counts(read(spark, sf_dir, "events").select(F.col("event_type").alias("state")))


@query("WITH r AS (SELECT doc_id AS request, sha256(text) AS artifact, source || ':' || n_chars::VARCHAR AS content FROM documents), k AS (SELECT doc_id, sha256(text) AS artifact, source || ':' || n_chars::VARCHAR AS content FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)), c AS (SELECT request, 0 AS p, doc_id FROM r JOIN k ON k.artifact = r.artifact UNION ALL SELECT request, 1, doc_id FROM r JOIN k ON k.content = r.content), b AS (SELECT request, min(p) AS p FROM c GROUP BY 1) SELECT b.request, min(doc_id) AS doc_id, b.p = 0 AS same_artifact FROM b JOIN c ON c.request = b.request AND c.p = b.p GROUP BY b.request, b.p")
def artifact_priority_lookup(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("artifact"), F.concat_ws(":", "source", F.col("n_chars").cast("string")).alias("content"))
    known = rows.join(read(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return registry.lookup(rows.withColumnRenamed("doc_id", "request"), known, "artifact", "content", "doc_id")


@query("WITH c AS (SELECT user_id, count(*) AS attempts, count(*) FILTER (event_type = 'error') AS failures FROM events GROUP BY 1) SELECT user_id, attempts::BIGINT AS attempts, failures::BIGINT AS failures FROM c")
def retry_counts(spark, sf_dir):
    attempts = read(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") == "error", "failed").otherwise("ready").alias("status"), F.col("props").alias("error"), F.col("ts").alias("at"))
    return registry.retry_counts(attempts, "user_id").select("user_id", "attempts", "failures")


@query("SELECT event_id, CASE WHEN value < 0 OR value <> floor(value) THEN 'views: not a count' ELSE '' END AS problems FROM events")
def outcome_rule_violations(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", F.create_map(F.lit("views"), "value").alias("metrics"))
    return rows.select("event_id", F.array_join(outcomes.metric_problems(F.col("metrics")), ",").alias("problems"))


@query("WITH r AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) SELECT (i // 100)::BIGINT AS shard, count(*)::BIGINT AS rows, sha256(string_agg(text, chr(10) ORDER BY doc_id)) AS sha256 FROM r GROUP BY 1")
def manifest_shards(spark, sf_dir):
    return sinks.shards(read(spark, sf_dir, "documents"), "doc_id", "text", 100)


@query("SELECT lang AS dimension_value, count(*)::BIGINT AS n FROM documents GROUP BY 1 UNION ALL SELECT CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 2000 THEN 'medium' ELSE 'long' END, count(*)::BIGINT FROM documents GROUP BY 1")
def audit_distributions(spark, sf_dir):
    rows = training.distributions(read(spark, sf_dir, "documents"), {"lang": F.col("lang"), "size": training.bucketed(F.col("n_chars"), (500, 2000), ("short", "medium", "long"))})
    return rows.select(F.col("value").alias("dimension_value"), "n")


@query("SELECT page_id, substr(sha256(html), 1, 2) AS prefix, sha256(html) AS sha256 FROM pages")
def raw_identities(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.substring(F.sha2("html", 256), 1, 2).alias("prefix"), F.sha2("html", 256).alias("sha256"))


@query("WITH w AS (SELECT date_trunc('hour', ts) AS start, event_type, count(*)::BIGINT AS n FROM events GROUP BY 1, 2) SELECT epoch(start)::BIGINT AS start, event_type, n FROM w")
def hourly_counts(spark, sf_dir):
    rows = read(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.unix_seconds(F.col("window.start").cast("timestamp")).alias("start"), "event_type", "n")


@query()
def staged_reconstruction(spark, sf_dir):
    rows = corpus.records_of(read(spark, sf_dir, "documents"), hook_rules=HOOKS).withColumn("record_id", F.col("key").cast("string")).withColumn("roles", F.transform("beats", lambda _: F.lit("body")))
    fields, _ = reconstruction.staged(rows)
    return fields


def _dataset(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return corpus.training_dataset(docs, topic=F.col("source"), language=F.col("lang"), per_source=4, per_cluster=8)


@query()
def training_examples(spark, sf_dir):
    return _dataset(spark, sf_dir).examples.select("example_id", "key", "objective", "variant_id", "split", "eligibility", "quality", F.array_join("exclusion_reasons", ",").alias("reasons"))


@query()
def training_manifests(spark, sf_dir):
    return _dataset(spark, sf_dir).manifests


@query()
def readiness_gates(spark, sf_dir):
    return _dataset(spark, sf_dir).gates


def _briefs(spark, sf_dir):
    """Briefs in long form: the source as topic, the length class as format, a sure audience for long texts."""
    docs = read(spark, sf_dir, "documents")
    field = lambda name, value, confidence, sources: F.struct(F.lit(name).alias("field"), value.alias("value"), F.lit(confidence).alias("confidence"), F.lit("model_inference").alias("evidence_type"), sources.alias("sources"))
    some, none = F.array(F.lit("text")), F.array().cast("array<string>")
    fields = F.array(
        field("topic", F.col("source"), 0.7, some),
        field("content_format", F.when(F.col("n_chars") > 100, "long").otherwise("short"), 0.6, F.when(F.col("n_chars") > 500, some).otherwise(none)),
        field("central_idea", F.concat(F.col("source"), F.lit(" "), F.col("lang")), 0.99, some),
    )
    return docs.select(F.col("doc_id").alias("record_id"), F.inline(fields))


@query("WITH n AS (SELECT count(*) AS n FROM documents), f AS (SELECT doc_id, CASE WHEN n_chars > 100 THEN 'long' ELSE 'short' END AS v, n_chars, source || ' ' || lang AS idea, source FROM documents) SELECT category, count(*)::BIGINT AS n FROM (SELECT 'format_collapse' AS category FROM f WHERE v IN (SELECT v FROM f GROUP BY v HAVING count(*) / (SELECT n FROM n) > 0.8) UNION ALL SELECT 'generic_topic_collapse' FROM f WHERE source IN (SELECT source FROM f GROUP BY 1 HAVING count(*) / (SELECT n FROM n) > 0.5) UNION ALL SELECT 'repeated_central_idea' FROM f WHERE idea IN (SELECT idea FROM f GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'suspiciously_high_confidence' FROM f UNION ALL SELECT 'empty_evidence' FROM f WHERE n_chars <= 500) GROUP BY 1")
def anomaly_categories(spark, sf_dir):
    return gold.anomalies(_briefs(spark, sf_dir)).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT conv_id AS record_id, role AS field, count(DISTINCT length(text) > 200)::BIGINT AS outputs FROM conversations GROUP BY 1, 2 HAVING count(DISTINCT length(text) > 200) > 1")
def contaminated_fields(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations")
    return gold.contamination(turns.select(F.col("conv_id").alias("record_id"), F.col("turn").alias("context_id"), F.col("role").alias("field"), (F.length("text") > 200).cast("string").alias("value")))


@query(f"WITH p AS (SELECT count(*) AS records, count(*) * 3 AS requests, (sum({_WORDS}) * 3)::BIGINT AS input_tokens, count(*) * 360 AS output_tokens FROM documents), b AS (SELECT unnest([{{'band': 'low', 'f': 0.8::DOUBLE}}, {{'band': 'expected', 'f': 1.0::DOUBLE}}, {{'band': 'high', 'f': 1.3::DOUBLE}}]) AS b), s AS (SELECT b.band AS band, round_even(requests / records * 7500 * b.f, 0)::BIGINT AS requests, round_even(input_tokens / records * 7500 * b.f, 0)::BIGINT AS input_tokens, round_even(output_tokens / records * 7500 * b.f, 0)::BIGINT AS output_tokens FROM p, b) SELECT *, round(input_tokens / 1e6 * 2.0 + output_tokens / 1e6 * 8.0, 4) AS cost FROM s")
def projected_costs(spark, sf_dir):
    words = read(spark, sf_dir, "documents").select(t.word_count(t.clean(F.col("text"))).alias("w"))
    pilot = words.agg(F.count(F.lit(1)).alias("records"), (F.count(F.lit(1)) * 3).alias("requests"), (F.sum("w") * 3).cast("long").alias("input_tokens"), (F.count(F.lit(1)) * 360).alias("output_tokens"))
    return gold.cost_projection(pilot, 7500, 2.0, 8.0)


@query(_JUDGED + ", m AS (SELECT field, round(count(*) FILTER (outcome = 'accepted') / count(*), 4) AS a, round(count(*) FILTER (outcome = 'unsupported_inference') / count(*), 4) AS u FROM r GROUP BY 1), g AS (SELECT unnest([{'gate': 'minimum_human_reviewed_sources', 'passed': true}, {'gate': 'zero_high_severity_leakage', 'passed': true}, {'gate': 'central_idea_acceptance', 'passed': false}, {'gate': 'objective_acceptance', 'passed': false}, {'gate': 'format_acceptance', 'passed': false}, {'gate': 'unsupported_audience_inference', 'passed': false}]) AS g) SELECT g.gate AS gate, g.passed AS passed FROM g UNION ALL SELECT 'topic_acceptance', a >= 0.9 FROM m WHERE field = 'quality' UNION ALL SELECT 'false_cta_inference', u <= 0.02 FROM m WHERE field = 'toxic'")
def gold_quality_gates(spark, sf_dir):
    names = F.when(F.col("field") == "quality", "topic").otherwise("cta_intent")
    return gold.quality_gates(gold.field_metrics(_judged(spark, sf_dir)).withColumn("field", names), 100, 0)


@query("WITH d AS (SELECT 'lang' AS dimension, lang AS value, count(*)::BIGINT AS n FROM documents GROUP BY 2 UNION ALL SELECT 'long', (n_chars > 100)::VARCHAR, count(*)::BIGINT FROM documents GROUP BY 2), s AS (SELECT *, n / sum(n) OVER (PARTITION BY dimension) AS share FROM d) SELECT dimension, value, n, round(share, 6) AS share FROM s WHERE share > 0.7")
def imbalanced_dimensions(spark, sf_dir):
    rows = training.distributions(read(spark, sf_dir, "documents"), {"lang": F.col("lang"), "long": F.col("n_chars") > 100})
    return training.imbalances(rows).select("dimension", "value", "n", F.round("share", 6).alias("share"))


@query("SELECT l.doc_id AS record_id, 'quality' AS field, CASE WHEN l.doc_id % 7 = 0 THEN '1' ELSE l.quality::VARCHAR END AS value, CASE WHEN l.doc_id % 7 = 0 THEN 2 ELSE 0 END::BIGINT AS reviewers FROM labels l")
def resolved_labels(spark, sf_dir):
    labels = read(spark, sf_dir, "labels")
    row = lambda who, at: labels.select(F.col("doc_id").alias("record_id"), F.lit(who).alias("reviewer_id"), F.lit(at).alias("created_at"), F.lit("quality").alias("field"), F.lit("value").alias("status"), F.array((F.col("quality") if at == 1 else F.lit(0)).cast("string")).alias("acceptable"))
    notes = row("r1", 1).union(row("r2", 2))
    rulings = labels.where("doc_id % 7 = 0").select(F.col("doc_id").alias("record_id"), F.lit("quality").alias("field"), F.lit("lead").alias("resolver_id"), F.lit("value").alias("status"), F.array(F.lit("1")).alias("acceptable"))
    ruled = annotations.adjudicated(rulings, notes)
    out = gold.resolved(notes, ruled).join(ruled.select("record_id", "reviewer_count"), "record_id", "left")
    return out.select("record_id", "field", F.element_at("acceptable", 1).alias("value"), F.coalesce("reviewer_count", F.lit(0)).cast("long").alias("reviewers"))


@query("SELECT l_orderkey, round(sum(l_quantity / 64.0::DOUBLE) / count(*), 4) AS asr_confidence FROM lineitem GROUP BY 1")
def asr_confidence(spark, sf_dir):
    words = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct((F.col("l_quantity").cast("double") / 64).alias("confidence"))).alias("words"))
    return words.select("l_orderkey", t.mean_confidence(F.col("words")).alias("asr_confidence"))


_COMPILED = """
WITH p AS (SELECT doc_id, text IS NULL OR trim(text) = '' AS bad, lang IS NOT DISTINCT FROM 'en' AS saved FROM documents)"""


def _compile_run(spark, sf_dir):
    """A run over all documents, of which English ones have records already."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    make = lambda d: d.select("doc_id", F.sha2("text", 256).alias("record_sha256"))
    blank = F.coalesce(F.trim("text"), F.lit("")) == ""
    return service.compile_pending(docs.withColumn("problem", F.when(blank, "transcript_missing")), make(docs.where("lang = 'en'")), make, "doc_id")


@query(_COMPILED + "SELECT count(*)::BIGINT AS examined, count(*) FILTER (NOT bad AND NOT saved)::BIGINT AS compiled, count(*) FILTER (NOT bad AND saved)::BIGINT AS unchanged, count(*) FILTER (bad)::BIGINT AS failed FROM p")
def compile_pending_summary(spark, sf_dir):
    return _compile_run(spark, sf_dir).summary


@query(_COMPILED + "SELECT doc_id FROM p WHERE NOT bad AND NOT saved")
def compile_pending_records(spark, sf_dir):
    return _compile_run(spark, sf_dir).records.select("doc_id")


@query("SELECT doc_id, CASE WHEN l.quality IS NULL THEN 1.0 ELSE 1.0 + l.quality END::DOUBLE AS sampling_weight FROM documents LEFT JOIN labels l USING (doc_id)")
def outcome_weights(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels").select("doc_id", "quality")
    return training.outcome_weights(docs, labels, "doc_id", F.col("quality") + 1)
