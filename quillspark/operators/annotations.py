"""The life of gold annotations: what reviewers see, checks of what they say, adjudication, frozen sets; and input ablations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators import gold, reconstruction

# Fixed values.
ANNOTATION_VERSION = "1.0.0"
MODES = ("blind", "assisted")
STATUSES = ("value", "accepted", *gold.QUALITATIVE, *gold.ABSTAINING)


def review_payloads(records: DataFrame, mode: str, proposals: DataFrame | None = None, fields: tuple[str, ...] = gold.CORE_FIELDS) -> DataFrame:
    """(record_id, payload as JSON) for reviewers; a blind payload never holds a proposal.

    records: record_id, clean_transcript and any of hook_mechanisms, roles, client_context; proposals: (record_id, proposal).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    shown = [F.col(c) for c in ("hook_mechanisms", "roles", "client_context") if c in records.columns]
    parts = [F.lit(mode).alias("mode"), F.struct(F.col("clean_transcript").alias("transcript"), *shown).alias("source"), F.array(*[F.lit(f) for f in fields]).alias("fields")]
    if mode == "assisted":
        records = records.withColumn("proposal", F.lit(None).cast("string")) if proposals is None else records.join(proposals.select("record_id", "proposal"), "record_id", "left")
        parts.append(F.coalesce("proposal", F.lit("{}")).alias("proposal"))
    return records.select("record_id", F.to_json(F.struct("record_id", *parts)).alias("payload"))


def annotation_problems() -> Column:
    """What is wrong with an annotation in long form, as an array of texts.

    Columns: schema_version, record_id, reviewer_id, mode, field, status, acceptable (array), human_value, confidence.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    says = {
        "unsupported annotation version": ~F.col("schema_version").eqNullSafe(F.lit(ANNOTATION_VERSION)),
        "record_id is missing": empty("record_id"),
        "reviewer_id is missing": empty("reviewer_id"),
        "invalid review mode": ~F.coalesce(F.col("mode").isin(*MODES), F.lit(False)),
        "unsupported status": ~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)),
        "a value needs acceptable values or a human value": (F.col("status") == "value") & F.col("acceptable").isNull() & F.col("human_value").isNull(),
        "confidence must be between 0 and 1": ~F.col("confidence").between(0, 1),
    }
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(text)) for text, bad in says.items()]))


def adjudicated(rulings: DataFrame, annotations: DataFrame) -> DataFrame:
    """rulings (record_id, field, resolver_id, status, acceptable) with source_reviewers, sorted, and reviewer_count of what they rule on.

    An unsupported status is an error when the plan runs: it would count as a label.
    """
    seen = annotations.groupBy("record_id", "field").agg(F.array_sort(F.collect_set("reviewer_id")).alias("source_reviewers"), F.count(F.lit(1)).alias("reviewer_count"))
    ok = F.when(F.col("status").isin(*STATUSES), F.col("status")).otherwise(F.raise_error(F.concat(F.lit("unsupported status "), F.coalesce("status", F.lit("null")))).cast("string"))
    joined = rulings.withColumn("status", ok).join(seen, ["record_id", "field"], "left")
    return joined.withColumn("source_reviewers", F.coalesce("source_reviewers", F.array().cast("array<string>"))).withColumn("reviewer_count", F.coalesce("reviewer_count", F.lit(0)))


def frozen(entries: DataFrame, annotations: DataFrame, adjudications: DataFrame) -> DataFrame:
    """The rows of a frozen gold set, (part, key, line, manifest_id): entries, annotations, rulings and resolved labels as JSON.

    manifest_id digests all lines whatever their order, so that a set that is frozen twice has one name.
    """
    part = lambda name, df, *key: df.select(F.lit(name).alias("part"), F.concat_ws(":", *key).alias("key"), F.to_json(F.struct(*sorted(df.columns))).alias("line"))
    rows = part("entry", entries, "record_id").union(part("annotation", annotations, "record_id", "field", "reviewer_id")).union(part("adjudication", adjudications, "record_id", "field"))
    rows = rows.union(part("resolved", gold.resolved(annotations, adjudications), "record_id", "field"))
    sums = [F.sum(F.xxhash64(F.lit(k), "part", "line").cast("decimal(38,0)")).cast("string") for k in (1, 2)]
    digest = rows.agg(F.substring(F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums), 256), 1, 16).alias("d")).select(F.concat(F.lit("gold-manifest-"), "d").alias("manifest_id"))
    return rows.crossJoin(F.broadcast(digest))  # one row


def ablation(records: DataFrame, labels: DataFrame, adapter=reconstruction.rule_adapter, variants: tuple[str, ...] = reconstruction.VARIANTS, single_pass: bool = False) -> DataFrame:
    """A row for each input variant: records, failures, a proxy of the tokens sent, and acceptance of the headline fields."""
    words = F.size(F.filter(F.split("clean_transcript", r"\s+"), lambda w: w != ""))
    stages = 1 if single_pass else len(reconstruction.STAGES)
    sent = records.agg(F.count(F.lit(1)).alias("record_count"), (F.coalesce(F.sum(words), F.lit(0)) * stages).alias("input_tokens"))
    out = None
    for v in variants:
        fields, results = reconstruction.staged(records, adapter=adapter, variant=v, single_pass=single_pass)
        said = fields.where("accepted").select("record_id", "field", F.array("value").alias("value"), "confidence")
        known = records.select("record_id").crossJoin(F.broadcast(labels.select("field").distinct()))  # the labelled fields, a handful
        briefs = known.join(said, ["record_id", "field"], "left")
        rates = gold.field_metrics(gold.judged(labels, briefs))
        of = lambda f: F.max(F.when(F.col("field") == f, F.col("acceptance_rate"))).alias(f"{f}_acceptance")
        row = sent.crossJoin(results.agg(F.count_if(F.col("error").isNotNull()).alias("failed_requests"))).crossJoin(rates.agg(*[of(f) for f in ("topic", "central_idea", "content_objective", "content_format")]))  # one row each
        row = row.select(F.lit(v).alias("variant"), "*")
        out = row if out is None else out.unionByName(row)
    return out
