"""Staged semantic reconstruction: adapters as Arrow functions, retries, caching, and control of what they infer."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.leakage import leakage
from quillspark.operators.registry import cache_misses

# Fixed values.
STAGES = ("topic_central_idea", "objective_format", "conditional_context")
VARIANTS = ("transcript", "structure", "delivery", "full", "full_with_client")
LONGEST_IDEA = 32
RETRIES = 2
#: The rule adapter: (words that must all occur, any of which suffices) and what it says at a stage.
RULES = (
    (("doge", "government workers"), all, {
        "topic_central_idea": {"topic": ("DOGE government workforce cuts", 0.72), "central_idea": ("The speaker argues that arbitrary workforce cuts harm public workers.", 0.68)},
        "objective_format": {"content_objective": ("persuade", 0.63), "content_format": ("commentary", 0.78)},
        "conditional_context": {"required_concepts": (["DOGE", "government workers", "consequences"], 0.75), "hook_intent": ("open a critical discussion through a question", 0.58)},
    }),
    (("how to", "step"), any, {"objective_format": {"content_objective": ("educate", 0.62), "content_format": ("tutorial", 0.62)}}),
)
FIELDS = "array<struct<field:string,value:string,confidence:double>>"


def semantic_input(variant: str, client: Column | None = None) -> Column:
    """The adapter's request as JSON, with as much of the record as the variant allows.

    Columns: clean_transcript, hook_mechanisms, roles, words_per_second, person_usage, vocabulary.
    """
    if variant not in VARIANTS:
        raise ValueError("unsupported semantic input variant")
    level = VARIANTS.index(variant)
    parts = [F.col("clean_transcript").alias("transcript"), F.lit(variant).alias("variant")]
    if level >= 1:
        parts += [F.transform("hook_mechanisms", lambda m: m["mechanism"]).alias("hook_mechanisms"), F.col("roles").alias("beat_roles")]
    if level >= 2:
        parts.append(F.col("words_per_second").alias("delivery"))
    if level >= 3:
        parts.append(F.struct("person_usage", "vocabulary").alias("script_relevant_evidence"))
    if level >= 4:
        parts.append((F.lit(None).cast("string") if client is None else client).alias("client_context"))
    return F.to_json(F.struct(*parts))


def rule_adapter(request: dict, stage: str, rules=RULES) -> dict[str, tuple[str | list[str], float]]:
    """Conservative rules; the first whose words occur speaks. Values are texts or lists of texts (JSON in the result)."""
    text = request["transcript"].lower()
    for words, how, said in rules:
        if how(w in text for w in words):
            if stage == "single_pass":
                return {k: v for part in said.values() for k, v in part.items()}
            return said.get(stage, {})
    return {}


def infer(requests: DataFrame, adapter: Callable[[dict, str], dict] = rule_adapter, retries: int = RETRIES) -> DataFrame:
    """(key, fields, error) of (key, request, stage): up to retries + 1 attempts, then an error and no fields."""

    def run(batches):
        for rows in batches:
            out = []
            for key, request, stage in zip(rows["key"], rows["request"], rows["stage"]):
                fields, error = None, None
                for _ in range(retries + 1):
                    try:
                        said = adapter(json.loads(request), stage)
                        if not all(0 <= c <= 1 for _, c in said.values()):
                            raise ValueError("confidence must be between 0 and 1")
                        fields, error = [(k, v if isinstance(v, str) else json.dumps(v, ensure_ascii=False), float(c)) for k, (v, c) in said.items()], None
                        break
                    except Exception as e:  # an adapter may fail in any way
                        error = f"{type(e).__name__}: {e}"
                out.append((key, fields, error))
            yield pd.DataFrame(out, columns=["key", "fields", "error"])

    return requests.select("key", "request", "stage").mapInPandas(run, f"key string, fields {FIELDS}, error string")


def staged(records: DataFrame, cache: DataFrame | None = None, adapter=rule_adapter, version: str = "rule-semantic-intent-v1", variant: str = "full_with_client", single_pass: bool = False, retries: int = RETRIES) -> tuple[DataFrame, DataFrame]:
    """(fields, results): controlled fields (record_id, field, value, confidence, accepted), and every stage's result for the cache.

    A stage that fails makes its record fail: it has no fields. A field that leaks the transcript, or an
    idea of more than LONGEST_IDEA words, is not accepted.
    """
    stages = ("single_pass",) if single_pass else STAGES
    asked = records.select("record_id", "clean_transcript", semantic_input(variant).alias("request")).withColumn("stage", F.explode(F.array(*[F.lit(s) for s in stages])))
    asked = asked.withColumn("key", F.sha2(F.concat_ws("|", "request", "stage", F.lit(version)), 256))
    distinct = asked.select("key", "request", "stage").dropDuplicates(["key"])
    done = infer(distinct if cache is None else cache_misses(distinct, cache, "key"), adapter, retries)
    results = done if cache is None else distinct.select("key").join(cache.select("key", "fields", "error"), "key").unionByName(done)
    full = asked.join(results, "key")
    failed = full.groupBy("record_id").agg(F.bool_or(F.col("error").isNotNull()).alias("failed")).where("failed")
    good = full.join(failed, "record_id", "left_anti").select("record_id", "clean_transcript", F.inline("fields"))
    compact = (F.col("field") != "central_idea") | (F.size(F.split(F.trim("value"), r"\s+")) <= LONGEST_IDEA)
    leaks = leakage(F.col("value"), F.col("clean_transcript"))["rejected"]
    return good.select("record_id", "field", "value", "confidence", (compact & ~leaks).alias("accepted")), results


def brief_id(source: Column, version: str) -> Column:
    return F.concat(F.lit("msb:"), F.substring(F.sha2(F.concat(source, F.lit(version)), 256), 1, 24))


def estimate(records: int, average_words: int, requests_each: int = 3, input_price: float = 0.0, output_price: float = 0.0) -> dict[str, float | int | None]:
    """What inference over a corpus asks for; the cost is None without prices."""
    requests = records * requests_each
    tokens_in, tokens_out = requests * average_words, requests * 120
    cost = tokens_in / 1e6 * input_price + tokens_out / 1e6 * output_price if input_price or output_price else None
    return {"records": records, "requests": requests, "input_tokens": tokens_in, "output_tokens": tokens_out, "cost": cost}
