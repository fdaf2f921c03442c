"""The registry's tables by version, and the service that compiles what is pending."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.registry import LONGEST_ERROR

#: Tables that each version adds.
VERSIONS: dict[int, dict[str, str]] = {
    1: {
        "reports": "report_id string, artifact_sha256 string, content_hash string, path string, split string, accepted timestamp",
        "reservations": "report_id string, run_id string, role string, status string",
        "runs": "run_id string, dataset_id string, state string, created timestamp",
        "dataset_members": "dataset_id string, report_id string, role string",
    },
    2: {
        "records": "report_id string, record_sha256 string, record string, compiled timestamp",
        "compile_errors": "report_id string, error string, at timestamp",
        "outcomes": "outcome_id string, report_id string, outcome string, recorded timestamp",
    },
}
CURRENT_VERSION = max(VERSIONS)


def version(spark: SparkSession, root: str) -> int:
    """The version of the tables under root; 0 if there are none."""
    try:
        return spark.read.schema("version int").parquet(f"{root}/schema_meta").agg(F.max("version")).first()[0] or 0
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def bootstrap(spark: SparkSession, root: str) -> int:
    """Brings the tables under root to the current version, which is returned; an error if theirs is newer.

    A version is recorded after its tables, which are left alone where they exist: a run that was cut short is repeated.
    """
    have = version(spark, root)
    if have > CURRENT_VERSION:
        raise RuntimeError(f"tables of version {have} are newer than {CURRENT_VERSION}")
    for v in range(have + 1, CURRENT_VERSION + 1):
        for name, schema in VERSIONS[v].items():
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{root}/{name}")
        spark.createDataFrame([(v,)], "version int").write.mode("append").parquet(f"{root}/schema_meta")
    return CURRENT_VERSION


class Compiled(NamedTuple):
    records: DataFrame
    errors: DataFrame
    summary: DataFrame


def compile_pending(pending: DataFrame, saved: DataFrame, make: Callable[[DataFrame], DataFrame], key: str, most: int | None = None) -> Compiled:
    """New records of pending rows, what failed, and one row of counts (examined, compiled, unchanged, failed).

    pending: key and problem (null for valid rows) beside what make() takes; make() gives key and record_sha256, at most
    one row for each of the valid rows; a valid row without one has failed. saved: key and record_sha256 of the records
    there are; equal ones are unchanged and not given again. most: rows of one run, by key.
    """
    rows = pending if most is None else pending.orderBy(key).limit(most)
    old = saved.select(key, F.col("record_sha256").alias("_old"))
    made = make(rows.where("problem is null").drop("problem"))
    known = rows.select(key, "problem").join(made.select(key, F.col("record_sha256").alias("_new")), key, "left").join(old, key, "left")
    state = F.when(F.col("_new").isNull(), "failed").when(F.col("_new").eqNullSafe(F.col("_old")), "unchanged").otherwise("compiled")
    known = known.withColumn("state", state)
    errors = known.where("state = 'failed'").select(key, F.left(F.coalesce("problem", F.lit("no record was made")), F.lit(LONGEST_ERROR)).alias("error"))
    states = ("compiled", "unchanged", "failed")
    summary = known.agg(F.count(F.lit(1)).alias("examined"), *[F.count_if(F.col("state") == s).alias(s) for s in states])
    return Compiled(made.join(known.where("state = 'compiled'").select(key), key, "left_semi"), errors, summary)
