"""Registry queries: reports, artifacts, reservations, runs and compile attempts as joins and aggregates of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
ACTIVE_STATES = ("queued", "preparing", "running", "evaluating", "promotable", "failed")
ROLES = ("new", "replay", "evaluation")
LONGEST_ERROR = 2000


def revision_key(md5: Column, modified: Column, size: Column) -> Column:
    """md5:<checksum>, or meta:<time>:<size> without one."""
    return F.when(F.coalesce(md5, F.lit("")) != "", F.concat(F.lit("md5:"), md5)).otherwise(F.concat(F.lit("meta:"), F.coalesce(modified.cast("string"), F.lit("")), F.lit(":"), F.coalesce(size.cast("string"), F.lit("unknown"))))


def state_counts(revisions: DataFrame, state: str = "state") -> DataFrame:
    return revisions.groupBy(state).agg(F.count(F.lit(1)).alias("n"))


def unreserved(reports: DataFrame, reservations: DataFrame, key: str, split: Column) -> DataFrame:
    """Training reports that no run has reserved: an anti join."""
    return reports.where(split).join(reservations.select(key), key, "left_anti")


def new_batch(reports: DataFrame, reservations: DataFrame, key: str, split: Column, most: int) -> DataFrame:
    return unreserved(reports, reservations, key, split).orderBy(key).limit(most)


def replay_sample(reports: DataFrame, reservations: DataFrame, key: str, consumed: Column, artifact: Column, seed: str, most: int) -> DataFrame:
    """Reports with a consumed reservation, most of them, in the order of SHA-256(seed:artifact): a semi join."""
    used = reports.join(reservations.where(consumed).select(key), key, "left_semi")
    return used.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), artifact), 256)).limit(max(0, most))


def replay_size(new: int, percent: int) -> int:
    return -(-new * percent // 100)


def dataset_members(new: DataFrame, replay: DataFrame, evaluation: DataFrame, key: str) -> DataFrame:
    """(key, role) of a dataset version."""
    parts = [df.select(key, F.lit(role).alias("role")) for df, role in zip((new, replay, evaluation), ROLES)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def version_of(members: DataFrame, key: str) -> DataFrame:
    """A version's name: the head of a digest over its members."""
    parts = members.agg(F.count(F.lit(1)).alias("members"), F.sum(F.xxhash64("role", key).cast("decimal(38,0)")).alias("h"))
    return parts.select(F.substring(F.sha2(F.concat_ws(":", F.col("members").cast("string"), F.col("h").cast("string")), 256), 1, 16).alias("version"), "members")


def propose_run(reports: DataFrame, reservations: DataFrame, runs: DataFrame, key: str, artifact: Column, *, rights_allowed: bool, least_new: int, most_new: int, replay_percent: int, seed: str) -> DataFrame:
    """Members of a new run; an error if training rights are missing, a run is active or too few reports are new."""
    if not rights_allowed:
        raise ValueError("training rights are not confirmed")
    if runs.where(F.col("state").isin(*ACTIVE_STATES)).limit(1).count():
        raise ValueError("a training run is active")
    fresh = new_batch(reports, reservations, key, F.col("split") == "train", most_new)
    n = fresh.count()
    if n < least_new:
        raise ValueError(f"{n} new reports, {least_new} needed")
    replay = replay_sample(reports.where("split = 'train'"), reservations, key, F.col("status") == "consumed", artifact, seed, replay_size(n, replay_percent))
    return dataset_members(fresh, replay, reports.where("split = 'test'").orderBy(key), key)


def active_run(runs: DataFrame) -> DataFrame:
    """The latest active run: one row, null if there is none."""
    return runs.where(F.col("state").isin(*ACTIVE_STATES)).agg(F.max_by("run_id", "id").alias("run_id"))


def run_details(runs: DataFrame, versions: DataFrame, members: DataFrame) -> DataFrame:
    """Members by role of each run: a three-way join, aggregated before the runs come in."""
    sums = members.groupBy("dataset_id").agg(*[F.count_if(F.col("role") == r).alias(f"{r}_count") for r in ROLES])
    return runs.join(versions, "dataset_id").join(sums, "dataset_id").orderBy(F.desc("id"))


def pending(reports: DataFrame, compiled: DataFrame, key: str, stale: Column) -> DataFrame:
    """Reports without a current record: none at all, or one for which the condition stale holds."""
    return reports.join(compiled, key, "left").where(F.col("record_id").isNull() | stale).select(*[reports[c] for c in reports.columns])


def compile_counts(reports: DataFrame, compiled: DataFrame, key: str) -> DataFrame:
    """ready, failed and pending reports."""
    joined = reports.select(key).join(compiled.select(key, "status"), key, "left")
    return joined.agg(F.count_if(F.col("status") == "ready").alias("ready"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status").isNull()).alias("pending"))


def lookup(requests: DataFrame, reports: DataFrame, artifact: str, content: str, key: str) -> DataFrame:
    """The report of each request (request, artifact, content): one of the same artifact, else one of the same content.

    A disjunction of two equalities: two joins and a priority, so that both can hash.
    """
    take = lambda col, p: requests.join(reports.select(F.col(col).alias("_v"), F.col(key).alias("_k")), requests[col] == F.col("_v")).select("request", F.struct(F.lit(p).alias("p"), F.col("_k").alias("k")).alias("_c"))
    return take(artifact, 0).union(take(content, 1)).groupBy("request").agg(F.min("_c").alias("_c")).select("request", F.col("_c.k").alias(key), (F.col("_c.p") == 0).alias("same_artifact"))


def first_writer_wins(rows: DataFrame, content: str, order: str) -> DataFrame:
    """One row for each content hash: the first."""
    return rows.groupBy(content).agg(F.min_by(F.struct(*rows.columns), order).alias("_r")).select("_r.*")


def append_new(table: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of fresh that the table lacks, each key once: an idempotent append writes these."""
    return fresh.dropDuplicates(keys).join(table.select(*keys), keys, "left_anti")


def upsert(table: DataFrame, fresh: DataFrame, keys: list[str], at: str) -> DataFrame:
    """table with the latest row of each key from either."""
    both = table.unionByName(fresh)
    return both.groupBy(*keys).agg(F.max_by(F.struct(*both.columns), at).alias("_r")).select("_r.*")


def claimable(revisions: DataFrame, now: Column) -> DataFrame:
    """Revisions that may be worked on: discovered, due for another try, or left by a worker whose lease ran out."""
    return revisions.where(F.col("state").isin("discovered", "retry") | ((F.col("state") == "downloading") & (F.col("lease_until") < now)))


def retry_counts(attempts: DataFrame, key: str) -> DataFrame:
    """Attempts and failures of each report, and its last error, cut to a length."""
    return attempts.groupBy(key).agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("status") == "failed").alias("failures"), F.left(F.max_by("error", "at"), F.lit(LONGEST_ERROR)).alias("last_error"))


def point_lookup(table: DataFrame, key: str, value, column: str):
    """One value by key; KeyError if the key is not there."""
    row = table.where(F.col(key) == value).select(column).first()
    if row is None:
        raise KeyError(value)
    return row[0]


def cache_misses(wanted: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    return wanted.join(cache.select(key), key, "left_anti")


def cached_or_computed(wanted: DataFrame, cache: DataFrame, key: str, compute) -> DataFrame:
    """Results for all wanted keys: from the cache, and computed for those it lacks."""
    hits = wanted.select(key).join(cache, key)
    return hits.unionByName(compute(cache_misses(wanted, cache, key)).select(*cache.columns))


