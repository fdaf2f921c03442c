"""Sinks: content-addressed raw files, canonical JSON lines by objective, shards with digests, write-once folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators.training import manifests


def write_raw(rows: DataFrame, folder: str) -> None:
    """Files by digest, in folders by its first two digits; content that is there already stays."""
    rows.dropDuplicates(["sha256"]).select("sha256", "size", "content", F.substring("sha256", 1, 2).alias("prefix")).write.mode("append").partitionBy("prefix").parquet(folder)


def _ordered(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*[_ordered(c[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)])
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(c, lambda x: _ordered(x, kind.elementType))
    return c


def canonical_json(df: DataFrame, *columns: str) -> Column:
    """The columns as JSON with sorted keys, without blanks, nulls kept."""
    row = F.struct(*[_ordered(F.col(c), df.schema[c].dataType).alias(c) for c in sorted(columns)])
    return F.to_json(row, {"ignoreNullFields": "false"})


def write_objectives(selected: DataFrame, rejected: DataFrame, folder: str, line: Column) -> DataFrame:
    """JSON lines by objective, rejections beside them; returns the manifest rows."""
    selected.select("objective", line.alias("value")).write.mode("errorifexists").partitionBy("objective").text(f"{folder}/examples")
    rejected.select("example_id", "objective", "reasons").repartitionByRange("objective", "example_id").sortWithinPartitions("objective", "example_id").write.mode("errorifexists").json(f"{folder}/rejections")
    out = manifests(selected, rejected)
    out.write.mode("errorifexists").json(f"{folder}/manifests")
    return out


def shards(rows: DataFrame, key: str, line: str, size: int = 1000) -> DataFrame:
    """(shard, rows, sha256): fixed numbers of lines in the order of the key, with the digest of each shard's lines.

    Places come from a range-partitioned sort and the partitions' counts, so no task sees all rows.
    """
    from quillspark.plans.components import materialised

    ordered = materialised(rows.select(key, line).repartitionByRange(key).sortWithinPartitions(key).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    counts = {r["_p"]: r["count"] for r in ordered.groupBy("_p").count().collect()}  # one row for each partition
    before, total = {}, 0
    for p in sorted(counts):
        before[p], total = total, total + counts[p]
    start = F.create_map(*[F.lit(x) for p, n in before.items() for x in (p, n)])[F.col("_p")] if before else F.lit(0)
    place = start + F.col("_i").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ordered.withColumn("shard", F.floor(place / size).cast("long"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, line))), lambda x: x[line]), "\n")
    return numbered.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sha2(lines, 256).alias("sha256"))


def manifest_digest(shard_rows: DataFrame) -> DataFrame:
    """One digest over the shards' digests in order."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("shard", "sha256"))), lambda x: x["sha256"])
    return shard_rows.agg(F.sha2(F.array_join(ordered, "\n"), 256).alias("manifest_sha256"), F.sum("rows").alias("rows"))


def write_once(df: DataFrame, folder: str, digest: str) -> str:
    """Write df under a folder named by its digest, or check that what is there is equal; other content is an error."""
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{digest}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        df.write.mode("errorifexists").parquet(path)
        return path
    there = spark.read.parquet(path)
    if there.schema.names != df.columns or there.exceptAll(df).limit(1).count() or df.exceptAll(there).limit(1).count():
        raise ValueError(f"{path} holds other content")
    return path
