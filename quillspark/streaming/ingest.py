"""Ingestion as a stream: files are archived, validated, admitted once by content, or put into quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quillspark.operators.registry import append_new, first_writer_wins
from quillspark.sources.reports import LARGEST_FILE, canonical, parsed, validated

BINARY = T.StructType().add("path", "string").add("modificationTime", "timestamp").add("length", "long").add("content", "binary")


def read_stream(spark: SparkSession, folder: str, files_each: int = 500) -> DataFrame:
    """New JSON files of a folder, some in each batch."""
    files = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", "*.[jJ][sS][oO][nN]").option("maxFilesPerTrigger", files_each).load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"), "content").withColumn("sha256", F.sha2("content", 256))


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def admit(batch: DataFrame, folder: str, largest: int = LARGEST_FILE) -> dict[str, int]:
    """One batch: admitted reports go to <folder>/reports, the rest to <folder>/quarantine.

    Both appends leave out what is there already, so a batch that runs again changes nothing; of several
    reports of one content the first by path wins. Returns counts.
    """
    spark = batch.sparkSession
    rows = validated(parsed(batch, largest)).persist()
    try:
        good = first_writer_wins(canonical(rows), "content_hash", "path")
        fresh = append_new(_table(spark, f"{folder}/reports", good.schema), good, ["content_hash"]).persist()
        bad = rows.where("problem is not null").select("path", "sha256", F.left("problem", F.lit(2000)).alias("problem"))
        lost = append_new(_table(spark, f"{folder}/quarantine", bad.schema), bad, ["path", "sha256"]).persist()
        counts = {"seen": rows.count(), "admitted": fresh.count(), "quarantined": lost.count()}
        fresh.write.mode("append").parquet(f"{folder}/reports")
        lost.write.mode("append").parquet(f"{folder}/quarantine")
        fresh.unpersist()
        lost.unpersist()
        return counts
    finally:
        rows.unpersist()


def ingest(spark: SparkSession, source: str, folder: str, once: bool = True, every: str = "60 seconds", largest: int = LARGEST_FILE) -> StreamingQuery:
    """Start ingestion: once over what is there, or again and again. Its checkpoint replaces leases and retry states."""
    writer = read_stream(spark, source).writeStream.foreachBatch(lambda df, _: admit(df, folder, largest)).option("checkpointLocation", f"{folder}/_checkpoint")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def first_by_content(stream: DataFrame, content: str, at: str, delay: str = "1 day") -> DataFrame:
    """A stream's rows, the first of each content hash within the watermark's delay."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([content])


def window_counts(stream: DataFrame, at: str, key: str, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Rows of each key in tumbling windows; late rows within the delay count."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, width), key).agg(F.count(F.lit(1)).alias("n"))
