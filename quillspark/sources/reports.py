"""Extractor reports: listing, reading, validating and projecting JSON files, and a source for tests."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed values.
LARGEST_FILE = 16 * 1024 * 1024
LEAST_WORDS = 3
REPORT_SCHEMA = """
report_id string,
source struct<content_hash:string,duration_seconds:double,fps:double,resolution:string,filename:string,has_audio:boolean>,
processing struct<status:string,extractor_version:string>,
transcript struct<status:string,full_text:string,language:string,language_probability:double,
  sentences:array<struct<sentence_id:int,text:string,start:double,end:double,confidence:double>>,
  words:array<struct<word:string,start:double,end:double,confidence:double>>,
  delivery:struct<word_count:int,overall_words_per_minute:double,speaking_span_seconds:double,rolling_windows:array<struct<start:double,end:double,words_per_minute:double>>>>,
context struct<platform:string,topic:string,subtopic:string,content_format:string,audience_intent:string>,
semantic struct<method:string,sections:array<struct<section_id:string,type:string,text:string,start:double,end:double,confidence:double,verification_status:string>>>,
editing struct<verified_events:array<struct<type:string,timestamp:double,verification_status:string>>>,
training_features struct<values:map<string,string>,provenance:map<string,string>,excluded:map<string,string>>,
training_eligibility struct<script:boolean,editing:boolean,audio:boolean,color:boolean,captions:boolean>
"""


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified, size) of JSON files, by time of change; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[jJ][sS][oO][nN]").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size")).orderBy("modified", "path")


def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified, size, content, sha256): each file whole, with its digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[jJ][sS][oO][nN]").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"), "content").withColumn("sha256", F.sha2("content", 256))


def parsed(raw: DataFrame, most: int = LARGEST_FILE) -> DataFrame:
    """raw with report (struct) and parse_problem: too large, not UTF-8, not JSON, not an object."""
    text = F.try_validate_utf8(F.col("content").cast("string"))
    text = F.when(F.col("size") <= most, text)
    variant = F.try_parse_json(text)
    kind = F.schema_of_variant(variant)
    problem = (
        F.when(F.col("size") > most, "file_too_large")
        .when(text.isNull(), "invalid_utf8")
        .when(variant.isNull(), "invalid_json")
        .when(~F.startswith(kind, F.lit("OBJECT")), "not_an_object")
    )
    return raw.withColumn("report", F.from_json(text, REPORT_SCHEMA)).withColumn("parse_problem", problem)


def report_problem(r: Column) -> Column:
    """The first rule that a report breaks, null for a valid one."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    duration = r["source"]["duration_seconds"]
    body = r["transcript"]["full_text"]
    words = F.size(F.filter(F.split(body, r"(?U)\s+"), lambda w: w != ""))
    return (
        F.when(blank(r["report_id"]), "report_id_missing")
        .when(r["source"].isNull(), "source_missing")
        .when(blank(r["source"]["content_hash"]), "content_hash_missing")
        .when(duration.isNull() | F.isnan(duration) | (duration <= 0) | (duration == float("inf")), "duration_invalid")
        .when(F.coalesce(r["processing"]["status"], F.lit("")) != "complete", "processing_incomplete")
        .when(blank(r["processing"]["extractor_version"]), "extractor_version_missing")
        .when(F.coalesce(r["transcript"]["status"], F.lit("")) != "complete", "transcript_incomplete")
        .when(blank(body), "full_text_missing")
        .when(words < LEAST_WORDS, "full_text_too_short")
    )


def validated(rows: DataFrame) -> DataFrame:
    """parsed() rows with problem: null for admitted rows, else why they go to quarantine."""
    return rows.withColumn("problem", F.coalesce("parse_problem", report_problem(F.col("report"))))


def canonical(rows: DataFrame) -> DataFrame:
    """What the registry keeps of admitted rows: identities, digests and a canonical JSON projection."""
    r = F.col("report")
    values = lambda k: F.coalesce(r["training_features"][k], F.create_map().cast("map<string,string>"))
    projection = F.struct(
        values("excluded").alias("excluded_features"),
        F.struct(r["processing"]["extractor_version"].alias("version")).alias("extractor"),
        values("provenance").alias("feature_provenance"),
        r["source"]["content_hash"].alias("group_key"),
        r["report_id"].alias("report_id"),
        F.lit("1.0").alias("schema_version"),
        F.struct(r["source"]["content_hash"].alias("content_hash"), r["source"]["duration_seconds"].alias("duration_seconds"), r["source"]["fps"].alias("fps"), r["source"]["resolution"].alias("resolution")).alias("source"),
        F.struct(r["transcript"]["full_text"].alias("text"), r["transcript"]["delivery"]["word_count"].alias("word_count"), r["transcript"]["delivery"]["overall_words_per_minute"].alias("words_per_minute")).alias("transcript"),
        values("values").alias("verified_features"),
    )
    return rows.where("problem is null").select("path", "sha256", r["report_id"].alias("report_id"), r["source"]["content_hash"].alias("content_hash"), r["processing"]["extractor_version"].alias("extractor_version"), F.sha2(r["transcript"]["full_text"], 256).alias("transcript_sha256"), F.to_json(projection, {"ignoreNullFields": "false"}).alias("canonical_json"), F.lit("observation_only").alias("quality_status"))


class MemoryReports(DataSource):
    """Reports held in memory, for tests: spark.read.format("memory_reports").option("name", json)."""

    @classmethod
    def name(cls) -> str:
        return "memory_reports"

    def schema(self) -> str:
        return "path string, size long, content binary"

    def reader(self, schema) -> "MemoryReader":
        return MemoryReader({k: v for k, v in self.options.items() if k != "path"})


class MemoryReader(DataSourceReader):
    def __init__(self, entries: dict[str, str]):
        self.entries = entries

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(k) for k in sorted(self.entries)] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is not None:
            body = self.entries[partition.value].encode()
            yield partition.value, len(body), body
