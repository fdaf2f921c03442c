import json

import pytest
from pyspark.sql import functions as F

from quillspark.sources import reports, sinks
from quillspark.streaming import ingest


def report(i, **change):
    out = {"report_id": f"r{i}", "source": {"content_hash": f"c{i}", "duration_seconds": 10.5}, "processing": {"status": "complete", "extractor_version": "1"}, "transcript": {"status": "complete", "full_text": f"some words number {i}"}}
    for k, v in change.items():
        a, b = k.split("__")
        out[a][b] = v
    return json.dumps(out)


BAD = {"short": report(1, transcript__full_text="two words"), "duration": report(1, source__duration_seconds=0), "status": report(1, processing__status="running"), "list": "[1]", "broken": "not-json", "empty": "{}"}


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in (1, 2):
        (source / f"good{i}.json").write_text(report(i))
    (source / "again.JSON").write_text(report(1))
    (source / "note.txt").write_text("no")
    for k, v in BAD.items():
        (source / f"{k}.json").write_text(v)
    (source / "bytes.json").write_bytes(b"\xff\xfe{")
    return tmp_path


def test_validation(spark, folder):
    assert reports.list_files(spark, str(folder / "in")).count() == 10
    rows = {r.path.rsplit("/", 1)[1]: r.problem for r in reports.validated(reports.parsed(reports.read_raw(spark, str(folder / "in")))).collect()}
    assert rows.pop("good1.json") is None and rows.pop("good2.json") is None and rows.pop("again.JSON") is None
    assert rows == {"short.json": "full_text_too_short", "duration.json": "duration_invalid", "status.json": "processing_incomplete", "list.json": "not_an_object", "broken.json": "invalid_json", "empty.json": "report_id_missing", "bytes.json": "invalid_utf8"}
    small = reports.validated(reports.parsed(reports.read_raw(spark, str(folder / "in")), 10)).where("problem = 'file_too_large'").count()
    assert small == 6


def test_streaming_admits_once(spark, folder):
    out = str(folder / "out")
    for _ in range(2):
        ingest.ingest(spark, str(folder / "in"), out).awaitTermination()
    assert sorted(r.content_hash for r in spark.read.parquet(f"{out}/reports").collect()) == ["c1", "c2"]
    assert spark.read.parquet(f"{out}/quarantine").count() == 7
    (folder / "in" / "good3.json").write_text(report(3))
    ingest.ingest(spark, str(folder / "in"), out).awaitTermination()
    assert spark.read.parquet(f"{out}/reports").count() == 3
    again = ingest.admit(reports.read_raw(spark, str(folder / "in")), out)
    assert again["admitted"] == again["quarantined"] == 0


def test_memory_source(spark):
    spark.dataSource.register(reports.MemoryReports)
    df = spark.read.format("memory_reports").options(**{"a.json": report(7), "b.json": "x"}).load()
    rows = reports.validated(reports.parsed(df.withColumn("sha256", F.sha2("content", 256)))).collect()
    assert sorted((r.path, r.problem) for r in rows) == [("a.json", None), ("b.json", "invalid_json")]


def test_sinks(spark, tmp_path):
    df = spark.range(2501).select(F.format_string("k%05d", "id").alias("k"), F.concat(F.lit("line "), "id").alias("line"))
    first, second = (sinks.shards(df.repartition(n), "k", "line", 1000).orderBy("shard") for n in (3, 7))
    assert [r.rows for r in first.collect()] == [1000, 1000, 501]
    assert sinks.manifest_digest(first).first() == sinks.manifest_digest(second).first()
    row = spark.createDataFrame([(1, ("x", None), "é")], "b int, a struct<z:string,y:string>, c string")
    assert row.select(sinks.canonical_json(row, "b", "a", "c").alias("j")).first().j == '{"a":{"y":null,"z":"x"},"b":1,"c":"é"}'
    assert sinks.write_once(df, str(tmp_path / "w"), "d1") == sinks.write_once(df, str(tmp_path / "w"), "d1")
    with pytest.raises(ValueError):
        sinks.write_once(df.limit(3), str(tmp_path / "w"), "d1")
    raw = spark.createDataFrame([("ab12", 3, b"abc"), ("ab12", 3, b"abc")], "sha256 string, size int, content binary")
    sinks.write_raw(raw, str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 1
