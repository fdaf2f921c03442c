"""Settings, registry tables by version, the compile service, recognition confidence and outcome weights."""

import pytest
from pyspark.sql import functions as F

from quillspark.functions import text as t
from quillspark.operators import service, training
from quillspark.settings import Settings


def test_settings():
    assert Settings.from_env(env={}) == Settings()
    got = Settings.from_env(env={"QUILLSPARK_POLL_SECONDS": "5", "QUILLSPARK_RIGHTS_ATTESTED": " Yes ", "QUILLSPARK_STATE": "/x", "OTHER": "1"})
    assert (got.poll_seconds, got.rights_attested, got.state) == (5, True, "/x")
    for name, value, says in (("POLL_SECONDS", "x", "integer"), ("LEASE_SECONDS", "0", "positive"), ("AUTO_PROPOSE_RUN", "maybe", "true or false")):
        with pytest.raises(ValueError, match=says):
            Settings.from_env(env={f"QUILLSPARK_{name}": value})


def test_bootstrap(spark, tmp_path):
    root = str(tmp_path / "state")
    assert service.version(spark, root) == 0
    assert service.bootstrap(spark, root) == service.CURRENT_VERSION
    spark.createDataFrame([("r", "s", "{}", None)], service.VERSIONS[2]["records"]).write.mode("append").parquet(f"{root}/records")
    assert service.bootstrap(spark, root) == service.version(spark, root) == service.CURRENT_VERSION
    assert spark.read.parquet(f"{root}/records").count() == 1
    spark.createDataFrame([(service.CURRENT_VERSION + 1,)], "version int").write.mode("append").parquet(f"{root}/schema_meta")
    with pytest.raises(RuntimeError, match="newer"):
        service.bootstrap(spark, root)


def test_bootstrap_from_the_first_version(spark, tmp_path):
    root = str(tmp_path / "state")
    spark.createDataFrame([(1,)], "version int").write.parquet(f"{root}/schema_meta")
    service.bootstrap(spark, root)
    assert spark.read.parquet(f"{root}/compile_errors").columns == ["report_id", "error", "at"]
    assert service.version(spark, root) == 2


def test_compile_pending(spark):
    pending = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", "x" * 3000), (4, "d", None), (5, "e", None)], "k int, text string, problem string")
    saved = spark.createDataFrame([(2, "B"), (4, "old")], "k int, record_sha256 string")
    make = lambda d: d.where("k <> 5").select("k", F.upper("text").alias("record_sha256"))
    out = service.compile_pending(pending, saved, make, "k")
    assert sorted(r.k for r in out.records.collect()) == [1, 4]
    assert {r.k: len(r.error) for r in out.errors.collect()} == {3: 2000, 5: len("no record was made")}
    assert tuple(out.summary.first()) == (5, 2, 1, 2)
    assert tuple(service.compile_pending(pending, saved, make, "k", 2).summary.first()) == (2, 1, 1, 0)
    assert tuple(service.compile_pending(pending.limit(0), saved, make, "k").summary.first()) == (0, 0, 0, 0)


def test_mean_confidence(spark):
    rows = spark.createDataFrame([([(0.5,), (None,), (0.25,)],), ([(None,)],), ([],), (None,)], "words array<struct<confidence:double>>")
    assert [r[0] for r in rows.select(t.mean_confidence(F.col("words"))).collect()] == [0.375, None, None, None]


def test_outcome_weights(spark):
    examples = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, text string")
    outcomes = spark.createDataFrame([(1, 10), (2, None)], "k int, views int")
    got = training.outcome_weights(examples, outcomes, "k", F.col("views") / 4)
    assert got.columns == ["k", "text", "sampling_weight"]
    assert {r.k: r.sampling_weight for r in got.collect()} == {1: 2.5, 2: 1.0, 3: 1.0}
