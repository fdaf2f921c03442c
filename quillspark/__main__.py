"""Command line: python -m quillspark <command>; every command reads and writes tables by path and prints JSON."""

from __future__ import annotations

import argparse
import json
import sys


def _print(rows) -> None:
    for r in rows:
        print(json.dumps(r.asDict(True) if hasattr(r, "asDict") else r, default=str, ensure_ascii=False))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("quillspark", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, about: str, *options: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=about)
        for o in options:
            c.add_argument(f"--{o}", required=True)
        return c

    add("sync", "ingest the files of a folder once", "source", "out")
    add("watch", "ingest a folder again and again", "source", "out").add_argument("--every", default="60 seconds")
    add("validate", "say what is wrong with each report of a folder", "source")
    add("suitability", "tiers by objective of a documents table", "documents")
    add("gaps", "what a documents table lacks, and what to do", "documents")
    add("compile", "write script records of a documents table", "documents", "out")
    q = add("query", "search a documents table", "documents", "text")
    q.add_argument("--top-k", type=int, default=10)
    add("outcomes", "say what is wrong with each outcome of a table", "outcomes")
    d = add("dataset-build", "build training examples, manifests and gates", "documents", "out")
    d.add_argument("--per-source", type=int)
    d.add_argument("--per-cluster", type=int)
    add("dataset-inspect", "show one example of a built dataset", "dataset", "example-id")
    add("dataset-audit", "distributions of a built dataset", "dataset")
    g = add("gold-sample", "choose a diverse gold set", "documents", "out")
    g.add_argument("--count", type=int, default=100)
    add("gold-report", "field metrics of predictions against labels", "labels", "predictions")
    add("gold-agreement", "agreement of several reviewers", "annotations")
    e = add("estimate", "requests and tokens that inference over a corpus needs")
    e.add_argument("--records", type=int, required=True)
    e.add_argument("--average-words", type=int, required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import functions as F

    from quillspark.functions.hashing import hash_embedding
    from quillspark.operators import gold, outcomes, reconstruction, search, suitability, training
    from quillspark.plans import corpus
    from quillspark.session import local_session
    from quillspark.sources import reports
    from quillspark.streaming import ingest

    a = parser().parse_args(argv)
    if a.command == "estimate":
        _print([reconstruction.estimate(a.records, a.average_words)])
        return 0
    spark = local_session(f"quillspark {a.command}")
    read = spark.read.parquet
    if a.command in ("sync", "watch"):
        ingest.ingest(spark, a.source, a.out, a.command == "sync", getattr(a, "every", "60 seconds")).awaitTermination()
    elif a.command == "validate":
        _print(reports.validated(reports.parsed(reports.read_raw(spark, a.source))).select("path", "sha256", "problem").toLocalIterator())
    elif a.command == "suitability":
        _print(suitability.crosstab(corpus.assessed(read(a.documents))).collect())
    elif a.command == "gaps":
        rows = corpus.assessed(read(a.documents))
        found = suitability.gaps(suitability.report(rows), suitability.floor_percentiles(rows, "word_count"))
        _print([*found.collect(), suitability.recommendation(found).first()])
    elif a.command == "compile":
        corpus.records_of(read(a.documents)).write.mode("errorifexists").parquet(a.out)
    elif a.command == "query":
        rows = corpus.records_of(read(a.documents))
        devices = F.transform("retention_devices", lambda d: d["device"])
        records = rows.select(F.col("key").cast("string").alias("record_id"), "source_content_hash", F.col("clean_transcript").alias("text"), "hooks", devices.alias("devices"), F.array().cast("array<string>").alias("fingerprint"), hash_embedding(F.col("clean_transcript")).alias("vector"))
        _print(search.search(records, search.SearchQuery(text=a.text, top_k=a.top_k)).drop("vector").orderBy("place").collect())
    elif a.command == "outcomes":
        _print(outcomes.checked(read(a.outcomes)).where(F.size("problems") > 0).select("report_id", "problems").toLocalIterator())
    elif a.command == "dataset-build":
        made = corpus.training_dataset(read(a.documents), per_source=a.per_source, per_cluster=a.per_cluster)
        for name in ("examples", "selected", "rejected", "manifests", "gates"):
            getattr(made, name).write.mode("errorifexists").parquet(f"{a.out}/{name}")
        _print([training.readiness_status(made.gates).first()])
    elif a.command == "dataset-inspect":
        _print(read(f"{a.dataset}/examples").where(F.col("example_id") == a.example_id).collect())
    elif a.command == "dataset-audit":
        columns = {c: F.col(c) for c in ("objective", "split", "eligibility")} | {"words": training.bucketed(F.size(F.split("target", r"\s+")), (50, 100, 200), ("<50", "50-99", "100-199", "200+"))}
        counts = training.distributions(read(f"{a.dataset}/examples"), columns)
        _print([*counts.orderBy("dimension", "value").collect(), *training.imbalances(counts).collect()])
    elif a.command == "gold-sample":
        rows = corpus.records_of(read(a.documents)).withColumnRenamed("clean_transcript", "text")
        none = F.lit(None).cast("double")
        strata = gold.strata(none, F.col("spoken_word_count"), none, F.try_element_at("hooks", F.lit(1)), F.transform("beats", lambda _: F.lit("body")), none, F.col("word_count"), F.col("has_cta"))
        gold.gold_entries(gold.stratified_sample(rows.withColumn("strata", strata), a.count), "text").write.mode("errorifexists").parquet(a.out)
        _print([gold.selection_id(read(a.out)).first()])
    elif a.command == "gold-report":
        rows = gold.judged(read(a.labels), read(a.predictions))
        _print([*gold.field_metrics(rows).collect(), *gold.band_calibration(rows).collect(), gold.expected_calibration_error(gold.numeric_calibration(rows)).first()])
    elif a.command == "gold-agreement":
        _print(gold.agreement(read(a.annotations)).collect())
    return 0


if __name__ == "__main__":
    sys.exit(main())
