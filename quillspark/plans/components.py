"""Connected components and materialised steps for iterative plans."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def materialised(df: DataFrame) -> DataFrame:
    """df written to the folder that all machines share (spark.checkpoint.dir) and read back, which cuts its lineage.

    A local session without that setting gets a temporary folder; a cluster without it is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quillspark-"))
        folder = sc.getCheckpointDir()
    path = f"{folder.rstrip('/')}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_forest(batches, kind: pa.DataType):
    """Spanning links (node, smallest node) of the links that one task has; the memory is that of its nodes."""
    parent: dict = {}

    def root(x):
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            parent.setdefault(x, x)
            parent.setdefault(y, y)
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if root(x) != x]
    for at in range(0, len(nodes), 50_000):
        part = nodes[at : at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([root(x) for x in part], kind)], ["a", "b"])


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each of nodes (node) reaches over edges (a, b); numbers or strings.

    Every task first replaces its own links by spanning trees; then stars are contracted around smaller and
    smaller nodes until nothing changes.
    """
    kind = edges.schema["a"].dataType
    arrow = pa.string() if kind.simpleString() == "string" else pa.int64()
    to = "string" if kind.simpleString() == "string" else "long"
    links = edges.select(F.col("a").cast(to).alias("a"), F.col("b").cast(to).alias("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, mark = materialised(links.mapInArrow(lambda b: local_forest(b, arrow), f"a {to}, b {to}")), None
    while True:
        both = now.union(now.select("b", "a"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, both.a == low.u).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low, large.a == low.u).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b")
        now = materialised(small.union(low.select("u", "m")).distinct())
        r = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == (r.n, r.h):
            break
        mark = (r.n, r.h)
    found = now.groupBy(F.col("a").alias("_n")).agg(F.min("b").alias("_c"))
    return nodes.select("node").distinct().join(found, F.col("node").cast(to) == F.col("_n"), "left").select("node", F.coalesce(F.col("_c").cast(nodes.schema["node"].dataType), F.col("node")).alias("component"))
