"""Embedding near-dedup by sorted projection passes.

Each pass concatenates random hash bits (of directions with their mean taken off) into a key, orders all
vectors by it and compares every vector with a bounded window of the ones after it. Verified pairs of all
passes are united. Passes run in rounds: as many as the number of vectors asks for, then on until a round
joins next to nothing. Since a window cannot reach all of a large group, the links inside every component
are then counted exactly, in cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import Scratch, connected_components, on_groups
from quillspark.llm.kernels import UnionFind
from quillspark.llm.vectors import matrix, packed

#: Rows of a block of the sorted order, besides the window that it borrows from the next one.
BLOCK = 8192
#: Vectors in one cell of a component.
CELL = 2048
KEY_BITS = 60


def passes_needed(n: int, threshold: float, window: int, recall: float) -> int:
    """Passes after which a pair at the threshold, among n spread vectors, has come into some window with probability recall.

    A window holds the vectors that share the first log2(n / window) bits; a bit agrees with probability 1 - angle / pi.
    """
    bits = min(max(np.log2(max(n, 1) / window), 0), KEY_BITS)
    met = (1 - np.arccos(np.clip(threshold, 0, 1)) / np.pi) ** bits
    return 1 if met >= 1 else int(np.ceil(np.log(1 - recall) / np.log1p(-met)))


def _sums(batches):
    """(d, n, total): the number and the sum of the directions of each length."""
    held: dict[int, list] = {}
    for b in batches:
        dims = b.column(0).to_numpy(zero_copy_only=False)
        for d in np.unique(dims):
            y = unit(matrix(b.column(1).take(pa.array(np.flatnonzero(dims == d))), int(d)))
            n, total = held.get(int(d), (0, 0))
            held[int(d)] = n + len(y), total + y.sum(0)
    for d, (n, total) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["d", "n", "total"])


def _summed(key, table):
    total = sum(np.frombuffer(x) for x in table.column("total").to_pylist())
    return pa.table({"d": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()), "total": pa.array([total.tobytes()], pa.binary())})


def _keys(batches, passes: int, seed: list[int], means: dict[int, np.ndarray]):
    """A row for each vector and pass, with the pass's key."""
    planes: dict[int, np.ndarray] = {}
    weights = np.int64(1) << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64)
    for b in batches:
        dims = b.column(1).to_numpy(zero_copy_only=False)
        for d in np.unique(dims):
            own = np.flatnonzero(dims == d)
            part = b.take(pa.array(own))
            x = (unit(matrix(part.column(2), int(d))) - means[int(d)]).astype(np.float32)
            if d not in planes:
                planes[d] = np.random.default_rng([*seed, int(d)]).standard_normal((passes, int(d), KEY_BITS), np.float32)
            for p in range(passes):
                key = ((x @ planes[d][p]) > 0) @ weights
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(np.full(len(own), p, np.int32)), pa.array(key), part.column(0), part.column(2)], ["d", "pass", "key", "id", "v"])


def _numbered(batches):
    """Rows of a sorted partition with the partition's number and their place in it."""
    part, at = TaskContext.get().partitionId(), 0
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(np.arange(at, at + b.num_rows))], ["d", "pass", "key", "id", "v", "part", "place"])
        at += b.num_rows


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _window_links(key, table, threshold: float, window: int):
    """Spanning links of the pairs that a block's windows verify."""
    table = table.sort_by("rank")
    dims, passes, ids = (table.column(c).to_numpy() for c in ("d", "pass", "id"))
    core = int((table.column("rank").to_numpy() // BLOCK == key[0].as_py()).sum())
    links = []
    for d in np.unique(dims):
        own = np.flatnonzero(dims == d)
        y = unit(matrix(table.column("v").combine_chunks().take(pa.array(own)), int(d)))
        p, who = passes[own], ids[own]
        inside = int((own < core).sum())
        groups = UnionFind(len(own))
        for step in range(1, min(window, len(own) - 1) + 1):
            m = min(inside, len(own) - step)
            near = np.flatnonzero((np.einsum("ij,ij->i", y[:m], y[step : step + m]) >= threshold) & (p[:m] == p[step : step + m]))
            for i in near.tolist():
                if groups.join(i, i + step):
                    links.append((int(who[i]), int(who[i + step])))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})


def _count_links(key, table, threshold: float):
    """(id, links) of the vectors of a bin of small components, or of one cell of a large one."""
    table = table.sort_by([("component", "ascending"), ("side", "ascending"), ("id", "ascending")])
    component, side, ids, copies, dims = (table.column(c).to_numpy() for c in ("component", "side", "id", "copies", "d"))
    v = table.column("v").combine_chunks()
    out = np.zeros(len(ids), np.int64)
    cuts = np.flatnonzero(np.diff(component)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
        y = unit(matrix(v.slice(lo, hi - lo), int(dims[lo])))
        k = int((side[lo:hi] == 0).sum())
        if key[1].as_py() == key[2].as_py():
            near = y @ y.T >= threshold
            np.fill_diagonal(near, False)
            out[lo:hi] = near @ copies[lo:hi]
        else:
            near = y[:k] @ y[k:].T >= threshold
            out[lo : lo + k], out[lo + k : hi] = near @ copies[lo + k : hi], near.T @ copies[lo : lo + k]
    return pa.table({"id": pa.array(ids), "links": pa.array(out)})


def _round(nodes: DataFrame, scratch: Scratch, parts: int, passes: int, seed: list[int], means: dict[int, np.ndarray], threshold: float, window: int) -> DataFrame:
    """Spanning links (a, b) of the pairs that the windows of some passes verify."""
    ordered = nodes.select("id", "d", "v").mapInArrow(lambda b: _keys(b, passes, seed, means), "d int, pass int, key long, id long, v binary")
    ordered = ordered.repartitionByRange(parts, "d", "pass", "key", "id").sortWithinPartitions("d", "pass", "key", "id")
    ordered = scratch.save(ordered.mapInArrow(_numbered, "d int, pass int, key long, id long, v binary, part int, place long"))
    counts = {r.part: r["count"] for r in ordered.groupBy("part").count().collect()}  # one row for each partition
    starts = F.lit(np.cumsum([0, *(counts.get(k, 0) for k in range(max(counts, default=0)))]).tolist())
    ranked = ordered.withColumn("rank", F.element_at(starts, F.col("part") + 1) + F.col("place"))
    block = F.floor(F.col("rank") / BLOCK)
    ranked = ranked.withColumn("block", F.explode(F.when((F.col("rank") % BLOCK < window) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))))
    pairs = ranked.select("block", "rank", "d", "pass", "id", "v").groupBy("block").applyInArrow(on_groups(_window_links, threshold=threshold, window=window), "a long, b long")
    links = scratch.save(pairs)
    scratch.drop(ordered)
    return links


def embedding_near_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9, passes: int = 24, window: int = 32, seed: int = 11, recall: float = 0.999) -> DataFrame:
    """Link vectors of cosine threshold or more and group them.

    Returns a row for each vector: the id column, n_links (other vectors linked directly), component_id
    (smallest id that links reach, its own included) and kept (whether its id is that). Vectors that are
    null, empty, zero or hold null or non-finite components, and vectors of different lengths, link with
    nothing. Rounds of so many passes run until a pair at the threshold would be found with probability
    recall if vectors were spread, and on until a round's joins are at most 1 - recall of all. Equal
    vectors are collapsed before the passes and counted as links, those of rows that repeat an id too.
    Ids are cast to long; a row with a null id links like others, but is kept only where no row of its
    component has an id (its component_id is null then). An empty table gives an empty result; other columns
    are ignored.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vector-dedup")
    held = scratch.save(packed(vectors, id_col, vec_col, null_ids=True).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(7), "v")))
    nodes = scratch.save(held.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("d").alias("d"), F.first("v").alias("v")).withColumn("id", F.col("h1")))
    n = nodes.count()
    parts = max(spark.sparkContext.defaultParallelism, -(-n * passes // 200_000))
    sums = nodes.select("d", "v").mapInArrow(_sums, "d int, n long, total binary").groupBy("d").applyInArrow(_summed, "d int, n long, total binary")
    means = {r.d: np.frombuffer(bytes(r.total)) / r.n for r in sums.collect()}  # one row for each length
    need, done, joined, groups = passes_needed(n, threshold, window, recall), 0, 0, None
    while True:
        found = _round(nodes, scratch, parts, passes, [seed, done], means, threshold, window)
        links = found if groups is None else found.union(groups.select("node", "component"))
        after = scratch.save(connected_components(links, scratch))
        scratch.drop(found, *([] if groups is None else [groups]))
        groups = after
        r = groups.agg(F.count(F.lit(1)).alias("nodes"), F.count_distinct("component").alias("components")).first()
        before, joined, done = joined, r.nodes - r.components, done + passes
        if done >= need and joined - before <= (1 - recall) * joined:
            break
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size")).withColumn("cells", F.ceil(F.col("size") / CELL).cast("int"))
    placed = groups.join(sizes, "component").join(nodes.select("id", "copies", "d", "v"), F.col("node") == F.col("id")).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))
    bins = max(1, -(-groups.count() // CELL))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    cells = other.select(F.when(F.col("cells") == 1, F.pmod(F.xxhash64("component"), F.lit(bins))).otherwise(F.col("component")).alias("bin"), F.when(F.col("cells") == 1, -1).otherwise(F.least("chunk", "other")).alias("i"), F.when(F.col("cells") == 1, -1).otherwise(F.greatest("chunk", "other")).alias("j"), (F.col("chunk") > F.col("other")).cast("int").alias("side"), "component", "id", "copies", "d", "v")
    counted = cells.groupBy("bin", "i", "j").applyInArrow(on_groups(_count_links, threshold=threshold), "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))
    named = nodes.select("h1", "h2", "copies", "first").join(groups.select(F.col("node").alias("h1"), "component"), "h1", "left").join(counted.withColumnRenamed("id", "h1"), "h1", "left")
    lowest = named.where("component is not null").groupBy("component").agg(F.min("first").alias("lowest"))
    named = named.join(lowest, "component", "left").select("h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n"), F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("lowest")).alias("c"))
    found = held.select("id", "h1", "h2").join(named, ["h1", "h2"]).select("id", "n", "c")
    odd = packed(vectors, id_col, vec_col, null_ids=True, odd=True).select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("c"))
    out = scratch.save(found.union(odd).select(F.col("id").alias(id_col), F.col("n").alias("n_links"), F.col("c").alias("component_id"), F.col("id").eqNullSafe(F.col("c")).alias("kept")))
    scratch.drop(held, nodes, groups)
    return out
