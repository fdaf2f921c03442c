"""What the operators share: tables in the shared folder, id filters, ranks and connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.plans.components import local_forest


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    A local session without one gets a temporary folder; a cluster without one is an error,
    because a machine-local folder would be invisible to the other machines.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quillspark-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


class Scratch:
    """Parquet tables under the shared folder: they cut lineage and outlive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.made = 0
        atexit.register(self.drop_all)

    def save(self, df: DataFrame) -> DataFrame:
        """Write df and return it read back; its path is in the attribute scratch_path."""
        self.made += 1
        path = f"{self.base}/{self.made:03d}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing will read any more."""
        for df in tables:
            self._delete(df.scratch_path)

    def drop_all(self) -> None:
        try:
            self._delete(self.base)
        except Exception:  # the session may have ended already
            pass

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of df has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for x in names:
        while x.lower() in taken:
            x = "_" + x
        taken.add(x.lower())
        out.append(x)
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def on_groups(f, **fixed):
    """f(key, table, **fixed) as a function without annotations, as applyInArrow wants it."""
    return lambda key, table: f(key, table, **fixed)


class IdFilter:
    """A Bloom filter over long ids, of at most 2**max_log2 bits whatever the number of ids.

    It never rejects an id that was put in, so it only saves work: an exact join follows.
    """

    HASHES = 4

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, ids: DataFrame, column: str, max_log2: int = 24) -> "IdFilter":
        """Built by tasks as partial bit sets, which are merged block by block."""
        n = ids.count()
        log2 = int(min(max_log2, max(13, np.ceil(np.log2(10 * max(n, 1))))))
        width = 1 << (log2 - 3)
        block = min(width, 1 << 16)

        def partial(batches):
            bits = np.zeros(width, np.uint8)
            for b in batches:
                _bloom_put(bits, b.column(0).to_numpy(zero_copy_only=False))
            for k in range(width // block):
                part = bits[k * block : (k + 1) * block]
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([_pack(part)], pa.binary())], ["block", "bits"])

        def merge(key, table):
            out = np.zeros(block, np.uint8)
            for x in table.column("bits").to_pylist():
                out |= _unpack(x, np.uint8)
            return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([_pack(out)], pa.binary())})

        found = ids.select(F.col(column).cast("long")).where(F.col(column).isNotNull()).mapInArrow(partial, "block int, bits binary")
        rows = found.groupBy("block").applyInArrow(merge, "block int, bits binary").collect()
        bits = np.zeros(width, np.uint8)
        for r in rows:
            bits[r.block * block : (r.block + 1) * block] = _unpack(bytes(r.bits), np.uint8)
        return cls(bits)

    def hit(self, ids: np.ndarray) -> np.ndarray:
        ok = np.ones(len(ids), bool)
        for at in _bloom_places(ids, len(self.bits) * 8, self.HASHES):
            ok &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return ok


def _bloom_places(ids: np.ndarray, n_bits: int, hashes: int):
    h = mix64(ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    step = mix64(h) | np.uint64(1)
    for k in range(hashes):
        yield (h + np.uint64(k) * step) & np.uint64(n_bits - 1)


def _bloom_put(bits: np.ndarray, ids: np.ndarray) -> None:
    for at in _bloom_places(ids, len(bits) * 8, IdFilter.HASHES):
        np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8)))


def _pack(x: np.ndarray) -> bytes:
    return pa.compress(x.tobytes(), codec="zstd", asbytes=True) + len(x.tobytes()).to_bytes(8, "little")


def _unpack(x: bytes, dtype) -> np.ndarray:
    x = bytes(x)
    return np.frombuffer(pa.decompress(x[:-8], decompressed_size=int.from_bytes(x[-8:], "little"), codec="zstd", asbytes=True), dtype)


def _sum_group(key, table, dtype):
    total = None
    for x in table.column("values"):
        part = _unpack(x.as_py(), dtype)
        total = part.copy() if total is None else total + part
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "values": pa.array([_pack(total)], pa.binary())})


def sum_arrays(parts: DataFrame, dtype, length: int) -> np.ndarray:
    """The sum of the tasks' packed arrays (block int, values binary), added up in two steps.

    The blocks, of one size, make up an array of the given length; the driver gets one row for each block.
    """
    total = np.zeros(length, dtype)
    some = parts.groupBy("block", (F.spark_partition_id() % 64).alias("salt")).applyInArrow(on_groups(_sum_group, dtype=dtype), "block int, values binary")
    for r in some.groupBy("block").applyInArrow(on_groups(_sum_group, dtype=dtype), "block int, values binary").toLocalIterator():
        part = _unpack(bytes(r["values"]), dtype)
        total[r.block * len(part) : (r.block + 1) * len(part)] += part
    return total


def salted_rank(df: DataFrame, keys: list[str], order: list, salt_by: list[str], rows_per_salt: int = 50_000, name: str = "rank") -> DataFrame:
    """Add a rank from 0 within each key without bringing a hot key into one task.

    Rows of a key are dealt to salts by a hash of salt_by; ranks inside a salt come from a window,
    and the salts' counts, one row for each key and salt, give the offsets.
    """
    n = df.count()
    salts = max(1, -(-n // rows_per_salt))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)))
    counts = salted.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    local = salted.withColumn("_local", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)) - 1)
    same = [local[k].eqNullSafe(offsets[k]) for k in [*keys, "_salt"]]
    on = same[0]
    for x in same[1:]:
        on = on & x
    joined = local.join(offsets.select(*[F.col(k) for k in [*keys, "_salt"]], "_before"), on, "inner")
    return joined.select(*[local[c] for c in df.columns], (F.col("_local") + F.col("_before")).cast("long").alias(name))


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Nodes of edges (a long, b long) with the smallest node that they reach: (node, component).

    Alternating large-star and small-star steps over DataFrames, after each task has replaced its own
    links by spanning trees. Every node that has an edge gets a row; loops count as no edge.
    """
    now = scratch.save(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().mapInArrow(lambda b: local_forest(b, pa.int64()), "a long, b long"))
    mark = None
    while True:  # every round but the last replaces links by ones to smaller nodes
        both = now.union(now.select("b", "a"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, both.a == low.u).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low, large.a == low.u).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b")
        after = scratch.save(small.union(low.select("u", "m")).distinct())
        r = after.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"), F.count_distinct("a").alias("d")).first()
        scratch.drop(now)
        now = after
        if mark == (r.n, r.h):
            break
        mark = (r.n, r.h)
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


class Joined:
    """Disjoint sets over rows that start out in groups."""

    def __init__(self, group: np.ndarray):
        names, at = np.unique(group, return_inverse=True)
        self.at, self.parent = at.tolist(), list(range(len(names)))

    def root(self, row: int) -> int:
        x, parent = self.at[row], self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, i: int, j: int) -> None:
        x, y = self.root(i), self.root(j)
        self.parent[max(x, y)] = min(x, y)


def _block_cells(key, table, link, payload: list[str]):
    """(a, b) of the links that link() finds in a cell; of a chunk of a large block also (node, its smallest joined node), marked in place."""
    table = table.sort_by([("block", "ascending"), ("side", "ascending"), ("node", "ascending")])
    block, node, side, group = (table.column(c).to_numpy() for c in ("block", "node", "side", "joined"))
    joined = Joined(group)
    pairs = link(block, table.select(payload), joined, side)
    a, b = (np.array([node[p[k]] for p in pairs], np.int64) for k in (0, 1))
    at = np.full(len(a), -1, np.int32)
    if len(key) == 2 and key[1].as_py() >= 0 and len(node):
        root = np.array([joined.root(i) for i in range(len(node))])
        order = np.lexsort((node, root))
        first = order[np.searchsorted(root[order], np.arange(root.max() + 1))]
        a, b, at = np.concatenate([a, node]), np.concatenate([b, node[first[root]]]), np.concatenate([at, np.full(len(node), key[1].as_py(), np.int32)])
    return pa.table({"a": pa.array(a), "b": pa.array(b), "at": pa.array(at), "block": pa.array(np.full(len(a), block[0] if len(block) else 0))})


def _hub_groups(key, table):
    """(block, at, root, main) of the groups of a large block's chunks that hold hubs: main names those that hubs join, the commonest 0."""
    node, at, root = (table.column(c).to_pylist() for c in ("node", "at", "root"))
    joined = Joined(np.array(node))
    seen: dict[tuple[int, int], int] = {}
    for i, x in enumerate(zip(at, root)):
        joined.join(i, seen.setdefault(x, i))
    first = list(seen.values())
    names = [joined.root(i) for i in first]
    common = max(set(names), key=lambda x: (names.count(x), -x))
    return pa.table({"block": pa.array([key[0].as_py()] * len(first), pa.int64()), "at": pa.array([at[i] for i in first], pa.int32()), "root": pa.array([root[i] for i in first], pa.int64()), "main": pa.array([int(x != common) * (x + 1) for x in names], pa.int64())})


def linked_in_blocks(placed: DataFrame, scratch: Scratch, link, cell: int, hubs: int = 8) -> DataFrame:
    """(a, b): links that join whatever link() joins inside the blocks of placed (block long, node long, payload).

    link(block, payload table, joined, side) gets rows in order of their blocks, joins what it links in joined and
    gives positions of linked pairs, all of one block; it may leave out pairs that are joined already, and where there
    are two sides it compares across them only. A block of more than cell members is dealt to chunks, each with the
    block's few hubs; then only members outside the block's main group, the one that hubs join most of, meet the other
    chunks. So no task holds a large block, and one whose members the hubs join costs no more than its chunks. All
    pairs of a block are covered.
    """
    payload = [c for c in placed.columns if c not in ("block", "node")]
    schema = "a long, b long, at int, block long"
    sizes = scratch.save(placed.groupBy("block").agg(F.count(F.lit(1)).alias("size")))
    r = sizes.agg(F.max("size").alias("most"), F.sum("size").alias("all")).first()
    bins = F.lit(max(1, -(-(r["all"] or 0) // cell)))
    some = (r.most or 0) > cell
    if some:
        large = sizes.where(F.col("size") > cell).withColumn("chunks", F.ceil(F.col("size") / cell).cast("int"))
        known = placed.join(large, "block", "left").withColumn("chunk", F.when(F.col("chunks").isNull(), -1).otherwise(F.pmod(F.xxhash64("node"), F.col("chunks"))).cast("int"))
        hub = F.col("chunks").isNotNull() & (F.pmod(F.xxhash64(F.lit(1), "node"), F.col("size")) < hubs)
        dealt = known.withColumn("at", F.explode(F.when(hub, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("chunk"))))
    else:
        dealt = placed.withColumn("at", F.lit(-1))
    bin_ = F.when(F.col("at") < 0, F.pmod(F.xxhash64("block"), bins)).otherwise(F.col("block"))
    cells = dealt.select(bin_.alias("bin"), "at", "block", "node", F.lit(0).alias("side"), F.col("node").alias("joined"), *payload)
    found = scratch.save(cells.groupBy("bin", "at").applyInArrow(on_groups(_block_cells, link=link, payload=payload), schema))
    links = found.where("at < 0").select("a", "b")
    if not some:
        return links
    own = found.where("at >= 0").select("block", "at", F.col("a").alias("node"), F.col("b").alias("root"))
    marked = own.join(large, "block").withColumn("hub", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("size")) < hubs).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    main = marked.where("hub").select("block", "at", "root", "node").groupBy("block").applyInArrow(_hub_groups, "block long, at int, root long, main long")  # hubs times chunks rows a block
    odd = scratch.save(marked.where("chunk = at").join(main, ["block", "at", "root"], "left").where("main is null or main <> 0").select("block", "node", "chunk", "chunks", "root"))
    counts = scratch.save(odd.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("odd_chunks")))
    if counts.isEmpty():
        return links
    left = known.where("chunk >= 0").select("block", "node", "chunk", *payload).join(counts, "block")
    ours = left.select("block", F.col("chunk").alias("at"), F.explode(F.sequence(F.lit(0), F.col("odd_chunks") - 1)).alias("odd_at"), "node", F.lit(0).alias("side"), F.col("node").alias("joined"), *payload)
    theirs = left.join(odd.select("block", "node", "chunks"), ["block", "node"]).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where("at <> chunk")
    theirs = theirs.select("block", "at", F.pmod(F.xxhash64(F.lit(2), "node"), F.col("odd_chunks")).cast("int").alias("odd_at"), "node", F.lit(1).alias("side"), F.col("node").alias("joined"), *payload)
    more = ours.union(theirs).groupBy("block", "at", "odd_at").applyInArrow(on_groups(_block_cells, link=link, payload=payload), schema)
    return scratch.save(links.union(more.select("a", "b")))
