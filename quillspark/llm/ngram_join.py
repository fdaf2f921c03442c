"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

Documents become sets of word shingles. Equal sets collapse to one node. The shingles of a set are
ordered rare first by a frequency sketch over all documents; two sets of Jaccard similarity t or more
share at least one shingle in their prefixes, and the shared shingles that their prefixes must have
(the positional filter) grow with their sizes. A shingle that many prefixes have makes no pairs: sets that
have one are matched by parts instead. Sets that are similar enough differ in a bounded number of shingles, so of
some more parts, which hashes deal shingles to, some are equal; sets that have an equal part are candidates. Pairs that
pass are gathered into blocks of connected candidates; each set goes once into its block (or its cells, for a large block), where length and
suffix filters come before the exact comparison. Sets are exact hashes of shingles; a node is a set's hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import IdFilter, Scratch, _pack, _unpack, connected_components, linked_in_blocks, mix64, on_groups
from quillspark.llm.kernels import shingle_sets

SKETCH_WIDTH = 1 << 20
SKETCH_BLOCK = 1 << 16
#: Members of a prefix shingle's group up to which each pair is counted; members of larger groups are matched by parts.
PAIRED_GROUP = 12
#: Sets in one cell of a block.
CELL = 1500
#: Buckets of the suffix filter's histogram.
SUFFIX_BUCKETS = 64


def _sketch_places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(44)).astype(np.int64), ((h >> np.uint64(20)) & np.uint64(SKETCH_WIDTH - 1)).astype(np.int64)


def _signature(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a = mix64(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64) + np.uint64(len(s))
        b = np.bitwise_xor.reduce(mix64(s + np.uint64(0x632BE59BD9B4E019))) * np.uint64(3) + np.uint64(len(s))
    return int(mix64(np.array([a]))[0].astype(np.int64)), int(np.array([b]).astype(np.int64)[0])


def _describe(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows of documents (id, row, n, s1, s2), and at the end the task's sketch in blocks."""
    counts = np.zeros((2, SKETCH_WIDTH), np.uint32)
    names = ["id", "row", "n", "s1", "s2", "block", "counts"]
    kinds = [None, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    for b in batches:
        kinds[0] = b.column(0).type
        n = b.num_rows
        size, s1, s2 = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        held: list[np.ndarray] = []
        total = 0
        for row, s in shingle_sets(b.column(1), k):
            size[row] = len(s)
            if len(s):
                s1[row], s2[row] = _signature(s)
                held.append(s)
                total += len(s)
            if total > 200_000:
                _sketch_add(counts, held)
                held, total = [], 0
        _sketch_add(counts, held)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(size), pa.array(s1), pa.array(s2), pa.nulls(n, kinds[5]), pa.nulls(n, kinds[6])], names)
    for at in range(0, SKETCH_WIDTH if kinds[0] is not None else 0, SKETCH_BLOCK):
        part = counts[:, at : at + SKETCH_BLOCK]
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, x) for x in kinds[:5]] + [pa.array([at // SKETCH_BLOCK], kinds[5]), pa.array([_pack(part)], kinds[6])], names)


def _sketch_add(counts: np.ndarray, sets: list[np.ndarray]) -> None:
    if sets:
        for k, at in enumerate(_sketch_places(np.concatenate(sets))):
            np.add.at(counts[k], at, 1)


def _sketch_sum(key, table: pa.Table) -> pa.Table:
    total = np.zeros(2 * SKETCH_BLOCK, np.uint32)
    for x in table.column("counts"):
        total += _unpack(x.as_py(), np.uint32)
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([_pack(total)], pa.binary())})


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Shared shingles that sets of n and m need for 100 * intersection >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n, percent: int):
    return n - -(-percent * n // 100) + 1


def _prefixes(batches: Iterator[pa.RecordBatch], k: int, percent: int, counts) -> Iterator[pa.RecordBatch]:
    """(token, node, n) for the rare-first prefix of each distinct set that the task has."""
    sketch = counts.value
    seen: set[int] = set()
    for b in batches:
        tokens, nodes, sizes = [], [], []
        for _, s in shingle_sets(b.column(0), k):
            if not len(s):
                continue
            node = _signature(s)[0]
            if node in seen:
                continue
            seen.add(node)
            n = len(s)
            p = prefix_length(n, percent)
            x, y = _sketch_places(s)
            often = np.minimum(sketch[0][x], sketch[1][y])
            if p < n:
                edge = np.partition(often, p - 1)[p - 1]
                s, often = s[often <= edge], often[often <= edge]
            take = s[np.lexsort((s, often))[:p]]
            tokens.append(take)
            nodes.append(np.full(len(take), node, np.int64))
            sizes.append(np.full(len(take), n, np.int32))
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sizes))], ["token", "node", "n"])


def _groups(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a, b, shared, na, nb) from rows sorted by token and node; a < b.

    Each pair of a small group counts one shared shingle. Of a larger group each member (a) is named, b is null.
    """

    def small(t: np.ndarray, node: np.ndarray, n: np.ndarray, size: np.ndarray):
        """All pairs of groups: row i with the rows 1, 2, ... after it in its group."""
        out = []
        for d in range(1, PAIRED_GROUP):
            i = np.flatnonzero((t[:-d] == t[d:]) & (size[:-d] <= PAIRED_GROUP)) if len(t) > d else np.zeros(0, np.int64)
            if not len(i):
                break
            na, nb = n[i].astype(np.int64), n[i + d].astype(np.int64)
            ok = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
            i, na, nb = i[ok], na[ok], nb[ok]
            out.append((node[i], node[i + d], np.ones(len(i), np.int32), na, nb))
        return out

    def crowd(node: np.ndarray, n: np.ndarray):
        node, own = np.unique(node, return_index=True)
        zero = np.zeros(len(node), np.int64)
        return node, zero, zero.astype(np.int32), n[own].astype(np.int64), zero

    def emit(t, node, n, more):
        first = np.concatenate(([True], t[1:] != t[:-1])) if len(t) else np.zeros(0, bool)
        group = np.cumsum(first) - 1
        size = np.bincount(group)[group] if len(t) else group
        found = small(t, node, n, size)
        big = size > PAIRED_GROUP
        if big.any():
            found.append(crowd(node[big], n[big]))
        if more is not None and len(more[0]):
            found.append(more)
        if not found:
            return None
        a, b, c, na, nb = (np.concatenate(x) for x in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=c == 0), pa.array(c), pa.array(na.astype(np.int32)), pa.array(nb.astype(np.int32))], ["a", "b", "shared", "na", "nb"])

    held: list[np.ndarray] | None = None
    large: int | None = None  # the token of a large group that may go on

    for b in batches:
        now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        t, node, n = now
        if not len(t):
            continue
        fresh = np.ones(len(t), bool)
        fresh[1:] = (t[1:] != t[:-1]) | (node[1:] != node[:-1])
        t, node, n = t[fresh], node[fresh], n[fresh]
        more = held = None
        if large is not None:
            k = int((t == large).sum())
            more = crowd(node[:k], n[:k])
            t, node, n = t[k:], node[k:], n[k:]
        tail = int(np.searchsorted(t, t[-1], "left")) if len(t) else 0  # the last group may go on
        if len(t) - tail > PAIRED_GROUP:
            large, tail = int(t[tail]), len(t)
        elif len(t):
            large, held = None, [t[tail:], node[tail:], n[tail:]]
        x = emit(t[:tail], node[:tail], n[:tail], more)
        if x is not None:
            yield x
    if held is not None and len(held[0]):
        x = emit(*held, None)
        if x is not None:
            yield x


def size_classes(percent: int) -> list[tuple[int, int, int]]:
    """(smallest size, parts, spare parts) of classes of sizes: of two sets that may link, the larger is in the smaller's class or the next.

    Linked sets of which the smaller is in the class differ in fewer shingles than there are parts that aren't spare, so
    more parts than the spare ones are equal. There are about as many spare parts as may be empty; none at all where
    only equal sets link.
    """
    out, least = [], 1
    while least < 1 << 40:
        after = 100 * least // percent + 1
        differ = (100 - percent) * (after - 1 + 100 * (after - 1) // percent) // (100 + percent)
        spare = 1
        for _ in range(20):
            parts = differ + 1 + spare
            empty = parts * np.exp(-least / parts)
            spare = max(1, min(differ + 1, int(np.ceil(empty + 3 * empty**0.5))))
        out.append((least, differ + 1 + spare if differ else 0, spare))
        least = after
    return out


def part_keys(s: np.ndarray, percent: int, classes: list[tuple[int, int, int]]) -> np.ndarray:
    """Keys of a set's parts under its class and the one below; sets that link have one in common.

    Empty parts have no key unless a set has more of them than are spare: then all equal parts might be empty.
    """
    at = int(np.searchsorted([c[0] for c in classes], len(s), "right")) - 1
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(s ^ np.uint64(0x3C6EF372FE94F82B)), dtype=np.uint64)])
    out = []
    for c in (at - 1, at) if at else (at,):
        least, parts, spare = classes[c]
        if not parts or c < at and percent * len(s) > 100 * (classes[at][0] - 1):
            continue  # too large for the class below
        edges = np.searchsorted((s >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))
        key = mix64(total[edges[1:]] - total[edges[:-1]] + mix64(np.arange(parts, dtype=np.uint64) + np.uint64((c + 1) << 40)))
        full = edges[1:] > edges[:-1]
        out.append(key[full] if parts - int(full.sum()) <= spare else key)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _parts(batches: Iterator[pa.RecordBatch], k: int, percent: int, wanted) -> Iterator[pa.RecordBatch]:
    """(key, node) of the parts of each distinct set that the filter lets through."""
    classes = size_classes(percent)
    seen: set[int] = set()
    for b in batches:
        keys, nodes = [], []
        for _, s in shingle_sets(b.column(0), k):
            if not len(s):
                continue
            node = _signature(s)[0]
            if node in seen or not wanted.value.hit(np.array([node]))[0]:
                continue
            seen.add(node)
            keys.append(part_keys(s, percent, classes))
            nodes.append(np.full(len(keys[-1]), node, np.int64))
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))], ["key", "node"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of all nodes of a key to its first, from rows sorted by key and node."""
    key, head = None, None
    for b in batches:
        t, node = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        if not len(t):
            continue
        first = np.concatenate(([key is None or t[0] != key], t[1:] != t[:-1]))
        heads = np.concatenate(([0 if head is None else head], node[first]))[np.cumsum(first)]
        key, head = t[-1], heads[-1]
        own = heads != node
        if own.any():
            yield pa.RecordBatch.from_arrays([pa.array(heads[own]), pa.array(node[own])], ["a", "b"])


def _sets_of(batches: Iterator[pa.RecordBatch], k: int, wanted) -> Iterator[pa.RecordBatch]:
    """(row, set) of the rows that the filter lets through."""
    for b in batches:
        rows = b.column(0).to_numpy(zero_copy_only=False)
        own = np.flatnonzero(wanted.value.hit(rows))
        if not len(own):
            continue
        out, sets, held = [], [], 0
        for at, s in shingle_sets(b.column(1).take(pa.array(own)), k):
            out.append(int(rows[own[at]]))
            sets.append(s.tobytes())
            held += len(sets[-1])
            if held > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(sets, pa.binary())], ["row", "shingles"])
                out, sets, held = [], [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(sets, pa.binary())], ["row", "shingles"])


def link_sets(sets: list[np.ndarray], member: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (as positions) that join sets into the groups that all of their links make.

    With two sides only pairs across them are compared. Members that are already joined need no
    comparison, so a large group of near copies costs one comparison a member, not one a pair.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(size, kind="stable")
    hist = np.zeros((n, SUFFIX_BUCKETS), np.int32)
    for i, s in enumerate(sets):
        hist[i] = np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=SUFFIX_BUCKETS)
    member = member.copy()
    two = side.min() != side.max() if n else False
    links = []
    sorted_size = size[order]
    for at in range(n):
        i = int(order[at])
        lo = int(np.searchsorted(sorted_size, -(-percent * size[i] // 100), "left"))
        others = order[lo:at]
        if two:
            others = others[side[others] != side[i]]
        others = others[member[others] != member[i]]
        while len(others):
            need = least_overlap(size[others], size[i], percent)
            apart = np.abs(hist[others] - hist[i]).sum(1)
            others = others[(size[others] + size[i] - apart) >= 2 * need]  # the suffix filter
            if not len(others):
                break
            j = int(others[-1])
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both >= least_overlap(size[j], size[i], percent):
                links.append((i, j))
                member[member == max(member[i], member[j])] = min(member[i], member[j])
                others = others[member[others] != member[i]]
            else:
                others = others[:-1]
    return links


def _link_blocks(block: np.ndarray, table: pa.Table, joined, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
    cuts, out = np.flatnonzero(np.diff(block)) + 1, []
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
        member = np.array([joined.root(i) for i in range(lo, hi)])
        for i, j in link_sets(sets[lo:hi], member, side[lo:hi], percent):
            joined.join(lo + i, lo + j)
            out.append((lo + i, lo + j))
    return out


def prefix_sql(n, percent: int):
    return n - F.ceil(percent * n / F.lit(100)) + 1


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents whose word-shingle sets have a Jaccard similarity of percent / 100 or more.

    Returns one row for each row of docs: the id column, n_shingles (size of its set) and component_id (smallest id
    that links reach, its own included). Words are runs without ASCII white space, A-Z in lower case. A text
    with fewer than k words is one shingle; null, empty and blank texts have an empty set and link with nothing.
    Ids may be of any type that has an order. Rows are documents of their own, also where they repeat an id or have
    none; a null id is never the smallest of a group that has another. An empty table gives an empty result. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).withColumn("row", F.xxhash64("id", "text"))
    seen = scratch.save(own.mapInArrow(partial(_describe, k=k), f"id {kind}, row long, n long, s1 long, s2 long, block int, counts binary"))
    sketch = np.zeros((2, SKETCH_WIDTH), np.uint32)
    parts = seen.where("block is not null").select("block", "counts").groupBy("block", (F.spark_partition_id() % 64).alias("salt"))
    for r in parts.applyInArrow(on_groups(_sketch_sum), "block int, counts binary").groupBy("block").applyInArrow(on_groups(_sketch_sum), "block int, counts binary").toLocalIterator():
        sketch[:, r.block * SKETCH_BLOCK : (r.block + 1) * SKETCH_BLOCK] = _unpack(bytes(r.counts), np.uint32).reshape(2, SKETCH_BLOCK)
    members = seen.where("block is null").select("id", "row", "n", "s1", "s2")
    counts = spark.sparkContext.broadcast(sketch)
    tokens = own.select("text").mapInArrow(partial(_prefixes, k=k, percent=percent, counts=counts), "token long, node long, n int")
    pairs = tokens.repartition("token").sortWithinPartitions("token", "node").mapInArrow(partial(_groups, percent=percent), "a long, b long, shared int, na int, nb int")
    n, m = F.col("na").cast("long"), F.col("nb").cast("long")
    need = F.ceil(percent * (n + m) / F.lit(100 + percent)) - F.greatest(n - prefix_sql(n, percent), m - prefix_sql(m, percent))
    met = pairs.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    met = scratch.save(met.where(F.col("b").isNull() | (F.col("shared") >= need)).select("a", "b"))
    candidates, crowded = met.where("b is not null"), met.where("b is null")
    if not crowded.isEmpty():
        among = spark.sparkContext.broadcast(IdFilter.of(crowded, "a"))
        parts = own.select("text").mapInArrow(partial(_parts, k=k, percent=percent, wanted=among), "key long, node long")
        candidates = candidates.union(parts.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_stars, "a long, b long"))
    blocks = scratch.save(connected_components(candidates, scratch))
    rows = members.where("n > 0").groupBy(F.col("s1").alias("node")).agg(F.min("row").alias("row"))
    chosen = scratch.save(blocks.join(rows, "node").select(F.col("component").alias("block"), "node", "row"))
    wanted = spark.sparkContext.broadcast(IdFilter.of(chosen, "row"))
    sets = own.select("row", "text").mapInArrow(partial(_sets_of, k=k, wanted=wanted), "row long, shingles binary").groupBy("row").agg(F.first("shingles").alias("shingles"))
    placed = scratch.save(chosen.join(sets, "row").select("block", "node", "shingles"))
    groups = scratch.save(connected_components(linked_in_blocks(placed, scratch, partial(_link_blocks, percent=percent), CELL), scratch))
    firsts = members.where("n > 0").groupBy("s1", "s2").agg(F.min("id").alias("first"))
    named = firsts.join(groups, F.col("s1") == F.col("node"), "left").withColumn("group", F.coalesce("component", "s1"))
    lowest = named.where("component is not null").groupBy("component").agg(F.min("first").alias("lowest"))
    named = named.select("s1", "s2", "first", "group").join(lowest, F.col("group") == F.col("component"), "left")
    named = named.select(F.col("s1").alias("t1"), F.col("s2").alias("t2"), F.coalesce("lowest", "first").alias("named"))
    out = members.join(named, (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")), "left")
    out = scratch.save(out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("named")).otherwise(F.col("id")).alias("component_id")))
    scratch.drop(seen, met, blocks, chosen, placed, groups)
    return out
