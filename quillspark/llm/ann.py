"""Approximate nearest neighbours by additive quantisation.

Full-dimensional residual codebooks are fitted on a bounded sample and refined by least squares; every
vector is encoded by beam search. A query scores a block of codes through a lookup table of its inner
products with all codewords. Vectors whose score, within an error margin from their stored norms, may
reach the k-th best are reranked exactly in double precision, so a dense group is never cut off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.llm.common import Scratch
from quillspark.llm.vectors import matrix, packed, rows_binary

CODEWORDS = 256
BEAM = 4
#: Rows of vectors in a block, and queries in one.
ROW_BLOCK = 8192
QUERY_BLOCK = 16384
#: Standard deviations of a score's error that the margin allows for.
MARGIN = 3.0


def fit_codebooks(x: np.ndarray, stages: int, seed: int = 5, turns: int = 5) -> np.ndarray:
    """Codebooks (stages, codewords, d): k-means on the residuals, stage by stage, then least squares for all together."""
    rng = np.random.default_rng(seed)
    words = min(CODEWORDS, len(x))
    books = np.zeros((stages, words, x.shape[1]), np.float32)
    rest = x.astype(np.float32).copy()
    for s in range(stages):
        c = rest[rng.permutation(len(rest))[:words]].copy()
        for _ in range(turns):
            near = _nearest(rest, c)
            count = np.bincount(near, minlength=words)
            total = np.zeros_like(c)
            np.add.at(total, near, rest)
            c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], rest[rng.integers(0, len(rest), words)])
        books[s] = c
        rest -= c[_nearest(rest, c)]
    codes = encode(x, books)[0]
    rows = codes.astype(np.int64) + np.arange(stages) * words
    gram = np.zeros((stages * words,) * 2, np.float32)
    for a in range(stages):
        for b in range(stages):
            np.add.at(gram, (rows[:, a], rows[:, b]), 1)
    right = np.zeros((stages * words, x.shape[1]), np.float32)
    for a in range(stages):
        np.add.at(right, rows[:, a], x.astype(np.float32))
    flat = books.reshape(-1, x.shape[1])
    pull = np.float32(1.0)  # towards the codewords of the first fit, which keeps unused ones where they are
    gram[np.diag_indices_from(gram)] += pull
    return np.linalg.solve(gram, right + pull * flat).astype(np.float32).reshape(books.shape)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1) - 2 * (x @ c.T), axis=1)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Codes (n, stages) found by beam search, and the norms of what they leave unexplained."""
    stages, words, d = books.shape
    codes, left = np.zeros((len(x), stages), np.uint8), np.zeros(len(x), np.float32)
    for at in range(0, len(x), 1024):
        own = x[at : at + 1024].astype(np.float32)
        n = len(own)
        rest, error, path = own[:, None, :], (own * own).sum(1)[:, None], np.zeros((n, 1, 0), np.uint8)
        for s in range(stages):
            c = books[s]
            cost = error[:, :, None] + (c * c).sum(1) - 2 * (rest.reshape(-1, d) @ c.T).reshape(n, rest.shape[1], words)
            flat = cost.reshape(n, -1)
            k = min(beam, flat.shape[1])
            best = np.argpartition(flat, k - 1, axis=1)[:, :k]
            error = np.take_along_axis(flat, best, 1)
            i, w = best // words, best % words
            rest = np.take_along_axis(rest, i[:, :, None], 1) - c[w]
            path = np.concatenate([np.take_along_axis(path, i[:, :, None], 1), w[:, :, None].astype(np.uint8)], 2)
        top = np.argmin(error, 1)
        codes[at : at + n] = path[np.arange(n), top]
        left[at : at + n] = np.sqrt(np.maximum(error[np.arange(n), top], 0))
    return codes, left


def search_block(query_rows: np.ndarray, q: np.ndarray, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, codes: np.ndarray, left: np.ndarray, books: np.ndarray, k: int):
    """(query, row) numbers and scores of the exact top k of the block for each query, among the vectors that the lookup tables let through; query_rows and rows name rows."""
    tables = np.einsum("qd,swd->sqw", q.astype(np.float32), books)
    norm = np.sqrt((q * q).sum(1)).astype(np.float32)
    scores = np.zeros((len(q), len(x)), np.float32)
    for s in range(len(books)):
        scores += np.take(tables[s], codes[:, s], axis=1)
    cut = np.partition(scores, len(x) - min(k + 1, len(x)), axis=1)[:, len(x) - min(k + 1, len(x))]
    margin = left * np.float32(MARGIN / np.sqrt(q.shape[1]))
    out = []
    for i in range(len(q)):
        may = np.flatnonzero((scores[i] + margin * norm[i] >= cut[i]) & (rows != query_rows[i]))
        exact = (x[may].astype(np.float64) * q[i]).sum(1)
        order = np.lexsort((ids[may], -exact))[:k]
        out.append((np.full(len(order), i), may[order], exact[order]))
    return [np.concatenate(z) for z in zip(*out)]


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", sample_rows: int = 8192, seed: int = 5) -> DataFrame:
    """The k vectors of largest inner product for each row that the condition is_query (on the id column) holds for.

    Returns query_id, rank (from 1), the id column and score, nearest first and ties to the smaller id;
    all candidates if there are fewer than k. Every row is indexed; the codebooks alone are fitted on
    the sample_rows rows of smallest hash. Vectors that are null, empty, zero or hold null or non-finite
    components take no part, nor do rows with a null id or with another dimension than the commonest of
    the sample. Rows that repeat an id and vector count once; different vectors under one id are rows of
    their own: each is a query with its own ranks, and a neighbour of the others. Ids are cast to long. An empty
    table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    schema = f"query_id long, rank int, {id_col} long, score double"
    scratch = Scratch(spark, "ann")
    row = F.xxhash64("id", "v")  # a row's name
    own = scratch.save(packed(vectors, id_col, vec_col).dropDuplicates(["id", "v"]).withColumn("row", row))
    sample = own.orderBy(F.xxhash64(F.lit(seed), "id"), "id", "v").limit(sample_rows).toArrow()  # a bounded sample
    if not sample.num_rows:
        return spark.createDataFrame([], schema)
    d = int(np.bincount(sample.column("d").to_numpy()).argmax())
    sample = sample.take(pa.array(np.flatnonzero(sample.column("d").to_numpy() == d)))
    stages = int(min(32, max(4, d // 4)))
    books = spark.sparkContext.broadcast(fit_codebooks(matrix(sample.column("v"), d).astype(np.float32), stages, seed))

    def index(batches):
        for b in batches:
            if b.num_rows:
                codes, left = encode(matrix(b.column(1), d), books.value)
                yield pa.RecordBatch.from_arrays([*b.columns, rows_binary(codes), pa.array(left)], ["id", "v", "row", "codes", "left"])

    same = own.where(F.col("d") == d)
    n = same.count()
    asked = same.where(is_query(F.col("id")))
    row_blocks, query_blocks = max(1, -(-n // ROW_BLOCK)), max(1, -(-asked.count() // QUERY_BLOCK))
    rows = same.select("id", "v", "row").mapInArrow(index, "id long, v binary, row long, codes binary, left float")
    rows = rows.withColumn("row_block", F.pmod("row", F.lit(row_blocks))).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = asked.withColumn("query_block", F.pmod(F.xxhash64(F.lit(3), "row"), F.lit(query_blocks)).cast("int")).withColumn("row_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))))

    def search(left, right):
        names = ["query_row", "query_id", "row", id_col, "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4 + [pa.array([], pa.float64())], names)
        left, right = left.sort_by("row"), right.sort_by("row")
        query_rows, query_ids, q = right.column("row").to_numpy(), right.column("id").to_numpy(), matrix(right.column("v"), d).astype(np.float64)
        own, ids, x, codes, rest = left.column("row").to_numpy(), left.column("id").to_numpy(), matrix(left.column("v"), d), matrix(left.column("codes"), stages, np.uint8), left.column("left").to_numpy()
        found = [search_block(query_rows[at : at + 256], q[at : at + 256], own, ids, x, codes, rest, books.value, k) for at in range(0, len(q), 256)]
        i, j, score = (np.concatenate(z) for z in zip(*((a + 256 * n, b, s) for n, (a, b, s) in enumerate(found))))
        return pa.table([pa.array(z) for z in (query_rows[i], query_ids[i], own[j], ids[j], score)], names)

    found = rows.groupBy("row_block", "query_block").cogroup(asked.groupBy("row_block", "query_block")).applyInArrow(search, f"query_row long, query_id long, row long, {id_col} long, score double")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), id_col, "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), id_col, "score")
