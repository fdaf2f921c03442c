"""Packing token sequences by cutting-stock column generation.

A document's tokens are cut into full sequences and one rest. The lengths of all pieces make a histogram
of fixed resolution; column generation plans patterns of lengths for it, and the pieces, ranked within
their length class without bringing a class into one task, take the planned places.
"""

from __future__ import annotations

import zlib
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.llm.common import Scratch, salted_rank
from quillspark.llm.cutting_stock import plan
from quillspark.llm.kernels import EXACT_BYTE_HASH, text_slices, word_bounds, word_hashes

#: Tokens in one unit of the histogram.
UNIT = 4
#: Words whose tokens a task keeps.
CACHED_WORDS = 1 << 20


class WordTokens:
    """Token ids of words between ASCII white space, which the tokenizer never joins; words are known by 64-bit hashes.

    Hashes lie in an open-addressed table of four times CACHED_WORDS places, so that all words of a slice are looked
    up at once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.shift = np.uint64(64 - (4 * CACHED_WORDS - 1).bit_length())
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(1 << (64 - int(self.shift)), np.uint64)
        self.words = np.zeros(len(self.hashes), np.int32)
        self.known, self.used = 0, 0
        self.first, self.ids = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)  # first[w] to first[w + 1]

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each word, or -1."""
        at, out = (h >> self.shift).astype(np.int64), np.full(len(h), -1, np.int32)
        todo = np.arange(len(h))
        while len(todo):
            there = self.hashes[at]
            hit = there == h[todo]
            out[todo[hit]] = self.words[at[hit]]
            on = ~hit & (there != 0)
            todo, at = todo[on], (at[on] + 1) & (len(self.hashes) - 1)
        return out

    def learn(self, h: np.ndarray, words: list[bytes]) -> None:
        """Add words that are not known; hashes differ and are not 0."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        if self.known + len(h) + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros(len(self.first) + len(h), np.int64)])
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + len(ids), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.first[self.known + 1 : self.known + len(h) + 1] = self.used + np.cumsum(sizes)
        number = np.arange(self.known, self.known + len(h), dtype=np.int32)
        self.known, self.used = self.known + len(h), self.used + len(ids)
        at = (h >> self.shift).astype(np.int64)
        while len(h):  # of words for one free place, one takes it
            free = np.flatnonzero(self.hashes[at] == 0)
            own = free[np.unique(at[free], return_index=True)[1]]
            self.hashes[at[own]], self.words[at[own]] = h[own], number[own]
            rest = np.ones(len(h), bool)
            rest[own] = False
            h, number, at = h[rest], number[rest], (at[rest] + 1) & (len(self.hashes) - 1)

    def tokens(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts with end_id after each, one after the other, and where each text's ids begin and end."""
        starts, ends, at = word_bounds(data, offsets)
        h = word_hashes(data, starts, EXACT_BYTE_HASH)
        h[h == 0] = 1
        if self.known > CACHED_WORDS:
            self.clear()
        number = self.find(h)
        new = np.flatnonzero(number < 0)
        for lo in range(0, len(new), 1 << 16):
            part = new[lo : lo + (1 << 16)]
            part = part[self.find(h[part]) < 0]
            if self.known > 2 * CACHED_WORDS:
                self.clear()
                return self._piecewise(data, offsets, starts, ends, at, h, end_id)
            fresh, rep = np.unique(h[part], return_index=True)
            self.learn(fresh, [data[starts[i] : ends[i]].tobytes() for i in part[rep].tolist()])
        if len(new):
            number[new] = self.find(h[new])
        return self._joined(number, at, end_id)

    def _joined(self, number: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        size = self.first[number + 1] - self.first[number]
        before = np.concatenate([[0], np.cumsum(size)])
        bounds = before[at] + np.arange(len(at))  # an end_id for each text before
        out = np.empty(int(bounds[-1]), np.uint32)
        body = np.ones(len(out), bool)
        body[bounds[1:] - 1] = False
        out[bounds[1:] - 1] = end_id
        out[body] = self.ids[np.repeat(self.first[number] - before[:-1], size) + np.arange(int(before[-1]))]
        return out, bounds

    def _piecewise(self, data, offsets, starts, ends, at, h, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """tokens for a slice with more different words than are kept: some words at a time."""
        parts, sizes = [], np.zeros(len(h), np.int64)
        for lo in range(0, len(h), CACHED_WORDS):
            hi = min(lo + CACHED_WORDS, len(h))
            self.clear()
            fresh, rep = np.unique(h[lo:hi], return_index=True)
            self.learn(fresh, [data[starts[lo + i] : ends[lo + i]].tobytes() for i in rep.tolist()])
            number = self.find(h[lo:hi])
            sizes[lo:hi] = self.first[number + 1] - self.first[number]
            parts.append(self._joined(number, np.array([0, hi - lo]), end_id)[0][:-1])
        before = np.concatenate([[0], np.cumsum(sizes)])
        bounds = before[at] + np.arange(len(at))
        out = np.empty(int(bounds[-1]), np.uint32)
        body = np.ones(len(out), bool)
        body[bounds[1:] - 1] = False
        out[bounds[1:] - 1] = end_id
        out[body] = np.concatenate(parts)
        return out, bounds


@cache
def _words(path: str) -> WordTokens:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokens(path)


def _pieces(batches, path: str, length: int, end_id: int, keep_ids: bool):
    known = _words(path)
    for b in batches:
        for first, data, offsets in text_slices(b.column(1)):
            ids, bounds = known.tokens(data, offsets, end_id)
            ids = ids.astype("<u4", copy=False)
            total = np.diff(bounds)
            count = -(-total // length)
            row = np.repeat(np.arange(len(total)), count)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * length
            size = np.minimum(length, total[row] - start)
            raw = memoryview(ids).cast("B")
            at = ((bounds[row] + start) * 4).tolist()
            spans = [raw[i : i + 4 * n] for i, n in zip(at, size.tolist())]
            crc = np.fromiter(map(zlib.crc32, spans), np.int64, len(spans))
            kept = pa.array([bytes(x) for x in spans], pa.binary()) if keep_ids else pa.nulls(len(spans), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(first + row)), pa.array(start), pa.array(size), pa.array(crc), pa.array(total[row]), kept], ["id", "start", "length", "ids_crc32", "doc_tokens", "ids"])


def _places(batches, shared):
    """Sequence numbers of ranked pieces (class, rank)."""
    starts, spans, times, firsts = shared.value
    for b in batches:
        cls, rank = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), b.column(1).to_numpy(zero_copy_only=False)
        out = np.zeros(len(cls), np.int64)
        for c in np.unique(cls):
            own = np.flatnonzero(cls == c)
            k = np.searchsorted(starts[c], rank[own], "right") - 1
            out[own] = firsts[c][k] + (rank[own] - starts[c][k]) // times[c][k]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], [*b.schema.names, "sequence_id"])


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents' tokens, placed in sequences of at most length tokens.

    A document is the tokens of its whole text (null: empty) and end_id. Returns a row for each piece: the
    id column, start (tokens before it in its document), length, ids_crc32 (of its ids as little-endian
    unsigned 32-bit numbers), doc_tokens, sequence_id and offset (its place in the sequence, gapless from
    0), and with keep_ids its ids as bytes. Repeated rows are documents of their own; an empty table gives
    an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    kind = docs.schema[id_col].dataType.simpleString()
    cut = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lambda b: _pieces(b, tokenizer_path, length, end_id, keep_ids), f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids binary")
    pieces = scratch.save(cut.withColumn("class", F.ceil(F.col("length") / UNIT).cast("int")))
    histogram = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}  # length / UNIT rows at most
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    used, first = dict.fromkeys(histogram, 0), 0
    for pattern, bars in plan(histogram, -(-length // UNIT)):
        for c, times in pattern.items():
            table.setdefault(c, []).append((used[c], bars * times, times, first))
            used[c] += bars * times
        first += bars
    shared = spark.sparkContext.broadcast(tuple({c: np.array([r[k] for r in rows], np.int64) for c, rows in table.items()} for k in range(4)))
    order = [F.col(x) for x in ("id", "start", "length", "ids_crc32", "doc_tokens")]
    ranked = salted_rank(pieces.drop("ids") if not keep_ids else pieces, ["class"], order, ["id", "start", "ids_crc32"]).select("class", "rank", *order, *(["ids"] if keep_ids else []))
    schema = type(ranked.schema)([*ranked.schema.fields]).add("sequence_id", "long")
    placed = ranked.mapInArrow(lambda b: _places(b, shared), schema)
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"), *(["ids"] if keep_ids else []))
