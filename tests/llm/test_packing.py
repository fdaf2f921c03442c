import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quillspark.llm.cutting_stock import fill_exactly, knapsack, plan, relaxed
from quillspark.llm.packing import pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_hold_every_token_once_and_sequences_have_no_gap(spark):
    texts = [None, "", " \n", "Hello  World's\ttest x é́ <|endoftext|> 12,5!", "a\x1cb\x85c d e", "word " * 9000, "ein Zwei drei\n" * 300] + [f"some words {i} " * (i * 7 % 400) for i in range(60)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, class int").repartition(3)
    out = pack_documents(df, PATH, keep_ids=True).collect()
    plain = Tokenizer.from_file(PATH)
    for i, t in enumerate(texts):
        own = sorted((r for r in out if r.doc_id == i), key=lambda r: r.start)
        if i == 3:
            assert len(own) == 2
            own = own[:1]
        want = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert b"".join(bytes(r.ids) for r in own) == want.tobytes()
        at = 0
        for r in own:
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(want), zlib.crc32(want[at : at + r.length].tobytes()))
            at += r.length
    sequences: dict[int, list] = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    total = sum(r.length for r in out)
    assert len(sequences) <= total / 4096 * 1.05 + 2
    assert pack_documents(df.limit(0), PATH).count() == 0


def test_plan_covers_the_demand_nearly_optimally():
    g = np.random.default_rng(1)
    for capacity, lengths in ((100, g.integers(1, 101, 800)), (64, g.integers(20, 40, 500)), (30, np.full(50, 16)), (30, [30] * 4), (10, [])):
        demand = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
        bars = plan(demand, capacity)
        held: dict[int, int] = {}
        for pattern, times in bars:
            assert sum(k * n for k, n in pattern.items()) <= capacity
            for k, n in pattern.items():
                held[k] = held.get(k, 0) + n * times
        assert held == demand
        if demand:
            keys = np.array(sorted(demand))
            least = relaxed(keys, np.array([demand[int(k)] for k in keys], float), capacity, gap=1e-6)[1].sum()
            assert sum(t for _, t in bars) <= least * 1.03 + 2


def test_knapsack_and_filling():
    value, pattern = knapsack(np.array([0.4, 0.65]), np.array([3, 5]), 11)
    assert abs(value - 1.45) < 1e-9 and pattern.tolist() == [2, 1]
    assert fill_exactly({7: 1, 5: 2, 3: 9}, 20) == {7: 1, 5: 2, 3: 1}
