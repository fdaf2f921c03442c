"""Secret scans by combined deterministic automata over the bytes of whole texts.

One minimal automaton reads every byte of a text once, for all rules, and says in which lines a rule ends. There the
automaton of the reversed rules, read backwards, says where rules start, and a rule's own automaton where its match
ends. No rule matches across a line feed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.automaton import Automaton
from quillspark.llm.kernels import text_slices

_WORDS = "(password|passwd|secret|token|api_?key)"
#: Kind, what precedes the value, the value, whether letters may have either case, the value's least length, and what ends where a rule may.
BASE_RULES = [
    ("assign", _WORDS + r"""["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]+", True, 6, _WORDS + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}"""),
    ("access", "", "AKIA[A-Z0-9]+", False, 20, "AKIA[A-Z0-9]{8}"),
    ("hex", "", "[0-9a-f]+", False, 24, "[0-9a-f]{24}"),
]
MORE_RULES = [
    ("github", "", "gh[pousr]_[A-Za-z0-9]+", False, 40, "gh[pousr]_[A-Za-z0-9]{4}"),
    ("slack", "", "xox[abprs]-[A-Za-z0-9-]+", False, 20, "xox[abprs]-[A-Za-z0-9]"),
    ("google", "", "AIza[A-Za-z0-9_-]+", False, 39, "AIza[A-Za-z0-9_-]{4}"),
    ("pem", "", "-----BEGIN [A-Z ]*PRIVATE KEY-----", False, 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
RULES = [*BASE_RULES, *MORE_RULES]


class Scanner:
    """The automata of a list of rules."""

    def __init__(self, rules=RULES):
        self.rules = rules
        self.all = Automaton((probe, fold) for _, _, _, fold, _, probe in rules)
        self.back = Automaton([(head + value, fold) for _, head, value, fold, _, _ in rules], backward=True)
        self.whole = [Automaton([(head + value, fold)], anchored=True) for _, head, value, fold, _, _ in rules]
        self.heads = [Automaton([(head, fold)], anchored=True) if head else None for _, head, _, fold, _, _ in rules]

    def spans(self, text: bytes, lines: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(start, rule, end) in code points of all spans in the given byte ranges, by start and then rule.

        Of a rule, the leftmost match counts and goes as far as it can; the next one begins after it.
        """
        found = []
        for lo, hi in lines:
            part = text[lo:hi]
            done = [0] * len(self.rules)
            for at, bits in reversed(self.back.starts(part)):
                for k in range(len(self.rules)):
                    if bits >> k & 1 and at >= done[k]:
                        end = done[k] = self.whole[k].longest(part, at)
                        value = self.heads[k].longest(part, at, end) if self.heads[k] else at
                        if end - value >= self.rules[k][4]:
                            found.append((lo + at, k, lo + end))
        if found:
            heads = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
            found = sorted((int(heads[a]), k, int(heads[b])) for a, k, b in found)
        return found


def scan_texts(column: pa.Array, scanner: Scanner) -> dict[int, list[tuple[int, int, int]]]:
    """The spans of each row that has any."""
    out = {}
    for row, data, offsets in text_slices(column, 4 << 20):
        starts, ends = scanner.all.chunks_with_hits(data, offsets)
        if not len(starts):
            continue
        order = np.argsort(starts)
        breaks = np.flatnonzero(data == 10)
        lines: dict[int, list[tuple[int, int]]] = {}
        for lo, hi in zip(starts[order].tolist(), ends[order].tolist()):
            i = int(np.searchsorted(offsets, lo, "right")) - 1
            a, b = int(offsets[i]), int(offsets[i + 1])
            before, after = np.searchsorted(breaks, lo) - 1, np.searchsorted(breaks, hi - 1)
            lo = max(a, int(breaks[before]) + 1 if before >= 0 else 0)
            hi = min(b, int(breaks[after]) if after < len(breaks) else len(data))
            own = lines.setdefault(i, [])
            if own and lo - a <= own[-1][1]:
                own[-1] = (own[-1][0], max(own[-1][1], hi - a))
            else:
                own.append((lo - a, hi - a))
        for i, ranges in lines.items():
            if spans := scanner.spans(data[offsets[i] : offsets[i + 1]].tobytes(), ranges):
                out[row + i] = spans
    return out


def _scan(batches, shared):
    for b in batches:
        found = scan_texts(b.column(1), shared.value)
        counts = np.zeros((len(RULES), b.num_rows), np.int64)
        base, spans = [], []
        for i in range(b.num_rows):
            own = found.get(i, [])
            for _, k, _ in own:
                counts[k, i] += 1
            said = [(k, f"{RULES[k][0]}:{s}:{e}") for s, k, e in own]
            base.append(hashlib.sha256(",".join(x for k, x in said if k < len(BASE_RULES)).encode()).hexdigest())
            spans.append(",".join(x for _, x in said))
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(counts[k]) for k in range(len(RULES))), pa.array(base), pa.array(spans, pa.string())], ["id", *(f"n_{r[0]}" for r in RULES), "base_sha256", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets in every whole text, one row for each row of docs.

    Returns the id column, a count for each kind (n_<kind>), base_sha256 (of the base kinds' spans) and spans:
    kind:start:end in code points, end exclusive, by start and then kind, joined by commas. Matches of a
    kind are leftmost and don't overlap; those under the kind's least length are dropped. A null text is
    an empty one and has no span; repeated rows and null ids stay; an empty table gives an empty result;
    other columns are ignored.
    """
    counts = ", ".join(f"n_{r[0]} long" for r in RULES)
    shared = docs.sparkSession.sparkContext.broadcast(Scanner())
    out = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(lambda b: _scan(b, shared), f"id {docs.schema[id_col].dataType.simpleString()}, {counts}, base_sha256 string, spans string")
    return out.withColumnRenamed("id", id_col)


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with every span in its texts replaced by mark; null texts stay null, all columns stay."""
    names, at = docs.columns, docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(Scanner())

    def redact(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            for i, own in scan_texts(b.column(at), shared.value).items():
                t, out, done = texts[i], [], 0
                for s, _, e in own:
                    if s >= done:
                        out += [t[done:s], mark]
                    done = max(done, e)
                texts[i] = "".join(out) + t[done:]
            yield b.set_column(at, names[at], pa.array(texts, b.schema.field(at).type))

    return docs.mapInArrow(redact, docs.schema)
