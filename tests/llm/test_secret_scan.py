import hashlib
import random
import re

from quillspark.llm.automaton import Automaton
from quillspark.llm.secret_scan import RULES, Scanner, redact_secrets, scan_secrets


def brute(text):
    found = []
    for k, (kind, head, value, fold, least, _) in enumerate(RULES):
        for m in re.finditer(f"{head}(?P<value>{value})", text, re.A | (re.I if fold else 0)):
            if len(m["value"]) >= least:
                found.append((m.start(), k, m.end()))
    return [f"{RULES[k][0]}:{s}:{e}" for s, k, e in sorted(found)]


def texts():
    rng = random.Random(4)
    parts = ["password", "PassWd", "token=", "secret: ", "api_key", "apikey = '", "\"", "'", " ", ":", "=", "\n", "é", "ß,", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", "x", "-", "==", ".", "ghp_", "a" * 36, "xoxb-", "AIza", "-----BEGIN RSA PRIVATE KEY-----", ",", "word "]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(1500)] + ["", "a" * 5000, "0" * 24, "0" * 23, "AKIA" + "B" * 16, "AKIA" + "B" * 15, "token=" + "c" * 100_000, "token token=token=abcdef"]


def test_spans_equal_plain_expressions(spark):
    rows = list(enumerate(texts())) + [(-1, None)]
    out = {r.doc_id: r for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for i, t in rows:
        want = brute(t or "")
        assert out[i].spans == ",".join(want), (t or "")[:200]
        base = [x for x in want if x.split(":")[0] in ("assign", "access", "hex")]
        assert out[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert out[i].n_hex == sum(x.startswith("hex:") for x in want)


def test_automaton_finds_the_same_ends():
    rules = [("ab+c|x{2,3}", False), ("[0-9]{3}", False), ("k?ey", True)]
    dfa, rng = Automaton(rules), random.Random(1)
    for _ in range(300):
        s = "".join(rng.choice("abcx0123kKEyY ") for _ in range(30)).encode()
        state = 0
        for i, b in enumerate(s):
            state = dfa.next[state, b]
            for k, (p, fold) in enumerate(rules):
                ends = any(re.fullmatch(p.encode(), s[j : i + 1], re.I if fold else 0) for j in range(i + 1))
                assert bool(dfa.ends[state] >> k & 1) == ends
    back = Automaton(rules, backward=True)
    for _ in range(300):
        s = "".join(rng.choice("abcx0123kKEyY ") for _ in range(30)).encode()
        starts = dict(back.starts(s))
        for i in range(30):
            for k, (p, fold) in enumerate(rules):
                assert bool(starts.get(i, 0) >> k & 1) == bool(re.compile(p.encode(), re.I if fold else 0).match(s, i))
    assert len(Scanner().all.next) < 3_000 and len(Scanner().back.next) < 3_000


def test_a_megabyte_without_a_reset_byte():
    import time

    import pyarrow as pa
    from quillspark.llm.secret_scan import scan_texts

    scanner = Scanner()
    began = time.process_time()
    out = scan_texts(pa.array(["x " + "0123456789abcdef" * 65_536 + "\npassword: hunter22", "token=" + "secret=" * 100_000]), scanner)
    assert time.process_time() - began < 3
    assert out[0] == [(2, 2, 2 + 16 * 65_536), (3 + 16 * 65_536, 0, 3 + 16 * 65_536 + 18)]
    assert out[1] == [(0, 0, 6 + 700_000)]


def test_redaction_and_empty_table(spark):
    df = spark.createDataFrame([(1, "my password=hunter22 é", 7), (2, None, 8)], "doc_id long, text string, spans int")
    assert sorted((r.doc_id, r.text, r.spans) for r in redact_secrets(df).collect()) == [(1, "my [SECRET] é", 7), (2, None, 8)]
    assert scan_secrets(df).count() == 2
    assert scan_secrets(df.limit(0)).count() == 0
