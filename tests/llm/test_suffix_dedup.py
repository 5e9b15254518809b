import hashlib
import random
from collections import Counter

from common_cases import documents

from ledgerline.llm import suffix_dedup
from ledgerline.llm.suffix_dedup import dedup


def brute(pairs, width):
    seen = Counter(b[p : p + width] for b in ((t or "").encode() for _, t in pairs) for p in range(len(b) - width + 1))
    out = []
    for i, t in pairs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if seen[b[p : p + width]] > 1:
                gone[p : p + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cases():
    rng = random.Random(5)
    words = ["tha", "er", "ín", "ion", "ß", "on"]
    text = lambda n: "".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(n))
    shared = [text(60) for _ in range(4)]
    pairs = [(i, text(rng.randrange(80)) + rng.choice(shared)[rng.randrange(30) :] + text(rng.randrange(60))) for i in range(60)]
    long = text(3000)
    return [
        *pairs, (100, None), (101, ""), (102, "x" * 500), (103, "ab" * 300), (104, long), (105, long[200:2000] + "Z" + long[2001:]),
        (106, pairs[3][1]), (107, pairs[3][1]), (3, pairs[3][1]), (None, pairs[4][1]),
    ]


def check(spark, pairs, width):
    got = dedup(documents(spark, pairs), width).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute(pairs, width)


def test_equals_brute_force(spark):
    check(spark, cases(), 64)


def test_long_texts_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    pairs = [(i, t) for i, t in cases() if t and len(t) > 200]
    runs = [r for i, t in pairs for s, b in suffix_dedup._blocks(t.encode(), 64) for r in suffix_dedup._runs(b, 64)[1] + s]
    assert len(set(runs)) > 100
    check(spark, pairs, 64)


def test_empty_table(spark):
    assert dedup(documents(spark, [])).collect() == []
