import hashlib
import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from common_cases import documents
from tokenizers import Tokenizer

from ledgerline.llm import fingerprints, packing, token_counts


def texts():
    rng = random.Random(3)
    words = ["The", "tha", "ín", "ß", "12", "don't", "x=1", "\t", "\n", "", " ", "  ", "\xa0", "é", "<|endoftext|>", "日本", "!!"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(120)]
    made += ["".join(rng.choice([" ", "\n", "a", " ", "."]) for _ in range(30)) for _ in range(120)]
    made += ["".join(rng.choice([" ", "\xa0", "\u2028", "\t", "a", "\x1c"]) for _ in range(60)) for _ in range(120)]
    return [None, "", " ", "   a", "a  ", "word " * 9000, "x" * 5000, made[3], made[3], *made]


def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    pairs = list(enumerate(texts()))
    got = token_counts.count_tokens(documents(spark, pairs), path, limit=20, table_size=50).collect()
    want = []
    for i, s in pairs:
        n = len(t.encode(s or "", add_special_tokens=False).ids)
        want.append((i, len((s or "").encode()), n, n > 20))
    assert sorted(map(tuple, got)) == want
    assert token_counts.count_tokens(documents(spark, []), path).collect() == []


def test_bounded_cache_keeps_the_table(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE", 10)
    e = token_counts.Encoded(len, lambda s: [s], sum, " ", {"a": 7})
    assert [e[str(i)] for i in range(40)] == [len(str(i)) + 1 for i in range(40)]
    assert e["a"] == 7 and len(e) <= 11


@pytest.mark.parametrize("seed", range(30))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    size = rng.choice([8, 50, 128])
    histogram = {n: rng.randrange(1, 200) for n in rng.sample(range(1, size + 1), rng.randrange(1, min(size, 20)))}
    used, ranks = defaultdict(list), defaultdict(list)
    for length, rank, n, start, offset in packing.plan(histogram, size):
        ranks[length].append((rank, n))
        for i in range(n):
            used[start + i].append((offset, length))
    for length, n in histogram.items():
        at = 0
        for rank, k in sorted(ranks[length]):
            assert rank == at
            at += k
        assert at == n
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    rooms = []  # best fit decreasing, piece by piece
    for length in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
        best = min((r for r in rooms if r >= length), default=None)
        if best is None:
            best = size
        else:
            rooms.remove(best)
        rooms.append(best - length)
    assert len(used) <= len(rooms) + 1


def test_packing_round_trip(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    pairs = list(enumerate(texts()))
    pairs.append((3, pairs[4][1]))
    got = packing.pack(documents(spark, pairs), path, size=64, with_ids=True).collect()
    want = defaultdict(list)
    for i, s in pairs:
        ids = [*t.encode(s or "", add_special_tokens=False).ids, 0]
        want[i].append(ids)
    have, places = defaultdict(list), defaultdict(list)
    for r in got:
        ids = list(struct.unpack(f"<{r['length']}I", bytes(r["ids"])))
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and 0 < r["length"] <= 64
        have[r["doc_id"]].append((r["piece"], r["start"], ids))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, documents_ in want.items():
        pieces = sorted((k, s, d[s : s + 64]) for d in documents_ for k, s in enumerate(range(0, len(d), 64)))
        assert sorted(have[i]) == pieces
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(documents(spark, []), path).collect() == []


def shingle_set(s):
    w = s.split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_and_next_documents(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    pairs = [(i * 7, " ".join(rng.choices(words, k=rng.randrange(400)))) for i in range(80)]
    pairs += [(5, None), (6, ""), (8, "one two"), (9, "one two")]
    rng.shuffle(pairs)
    got = {r["doc_id"]: r for r in fingerprints.with_next(documents(spark, pairs), parts=7).collect()}
    order = sorted((i, s or "") for i, s in pairs)
    assert len(got) == len(order)
    for n, (i, s) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        q = len(s) // 4
        edited = s[: len(s) - q] + after[:q]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(s), hashlib.sha256(edited.encode()).hexdigest())
        small = len(shingle_set(s) | shingle_set(edited)) <= fingerprints.K
        assert abs(r["near_edited"] - jaccard(s, edited)) <= (1e-9 if small else 0.18)
        assert abs(r["near_next"] - jaccard(s, after)) <= 0.18
    assert got[8]["fingerprint"] == got[9]["fingerprint"] and got[5]["fingerprint"] == ""
    assert got[8]["near_next"] == 1.0
    only = fingerprints.with_next(documents(spark, [(4, "a b c d e f g h")])).collect()
    assert [(r["doc_id"], r["near_next"]) for r in only] == [(4, 1.0)]
    assert fingerprints.with_next(documents(spark, [])).collect() == []


def test_sketches_merge_and_estimate():
    import numpy as np

    cache = fingerprints.shingles.WordHashes()
    a, b = " ".join(f"a{i}" for i in range(3000)), " ".join(f"a{i}" for i in range(1000, 5000))
    x, y = fingerprints.sketch(a, 256, cache), fingerprints.sketch(b, 256, cache)
    every = np.unique(np.concatenate([fingerprints.shingles.of(fingerprints.shingles.word_hashes(s.split(), cache)) for s in (a, b)]))
    assert (fingerprints.merge(x, y, 256) == every[:256]).all()
    assert abs(fingerprints.distinct(x, 256) / 2996 - 1) < 0.25
    assert abs(fingerprints.resemblance(x, y, 256) - jaccard(a, b)) < 0.12
    assert abs(fingerprints.containment(x, y, 256) - 1996 / 2996) < 0.2
    assert (fingerprints.decode(fingerprints.encode(x)) == x).all()
