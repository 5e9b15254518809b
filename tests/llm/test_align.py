import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from common_cases import documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def texts():
    rng = random.Random(11)
    words = ["The", "thé", "aaaa" * 9, "12", "don't", "日本語", "👍🏽", "<|endoftext|>", "<s>", "<0x41>", "<unk>", "x=1;", "\t", "", "Straße"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(120)]
    return [None, "", " ", "a  b", " lead", "trail ", "line\nbreak", "ﬁ ligature", "z" * 9000, "word " * 5000, made[0], made[0], *made]


def ends(pieces):
    return np.cumsum([len(p) for p in pieces]).tolist()


def brute_force(pairs):
    """Every digest column by sets of byte offsets and loops over occurrences."""
    t, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    t.encode_special_tokens = True
    byte_of, n = {}, 0
    for b in range(256):
        plain = 33 <= b < 127 or 161 <= b < 173 or b >= 174
        byte_of[chr(b if plain else 256 + n)] = b
        n += not plain
    rows, held = [], defaultdict(set)
    for row, (doc_id, text) in enumerate(pairs):
        a = t.encode(" " + (text or ""), add_special_tokens=False).ids
        b = sp.encode(text or "")
        bytes_a = [bytes(byte_of[c] for c in t.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            rows.append((doc_id, 0, 0, [], Counter()))
            continue
        ends_a, ends_b = ends(bytes_a), ends(bytes_b)
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, links = [], Counter()
        for lo, hi in zip([0, *cuts], cuts, strict=False):
            own_a = [i for i, e in zip(a, ends_a, strict=True) if lo < e <= hi]
            own_b = [i for i, e in zip(b, ends_b, strict=True) if lo < e <= hi]
            groups.append((own_a, own_b))
            for x, n in Counter(own_a).items():
                for y, m in Counter(own_b).items():
                    links[x, y] += n * m
        for pair in links:
            held[pair].add(row)
        rows.append((doc_id, len(a), len(b), groups, links))
    top = defaultdict(int)
    for (x, _), docs in held.items():
        top[x] = max(top[x], len(docs))
    out = []
    for doc_id, n_a, n_b, groups, links in rows:
        written = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append(
            (
                doc_id, n_a, n_b, len(groups), sum(links.values()),
                sum(n for (x, y), n in links.items() if len(held[x, y]) == top[x]),
                sum(n * len(held[pair]) for pair, n in links.items()),
                hashlib.sha256(written.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out)


def digests(docs, hot_pairs):
    links = align.align(docs, A, B)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    links = links.select(F.monotonically_increasing_id().alias("row"), "*", digest).drop("groups").checkpoint()
    scored = align.score(links, align.pair_counts(links), hot_pairs)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, scored.select(*names).collect()))


@pytest.mark.parametrize("hot_pairs", [0, 7, 1 << 18])
def test_alignment_equals_brute_force(spark, hot_pairs):
    pairs = list(enumerate(texts()))
    assert digests(documents(spark, pairs), hot_pairs) == brute_force(pairs)


def test_wide_groups_and_small_chunks(spark, monkeypatch):
    a, b = np.array([1, 2, 1, 2]), np.array([5, 5, 6])
    groups = np.zeros(4, int), np.zeros(3, int), np.zeros(1, int)
    want = [x.tolist() for x in align._links(a, b, *groups)]
    monkeypatch.setattr(align, "WIDE", 2)
    assert [x.tolist() for x in align._links(a, b, *groups)] == want == [[0] * 4, [1, 1, 2, 2], [5, 6, 5, 6], [4, 2, 4, 2]]


def test_a_repeated_stretch_is_encoded_and_aligned_once_a_batch(monkeypatch):
    sides = align.byte_level(A), align.sentence_pieces(B)
    asked, jumped, jump = [], [], align.components
    for side in sides:
        monkeypatch.setattr(side, "encode", lambda new, own=side.encode: asked.append(sorted(new)) or own(new))
    monkeypatch.setattr(align, "components", lambda a, b: jumped.append(len(a) + len(b)) or jump(a, b))
    texts = ["the word and the word " * 200 + "the"] * 5
    rows = align._chunk(list(range(5)), texts, *sides, align.Recent()).to_pylist()
    assert asked == [["and", "the", "word"]] * 2 and sum(jumped) <= 20
    assert {tuple(map(str, list(r.values())[1:])) for r in rows} == {tuple(map(str, list(rows[0].values())[1:]))}
    assert rows[0]["n_groups"] == 1001 == sum(rows[0]["times"]) and rows[0]["groups"].count(";") == 1000


def test_text_that_is_exact_only_as_a_whole():
    ids = lambda *x: np.array(x, "<u4").tobytes()
    over = align.Side(lambda new: [{"ab": ids(0), "c": ids(1), "d": ids(2)}[g] for g in new], [b" ab ", b"c", b" d"])
    plain = align.Side(lambda new: [{"ab": ids(0), "c": ids(1), "d": ids(2)}[g] for g in new], [b" ab", b" c", b" d"])
    rows = align._chunk([1, 2, 3, 4], ["ab c", "c ab", "d", ""], over, plain, align.Recent()).to_pylist()
    assert [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups"]) for r in rows] == [
        (2, 2, 1, 4, "0,1|0,1"), (0, 0, 0, 0, ""), (1, 1, 1, 1, "2|2"), (0, 0, 0, 0, "")
    ]
    assert rows[0]["a"] == [0, 0, 1, 1] and rows[0]["b"] == [0, 1, 0, 1] and rows[1]["a"] == []


def test_pointer_jumping_over_long_chains():
    """Tokens that interleave without a shared end but the last."""
    ends_a, ends_b = np.arange(2, 4002, 2), np.append(np.arange(1, 4000, 2), 4000)
    a, b = align.components(np.append(ends_a, 4004), np.append(ends_b, 4004))
    assert set(a[:-1]) == set(b[:-1]) == {0} and a[-1] == b[-1] == 1


def test_query_and_empty_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = align.op13_cross_tokenizer_alignment(spark, sf).select(*names)
    assert sorted(map(tuple, got.collect())) == brute_force([tuple(r) for r in rows])
    empty = align.align(documents(spark, []), A, B).withColumn("row", F.lit(0).cast("long"))
    assert align.score(empty, align.pair_counts(empty)).collect() == []
