import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
from common_cases import documents
from tokenizers import Tokenizer

from ledgerline.llm import bpe

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def texts():
    rng = random.Random(5)
    words = ["The", "thé", "İstanbul", "ΣΑΣ", "ﬁ", "12", "don't", "x=1", "\t", "\n", "", " ", "  ", "\xa0", "́", "日本", "👍🏽"]
    words += ["<|endoftext|>", "<|startoftext|>a", "<", "<|", "!!!", "\x1c", " ", "﻿", "é"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randrange(30))) for _ in range(150)]
    made += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x2FFF), 0x20])) for _ in range(40)) for _ in range(100)]
    return [None, "", " ", "   a", "a  ", "word " * 9000, "x" * 5000, "ab" * 20_000, made[3], made[3], *made]


@pytest.mark.parametrize("file", FILES)
def test_ids_and_decoded_text_equal_the_library(spark, file):
    path = public_tokenizers.path(file)
    t = Tokenizer.from_file(path)
    t.no_truncation()
    pairs = list(enumerate(texts()))
    got = bpe.decode(bpe.encode(documents(spark, pairs), path), path).collect()
    assert len(got) == len(pairs)
    for r in got:
        want = t.encode(pairs[r["doc_id"]][1] or "", add_special_tokens=False).ids
        assert list(memoryview(bytes(r["ids"])).cast("I")) == want, pairs[r["doc_id"]]
        assert r["decoded"] == t.decode(want, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(documents(spark, []), path), path).collect() == []


def test_special_strings_as_plain_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    text = "a<|endoftext|> <|endoftext|>b"
    (got,) = bpe.Encoder(path, special=False).many([text])
    assert list(memoryview(got).cast("I")) == t.encode(text, add_special_tokens=False).ids


def made_up_pairs(rng, letters, n):
    pairs, merged = [], []
    for _ in range(n):
        pair = rng.randrange(letters + len(merged)), rng.randrange(letters + len(merged))
        if pair not in pairs:
            pairs.append(pair)
            merged.append(letters + len(merged))
    return bpe.Pairs(pairs, merged)


def scanned(symbols, pairs):
    """A scan of all pairs before each merge."""
    rank_of, out = pairs.rank_of, list(symbols)
    while found := [(rank_of[a << 32 | b], i) for i, (a, b) in enumerate(zip(out, out[1:], strict=False)) if a << 32 | b in rank_of]:
        rank, i = min(found)
        out[i : i + 2] = [pairs.merged[rank]]
    return out


@pytest.mark.parametrize("seed", range(30))
def test_tree_takes_the_leftmost_pair_of_least_rank(seed):
    rng = random.Random(seed)
    letters = rng.randrange(1, 5)
    pairs = made_up_pairs(rng, letters, rng.randrange(0, 30))
    words = [[rng.randrange(letters) for _ in range(rng.randrange(1, rng.choice([3, 9, 70])))] for _ in range(40)]
    want = [scanned(w, pairs) for w in words]
    assert [bpe.merge(list(w), pairs) for w in words] == want
    rows = np.full((len(words), max(map(len, words))), -1)
    for row, w in zip(rows, words, strict=True):
        row[: len(w)] = w
    assert [[x for x in row if x >= 0] for row in bpe.merge_side_by_side(rows, pairs).tolist()] == want


def test_pairs_of_arrays():
    pairs = made_up_pairs(random.Random(1), 50, 400)
    left, right = np.repeat(np.arange(-1, 460), 461), np.tile(np.arange(-1, 460), 461)
    found = pairs.leaves(left, right, np.full(len(left), 7)).tolist()
    want = [pairs.rank_of.get(a << 32 | b) if min(a, b) >= 0 else None for a, b in zip(left.tolist(), right.tolist(), strict=True)]
    assert found == [bpe.NONE if r is None else r << 32 | 7 for r in want]


def test_caches_stay_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 20)
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, t = bpe.Encoder(path), Tokenizer.from_file(path)
    for i in range(30):
        text = " ".join([*(f"w{i}x{k}," for k in range(30)), "y" * 200])
        (got,) = encoder.many([text])
        assert list(memoryview(got).cast("I")) == t.encode(text, add_special_tokens=False).ids
        assert len(encoder.pieces) <= 100 and len(encoder.known[""]) <= 100  # two generations and a text's own
        assert "y" * 200 not in encoder.pieces.used


@pytest.mark.parametrize("file", FILES)
def test_lines_are_cut_like_words(file):
    """Words at the ends of lines are looked up like others; runs of white space stay as the library has them."""
    path = public_tokenizers.path(file)
    encoder, t = bpe.Encoder(path), Tokenizer.from_file(path)
    lines = "\n".join(f"Word{i % 7}, other{i % 6}" for i in range(300))
    (got,) = encoder.many([lines])
    assert list(memoryview(got).cast("I")) == t.encode(lines, add_special_tokens=False).ids
    assert len(encoder.known[""]) < 30
    rng = random.Random(8)
    marks = ["\n", " ", "\n\n", "\r\n", "\t", "a", "É", "ß,", "\n'", "don't", "x'", "'s", "12", "\x1c", "\u0301", "<|endoftext|>", "\u212a", "क़", "..."]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(14))) for _ in range(3000)]
    for text, got in zip(texts, encoder.many(texts), strict=True):
        assert list(memoryview(got).cast("I")) == t.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("file", FILES)
def test_capitals_share_their_small_letters_entry(file):
    """Texts with small ASCII letters from the start: one entry for all spellings of a word, and one for a word that is
    its own pre-token. Special strings and letters that are composed stay as the library has them."""
    path = public_tokenizers.path(file)
    encoder, t = bpe.Encoder(path), Tokenizer.from_file(path)
    odd = ["H\u0331 h\u0331", "<|ENDOFTEXT|> <|endoftext|>A", "\u0130I \u212a \u039f\u03a3A\u03a3", "\u00c9T\u00c9 ABC", "\u1e9e T\u0308 J\u030c\u0323", "A\u0340B"]
    for text in ["Word WORD word", *odd, *reversed(odd), "word, H\u0331"]:
        (got,) = encoder.many([text])
        assert list(memoryview(got).cast("I")) == t.encode(text, add_special_tokens=False).ids, repr(text)
    encoder = bpe.Encoder(path)
    encoder.many(["Word WORD word wORD"])
    assert file != FILES[0] or len(encoder.known[""]) + len(encoder.pieces) == 1


def test_one_long_pre_token_is_not_quadratic(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    text = "".join(random.Random(1).choice("abcde") for _ in range(300_000))
    got = bpe.encode(documents(spark, [(1, text)]), path).first()["ids"]
    assert list(memoryview(bytes(got)).cast("I")) == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_query_digests(spark):
    sf = "/root/testdata/sf0.001"
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    want = []
    for doc_id, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = t.encode(text or "", add_special_tokens=False).ids
        decoded = t.decode(ids, skip_special_tokens=False)
        digest = [hashlib.sha256(x).hexdigest() for x in (struct.pack(f"<{len(ids)}I", *ids), decoded.encode())]
        want.append((doc_id, len(ids), *digest))
    assert sorted(map(tuple, bpe.op12_bpe_round_trip(spark, sf).collect())) == sorted(want)
