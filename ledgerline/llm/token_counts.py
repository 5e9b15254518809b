"""Token counts by a two-tier lookup on the map side.

A text is cut at single spaces into pre-token groups (a word with its marks), which a
byte-level BPE encodes independently. Tier one is a broadcast table of the lengths of
frequent groups, of at most ``table_size`` entries; what it lacks is encoded by the
library in the worker and kept in a bounded cache. No pre-token is shuffled: the table
comes from bounded per-task summaries of the whole corpus.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from itertools import islice

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import kept

#: Groups longer than this are encoded but not kept, so caches stay bounded in bytes too.
LONGEST = 64
CACHE = 400_000
SUMMARY = 2_000

_at_space = re.compile(r"(?<=\S)(?= )")
_space_in_run = re.compile(r"\s ")


def groups(text: str) -> tuple[str, list[str]]:
    """The text as its first group and the others without the space that begins each.

    A boundary lies between a character that isn't white space and a space; a run of white
    space is a pre-token of its own but for its last character, so none lies inside it.
    """
    if not _space_in_run.search(text):
        first, *rest = text.split(" ")
        return first, rest
    first, *rest = _at_space.split(text)
    if first.startswith(" "):  # white space leads: nothing precedes its first space
        return "", [first[1:], *(x[1:] for x in rest)]
    return first, [x[1:] for x in rest]


def _bounded(cache: dict, keep: int, limit: int) -> None:
    """Drops the oldest half of the entries after the first ``keep`` once there are ``limit`` of them."""
    if len(cache) >= keep + limit:
        for old in list(islice(cache, keep, keep + limit // 2)):
            del cache[old]


class Pieces(dict):
    """Pre-token to what ``encode`` gives for it."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str):
        got = self.encode(piece)
        if len(piece) <= LONGEST:
            _bounded(self, 0, CACHE)
            self[piece] = got
        return got


class Encoded(dict):
    """Group to what the library gives for ``lead`` + group, joined from its pre-tokens.

    ``known`` is the first tier; misses are worked out and kept, within bounds. A group with a
    string that may be a special token goes to the library whole."""

    def __init__(self, encode, split, join, lead: str, known=()) -> None:
        super().__init__(known)
        self.encode, self.split, self.join, self.lead, self.base = encode, split, join, lead, len(self)
        self.pieces = Pieces(encode)

    def __missing__(self, group: str):
        text = self.lead + group
        got = self.encode(text) if "<" in text else self.join(map(self.pieces.__getitem__, self.split(text)))
        if len(group) <= LONGEST:
            _bounded(self, self.base, CACHE)
            self[group] = got
        return got


def tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


#: Fixed pattern: the pre-tokens of byte-level vocabularies with use_regex.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def pattern(spec: dict) -> str:
    """The pattern by which the pre-tokenizer of a vocabulary file cuts."""
    pre = spec["pre_tokenizer"]
    steps = pre.get("pretokenizers", [pre])
    own = [x["pattern"]["Regex"] for x in steps if x["type"] == "Split"]
    return own[0] if own else BYTE_LEVEL


def pre_tokens(path: str):
    """Normalised text to pre-tokens, by the vocabulary file's own pattern."""
    import json

    import regex

    with open(path, encoding="utf-8") as f:
        return regex.compile(pattern(json.load(f))).findall


def splitter(path: str):
    """Text to pre-tokens, by the vocabulary file's own normalizer and pattern."""
    find, normalizer = pre_tokens(path), tokenizer(path).normalizer
    return find if normalizer is None else lambda text: find(normalizer.normalize_str(text))


def _summaries(batches):
    seen: Counter = Counter()
    total = 0
    for b in batches:
        for text in b.column(0).to_pylist():
            rest = groups(text)[1]
            total += len(rest)
            seen.update(rest)
        if len(seen) > 40 * SUMMARY:  # as lossy counting: only rare groups are forgotten
            seen = Counter(dict(seen.most_common(20 * SUMMARY)))
    top = [(g, n) for g, n in seen.most_common(SUMMARY) if len(g) <= LONGEST and n * 100_000 >= total]
    if top:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*top, strict=True)], ["group", "n"])


def frequent(texts: DataFrame, path: str, table_size: int = 32_768) -> list[tuple[str, int]]:
    """At most ``table_size`` frequent groups of ``texts`` (one column) with their lengths."""

    def lengths(batches):
        t = tokenizer(path)
        for b in batches:
            found = t.encode_batch([" " + g for g in b.column(0).to_pylist()], add_special_tokens=False)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(e.ids) for e in found], pa.int64())], ["group", "n"])

    top = (
        texts.mapInArrow(_summaries, "group string, n long")
        .groupBy("group")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "group")
        .limit(table_size)
        .select("group")
    )
    return [tuple(r) for r in top.mapInArrow(lengths, "group string, n long").collect()]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, table_size: int = 32_768) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) for every row of ``docs``.

    ``path``: a byte-level BPE for the library ``tokenizers``. Counts are the library's
    without added special tokens; special strings in a text are handled as it does by
    default. Null texts are empty: 0 bytes, 0 tokens. Rows that repeat are counted each.
    """
    text = F.coalesce("text", F.lit(""))
    table = docs.sparkSession.sparkContext.broadcast(frequent(docs.select(text.alias("text")), path, table_size))

    job = uuid.uuid4().hex

    def run(batches):
        def make():
            t, split = tokenizer(path), splitter(path)
            count = lambda s: len(t.encode(s, add_special_tokens=False).ids)
            return Encoded(count, split, sum, " ", table.value), Encoded(count, split, sum, "")

        known, heads = kept("counts", (path, job), make)
        for b in batches:
            n = []
            for s in b.column("text").to_pylist():
                first, rest = groups(s)
                n.append(heads[first] + sum(map(known.__getitem__, rest)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def op5_token_counts(spark, sf_dir) -> DataFrame:
    return count_tokens(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
