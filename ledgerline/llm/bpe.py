"""BPE encoding by segment trees over the ranks of adjacent pairs, and decoding.

The leaves of a pre-token's tree are its adjacent pairs, each as (rank, position); the
root is the least of them, so the leftmost of the lowest rank. A merge changes three
leaves (the pair itself, the one before, the one behind), each in logarithmic time, and
goes on until the root holds no pair of the vocabulary. Pre-tokens are independent: the
trees of all new ones of a batch are worked on side by side in NumPy, a long one by
itself, and a worker keeps the ids of those it has seen, within bounds.
"""

from __future__ import annotations

import json
import re
import string
from itertools import accumulate, chain, filterfalse

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .token_counts import pattern, pre_tokens, splitter, tokenizer

#: No pair: over every (rank, position).
NONE = 1 << 62
#: Pre-tokens of more symbols have a tree of their own instead of a row among others.
SIDE_BY_SIDE = 64
#: Code points of text that are encoded at once.
CHUNK = 1 << 20
#: Entries that a worker keeps of either kind, groups and pre-tokens (and those of one chunk), and the longest kept.
CACHE = 300_000
LONGEST = 64
#: Bytes of output after which a batch ends, so that batches of long texts stay small.
BATCH_BYTES = 8 << 20

#: Before a stretch that has no space before it. No text holds a surrogate.
BARE = "\ud800"

#: Marks that are a pre-token of their own behind letters, at the end of a stretch.
MARKS = {*string.punctuation}

_space = re.compile(r"\s")
_run = re.compile(r"\s\s")
_before_run = re.compile(r"(?<=\S)(?=[ \n])")


def stretches(text: str) -> list[str]:
    """The text cut before spaces and line breaks that follow something else than white space. No pre-token reaches
    over such a place, and none depends on what is before it. A space that begins a stretch is left out, a line break
    stays, and any other stretch stands behind ``BARE``: ``whole`` gives them back."""
    if not _run.search(text):
        first, *rest = (text.replace("\n", " \n") if "\n" in text else text).split(" ")
    else:
        first, *rest = _before_run.split(text)
        rest = [BARE + x if x.startswith(" \n") else x[1:] if x[0] == " " else x for x in rest]
    return [BARE + first, *rest]


def whole(stretch: str) -> str:
    lead = stretch[:1]
    return stretch[1:] if lead == BARE else stretch if lead == "\n" else " " + stretch


def byte_letters() -> list[str]:
    """The letter of each byte in byte-level vocabularies: printable Latin-1 stands for
    itself, the other bytes take the letters from U+0100 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(others)) for b in range(256)]


class Pairs:
    """The rank of each pair of symbols and the symbol that the pair of a rank becomes. ``rank_of`` is for
    single look-ups, ``ranks`` for arrays, by a table of slots with linear probing."""

    def __init__(self, pairs: list[tuple[int, int]], merged: list[int]) -> None:
        self.rank_of = {a << 32 | b: r for r, (a, b) in enumerate(pairs)}
        self.merged, self.merged_array = merged, np.array([*merged, 0], dtype=np.int32)
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.key = np.full(1 << self.bits, -1, dtype=np.int64)
        self.rank = np.zeros(1 << self.bits, dtype=np.int64)
        keys, ranks = np.array(list(self.rank_of), dtype=np.int64), np.array(list(self.rank_of.values()), dtype=np.int64)
        slots = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.key[slots] < 0)
            _, first = np.unique(slots[free], return_index=True)
            at = free[first]  # of the keys that want a free slot, one takes it
            self.key[slots[at]], self.rank[slots[at]] = keys[at], ranks[at]
            rest = np.ones(len(keys), dtype=bool)
            rest[at] = False
            keys, ranks, slots = keys[rest], ranks[rest], (slots[rest] + 1) & (len(self.key) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def leaves(self, left: np.ndarray, right: np.ndarray, position: np.ndarray) -> np.ndarray:
        """rank << 32 | position of each pair, NONE where it has no rank or a side is missing (negative)."""
        keys = (left.astype(np.int64) << 32) | right
        slots = self._slot(keys)
        found = self.key[slots]
        out = np.where(found == keys, (self.rank[slots] << 32) | position, NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.key) - 1)
            found = self.key[slots[open_]]
            hit = open_[found == keys[open_]]
            out[hit] = (self.rank[slots[hit]] << 32) | position[hit]
            open_ = open_[(found != keys[open_]) & (found >= 0)]
        out[(left < 0) | (right < 0)] = NONE
        return out


def merge(symbols: list[int], pairs: Pairs) -> list[int]:
    """The symbols of one pre-token after all merges."""
    n = len(symbols)
    if n < 2:
        return symbols
    rank, merged = pairs.rank_of.get, pairs.merged
    width = 1 << (n - 2).bit_length()
    tree = [NONE] * (2 * width)
    for i in range(n - 1):
        r = rank(symbols[i] << 32 | symbols[i + 1])
        if r is not None:
            tree[width + i] = r << 32 | i
    for at in range(width - 1, 0, -1):
        a, b = tree[2 * at], tree[2 * at + 1]
        tree[at] = a if a < b else b
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    while (least := tree[1]) < NONE:
        i = least & 0xFFFFFFFF
        j = after[i]
        k = after[j]
        symbols[i], symbols[j] = merged[least >> 32], -1
        after[i] = k
        if k < n:
            before[k] = i
        for left, right in ((before[i], i), (i, k), (j, n)):  # the last: j begins no pair any more
            if left < 0 or left >= width:
                continue
            value = NONE
            if right < n:
                r = rank(symbols[left] << 32 | symbols[right])
                if r is not None:
                    value = r << 32 | left
            at = width + left
            while tree[at] != value:  # up to the first node that stays as it is
                tree[at] = value
                if at == 1:
                    break
                other = tree[at ^ 1]
                if other < value:
                    value = other
                at >>= 1
    return [s for s in symbols if s >= 0]


def merge_side_by_side(symbols: np.ndarray, pairs: Pairs) -> np.ndarray:
    """As ``merge`` for many pre-tokens, one row each, filled up with -1 behind. Where a symbol was merged
    into the one before it, -1 is left. Every step merges one pair of each row that still has one."""
    words, n = symbols.shape
    if n < 2 or not words:
        return symbols
    width = 1 << (n - 2).bit_length()
    columns, end = width + 2, width + 1  # the last place holds no symbol: what lies before the first and behind the last
    padded = np.full((words, columns), -1, dtype=np.int64)
    padded[:, :n] = symbols
    tree = np.empty((words, 2 * width), dtype=np.int64)
    place = np.tile(np.arange(width), words)
    tree[:, width:] = pairs.leaves(padded[:, :width].ravel(), padded[:, 1 : width + 1].ravel(), place).reshape(words, width)
    for at in range(width - 1, 0, -1):
        tree[:, at] = np.minimum(tree[:, 2 * at], tree[:, 2 * at + 1])
    after = np.tile(np.minimum(np.arange(1, columns + 1), end), words)
    before = np.tile(np.concatenate([[end], np.arange(end)]), words)
    padded, tree = padded.ravel(), tree.ravel()
    rows = np.arange(words)
    while True:
        rows = rows[tree[rows * (2 * width) + 1] < NONE]
        if not len(rows):
            return padded.reshape(words, columns)[:, :n]
        root, own = rows * (2 * width), rows * columns
        least = tree[root + 1]
        i = least & 0xFFFFFFFF
        j = after[own + i]
        k = after[own + j]
        h = before[own + i]
        symbol = pairs.merged_array[least >> 32]
        padded[own + i] = symbol
        padded[own + j] = -1
        after[own + i] = k
        before[own + k] = i
        h_leaf, j_leaf = np.where(h == end, i, h), np.where(j < width, j, i)  # i's leaf is written last
        tree[root + width + j_leaf] = NONE
        tree[root + width + h_leaf] = pairs.leaves(padded[own + h], symbol, h)
        tree[root + width + i] = pairs.leaves(symbol, padded[own + k], i)
        paths = [(width + leaf) >> 1 for leaf in (h_leaf, i, j_leaf)]
        for _ in range(width.bit_length() - 1):
            for p, at in enumerate(paths):
                tree[root + at] = np.minimum(tree[root + 2 * at], tree[root + 2 * at + 1])
                paths[p] = at >> 1


def letters_first(pattern: str) -> str | None:
    """What may stand before letters in a pre-token ("" or " ?") where a pattern takes all letters in a row, as its first
    choice but for strings that begin with an apostrophe; None if it isn't known to."""
    choice = next((x for x in pattern.split("|") if not x.startswith("'")), "")
    return {r"[\p{L}]+": "", r"\p{L}+": "", r" ?\p{L}+": " ?"}.get(choice)


def lowers_ascii(normalizer: dict | None) -> bool:
    """Whether a normalizer makes ASCII letters small and changes no other ASCII character but white space."""
    steps = (normalizer or {}).get("normalizers", [normalizer or {}])
    space = lambda s: s.get("type") == "Replace" and s["pattern"] == {"Regex": r"\s+"}
    return {"type": "Lowercase"} in steps and all(s in ({"type": "Lowercase"}, {"type": "NFC"}) or space(s) for s in steps)


class Vocabulary:
    """A byte-level BPE file of the library ``tokenizers``: its symbols, pair ranks, special
    strings and tokens. White space is either dropped by the pre-tokenizer or part of tokens.
    Without ``special``, special strings are plain text."""

    def __init__(self, path: str, special: bool = True) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("dropout"):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        ids: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters])
        self.last = np.array([ids[c + end] for c in letters])
        parts = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.pairs = Pairs([(ids[a], ids[b]) for a, b in parts], [ids[a + b] for a, b in parts])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any("<" not in s or _space.search(s) for s in self.special):  # what they are looked for by, and cut at
            raise ValueError(f"{path}: a special string without '<' or with white space")
        by_length = sorted(self.special, key=len, reverse=True)
        found = "(" + "|".join(map(regex.escape, by_length)) + ")"
        self.at_special = regex.compile(found) if special and by_length else None
        self.token_of = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.split, self.find = splitter(path), pre_tokens(path)
        self.normalizer = tokenizer(path).normalizer
        self.lowers_ascii = lowers_ascii(spec.get("normalizer"))
        self.letters_first = letters_first(pattern(spec))
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        self.drops_space = any(s["type"] == "Split" and s["behavior"] == "Removed" for s in steps)
        #: A line break is as good as a space where the normalizer makes it one.
        self.joins_lines = self.drops_space and self.normalizer is not None and self.normalizer.normalize_str("\n") == " "
        decoder = spec.get("decoder")
        if decoder and decoder["type"] != "ByteLevel":
            raise ValueError(f"{path}: no decoder of type {decoder['type']}")
        self.joins_bytes = bool(decoder)
        self.byte_of = {c: b for b, c in enumerate(letters)}

    def pre_tokens(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of each pre-token, little-endian unsigned 32-bit."""
        out: dict[str, bytes] = {}
        raws = list(map(str.encode, pieces))
        length = np.fromiter(map(len, raws), np.int64, len(raws))
        for i in np.flatnonzero(length > SIDE_BY_SIDE).tolist():
            symbols = self.inner[np.frombuffer(raws[i], np.uint8)]
            symbols[-1] = self.last[raws[i][-1]]
            out[pieces[i]] = np.array(merge(symbols.tolist(), self.pairs), dtype="<u4").tobytes()
        flat, start = np.frombuffer(b"".join(raws), np.uint8), np.cumsum(length) - length
        low = 0
        while low < SIDE_BY_SIDE:  # trees of one size: of up to 2, 3, 5, 9, ... symbols
            high = min(low + max(low - 1, 1), SIDE_BY_SIDE) if low else 2
            own = np.flatnonzero((length > low) & (length <= high))
            low = high
            if not len(own):
                continue
            lengths = length[own]
            held = np.arange(lengths.max()) < lengths[:, None]
            symbols = np.full(held.shape, -1, dtype=np.int64)
            symbols[held] = self.inner[flat[(start[own, None] + np.arange(lengths.max()))[held]]]
            symbols[np.arange(len(own)), lengths - 1] = self.last[flat[start[own] + lengths - 1]]
            symbols = merge_side_by_side(symbols, self.pairs)
            left = symbols >= 0
            ids, ends = symbols[left].astype("<u4").tobytes(), (np.cumsum(left.sum(axis=1)) * 4).tolist()
            out.update(zip(map(pieces.__getitem__, own.tolist()), map(ids.__getitem__, map(slice, [0, *ends], ends)), strict=True))
        return out

    def splits(self, stretches: list[str]) -> list[str | list[str | int]]:
        """The pre-tokens and special ids of stretches of text; a single pre-token by itself."""
        out: list[str | list[str | int]] = []
        lead = " " if self.letters_first == " ?" else ""
        simple = self.letters_first is not None
        for s, plain in zip(stretches, self._normalised(stretches), strict=True):
            if self.at_special and "<" in s and len(parts := self.at_special.split(s)) > 1:
                own: list[str | int] = []
                for i, part in enumerate(parts):
                    if i % 2:  # what split() kept: a special string
                        own.append(self.special[part])
                    else:
                        own.extend(self.split(part))
                out.append(own)
                continue
            word = plain[1:] if lead and plain[:1] == lead else plain
            if simple and word.isalpha():
                out.append(plain)
            elif simple and word[-1:] in MARKS and word[:-1].isalpha():
                out.append([plain[:-1], plain[-1]])
            else:
                out.append(self.find(plain))
        return out

    def _normalised(self, stretches: list[str]) -> list[str]:
        """What has no white space goes through the library in one string, joined by spaces, which no step of
        a normalizer reaches across."""
        if self.normalizer is None:
            return stretches
        if " ".join(stretches).split() != stretches:
            plain = [s for s in stretches if s and not _space.search(s)]
            done = dict(zip(plain, self._normalised(plain), strict=True))
            return [done[s] if s in done else self.normalizer.normalize_str(s) for s in stretches]
        rest = [s for s in stretches if not s.isascii()] if self.lowers_ascii else stretches
        parts = self.normalizer.normalize_str(" ".join(rest)).split(" ") if rest else []
        if len(parts) != len(rest):
            parts = list(map(self.normalizer.normalize_str, rest))
        if rest is stretches:
            return parts
        other = iter(parts)
        return [s.lower() if s.isascii() else next(other) for s in stretches]

    def decode(self, ids: list[int]) -> str:
        """As the library without skipping special tokens. Without a decoder in the file tokens are
        joined by spaces; a byte-level one joins bytes, wrong UTF-8 becoming U+FFFD."""
        if not self.joins_bytes:
            return " ".join(map(self.token_of.__getitem__, ids))
        return b"".join(map(self.token_bytes, ids)).decode("utf-8", "replace")

    def token_bytes(self, i: int) -> bytes:
        """The bytes that the token of id ``i`` stands for; a special string stands for itself."""
        token = self.token_of[i]
        return token.encode("utf-8") if token in self.special else bytes(map(self.byte_of.__getitem__, token))


def small_ascii(text: str) -> str:
    """The text with small ASCII letters, where a normalizer that makes them small gives the same for both. Not so where
    a capital may stand in a special string, or before a mark that only its small letter is composed with (U+0300 to
    U+036F, whose first byte is 0xCC or 0xCD)."""
    if "<" in text:
        return text
    if text.isascii():
        return text.lower()
    raw = text.encode()
    return text if b"\xcc" in raw or b"\xcd" in raw else raw.lower().decode()


class Encoder:
    """Whole texts to ids, group by group between spaces and line breaks. What a batch needs and is not yet known,
    groups first and then their pre-tokens, is worked out for the whole batch at once."""

    def __init__(self, path: str, special: bool = True) -> None:
        self.vocabulary = v = Vocabulary(path, special)
        #: Whether an ASCII pre-token is as good as the group that it makes alone; then groups' place keeps both.
        self.shared = v.drops_space and v.lowers_ascii
        self.pieces = Recent()
        self.known = {"": Recent(2 if self.shared else 1)}

    def many(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            size, start = 0, at
            while at < len(texts) and size < CHUNK:
                size += len(texts[at])
                at += 1
            out += self._chunk(texts[start:at])
        return out

    def behind_space(self, stretches: list[str]) -> list[bytes]:
        """The ids of space + stretch each; only pre-tokens are kept."""
        texts = [" " + s for s in stretches]
        v = self.vocabulary
        return self.many(texts) if v.lowers_ascii or v.drops_space else self._encoded(texts)

    def _chunk(self, texts: list[str]) -> list[bytes]:
        known, v = self.known[""], self.vocabulary
        if v.lowers_ascii:
            texts = list(map(small_ascii, texts))
        if not v.drops_space:
            return look_up(known, list(map(stretches, texts)), lambda new: self._encoded(list(map(whole, new))))
        if v.joins_lines:
            texts = [t.replace("\n", " ") for t in texts]
        return look_up(known, [t.split(" ") for t in texts], self._encoded)

    def _encoded(self, stretches: list[str]) -> list[bytes]:
        split = self.vocabulary.splits(stretches)
        wanted = {p for own in split if own.__class__ is list for p in own if p.__class__ is str}
        wanted.update(own for own in split if own.__class__ is str)
        self.pieces.turn()
        as_groups = set(filter(str.isascii, wanted)) if self.shared else set()
        ids: dict[str, bytes] = {}
        unseen = []
        for cache, own in ((self.known[""], as_groups), (self.pieces, wanted - as_groups)):
            new = cache.missing(own)
            own.difference_update(new)
            ids.update(zip(own, map(cache.used.__getitem__, own), strict=True))
            unseen.append((cache, new))
        ids.update(self.vocabulary.pre_tokens([p for _, new in unseen for p in new]))
        for cache, new in unseen:
            short = [p for p in new if len(p) <= LONGEST]
            cache.used.update(zip(short, map(ids.__getitem__, short), strict=True))
        return [
            ids[own] if own.__class__ is str else b"".join([ids[p] if p.__class__ is str else p.to_bytes(4, "little") for p in own])
            for own in split
        ]


class Recent:
    """What was looked up lately, in two generations: once the younger has half of ``CACHE`` entries (of ``kinds``
    times ``CACHE``) it becomes the older, whose entries go with the next turn unless they are used again."""

    def __init__(self, kinds: int = 1) -> None:
        self.kinds = kinds
        self.used: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def __len__(self) -> int:
        return len(self.used) + len(self.before)

    def turn(self) -> None:
        if len(self.used) > CACHE * self.kinds // 2:
            self.used, self.before = {}, self.used

    def missing(self, wanted) -> list[str]:
        """Those of ``wanted`` that are to be worked out, each once; all others are in ``used`` then."""
        new = set(filterfalse(self.used.__contains__, wanted))
        again = new & self.before.keys()
        self.used.update((k, self.before[k]) for k in again)
        return list(new - again)

    def forget(self, new: list[str]) -> None:
        """Long entries aren't kept."""
        for key in [key for key in new if len(key) > LONGEST]:
            del self.used[key]


def look_up(known: Recent, lists: list[list[str]], encoded) -> list[bytes]:
    """The joined ids of each list of groups; those not ``known`` come from ``encoded`` in one call. A known group
    is looked up once."""
    known.turn()
    flat = list(chain.from_iterable(lists))
    ids = list(map(known.used.get, flat))
    lacking = [i for i, own in enumerate(ids) if own is None]
    if lacking:
        groups = list(map(flat.__getitem__, lacking))
        new = known.missing(groups)
        if new:
            known.used.update(zip(new, encoded(new), strict=True))
        for i, own in zip(lacking, map(known.used.__getitem__, groups), strict=True):
            ids[i] = own
        known.forget(new)
    ends = list(accumulate(map(len, lists)))
    return [b"".join(ids[start:end]) for start, end in zip([0, *ends], ends)]


def _batches(rows, names, types):
    """Record batches of the tuples ``rows``, each of about BATCH_BYTES at most (or one row). The lengths of
    the last field count."""
    held, size = [], 0
    for row in chain(rows, [None]):
        if row is not None:
            held.append(row)
            size += len(row[-1])
        if held and (row is None or size >= BATCH_BYTES):
            columns = zip(zip(*held, strict=True), types, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)
            held, size = [], 0


def slices(batch: pa.RecordBatch):
    """The rows of a batch (doc_id, text) as lists of ids and of texts, of about CHUNK code points each."""
    ids, texts, size = [], [], 0
    for i, text in zip(batch.column(0), batch.column(1), strict=True):
        ids.append(i.as_py())
        texts.append(text.as_py())
        size += len(texts[-1])
        if size >= CHUNK:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) for every row of ``docs``; with ``decoded`` also the ids'
    text as ``decode`` gives it, in the same pass.

    ``path``: a byte-level BPE file of ``tokenizers``. Ids are the library's without added special
    tokens, truncation or padding; special strings in a text become their ids. Null and empty texts have
    no ids. Rows that repeat are encoded each, other columns are ignored, an empty table gives no rows.
    """
    names, types = ["doc_id", "ids"], [pa.int64(), pa.binary()]

    def run(batches):
        encoder = common.kept("bpe", path, lambda: Encoder(path))
        pieces = ((i, ids) for b in batches for own, texts in slices(b) for i, ids in zip(own, encoder.many(texts), strict=True))
        if not decoded:
            yield from _batches(pieces, names, types)
        else:
            back = ((i, ids, _text(encoder.vocabulary, ids)) for i, ids in pieces)
            yield from _batches(back, [*names, "decoded"], [*types, pa.string()])

    schema = "doc_id long, ids binary" + ", decoded string" * decoded
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def _text(vocabulary: Vocabulary, ids: bytes | None) -> str:
    return vocabulary.decode(np.frombuffer(ids or b"", "<u4").tolist())


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded for every row of (doc_id, ids); null or empty ids are an empty text. An id that
    the vocabulary lacks raises."""

    def run(batches):
        vocabulary = common.kept("bpe", path, lambda: Encoder(path)).vocabulary
        for b in batches:
            rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
            texts = ((i, ids, _text(vocabulary, ids)) for i, ids in rows)
            yield from _batches(texts, ["doc_id", "ids", "decoded"], [pa.int64(), pa.binary(), pa.string()])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded string")


def op12_bpe_round_trip(spark, sf_dir) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``documents``. Encoded and decoded in one
    pass, which saves a second Python worker for each task."""
    texts = encode(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), decoded=True)
    return texts.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
