"""Alignment of two tokenizers' tokens over the bytes of a text, by pointer jumping.

Both tokenizers cut the same bytes. Every token points to the token of the other side
that overlaps it and reaches farthest right, or to itself if none reaches farther; the
pointers of a batch of texts are doubled at once (``succ = succ[succ]``) until they stay,
and then name the last token of each token's component. A component ends where both
sides end, so texts that follow each other in a batch never share one.

Both sides cut a text at the same places first, where a space follows something else than
white space, and no token of either reaches over one. A batch of texts is so a list of
stretches, most of which come often: each is encoded and aligned once a batch, and a text's
row is put together from those of its stretches.

An id pair's count needs the whole corpus. Counts come from one aggregation of the
documents' distinct pairs; the frequent ones, at most ``HOT_PAIRS``, are looked up in a
broadcast table, and only the rest is joined by a shuffle. What is left for the join has
counts below that of every broadcast pair, so no key of it can hold a large share.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from itertools import chain, count

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .bpe import Encoder, Recent
from .token_counts import groups

#: Bytes of text (as counted in code points) that are aligned at once in a task.
CHUNK = 1 << 20
#: Pairs in the broadcast table at most: 17 bytes each.
HOT_PAIRS = 1 << 18
#: A group of more links than this is expanded over its distinct ids.
WIDE = 4096

SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, a array<int>, b array<int>, times array<long>"


class Side:
    """One tokenizer over space + stretch: stretches to ids (little-endian 32-bit), the bytes of each id, and the ids
    as text with what may follow them. ``cuts``: no token reaches from one stretch into the next."""

    def __init__(self, encode, token_bytes: list[bytes], cuts: bool = True) -> None:
        self.encode, self.bytes, self.cuts = encode, token_bytes, cuts
        self.length = np.array([len(x) for x in token_bytes], dtype=np.int64)
        self.then = {c: np.array([f"{i}{c}" for i in range(len(token_bytes))], dtype=object) for c in ",|;"}

    def tokens(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all stretches, one after another, and how many each has."""
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), "<u4").astype(np.int64), n

    def joined(self, tokens: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, tokens.tolist()))

    def exact(self, tokens: np.ndarray, n: np.ndarray, want: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether each stretch's tokens (``n`` of them) join to its own of the bytes ``want`` (``size`` of them)."""
        sizes = _sums(self.length[tokens], np.cumsum(n))
        same = sizes == size
        got = np.frombuffer(self.joined(tokens), np.uint8)
        wrong = np.flatnonzero(got[np.repeat(same, sizes)] != want[np.repeat(same, size)])
        same[np.searchsorted(np.cumsum(size * same), wrong, "right")] = False
        return same


def byte_level(path: str) -> Side:
    """A byte-level BPE of ``tokenizers``; special strings are plain text."""
    encoder = Encoder(path, special=False)
    v = encoder.vocabulary
    known = [v.token_bytes(i) if i in v.token_of else b"" for i in range(max(v.token_of) + 1)]
    return Side(encoder.behind_space, known)


def sentence_pieces(path: str) -> Side:
    """A sentencepiece model, which adds the space itself. No piece of a vocabulary without spaces inside pieces
    reaches from a character over a space; with another vocabulary, texts are encoded whole."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    known = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]
    ids = lambda found: struct.pack(f"<{len(found)}I", *found)
    cuts = not any("\u2581" in p.lstrip("\u2581") for p in pieces)
    space = ids([sp.piece_to_id("\u2581")])

    def encoded(new: list[str]) -> list[bytes]:  # an empty stretch is a single space, which no text stands for
        return [ids(x) if g else space for g, x in zip(new, sp.encode(new, num_threads=1), strict=True)]

    return Side(encoded, known, cuts)


def components(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For tokens that end at these bytes (ascending, both up to the same last byte): the number of the
    component of each A token and each B token, from 0 in order."""
    n = len(ends_a)
    over = np.searchsorted(ends_b, ends_a)  # the B token that holds an A token's last byte
    back = np.searchsorted(ends_a, ends_b)
    own = n + np.arange(len(ends_b))
    succ = np.concatenate([n + over, np.where(ends_a[back] > ends_b, back, own)])
    while True:
        farther = succ[succ]
        if np.array_equal(farther, succ):
            break
        succ = farther
    last, label = np.unique(succ[n:], return_inverse=True)
    return np.searchsorted(last, succ[:n]), label


def _links(a, b, group_a, group_b, doc_of_group):
    """The linked id pairs as (doc, a, b, times), each once a document, ordered by document."""
    groups = len(doc_of_group)
    count_a, count_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    start_a, start_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
    wide = count_a * count_b > WIDE
    narrow = ~wide[group_a]
    reach = count_b[group_a[narrow]]
    first = np.cumsum(reach) - reach
    other = np.arange(reach.sum()) - np.repeat(first - start_b[group_a[narrow]], reach)
    found = [(np.repeat(doc_of_group[group_a[narrow]], reach), np.repeat(a[narrow], reach), b[other], np.ones(len(other), np.int64))]
    for g in np.flatnonzero(wide):
        x, times_x = np.unique(a[start_a[g] : start_a[g] + count_a[g]], return_counts=True)
        y, times_y = np.unique(b[start_b[g] : start_b[g] + count_b[g]], return_counts=True)
        n = len(x) * len(y)
        found.append((np.full(n, doc_of_group[g]), np.repeat(x, len(y)), np.tile(y, len(x)), np.outer(times_x, times_y).ravel()))
    doc, x, y, times = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((y, x, doc))
    doc, x, y, times = doc[order], x[order], y[order], times[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    at = np.flatnonzero(new)
    return doc[at], x[at], y[at], np.add.reduceat(times, at)


def _written_groups(a, b, group_a, group_b, side_a: Side, side_b: Side) -> np.ndarray:
    """The tokens of both sides in the order of their groups, as text with the sign that follows each."""
    groups = int(group_b[-1]) + 1
    end_a, end_b = np.cumsum(np.bincount(group_a, minlength=groups)), np.cumsum(np.bincount(group_b, minlength=groups))
    out = np.empty(len(a) + len(b), dtype=object)
    place_a = np.arange(len(a)) + (end_b - np.bincount(group_b, minlength=groups))[group_a]
    place_b = np.arange(len(b)) + end_a[group_b]
    out[place_a], out[place_b] = side_a.then[","][a], side_b.then[","][b]
    out[place_a[end_a - 1]] = side_a.then["|"][a[end_a - 1]]
    out[place_b[end_b - 1]] = side_b.then[";"][b[end_b - 1]]
    return out


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (n[0] numbers), then those from start[1] on, ..."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) + np.repeat(start - (ends - n), n)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sum of the values up to each end, from the end before."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], ends])])


def _encoded(stretches: list[str], side_a: Side, side_b: Side, known: Recent) -> tuple:
    """The ids of different stretches by both sides; ``known`` keeps those of short ones."""
    known.turn()
    new = known.missing(stretches)
    if new:
        known.used.update(zip(new, zip(side_a.encode(new), side_b.encode(new), strict=True), strict=True))
    found = list(map(known.used.__getitem__, stretches))
    known.forget(new)
    return tuple(zip(*found, strict=True)) or ((), ())


def _chunk(ids: list, texts: list[str], side_a: Side, side_b: Side, known: Recent) -> pa.RecordBatch:
    n = len(texts)
    cut = side_a.cuts and side_b.cuts
    lists = [(groups(" " + t)[1] if cut else [t]) if t else [] for t in texts]
    number = defaultdict(count().__next__)  # of each different stretch, in the order they come
    parts = np.array(list(map(number.__getitem__, chain.from_iterable(lists))), np.int64)
    ends = np.cumsum(np.fromiter(map(len, lists), np.int64, n))
    stretches = list(number)
    found = _encoded(stretches, side_a, side_b, known)
    sides = [(side, *side.tokens(own)) for side, own in zip((side_a, side_b), found, strict=True)]
    raw = list(map(str.encode, stretches))
    size = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    want = np.frombuffer(b"".join([b" ", b" ".join(raw)])[: int(size.sum())], np.uint8)
    exact = np.logical_and(*(side.exact(tokens, of, want, size) for side, tokens, of in sides))
    has = ends > np.concatenate([[0], ends[:-1]])
    same = has & (_sums(~exact[parts], ends) == 0)
    stops = [np.cumsum(of) for _, _, of in sides]
    # a text whose stretches aren't all exact may still be so as a whole: then it is one stretch
    for i in np.flatnonzero(has & ~same).tolist():
        own = parts[ends[i] - len(lists[i]) : ends[i]]
        starts = [stop[own] - of[own] for stop, (_, _, of) in zip(stops, sides, strict=True)]
        whole = [tokens[_ranges(start, of[own])] for start, (_, tokens, of) in zip(starts, sides, strict=True)]
        length = size[own].sum()
        if any(side.length[w].sum() != length for w, (side, _, _) in zip(whole, sides, strict=True)):
            continue
        if all(side.joined(w) == (" " + texts[i]).encode() for w, (side, _, _) in zip(whole, sides, strict=True)):
            sides = [(x, np.append(tokens, w), np.append(of, len(w))) for w, (x, tokens, of) in zip(whole, sides, strict=True)]
            same[i], exact = True, np.append(exact, True)
            parts[ends[i] - len(own) : ends[i]] = -1
            parts[ends[i] - 1] = len(exact) - 1
    (_, a, a_of), (_, b, b_of) = ((side, t[np.repeat(exact, of)], of * exact) for side, t, of in sides)
    doc_of = np.repeat(np.arange(n), np.diff(np.concatenate([[0], ends])))
    held = same[doc_of] & (parts >= 0)
    parts, doc_of = parts[held], doc_of[held]
    ends = np.searchsorted(doc_of, np.arange(n), "right")
    n_a, n_b = _sums(a_of[parts], ends), _sums(b_of[parts], ends)
    n_groups, n_links, written = np.zeros(n, np.int64), np.zeros(n, np.int64), [""] * n
    doc = x = y = times = np.zeros(0, np.int64)
    if len(parts):
        group_a, group_b = components(np.cumsum(side_a.length[a]), np.cumsum(side_b.length[b]))
        part_of_group = np.zeros(int(group_b[-1]) + 1, np.int64)
        part_of_group[group_a] = np.repeat(np.arange(len(exact)), a_of)
        n_groups = _sums(np.bincount(part_of_group, minlength=len(exact))[parts], ends)
        doc, x, y, times = _of_texts(parts, doc_of, *_links(a, b, group_a, group_b, part_of_group), len(exact))
        np.add.at(n_links, doc, times)
        out = _written_groups(a, b, group_a, group_b, side_a, side_b).tolist()
        stop = np.cumsum(a_of + b_of).tolist()
        texts_of = ["".join(out[i:j]) for i, j in zip([0, *stop], stop)]
        start = 0
        for i, end in enumerate(ends.tolist()):
            if end > start:
                written[i] = "".join(map(texts_of.__getitem__, parts[start:end].tolist()))[:-1]
            start = end
    offsets = pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v, t)) for v, t in ((x, pa.int32()), (y, pa.int32()), (times, pa.int64()))]
    columns = [pa.array(ids, pa.int64()), *map(pa.array, (n_a, n_b, n_groups, n_links)), pa.array(written, pa.string()), *lists]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])


def _of_texts(parts, doc_of, part, a, b, times, n_parts: int):
    """The linked id pairs of stretches, (part, a, b, times) ordered by part, as those of the texts that hold the
    stretches: (doc, a, b, times), each once a document, ordered by document."""
    held, often = np.unique(doc_of * n_parts + parts, return_counts=True)  # a stretch that a text repeats counts so often
    doc, own = np.divmod(held, n_parts)
    start = np.searchsorted(part, np.arange(n_parts + 1))
    n = np.diff(start)[own]
    at = _ranges(start[own], n)
    doc, a, b, times = np.repeat(doc, n), a[at], b[at], times[at] * np.repeat(often, n)
    base = int(b.max()) + 1
    pair = (doc * (int(a.max()) + 1) + a) * base + b  # well below 2**63: CHUNK / 64 texts, ids of some 17 bits
    order = np.argsort(pair)
    pair = pair[order]
    at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    first = order[at]
    return doc[first], a[first], b[first], np.add.reduceat(times[order], at)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """For every row of ``docs``: doc_id, n_a, n_b (tokens), n_groups, n_links, groups (``a1,a2|b1;a3|b2``),
    and the linked id pairs a, b with their numbers of links, each pair once.

    A is a byte-level BPE of ``tokenizers`` over space + text, B a sentencepiece model over the text. Null and
    empty texts, and texts whose bytes either side changes, have no tokens: zeros, '' and no pairs. Rows that
    repeat are aligned each, other columns are ignored, an empty table gives no rows. A task holds the tokens
    of about ``CHUNK`` code points, or of one longer text.
    """

    def run(batches):
        sides = common.kept("align", (path_a, path_b), lambda: (byte_level(path_a), sentence_pieces(path_b), Recent()))
        for batch in batches:
            ids, texts, size = [], [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(text)
                size += len(text) + 64
                if size >= CHUNK:
                    yield _chunk(ids, texts, *sides)
                    ids, texts, size = [], [], 0
            if ids:
                yield _chunk(ids, texts, *sides)

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n (rows that hold the pair linked), best (no other b has more rows with this a)."""
    pairs = aligned.select(F.explode(F.arrays_zip("a", "b")).alias("p")).select("p.a", "p.b")
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    top = F.max("n").over(Window.partitionBy("a"))  # at most B's vocabulary in a group
    return counts.withColumn("best", F.col("n") == top)


def _frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The most frequent pairs, at most ``limit``: all from a class of counts on. Found by a histogram
    of classes, so nothing is sorted."""
    level = F.floor(F.log2("n") * 16).cast("int")  # at most 1,024 classes
    classes = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("pairs")).collect()
    total, least = 0, None
    for c in sorted(classes, reverse=True):
        total += c["pairs"]
        if total > limit:
            break
        least = c["level"]
    return counts.where(F.lit(False) if least is None else level >= least)


def score(aligned: DataFrame, counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``aligned`` (with a unique ``row``) without its pairs, and n_best (links whose pair is best for its
    a) and count_sum (over links). The result is the same for every ``hot_pairs``."""
    table = _frequent(counts, hot_pairs).select("a", "b", "n", "best").toArrow()
    code = (table["a"].to_numpy().astype(np.int64) << 32) | table["b"].to_numpy()
    order = np.argsort(code)
    n, best = table["n"].to_numpy()[order], table["best"].to_numpy().astype(np.int64)[order]
    shared = aligned.sparkSession.sparkContext.broadcast((code[order], n, best))

    def look_up(batches):
        code, n, best = shared.value
        for batch in batches:
            a, b, times = (batch.column(i) for i in (1, 2, 3))
            offsets = a.offsets.to_numpy() - a.offsets[0].as_py()
            doc = np.repeat(np.arange(len(a)), np.diff(offsets))
            a, b, times = (x.flatten().to_numpy() for x in (a, b, times))
            want = (a.astype(np.int64) << 32) | b
            at = np.minimum(np.searchsorted(code, want), max(len(code) - 1, 0))
            hit = code[at] == want if len(code) else np.zeros(len(want), dtype=bool)
            sums = np.zeros((2, len(offsets) - 1), np.int64)
            np.add.at(sums[0], doc[hit], times[hit] * best[at[hit]])
            np.add.at(sums[1], doc[hit], times[hit] * n[at[hit]])
            left = ~hit
            kept_to = pa.array(np.concatenate([[0], np.cumsum(left)])[offsets], pa.int32())
            lists = [pa.ListArray.from_arrays(kept_to, pa.array(x[left])) for x in (a, b, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, sums), *lists], ["row", "n_best", "count_sum", "a", "b", "times"])

    first = "row long, n_best long, count_sum long, a array<int>, b array<int>, times array<long>"
    looked_up = common.written(aligned.select("row", "a", "b", "times").mapInArrow(look_up, first), "hot-links")
    rest = looked_up.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("p")).select("row", "p.*")
    rest = rest.join(counts, ["a", "b"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_links"), F.sum(F.col("times") * F.col("n")).alias("links")
    )
    sums = looked_up.select("row", "n_best", "count_sum").join(rest, "row", "left")
    sums = sums.select(
        "row",
        (F.col("n_best") + F.coalesce("best_links", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("links", F.lit(0))).alias("count_sum"),
    )
    return aligned.drop("a", "b", "times").join(sums, "row").drop("row")


def op13_cross_tokenizer_alignment(spark, sf_dir) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``documents``."""
    aligned = align(
        common.table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    links = aligned.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "a", "b", "times"
    )
    links = common.written(links, "links")
    counts = common.written(pair_counts(links), "pair-counts")
    return score(links, counts)
