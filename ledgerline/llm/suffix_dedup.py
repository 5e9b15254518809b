"""Exact substring removal by distributed prefix doubling over sparse positions.

A byte goes when a ``width``-byte string that covers it also starts elsewhere. The
names (ranks) of strings grow by doubling: first those of ``width/2`` bytes, then the
pairs (name at p, name at p + width/2), which name ``width`` bytes. Spark counts the
names; a position whose name is unique drops out, and the doubling ends at the
threshold.

Sorting all positions of 100 TB is out of reach, so positions enter by *anchors*:
every ``width``-byte window picks the position with the least hash of its next 16
bytes among its first ``width/2 + 1``, leftmost at ties. Equal windows pick the same
anchor at the same offset, so a window can only repeat if the ``width/2`` bytes at
its anchor do. Neighbouring windows share an anchor:

1. ``anchors``: one row for each run of windows with one anchor: the name of the half
   window at the anchor, and the name of the run's whole string.
2. Runs whose half window is unique drop out (no window there repeats).
3. Runs whose whole string occurs twice are settled: all their windows repeat.
4. The others, the ends of repeated stretches, are cut into pieces of up to ``PIECE``
   windows; a piece stays if what all its windows share repeats. Then their windows are
   counted one by one. Names here are pairs of half-window names. One run of each settled
   string that shares a half window with an unsettled run is taken along, as two.

Names are 64-bit polynomial hashes of a string, so they need no global sort; what is
decided rests on two of them (128 bits). Any block of a long text is scanned alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BLOCK = 1 << 18
PIECE = 8
_U = np.uint64
_M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_BASE = 0x5851F42D4C957F2D


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(31))
    x = x * _M1
    x = x ^ (x >> _U(29))
    return x * _M2


class Names:
    """Hashes of any substring of a block, from prefix sums of byte weights times powers."""

    weight = _mix(np.arange(1, 257, dtype=_U) * _M2)
    power = np.ones(1, dtype=_U)
    inverse = np.ones(1, dtype=_U)

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.power) <= n:
            steps = np.full(max(n, 1 << 12), _U(_BASE))
            back = np.full(len(steps), _U(pow(_BASE, -1, 1 << 64)))
            cls.power = np.concatenate([np.ones(1, dtype=_U), np.cumprod(steps)])
            cls.inverse = np.concatenate([np.ones(1, dtype=_U), np.cumprod(back)])

    def __init__(self, block: bytes) -> None:
        n = len(block)
        self.reach(n)
        self.sums = np.zeros(n + 1, dtype=_U)
        np.cumsum(self.weight[np.frombuffer(block, dtype=np.uint8)] * self.power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def _runs(block: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a block of at least ``width`` bytes, with first and last window of each."""
    half, m = width // 2, len(block) - width // 2 + 1
    words = np.ndarray((len(block) - 7,), dtype="<u8", buffer=block, strides=(1,))
    h = words[:m] * _M1 + words[8 : 8 + m] * _M2
    h ^= h >> _U(29)
    h *= _M1
    least = (h & _U(0xFFFFFFFFFF000000)) | np.arange(m, dtype=_U)  # hash, then position
    span, step = width - half + 1, 1
    while step * 2 <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < span:
        least = np.minimum(least[: -(span - step)], least[span - step :])
    at = (least & _U(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    return at[first], first, last


def _blocks(text: bytes, width: int) -> Iterator[tuple[int, bytes]]:
    """Each window is in exactly one block."""
    for i in range(0, max(len(text) - width + 1, 0), BLOCK):
        yield i, text[i : i + BLOCK + width - 1]


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == _U else x.astype(np.int64))


def _anchor_rows(width: int):
    half = width // 2

    def run(batches):
        for b in batches:
            parts = []
            for key, text in zip(b.column("k").to_pylist(), b.column("bytes").to_pylist(), strict=True):
                for start, block in _blocks(text, width):
                    at, first, last = _runs(block, width)
                    names = Names(block)
                    whole = names.of(first, last + width) + (last - first).astype(_U) * _M1
                    whole = _mix(whole + (at - first).astype(_U) * _M2)
                    place = ((at + start) << 16) | ((at - first) << 8) | (at - last)
                    parts.append((names.of(at, at + half), whole, np.full(len(at), key), place))
            if parts:
                cols = [_i64(np.concatenate(c)) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, ["half", "whole", "k", "place"])

    return run


def _pieces(place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs cut into pieces of at most ``size`` windows, at offsets from the anchor that are multiples
    of it, and the last window that a whole piece would have."""
    place = np.unique(place)
    at, far, near = place >> 16, place >> 8 & 255, place & 255
    low = near // size
    n = far // size - low + 1
    j = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
    at, far, near = (np.repeat(x, n) for x in (at, far, near))
    far, near = np.minimum(far, j * size + size - 1), np.maximum(near, j * size)
    return (at << 16) | (far << 8) | near, at - j * size


def _piece_rows(width: int, size: int):
    """Names of what the windows of each piece have in common, for a document's unsettled runs (n = 1)
    and its samples of settled ones (n = 2)."""
    half, long = width // 2, width - size + 1

    def run(batches):
        for b in batches:
            parts = []
            for key, text, *places in zip(
                b.column("k").to_pylist(), b.column("bytes").to_pylist(), b.column("ends"), b.column("samples"), strict=True
            ):
                cut = [_pieces(x.values.to_numpy(), size) for x in places]
                n = np.repeat([1, 2], [len(p) for p, _ in cut])
                place, start = (np.concatenate(x) for x in zip(*cut, strict=True))
                order = np.argsort(start, kind="stable")
                n, place, start = n[order], place[order], start[order]
                for block in range(0, len(text), BLOCK):
                    own = slice(*np.searchsorted(start, [block, block + BLOCK]))
                    p = start[own] - block
                    if len(p):
                        names = Names(text[block : block + BLOCK + width - 1])
                        pair = names.of(p, p + half), names.of(p + long - half, p + long)
                        parts.append((*pair, np.full(len(p), key), place[own], n[own]))
            if parts:
                cols = [_i64(np.concatenate(c)) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, ["name", "next", "k", "place", "n"])

    return run


def _spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of the half-open ranges, ends that touch merged."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], reach[np.concatenate([new[1:], [True]])]


def _cut(width: int):
    def run(batches):
        for b in batches:
            out = []
            for text, runs, ends in zip(
                b.column("bytes").to_pylist(), b.column("runs"), b.column("windows"), strict=True
            ):
                none = np.zeros(0, dtype=np.int64)
                place = none if runs.values is None else runs.values.to_numpy()
                p = none if ends.values is None else ends.values.to_numpy()
                place = np.concatenate([place, p])
                at = place >> 16
                lo, hi = _spans(at - (place >> 8 & 255), at - (place & 255) + width)
                kept, done = [], 0
                for x, y in zip(lo.tolist(), hi.tolist(), strict=True):
                    kept.append(text[done:x])
                    done = y
                kept = b"".join([*kept, text[done:]])
                spans = [{"start": x, "end": y} for x, y in zip(lo.tolist(), hi.tolist(), strict=True)]
                out.append((len(text), len(text) - len(kept), len(lo), hashlib.sha256(kept).hexdigest(), kept, spans))
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), SPANS]
            cols = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", *names]
            )

    return run


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def dedup(docs: DataFrame, width: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes), spans (removed byte ranges).

    Whole texts as UTF-8 bytes; strings never cross documents; a null text is empty; texts
    under ``width`` bytes lose nothing. A repeated row is a document of its own, so both
    lose what they share. Columns besides doc_id and text are ignored. ``width``: even, 32 to 400.
    """
    if width % 2 or not 32 <= width <= 400:
        raise ValueError("width must be even, 32 to 400")
    spark = docs.sparkSession
    texts = docs.select(
        "doc_id", common.row_key().alias("k"), F.coalesce("text", F.lit("")).cast("binary").alias("bytes")
    )
    rows = "half long, whole long, k long, place long"
    anchors = texts.select("k", "bytes").where(F.length("bytes") >= width).mapInArrow(_anchor_rows(width), rows)
    shared = common.written(common.repeated(anchors, ["half"]), "shared")
    groups = shared.groupBy("half", "whole").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "place")).alias("first")
    )
    groups = common.written(groups, "groups")
    open_halves = groups.where("n = 1").select("half").distinct().withColumn("is_open", F.lit(True))
    settled = groups.where("n > 1").join(open_halves, "half", "left").drop("n")
    this = F.struct("k", "place")
    per_doc = common.written(
        shared.join(settled, ["half", "whole"], "left")
        .groupBy("k")
        .agg(
            F.collect_list(F.when(F.col("first").isNotNull(), F.col("place"))).alias("runs"),
            F.collect_list(F.when(F.col("first").isNull(), F.col("place"))).alias("ends"),
            F.collect_list(F.when(F.col("is_open") & (F.col("first") == this), F.col("place"))).alias("samples"),
        ),
        "runs",
    )
    left = per_doc.where("size(ends) > 0 or size(samples) > 0").drop("runs")
    for size in (PIECE, 1):
        # a repeated row counts as often as it occurs: the join keeps each of its rows
        pieces = (
            texts.select("k", "bytes")
            .join(left, "k")
            .mapInArrow(_piece_rows(width, size), "name long, next long, k long, place long, n long")
        )
        twice = pieces.groupBy("name", "next").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
        found = pieces.where("n = 1" if size == 1 else "true").join(twice, ["name", "next"], "left_semi")
        found = found.groupBy("k").agg(
            F.collect_set(F.when(F.col("n") == 1, F.col("place"))).alias("ends"),
            F.collect_set(F.when(F.col("n") == 2, F.col("place"))).alias("samples"),
        )
        left = common.written(found, "pieces")
    found = left.select("k", F.col("ends").alias("windows"))
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start: long, end: long>>"
    return (
        texts.join(per_doc.select("k", "runs"), "k", "left").join(found, "k", "left").drop("k").mapInArrow(_cut(width), out)
    )


def op1_suffix_dedup(spark, sf_dir) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
