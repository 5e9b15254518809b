"""Bottom-k sketches of word shingles.

A fingerprint is the k least of the distinct hashes of a document's shingles of five
words (white space separates words). Fingerprints merge across parts of a corpus: the k
least of their union. From them follow resemblance, containment and distinct counts.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, shingles

K = 128


def sketch(text: str, k: int, cache: shingles.WordHashes) -> np.ndarray:
    h = shingles.of(shingles.word_hashes(text.split(), cache))
    if len(h) > 8 * k:  # what lies far above the k-th least can't be among them
        near = h[h <= np.partition(h, 4 * k)[4 * k]]
        u = np.unique(near)
        if len(u) >= k:
            return u[:k]
    return np.unique(h)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct(a: np.ndarray, k: int) -> float:
    """Estimate of the number of distinct shingles; exact under k."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**64 / (float(a[-1]) + 1)


def resemblance(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimate of the Jaccard similarity: the share of the union's k least that both have.
    1 for two empty sets."""
    if not len(a) and not len(b):
        return 1.0
    least = merge(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return len(np.intersect1d(least, both, assume_unique=True)) / len(least)


def containment(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimate of the share of a's shingles that b has; 1 for an empty a."""
    if not len(a):
        return 1.0
    r = resemblance(a, b, k)
    both = r * distinct(merge(a, b, k), k)
    return min(1.0, both / distinct(a, k))


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def decode(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), dtype=">u8").astype(np.uint64)


def fingerprint(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, fingerprint (base64 of big-endian hashes, ascending) and distinct (estimated number of
    shingles) of every row; null texts are empty, with an empty fingerprint."""

    def run(batches):
        cache = shingles.kept_words()
        for b in batches:
            found = [sketch(s, k, cache) for s in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(map(encode, found), pa.string()), pa.array([distinct(a, k) for a in found], pa.float64())],
                ["doc_id", "fingerprint", "distinct"],
            )

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, fingerprint string, distinct double"
    )


def _bounds(docs: DataFrame, parts: int) -> list[int]:
    """Least doc_id of each part that has documents, ascending; about as many documents in each."""
    at = docs.where("doc_id is not null").stat.approxQuantile("doc_id", [i / parts for i in range(parts)], 1 / (4 * parts))
    return sorted({int(x) for x in at or []})


def with_next(docs: DataFrame, parts: int | None = None, k: int = K) -> DataFrame:
    """Each document beside its edited text and the next document by ascending doc_id.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The
    edited text has its last quarter replaced by as many code points of the next document's
    start; the first document follows the last. Null texts are empty; null ids come first; rows
    with one id follow each other by a hash of their text. A single document is followed by itself.

    Ranges of ids are parts, by bounds that are values, so the same rows meet again if a task
    is run again. The first document of a part goes to the part before as well.
    """
    spark = docs.sparkSession
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(docs, parts)

    def place(batches):
        low = np.array(bounds[1:], dtype=np.int64)
        for b in batches:
            ids = b.column("doc_id").fill_null(-(2**63)).to_numpy(zero_copy_only=False)
            yield b.append_column("part", pa.array(np.searchsorted(low, ids, side="right"), pa.int64()))

    placed = own.mapInArrow(place, "doc_id long, text string, part long")
    # part -> its first document, as (is not null, id, hash of the text): one entry for each part
    order = F.struct(F.col("doc_id").isNotNull().alias("has"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("h"))
    firsts = {r[0]: tuple(r[1]) for r in placed.groupBy("part").agg(F.min(order)).collect()}
    full = sorted(firsts)
    guests = [(*firsts[p], full[i - 1], i == 0) for i, p in enumerate(full)]
    guests = spark.createDataFrame(guests, "has boolean, id long, h long, to long, wraps boolean")
    keyed = placed.select("doc_id", "text", "part", order.alias("o")).select("doc_id", "text", "part", "o.*")
    visits = (
        keyed.join(F.broadcast(guests), ["has", "id", "h"])  # one row for each part
        .select("doc_id", "text", F.col("to").alias("part"), "has", "id", "h", F.lit(True).alias("guest"), "wraps")
        .dropDuplicates(["part", "wraps"])
    )
    rows = keyed.select("doc_id", "text", "part", "has", "id", "h", F.lit(False).alias("guest"), F.lit(False).alias("wraps"))
    rows = rows.unionByName(visits)
    rows = rows.repartition(parts, "part").sortWithinPartitions("part", "guest", "has", "id", "h")

    def run(batches):
        cache = shingles.kept_words()
        held = None  # the last document with its sketch, still without its next

        def done(doc_id, text, own, following, next_own):
            n = len(text) // 4
            edited = text[: len(text) - n] + following[:n]
            changed = sketch(edited, k, cache)
            return (
                doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), encode(own), encode(changed),
                resemblance(own, changed, k), resemblance(own, next_own, k),
            )

        for b in batches:
            out = []
            for part, doc_id, text, guest in zip(
                *(b.column(c).to_pylist() for c in ("part", "doc_id", "text", "guest")), strict=True
            ):
                this = sketch(text, k, cache)
                if held and held[0] == part:
                    out.append(done(*held[1:], text, this))
                held = None if guest else (part, doc_id, text, this)
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            cols = list(zip(*out, strict=True)) or [()] * len(NEXT)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], NEXT)

    return rows.select("part", "doc_id", "text", "guest").mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


NEXT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def op7_bottom_k_fingerprints(spark, sf_dir) -> DataFrame:
    return with_next(common.table(spark, sf_dir, "documents"))
