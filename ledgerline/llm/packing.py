"""Best-fit packing planned over the histogram of lengths.

Best fit runs over counts, not documents: for each length from the longest, all pieces
of it go at once to the fullest sequences that take them. The plan is a list of
placements (length, first rank, count, first sequence, offset) of a size that depends
on the number of lengths alone; each piece then takes the slot of its rank within its
length. Ranks come from per-bucket row numbers plus the counts of earlier buckets, so a
length that a third of all pieces have is not ranked in one task.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .bpe import Encoder, slices

BUCKETS = 256


def plan(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first sequence, offset): piece of rank r, first rank <= r <
    first rank + count, goes to sequence first sequence + r - first rank."""
    out, opened = [], 0
    rooms: list[int] = []  # distinct free rooms, ascending
    open_bins: dict[int, list[tuple[int, int]]] = {}  # free room: runs of (first sequence, count)

    def put_back(room: int, start: int, n: int) -> None:
        if room and n:
            if room not in open_bins:
                open_bins[room] = []
                insort(rooms, room)
            open_bins[room].append((start, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect_left(rooms, length)
            if k < len(rooms):  # the least room that takes it
                room = rooms[k]
                start, n = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[k]
                used = min(n, left)
                put_back(room, start + used, n - used)
            else:
                each = size // length
                room, start, used = size, opened, -(-left // each)
                opened += used
            out.append((length, rank, used, start, size - room))
            put_back(room - length, start, used)
            left, rank = left - used, rank + used
    return out


def tokenize(docs: DataFrame, path: str, size: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """The pieces of at most ``size`` ids of each document: doc_id, piece, start, length, ids_crc32
    (and ids). Words that a task hasn't seen are encoded for many documents at once."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    end = pack_ids([end_id])

    def run(batches):
        encoder = common.kept("bpe", path, lambda: Encoder(path))
        for b in batches:
            for doc_ids, texts in slices(b):
                rows = []
                for doc_id, ids in zip(doc_ids, encoder.many(texts), strict=True):
                    own = ids + end
                    for i, at in enumerate(range(0, len(own), 4 * size)):
                        part = own[at : at + 4 * size]
                        rows.append((doc_id, i, at // 4, len(part) // 4, zlib.crc32(part), part))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types, strict=False)][: len(names)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids: little-endian unsigned
    32-bit) of every piece; only documents of over ``size`` ids are cut.

    A null or empty text is its end id alone. Rows that repeat are packed each. An empty
    table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = common.written(
        tokenize(docs, path, size, end_id, with_ids).withColumn(
            "bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(BUCKETS)).cast("int")
        ),
        "pieces",
    )
    counts = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    first = counts.select("length", "bucket", before.alias("first"))  # at most size x BUCKETS rows
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most size rows
    slots: dict[int, list] = {}
    for length, *slot in plan(histogram, size):
        slots.setdefault(length, []).append(tuple(slot))
    slots = spark.createDataFrame(
        list(slots.items()), "length long, slots array<struct<rank: long, n: long, sequence: long, offset: long>>"
    )
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    slot = F.expr("filter(slots, s -> s.rank <= rank and rank < s.rank + s.n)[0]")
    return (
        pieces.withColumn("within", within)
        .join(first, ["length", "bucket"])
        .withColumn("rank", F.col("first") + F.col("within"))
        .join(F.broadcast(slots), "length")  # one row for each of at most `size` lengths
        .withColumn("slot", slot)
        .select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            (F.col("slot.sequence") + F.col("rank") - F.col("slot.rank")).alias("sequence_id"),
            F.col("slot.offset").alias("offset"), *["ids"] * with_ids,
        )
    )


def op4_best_fit_packing(spark, sf_dir) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
