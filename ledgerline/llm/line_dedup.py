"""Removal of repeated line runs by distributed prefix doubling over line-ID sequences.

Documents are sequences of lines. The rank of a position at level t is the earliest
position (by document, then line) whose next 2^t lines are the same: rank 0 groups equal
lines, and rank t + 1 groups equal pairs (rank t here, rank t 2^t lines on), each by one
Spark aggregation. A position whose rank is its own alone is unique and drops out; so do
all longer runs from there. Positions with one rank are an interval of the suffix array,
whose common prefix has at least 2^t lines.

From each position the shortest run of at least ``min_words`` words is what has to repeat.
A run of n lines with 2^t <= n < 2^(t+1) is named by two ranks of level t that cover it. The
union of the repeated runs' later copies is every maximal repeated run but its first copy.
Ranks are positions, not hashes, so equality is exact but for the 128-bit line IDs.

What moves: all lines once, as IDs combined in each task, to find those that repeat. A bit
table of these (``BITS``, whatever the corpus) lets the second cut of the texts keep the
repeated lines and few others; only these are joined with their ranks. In each level the
positions are placed by document once, where a task finds the ranks further on by position.
At the end a like table of the documents that lose lines tells which texts have to meet
their runs; the others stay where they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

MIN_WORDS = 30
#: Bits of the table of repeated line IDs: 8 MB, as words of 4 kB. Lines that meet a wrong bit cost a join, no more.
BITS = 1 << 26


def _lines(min_words: int, bits=None):
    """A row for each line: its ID, and how many lines from it hold ``min_words`` words (0: too few). With
    ``bits`` (a broadcast table of IDs that repeat) only lines that may be in it."""

    def run(batches):
        table = None if bits is None else bits.value
        for b in batches:
            parts = []
            for doc, k, text in zip(*(b.column(c).to_pylist() for c in ("id", "k", "text")), strict=True):
                lines = text.split("\n")
                ids = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.encode()) for x in lines), dtype="<i8").reshape(-1, 2)
                at = np.arange(len(lines))
                if table is not None:
                    at = np.flatnonzero(_held(table, ids[:, 0]))
                    if not len(at):
                        continue
                words = np.cumsum([0, *(len(x.split()) for x in lines)])
                n = np.searchsorted(words, words[:-1] + min_words) - np.arange(len(lines))
                n[words[:-1] + min_words > words[-1]] = 0
                same = np.ones(len(at), dtype=np.int64)
                parts.append((same * doc, same * k, at, ids[at, 0], ids[at, 1], n[at]))
            if parts:
                cols = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, ["id", "k", "i", "a", "b", "n"])

    return run


LINES = "id long, k long, i long, a long, b long, n long"


def _held(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    bit = ids & (BITS - 1)
    return (table[bit >> 3] >> (bit & 7)) & 1 > 0


def _bit_words(ids: DataFrame, column: str) -> DataFrame:
    """word, bits of the column's low bits, combined in each task: at most BITS / 32,768 rows of 4 kB."""
    bit = F.col(column).bitwiseAND(BITS - 1) + 1  # buckets count from 1
    word = F.bitmap_bucket_number(bit)
    return ids.groupBy(word.alias("word")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))


def _bit_table(ids: DataFrame, column: str) -> np.ndarray:
    table = np.zeros(BITS // 8, dtype=np.uint8)
    for r in _bit_words(ids, column).collect():
        table[(r["word"] - 1) * 4096 : r["word"] * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return table


def _marked(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``df`` with ``hit``: whether the column's bit is among those of ``ids``, whose words are broadcast (8 MB at most)."""
    bit = F.col(column).bitwiseAND(BITS - 1) + 1
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    words = F.broadcast(_bit_words(ids, column))
    hit = F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False))
    return df.withColumn("word", F.bitmap_bucket_number(bit)).join(words, "word", "left").withColumn("hit", hit).drop("word", "bits")


def _first(df: DataFrame, same: list[str]) -> DataFrame:
    """``same`` and the earliest place, for what stands at two places at least. Repeated rows of one document
    stand at one place. Combined in each task, so a hot group costs it one row."""
    ends = df.groupBy(*same).agg(F.min(_place()).alias("rank"), F.max(_place()).alias("_last"))
    return ends.where("rank < _last").drop("_last")


def _named(rank: str = "rank") -> list:
    return [F.col(f"{rank}.{c}").alias(r) for c, r in zip(("id", "k", "i"), RANK, strict=True)]


def _ranked(df: DataFrame, same: list[str]) -> DataFrame:
    """The positions of ``df`` (id, k, i, n and ``same``) that share ``same`` with another one, with their rank."""
    first = _first(df, same).select(*(F.col(c).alias(f"_{c}") for c in same), *_named())
    return df.select("id", "k", "i", "n", *(F.col(c).alias(f"own_{c}") for c in same)).join(
        first, [F.col(f"own_{c}") == F.col(f"_{c}") for c in same]
    ).select(*LEVEL)


#: A rank is the place it names; AFTER is the rank ``span`` lines on, TAIL the one that ends the shortest run.
RANK, AFTER, TAIL = (["rid", "rk", "ri"], ["aid", "ak", "ai"], ["tid", "tk", "ti"])
LEVEL = ["id", "k", "i", "n", *RANK]


def _further(span: int):
    """For rows (LEVEL) sorted by document and position: adds AFTER, and TAIL where the shortest run has
    ``span`` to 2 ``span`` - 1 lines; null where the line there doesn't repeat."""

    def add(t: pa.Table) -> pa.RecordBatch:
        c = {x: t[x].to_numpy() for x in LEVEL}
        new = (c["id"][1:] != c["id"][:-1]) | (c["k"][1:] != c["k"][:-1])
        at = (np.concatenate([[0], np.cumsum(new)]) << 40) + c["i"]  # ascending over all documents of the table

        def ranks(lines, wanted):
            found = np.minimum(np.searchsorted(at, at + lines), len(at) - 1)
            missing = ~(wanted & (at[found] == at + lines))
            return [pa.array(c[r][found], pa.int64(), mask=missing) for r in RANK]

        run_ends = (c["n"] >= span) & (c["n"] < 2 * span)
        columns = [pa.array(c[x]) for x in LEVEL] + ranks(span, True) + ranks(c["n"] - span, run_ends)
        return pa.RecordBatch.from_arrays(columns, [*LEVEL, *AFTER, *TAIL])

    def run(batches):
        held = None
        for b in batches:
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            doc, k = held["id"].to_numpy(), held["k"].to_numpy()
            begins = np.flatnonzero((doc[1:] != doc[:-1]) | (k[1:] != k[:-1])) + 1
            if len(begins):  # all but the last document is whole
                yield add(held.slice(0, begins[-1]))
                held = held.slice(begins[-1])
        if held is not None and len(held):
            yield add(held)

    return run


def _place() -> Column:
    return F.struct("id", "k", "i")


def _keyed(docs: DataFrame) -> DataFrame:
    """row (all columns), id (null first), k, text."""
    return docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        F.coalesce("doc_id", F.lit(-(2**63))).alias("id"),
        common.row_key().alias("k"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """k (row key), i, n: the runs of n lines from line i that occur at an earlier place too."""
    texts = _keyed(docs).select("id", "k", "text")
    first = common.written(_first(texts.mapInArrow(_lines(min_words), LINES), ["a", "b"]), "line-ids")
    bits = docs.sparkSession.sparkContext.broadcast(_bit_table(first, "a"))
    level = texts.mapInArrow(_lines(min_words, bits), LINES).join(first, ["a", "b"]).select("id", "k", "i", "n", *_named())
    # rows with the same id and text are one document
    level, span = common.written(level.dropDuplicates(["id", "k", "i"]), "line-ranks"), 1
    schema = ", ".join(f"{c} long" for c in (*LEVEL, *AFTER, *TAIL))
    found = None
    while True:
        placed = level.repartition("id", "k").sortWithinPartitions("id", "k", "i").mapInArrow(_further(span), schema)
        placed = common.written(placed, "line-pairs")
        runs = placed.where("tid is not null")
        named = ["n", *RANK, *TAIL]
        earliest = runs.groupBy(*named).agg(F.min(_place()).alias("first"))
        later = runs.join(earliest, named).where(F.col("first") < _place()).select("k", "i", "n")
        later = common.written(later, "line-runs")
        found = later if found is None else found.unionByName(later)
        longest = level.agg(F.max("n")).first()[0]
        if longest is None or longest < 2 * span:
            return found
        level = common.written(_ranked(placed.where("aid is not null"), [*RANK, *AFTER]), "line-ranks")
        span *= 2


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """row (the columns given), text (the lines kept), n_lines, n_removed, runs (first line and number
    of lines of each run removed).

    A run of lines of at least ``min_words`` words that occurs at several places stays at the
    first, by doc_id, then line; null ids come first. Runs don't cross documents. A null text
    is one empty line. Rows that repeat id and text are one document: each gets its result.
    """
    runs = repeats(docs, min_words).groupBy("k").agg(F.collect_list(F.struct("i", "n")).alias("gone"))
    runs = common.written(runs, "line-gone")
    keyed = _keyed(docs)
    marked = _marked(keyed, "k", runs)
    # one plan at every size: texts that lose lines are dealt to their runs by key
    losing = marked.where("hit").join(runs.hint("merge"), "k", "left").select("row", "text", "gone")
    whole = marked.where("not hit").select("row", "text", F.lit(None).cast(runs.schema["gone"].dataType).alias("gone"))

    def cut(batches):
        for b in batches:
            out = []
            for text, gone in zip(b.column("text").to_pylist(), b.column("gone").to_pylist(), strict=True):
                lines = text.split("\n")
                mark = np.zeros(len(lines) + 1, dtype=np.int64)
                for x in gone or ():
                    mark[x["i"]] += 1
                    mark[x["i"] + x["n"]] -= 1
                drop = np.cumsum(mark[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], drop, [0]]).astype(np.int8)))
                spans = [{"line": int(x), "lines": int(y - x)} for x, y in zip(edge[::2], edge[1::2], strict=True)]
                kept = "\n".join(x for x, d in zip(lines, drop, strict=True) if not d)
                out.append((kept, len(lines), int(drop.sum()), spans))
            cols = list(zip(*out, strict=True)) or [()] * 4
            types = [pa.string(), pa.int64(), pa.int64(), RUNS]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                ["row", "text", "n_lines", "n_removed", "runs"],
            )

    kind = keyed.schema["row"].dataType.simpleString()
    return losing.unionByName(whole).mapInArrow(
        cut, f"row {kind}, text string, n_lines long, n_removed long, runs array<struct<line: long, lines: long>>"
    )


RUNS = pa.list_(pa.struct([("line", pa.int64()), ("lines", pa.int64())]))


def op3_line_dedup(spark, sf_dir) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op3_sql(min_words: int = MIN_WORDS) -> str:
    words = r"len(list_filter(regexp_split_to_array(line, '\s+'), lambda x: x <> ''))"
    return f"""
    WITH lines AS (
      SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS line, len(l) AS n_lines, l
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
    sums AS (SELECT *, sum({words}) OVER (PARTITION BY doc_id ORDER BY i) AS s, {words} AS w FROM lines),
    ends AS (SELECT a.doc_id, a.i, min(b.i) AS e FROM sums a JOIN sums b
             ON a.doc_id = b.doc_id AND b.s >= a.s - a.w + {min_words} AND b.i >= a.i GROUP BY a.doc_id, a.i),
    runs AS (SELECT doc_id, i, e,
                    row_number() OVER (PARTITION BY array_to_string(l[i + 1:e + 1], chr(10)) ORDER BY doc_id, i) AS nth
             FROM ends JOIN lines USING (doc_id, i)),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, e + 1)) AS i FROM runs WHERE nth > 1)
    SELECT s.doc_id, any_value(n_lines)::BIGINT AS n_lines, count(g.i)::BIGINT AS n_removed,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY s.i) FILTER (g.i IS NULL), '')) AS kept_sha256
    FROM sums s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i GROUP BY s.doc_id"""
