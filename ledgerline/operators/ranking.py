"""Exact global ranking without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves the whole input into one
task. Here the total order is split across tasks by *values*:

1. P - 1 bounds are rows of the order key, from a sample of about ``_PER_PART`` x P
   rows: those whose key's hash is under a threshold that the row count sets, so
   tasks keep only what is sampled. P follows the data (``ROWS_PER_PART``).
   Bounds only balance the work; any bounds give the same result.
2. A row's part is the number of bounds at or below its key, found by binary
   search in a constant array. It depends on the row alone, so a task that runs
   again, or a plan that evaluates the input twice, finds the same parts.
3. ``row_number`` within a part, plus the rows of earlier parts (one count for
   each part, broadcast), is the global position.

Orders are lists of ``(column, ascending)``: ascending puts NULLs first,
descending (numbers only) puts them last, like Spark's defaults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

Order = list[tuple[str, bool]]

#: Rows of a part that are aimed at; there are at least as many parts as shuffle partitions.
ROWS_PER_PART = 1_000_000
#: Parts at most. The bounds are one constant of the plan: 16,384 keys are 1 to 2 MB.
MAX_PARTS = 16_384
#: Sampled rows for each part.
_PER_PART = 16


def _parts(df: DataFrame, num_parts: int | None, rows: int) -> int:
    if num_parts:
        return num_parts
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_PARTS, max(least, -(-rows // ROWS_PER_PART)))


def sort_columns(order: Order) -> list[Column]:
    return [F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last() for c, up in order]


def _key(order: Order) -> Column:
    """A struct that sorts ascending as ``order`` does."""
    fields = []
    for i, (c, up) in enumerate(order):
        col = F.col(c)
        fields.append(F.when(col.isNull(), 0 if up else 1).otherwise(1 if up else 0).alias(f"f{i}"))
        fields.append((col if up else -col).alias(f"v{i}"))
    return F.struct(*fields)


def sampled(keys: DataFrame, rows: int, want: int) -> DataFrame:
    """About ``want`` of ``rows`` keys ``k``, chosen by value: the same ones whenever the plan runs."""
    if rows <= want:
        return keys
    below = -(1 << 63) + (1 << 64) * want // rows  # of the 2^64 hashes, the share want / rows
    return keys.where(F.xxhash64("k") < F.lit(below))


def _bounds(df: DataFrame, order: Order, num_parts: int | None) -> tuple[Column, int] | None:
    """An array constant of the bounds, ascending, and its size."""
    rows = df.count()
    want = _PER_PART * _parts(df, num_parts, rows)
    keys = df.select(_key(order).alias("k"))
    kind = keys.schema["k"].dataType
    # one text a key: exact for every type that orders here, and one constant for the plan
    sample = [r[0] for r in sampled(keys, rows, want).orderBy("k").select(F.to_json("k")).collect()]
    parts = min(_parts(df, num_parts, rows), len(sample))
    chosen = [sample[i * len(sample) // parts] for i in range(1, parts)]
    if not chosen:
        return None
    return F.from_json(F.lit(f"[{','.join(chosen)}]"), ArrayType(kind)), len(chosen)


def with_part(df: DataFrame, order: Order, num_parts: int | None = None, part_col: str = "_part") -> DataFrame:
    """Add the number of the row's part: parts are ranges of ``order``."""
    found = _bounds(df, order, num_parts)
    if found is None:
        return df.withColumn(part_col, F.lit(0))
    bounds, n = found
    steps = [1 << b for b in reversed(range(n.bit_length()))]
    key = _key(order)
    place = F.aggregate(
        F.array(*(F.lit(s) for s in steps)),
        F.lit(0),
        lambda at, s: F.when((at + s <= n) & (F.get(bounds, at + s - 1) <= key), at + s).otherwise(at),
    )
    return df.withColumn(part_col, place)


def global_index(
    df: DataFrame,
    order: Order,
    index_col: str = "_gidx",
    total_col: str | None = None,
    num_parts: int | None = None,
) -> DataFrame:
    """Add the exact 0-based position of each row in ``order`` (which must be a
    total order, e.g. end with a unique key) and optionally the row total."""
    tagged = with_part(df, order, num_parts)
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row for each part
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(before) - F.col("_n")).alias("_off"),
        F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_total"),
    )
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*sort_columns(order)))
    out = (
        tagged.withColumn("_pos", within)
        .join(F.broadcast(offsets), on="_part")
        .withColumn(index_col, F.col("_off") + F.col("_pos") - 1)
    )
    if total_col:
        out = out.withColumnRenamed("_total", total_col)
    return out.drop("_part", "_pos", "_off", "_total")


def ntile_from_index(index_col: str, total_col: str, k: int) -> Column:
    """NTILE(k) bucket (1-based) of 0-based position ``index_col`` among
    ``total_col`` rows: the first ``total % k`` buckets hold one extra row.
    Integer arithmetic only (``div``), exact for any row count."""
    k = int(k)
    q = f"({total_col} div {k})"
    r = f"({total_col} - {q} * {k})"
    big = f"(({q} + 1) * {r})"
    return F.expr(
        f"cast(CASE WHEN {index_col} < {big} THEN {index_col} div ({q} + 1) "
        f"ELSE {r} + ({index_col} - {big}) div greatest({q}, 1) END + 1 AS int)"
    )


def global_ntile(
    df: DataFrame, k: int, order: Order, out_col: str = "ntile", num_parts: int | None = None
) -> DataFrame:
    """Exact distributed ``ntile(k).over(Window.orderBy(*order))``."""
    idx = global_index(df, order, "_gidx", "_gtotal", num_parts)
    return idx.withColumn(out_col, ntile_from_index("_gidx", "_gtotal", k)).drop("_gidx", "_gtotal")


def global_dense_rank(
    df: DataFrame,
    value_col: str,
    descending: bool = True,
    out_col: str = "dense_rank",
    num_parts: int | None = None,
) -> DataFrame:
    """Exact distributed ``dense_rank().over(Window.orderBy(value))``: rank the
    distinct values, then join the rank back on the value (NULLs rank last
    when descending, first when ascending, like Spark)."""
    values = df.select(value_col).distinct()
    ranked = global_index(values, [(value_col, not descending)], "_gidx", None, num_parts).select(
        F.col(value_col).alias("_rv"), (F.col("_gidx") + 1).cast("int").alias(out_col)
    )
    return df.join(ranked, F.col(value_col).eqNullSafe(F.col("_rv")), "left").drop("_rv")


def distributed_lag(
    df: DataFrame,
    partition_cols: list[str],
    order: Order,
    value_col: str,
    out_col: str,
    num_parts: int | None = None,
) -> DataFrame:
    """``lag(value).over(partitionBy(keys).orderBy(order))`` without putting a
    whole group in one task: LAG within each part of (keys, order), and a
    part's first row takes the last row of the part before (one row for each
    part, broadcast). ``order`` must make the order total."""
    full: Order = [(c, True) for c in partition_cols] + order
    tagged = with_part(df, full, num_parts)
    carried = F.struct(*(F.col(c).alias(f"k{i}") for i, c in enumerate(partition_cols)), F.col(value_col).alias("v"))
    window = Window.partitionBy("_part").orderBy(*sort_columns(full))
    tagged = tagged.withColumn("_prev", F.lag(carried).over(window))
    last = tagged.select("_part", F.struct(_key(full).alias("key"), carried.alias("row")).alias("_end"))
    last = last.groupBy("_part").agg(F.max("_end").alias("_end"))
    before = last.select("_part", F.lag("_end.row").over(Window.orderBy("_part")).alias("_before"))
    joined = tagged.join(F.broadcast(before), on="_part", how="left")
    prev = F.coalesce("_prev", "_before")
    same = F.lit(True)
    for i, c in enumerate(partition_cols):
        same = same & F.col(c).eqNullSafe(prev[f"k{i}"])
    return joined.withColumn(out_col, F.when(same, prev["v"])).drop("_part", "_prev", "_before")
