"""Bronze ingestion: full-table reads from an operational database over JDBC,
plus audit columns.

The source reads a table in a single JDBC query. Here the read is split into one
query a task, each with its own WHERE clause: ranges of a numeric column
(``partition_column`` with bounds, which only decide the split points: rows
outside them and NULLs are read too), or, for text keys (order ids are text in
the source), ``predicates``, e.g. ``hash_predicates("CHECKSUM(ORDER_ID)", 64)``
for a SQL Server source. The clauses must match every row exactly once;
``cover`` counts the rows that they don't over any table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcSource:
    url: str
    table: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    partition_column: str | None = None
    lower_bound: int | None = None
    upper_bound: int | None = None
    num_partitions: int | None = None
    fetch_size: int = 10_000
    predicates: tuple[str, ...] = ()
    single_task: bool = False  # one connection reads the whole table: small tables only
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": self.table, "fetchsize": str(self.fetch_size)}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver:
            opts["driver"] = self.driver
        if self.partition_column and self.predicates:
            raise ValueError("use either partition_column or predicates, not both")
        if not (self.partition_column or self.predicates or self.single_task):
            raise ValueError("give partition_column with bounds, predicates, or single_task=True")
        if self.partition_column:
            if self.lower_bound is None or self.upper_bound is None or not self.num_partitions:
                raise ValueError("partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        opts.update(self.extra)
        return opts

    def clauses(self) -> tuple[str, ...]:
        """One WHERE clause a task; none for a single task."""
        if self.partition_column:
            return range_predicates(self.partition_column, self.lower_bound, self.upper_bound, self.num_partitions)
        return self.predicates


def range_predicates(column: str, lower: int, upper: int, parts: int) -> tuple[str, ...]:
    """``parts`` ranges of a numeric column with equal steps between the bounds.
    The first range is open below and takes the NULLs, the last is open above."""
    if parts < 1 or upper < lower:
        raise ValueError("range_predicates needs parts >= 1 and lower <= upper")
    cuts = sorted({lower + (upper - lower) * i // parts for i in range(1, parts)})
    if not cuts:
        return ("1 = 1",)
    inner = tuple(f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False))
    return (f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}")


def hash_predicates(hash_expr: str, buckets: int) -> tuple[str, ...]:
    """One predicate per bucket of an integer hash expression evaluated by the
    database, negative values included, and one for a NULL hash."""
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    bucket = f"((({hash_expr}) % {buckets}) + {buckets}) % {buckets}"
    return (*(f"{bucket} = {k}" for k in range(buckets)), f"({hash_expr}) IS NULL")


def cover(table: DataFrame, clauses: tuple[str, ...]) -> DataFrame:
    """One row: rows, never (rows that no clause matches), repeated (rows that
    several match). A clause that is NULL for a row does not match it, as in WHERE."""
    matches = sum((F.expr(f"CASE WHEN {c} THEN 1 ELSE 0 END") for c in clauses), F.lit(0))
    return table.select(matches.alias("m")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("m") == 0, 1)).alias("never"),
        F.count(F.when(F.col("m") > 1, 1)).alias("repeated"),
    )


def read_source(spark: SparkSession, source: JdbcSource) -> DataFrame:
    """One source table as a DataFrame (schema from JDBC metadata)."""
    opts = source.options()
    if clauses := source.clauses():
        url, table = opts.pop("url"), opts.pop("dbtable")
        return spark.read.jdbc(url, table, predicates=list(clauses), properties=opts)
    return spark.read.format("jdbc").options(**opts).load()


def add_audit(df: DataFrame, source_table: str, timestamp: bool = True) -> DataFrame:
    """Ingestion time and source table name."""
    cols = {}
    if timestamp:
        cols["bronze_ingestion_timestamp"] = F.current_timestamp()
    cols["bronze_source_table"] = F.lit(source_table)
    return df.withColumns(cols)
