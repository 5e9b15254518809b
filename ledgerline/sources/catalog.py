"""Catalog registration of layer tables (S8, S9) and SQL access.

``register`` re-points single names. What has to be read together is published
by ``publish``: one pointer file names the version of all tables at once, and
``current`` gives a reader that version's tables, whatever is published
meanwhile.
"""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerline.sources import store

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"invalid identifier {name!r}")
    return name


def register(
    spark: SparkSession, database: str, table: str, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> None:
    """CREATE DATABASE IF NOT EXISTS, then publish ``path`` as ``database.table``.

    The published name is a view over the versioned folder, replaced in one
    catalog operation: readers see the old version or the new one with its own
    partitions and columns, never a mix. ``schema`` stands in for a version
    without any rows, whose folder has no files to take a schema from."""
    db, tb = _ident(database), _ident(table)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    full = f"{db}.{tb}"
    if spark.catalog.tableExists(full) and spark.catalog.getTable(full).tableType != "VIEW":
        spark.sql(f"DROP TABLE {full}")  # a table of before names were views
    source = f"{_ident(fmt)}.`{path.replace('`', '``')}`"
    try:
        spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT * FROM {source}")
    except AnalysisException as e:
        if schema is None or e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
        spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT {columns} WHERE false")


def mart_query(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """SQL text in, DataFrame out, with bound (not interpolated) values,
    e.g. ``mart_query(spark, "SELECT * FROM gold.sales_trends WHERE
    period_type = :p", {"p": "weekly"})``."""
    return spark.sql(sql, args=args or {})


_POINTER = "_current.json"


def publish(spark: SparkSession, root: str, version: str, tables: dict[str, tuple[str, str, StructType]]) -> None:
    """Makes ``version`` the current one of all ``tables`` (name: path, format,
    schema) under ``root`` in one step."""
    entries = {t: {"path": p, "format": f, "schema": s.json()} for t, (p, f, s) in tables.items()}
    store.write_json(spark, f"{root}/{_POINTER}", {"version": version, "tables": entries})


def current(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the current version under ``root``. The pointer is read
    once, so they are of one version and stay so."""
    found = store.read_json(spark, f"{root}/{_POINTER}")
    if found is None:
        raise LookupError(f"nothing is published under {root}")
    return {
        t: spark.read.schema(StructType.fromJson(json.loads(e["schema"]))).format(e["format"]).load(e["path"])
        for t, e in found["tables"].items()
    }


def use_current(spark: SparkSession, root: str) -> None:
    """The tables of the current version as temporary views of this session, for SQL."""
    for name, df in current(spark, root).items():
        df.createOrReplaceTempView(_ident(name))
