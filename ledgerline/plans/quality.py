"""Post-run checks (S12): one row per table with its row count, rows with a
NULL key and the money total, and cross-mart invariants.

A pipeline run observes these figures in the jobs that write the tables
(``observed``), so no layer is read again for them. ``layer_checks`` and
``reconciliation`` compute the same rows over tables that already exist: a global
aggregate each (partial aggregates per task, one final row).
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.config import DAILY, DISCOUNT_METRIC, LOCATION_METRIC, LOYALTY_METRIC, MONTHLY, WEEKLY

# Key columns and money columns checked in each table, by presence.
_KEYS = ("ORDER_ID", "order_id", "user_id", "order_date", "date_key", "period_value", "metric_dimension")
_MONEY = (
    "item_gross_amount",
    "option_gross_amount",
    "daily_revenue",
    "monetary_total_spend",
    "total_revenue",
)


# Marts that hold the same revenue once per type: the type column and its values.
_TYPES = {
    "sales_trends": ("period_type", (DAILY, WEEKLY, MONTHLY)),
    "loyalty_location_discount": ("metric_type", (LOYALTY_METRIC, LOCATION_METRIC, DISCOUNT_METRIC)),
}
_CHECKS = "table_name string, row_count bigint, rows_with_null_keys bigint, amount_total double"
_RECONCILED = "check string, detail string, consistent boolean"


def _cents(c: str) -> Column:
    return F.col(c).cast("decimal(20,2)")


def figures(df: DataFrame, keys: list[str] | None = None, amount: str | None = None) -> dict[str, Column]:
    """The aggregates of a table's check row."""
    keys = keys if keys is not None else [c for c in _KEYS if c in df.columns]
    amount = amount or next((c for c in _MONEY if c in df.columns), None)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return {
        "row_count": F.count(F.lit(1)),
        "rows_with_null_keys": F.count(F.when(null_key, F.lit(1))),
        "amount_total": F.sum(_cents(amount)) if amount else F.lit(None).cast("decimal(20,2)"),
    }


def table_check(name: str, df: DataFrame, keys: list[str] | None = None, amount: str | None = None) -> DataFrame:
    found = figures(df, keys, amount)
    found["amount_total"] = found["amount_total"].cast("double")
    return df.agg(F.lit(name).alias("table_name"), *(c.alias(k) for k, c in found.items()))


def observed(df: DataFrame, table: str) -> tuple[DataFrame, Callable[[], dict]]:
    """``df`` with its check figures observed, and what gives them after the
    write: numbers and decimal texts."""
    wanted = figures(df)
    key, values = _TYPES.get(table, (None, ()))
    for v in values:
        wanted[f"total_{v}"] = F.sum(F.when(F.col(key) == v, _cents("total_revenue")))
    seen = Observation()

    def taken() -> dict:
        got = seen.get
        return {k: str(x) if isinstance(x, Decimal) else x for k, x in ((k, got.get(k)) for k in wanted)}

    return df.observe(seen, *(c.alias(k) for k, c in wanted.items())), taken


def checks_of(spark: SparkSession, metrics: dict[str, dict]) -> DataFrame:
    """``layer_checks`` from observed figures."""
    rows = [
        (name, m["row_count"] or 0, m["rows_with_null_keys"] or 0, None if m["amount_total"] is None else float(Decimal(m["amount_total"])))
        for name, m in metrics.items()
    ]
    return spark.createDataFrame(rows, _CHECKS)


def reconciliation_of(spark: SparkSession, metrics: dict[str, dict]) -> DataFrame:
    """``reconciliation`` from the observed figures of the marts."""
    customers = [metrics[m]["amount_total"] for m in ("customer_ltv_daily", "customer_segments")]
    rows = [("customer_marts_total", " / ".join(t for t in customers if t is not None), _agree(customers))]
    for mart, (key, values) in _TYPES.items():
        totals = {v: metrics[mart].get(f"total_{v}") for v in values}
        detail = " / ".join(sorted(f"{v}={t}" for v, t in totals.items() if t is not None))
        rows.append((f"{mart}_by_{key}", detail, _agree(totals.values())))
    return spark.createDataFrame(rows, _RECONCILED)


def _agree(totals) -> bool:
    return len({Decimal(t) for t in totals if t is not None}) <= 1


def layer_checks(*layers: dict[str, DataFrame]) -> DataFrame:
    out = None
    for layer in layers:
        for name, df in layer.items():
            part = table_check(name, df)
            out = part if out is None else out.unionByName(part)
    return out


def reconciliation(marts: dict[str, DataFrame]) -> DataFrame:
    """Cross-mart invariants, one row per check (check, detail, consistent):
    the LTV and segments totals are the same customer-grain order revenue;
    each trends period type and each metrics family partitions the same
    revenue, so their totals must agree. Exact (sums in cents)."""
    total = lambda mart, col: marts[mart].agg(F.sum(_cents(col)).alias("total"))
    both = total("customer_ltv_daily", "daily_revenue").unionByName(total("customer_segments", "monetary_total_spend"))
    out = _reconciled(both, "customer_marts_total", F.collect_list(F.col("total").cast("string")))
    for mart, (key, _) in _TYPES.items():
        per = marts[mart].groupBy(key).agg(F.sum(_cents("total_revenue")).alias("total"))
        detail = F.sort_array(F.collect_list(F.concat_ws("=", F.col(key), F.col("total").cast("string"))))
        out = out.unionByName(_reconciled(per, f"{mart}_by_{key}", detail))
    return out


def _reconciled(totals: DataFrame, check: str, detail: Column) -> DataFrame:
    return totals.agg(
        F.lit(check).alias("check"),
        F.concat_ws(" / ", detail).alias("detail"),
        (F.countDistinct("total") <= 1).alias("consistent"),
    )
