"""Operators produce exactly the declared layer schemas."""

from conftest import GOLDEN_AS_OF
from ledgerline import schemas as S
from ledgerline.operators import silver
from ledgerline.plans import marts
from ledgerline.plans.registry import Inputs
from ledgerline.sources import ingest

SF = "/root/testdata/sf0.001"


def test_bronze_schemas(spark):
    i = Inputs(spark, SF)
    for table, df in (
        ("order_items", i.bronze_items),
        ("order_item_options", i.bronze_options),
        ("date_dim", i.bronze_dates),
    ):
        assert S.names_and_types(df.schema) == S.names_and_types(S.bronze_schema(table))
        audited = ingest.add_audit(df, f"dbo.{table}")
        assert S.names_and_types(audited.schema) == S.names_and_types(S.bronze_schema(table, audit=True))


def test_silver_schemas(spark):
    i = Inputs(spark, SF)
    got = {
        "order_items": silver.order_items(i.bronze_items, audit=True),
        "order_item_options": silver.order_item_options(i.bronze_options, audit=True),
        "date_dim": silver.date_dim(i.bronze_dates, audit=True),
    }
    for table, df in got.items():
        assert S.names_and_types(df.schema) == S.names_and_types(S.SILVER[table]), table


def test_gold_schemas(golden):
    items, options = golden["items"], golden["options"]
    got = {
        "customer_ltv_daily": marts.customer_ltv_daily(items, options, audit=True),
        "customer_segments": marts.customer_segments(items, options, GOLDEN_AS_OF, audit=True),
        "sales_trends": marts.sales_trends(items, audit=True),
        "loyalty_location_discount": marts.loyalty_location_discount(items, options, audit=True),
    }
    for table, df in got.items():
        assert S.names_and_types(df.schema) == S.names_and_types(S.GOLD[table]), table


def test_require_bronze_columns(spark):
    import pytest

    i = Inputs(spark, SF)
    S.require_bronze_columns(i.bronze_items, "order_items")
    with pytest.raises(ValueError, match="ITEM_PRICE"):
        S.require_bronze_columns(i.bronze_items.drop("ITEM_PRICE"), "order_items")
