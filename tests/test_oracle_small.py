"""Every registered query against its independent DuckDB SQL on sf0.001."""

import pytest

from checks.compare import duck_connect, _rows

SF = "/root/testdata/sf0.001"
_DUCK_TO_SPARK = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF)


def _names():
    from ledgerline.plans.registry import queries

    return sorted(queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E

    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    sql = E.oracle_sql()[name]
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _rows(sdf.columns, srows) == _rows(ocols, orows)
    otypes = {c: _DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(ocols, duck.sql(sql).types)}
    assert dict(sdf.dtypes) == otypes


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "period_type",
        "period_value",
        "restaurant_id",
        "item_category",
        "currency",
        "total_revenue",
        "order_count",
        "customer_count",
    ]
