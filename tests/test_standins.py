"""The stand-in tables are the same in both engines (row count and distinct
values per column): every oracle comparison stands on this."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from oracle_compare import duck_connection
from tokoledger import catalog
from tokoledger.sources import standins


@pytest.fixture(scope="module")
def duck(small_sf):
    return duck_connection(small_sf)


@pytest.mark.parametrize("name", standins.STANDIN_TABLES)
def test_standin_same_in_both_engines(spark, small_sf, duck, name):
    df = catalog.standin_tables(spark, small_sf)[name]
    cte = standins.cte_prefix([name])
    n_duck = duck.execute(cte + f"SELECT count(*) FROM {name}").fetchone()[0]
    distinct_duck = duck.execute(cte + "SELECT " + ", ".join(f'count(DISTINCT "{c}")' for c in df.columns)
                                 + f" FROM {name}").fetchone()
    distinct_spark = df.agg(*[F.countDistinct(F.col(f"`{c}`")) for c in df.columns]).first()
    assert df.count() == n_duck
    assert tuple(distinct_spark) == tuple(distinct_duck)


def test_every_event_is_a_redemption_of_one_channel(spark, small_sf):
    from tokoledger.sources.tables import from_testdata

    tables = from_testdata(spark, small_sf)
    events = spark.read.parquet(f"{small_sf}/events.parquet").count()
    assert tables["point_redeem"].count() == events
    channels = ("point_redeem_detail", "point_redeem_detail_cashback", "ppob_transaction_master", "ewallet_transaction_master")
    assert sum(tables[c].select("redeem_no").distinct().count() for c in channels) == events
    codes = tables["redeem_item"].select("redeem_code")            # some gifts have two rows
    assert codes.count() > codes.distinct().count() == spark.read.parquet(f"{small_sf}/part.parquet").count()


def test_an_open_period_end_has_no_upper_bound(spark):
    import datetime as dt

    from tokoledger.operators.sales import within_window

    rows = spark.sql("SELECT timestamp_ntz'2024-05-01 10:00:00' AS invoice_date UNION ALL SELECT timestamp_ntz'1990-01-01 00:00:00'")
    assert within_window(rows, (dt.date(2000, 1, 1), dt.date.max)).count() == 1


def test_invoice_lines_are_joined_once(spark, tmp_path):
    """Invoices, line tables and targets read the kept lines instead of joining the base tables again."""
    from tokoledger.sources.tables import from_testdata

    rows = {
        "region": "SELECT * FROM VALUES (0, 'ASIA') AS t(r_regionkey, r_name)",
        "nation": "SELECT * FROM VALUES (0, 'NATION_0', 0) AS t(n_nationkey, n_name, n_regionkey)",
        "supplier": "SELECT * FROM VALUES (5L, 'five', 0, 1.5D), (6L, 'six', 0, 2.5D), (NULL, 'none', 0, 0D)"
                    " AS t(s_suppkey, s_name, s_nationkey, s_acctbal)",
        # a part that is there twice and one line that is there twice, each with its own effect on the sums
        "part": "SELECT * FROM VALUES (1L, 10D), (2L, 20D), (2L, 20D) AS t(p_partkey, p_retailprice)",
        "orders": "SELECT * FROM VALUES (100L, timestamp_ntz'1999-08-01 00:00:00'), (7L, timestamp_ntz'1999-08-02 00:00:00')"
                  " AS t(o_orderkey, o_orderdate)",
        "lineitem": "SELECT * FROM VALUES (100L, 1L, 5L, 3D, 4D), (100L, 1L, 5L, 3D, 4D), (7L, 2L, 6L, 1D, 8D), (7L, NULL, 6L, 1D, 8D)"
                    " AS t(l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice)",
    }
    for name, sql in rows.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    tables = from_testdata(spark, str(tmp_path))
    for name in ("invoice_master", "invoice_detail", "invoice_detail_activity", "outlet_basepack_target_detail"):
        tables[name].count()
        assert tables["so_lines"].storageLevel.useMemory, name
    assert "InMemoryTableScan" in tables["invoice_detail"]._jdf.queryExecution().executedPlan().toString()
    lines = sorted((r.invoice_no, r.quantity, int(r.total)) for r in tables["invoice_detail_activity"].collect())
    assert lines == [("INV100-5", 3, 4000)] * 2 + [("INV7-6", 1, 8000)] * 2
    invoices = sorted((r.invoice_no, int(r.invoice_amount), r.sales_id) for r in tables["invoice_master"].collect())
    assert invoices == [("INV100-5", 8000, "0")] * 2 + [("INV7-6", 16000, "S")]
