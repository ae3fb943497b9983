"""A hot outlet (about half of all invoices): with broadcasts off and AQE's
skew thresholds lowered to this data size, the joins on the outlet key are
split by AQE (the plan says so) and the results do not change."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tokoledger import params as P
from tokoledger.operators import sales
from tokoledger.plans.checks import plan_text

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "tokoledger.broadcast.maxRows": "0",
}


@pytest.fixture
def skew_conf(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _data(spark):
    rows = []
    for i in range(6000):
        outlet = "HOT" if i % 2 == 0 else f"T{i % 97}"
        when = dt.datetime(2025, 7, 1) + dt.timedelta(minutes=37 * i)
        rows.append((outlet, when, D(1000 + i)))
    invoices = spark.createDataFrame(rows, "outlet_id string, invoice_date timestamp_ntz, invoice_amount decimal(18,2)")
    outlets = ["HOT"] + [f"T{k}" for k in range(97)]
    targets = spark.createDataFrame(
        [("A1", o, "1", dt.date(2025, 7, 1), dt.date(2025, 9, 30)) for o in outlets],
        "activity_id string, Outlet_id string, Cluster string, periode_start date, periode_end date")
    master = spark.createDataFrame(
        [("A1", o, "1", dt.date(2025, 7, 1), dt.date(2025, 9, 30)) for o in outlets],
        "activity_id string, outlet_id string, cluster string, periode_start date, periode_end date")
    return invoices, targets, master


def test_hot_outlet_is_split_and_results_stay(spark, skew_conf):
    invoices, targets, master = _data(spark)
    p = P.SalesParams()
    growth = sales.growth_sales_points(targets, invoices, p)
    basepack = sales.basepack_sales_points(master, invoices, p)
    got_g = sorted(tuple(r) for r in growth.collect())
    got_b = sorted(tuple(r) for r in basepack.collect())
    text = plan_text(growth) + plan_text(basepack)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert "s_month" in text and "t_month" in text       # the hot outlet's rows are dealt over its months
    for k in SKEW_CONF:                       # same results with the ordinary settings
        spark.conf.unset(k)
    assert sorted(tuple(r) for r in sales.growth_sales_points(targets, invoices, p).collect()) == got_g
    assert sorted(tuple(r) for r in sales.basepack_sales_points(master, invoices, p).collect()) == got_b
    hot = [r for r in got_g if r[1] == "HOT"][0]
    assert hot[3] == sum(D(1000 + i) for i in range(0, 6000, 2)
                         if dt.datetime(2025, 7, 1) + dt.timedelta(minutes=37 * i) < dt.datetime(2025, 10, 1))


def test_hot_outlet_in_the_activity_lines_join(spark, skew_conf):
    from tokoledger.operators import activity

    rows = [("HOT" if i % 2 == 0 else f"T{i % 50}", f"I{i}", f"S{i % 4}", D(1), 1 + i % 3, D(10 + i % 7),
             dt.datetime(2025, 7, 1) + dt.timedelta(minutes=20 * i)) for i in range(6000)]
    lines = spark.createDataFrame(rows, "outlet_id string, invoice_no string, item_code string, price decimal(18,2), "
                                        "quantity int, total decimal(18,2), invoice_date timestamp_ntz")
    outlets = spark.createDataFrame([("A1", o) for o in ["HOT"] + [f"T{k}" for k in range(50)]],
                                    "activity_id string, Outlet_id string")
    skus = spark.createDataFrame([("A1", f"S{k}", 50) for k in range(4)], "activity_id string, sku_code string, ispcs int")
    acts = spark.createDataFrame([("A1", "C1", "2", "14", dt.date(2025, 7, 1), dt.date(2025, 9, 30))],
                                 "activity_id string, category_id string, mechanism_id string, "
                                 "status_activities string, periode_start date, periode_end date")
    eco = spark.createDataFrame([("A1", "HOT", "Q3", "2025")], "activity_id string, Outlet_id string, quarter string, "
                                                              "year string")
    df = activity.activity_sku_progress(lines, outlets, skus, acts, eco, P.ActivityParams())
    got = sorted(tuple(r) for r in df.collect())
    text = plan_text(df)
    assert "skew=true" in text or "isSkewJoin=true" in text
    hot = sum(r[5] for r in got if r[2] == "HOT")
    assert hot == sum(1 + i % 3 for i in range(0, 6000, 2)
                      if dt.datetime(2025, 7, 1) + dt.timedelta(minutes=20 * i) <= dt.datetime(2025, 9, 30))


def test_an_outlet_of_many_years_meets_only_its_own_months(spark):
    """Rows that the period join compares: a moment with the periods of its month, not with all of its outlet."""
    from tokoledger.plans.joins import by_month, month_bucket

    days = [dt.date(2010, 1, 5) + dt.timedelta(days=30 * k) for k in range(180)]
    invoices = spark.createDataFrame([("HOT", dt.datetime.combine(d, dt.time(9)), D(1)) for d in days],
                                     "outlet_id string, invoice_date timestamp_ntz, invoice_amount decimal(18,2)")
    periods = spark.createDataFrame([("A1", "HOT", "1", dt.date(y, q, 1), dt.date(y, q + 2, 28)) for y in range(2010, 2025) for q in (1, 4, 7, 10)]
                                    + [("A2", "HOT", "1", dt.date(2024, 1, 1), dt.date(9999, 12, 31)), ("A3", "HOT", "1", dt.date(2024, 5, 1), dt.date(2024, 4, 1))],
                                    "activity_id string, outlet_id string, cluster string, periode_start date, periode_end date")
    monthly = by_month(periods, "periode_start", "periode_end", "m")
    compared = invoices.withColumn("k", month_bucket(F.col("invoice_date"))).join(monthly, F.col("k") == F.col("m")).count()
    assert compared <= 3 * len(days)                                    # 180 x 62 without months
    got = {r.activity_id: r.total_sales_temp for r in sales.basepack_sales_points(periods, invoices, P.SalesParams(from_date=dt.date(2000, 1, 1))).collect()}
    inside = sum(any(dt.date(y, q, 1) <= d and dt.datetime.combine(d, dt.time(9)) <= dt.datetime(y, q + 2, 28) for y in range(2010, 2025) for q in (1, 4, 7, 10)) for d in days)
    assert got == {"A1": D(inside), "A2": D(sum(d >= dt.date(2024, 1, 1) for d in days))}


def test_hot_outlet_in_the_basepack_detail_and_distribution_joins(spark, skew_conf):
    from tokoledger.operators import basepack

    rows = [("HOT" if i % 2 == 0 else f"T{i % 50}", f"I{i}", f"S{i % 4}", D(1), 1 + i % 3, D(10 + i % 7),
             dt.datetime(2025, 7, 1) + dt.timedelta(minutes=20 * i)) for i in range(6000)]
    lines = spark.createDataFrame(rows, "outlet_id string, invoice_no string, item_code string, price decimal(18,2), "
                                        "quantity int, total decimal(18,2), invoice_date timestamp_ntz")
    products = spark.createDataFrame([(f"S{k}", f"BP{k % 2}") for k in range(4)], "sku_code string, basepack string")
    detail = spark.createDataFrame([("A1", o, "D1", f"BP{k}", "Y", "1", 5, dt.date(2025, 7, 1), dt.date(2025, 9, 30)) for o in ["HOT", "T1", "T3"] for k in (0, 1)],
                                   "activity_id string, outlet_id string, dist_code string, basepack_title string, status string, status_id string, target int, periode_start date, periode_end date")
    master = spark.createDataFrame([], "REGION string, AREA string, KODE_TOKO string, KODE_DIS string")
    regular = spark.createDataFrame([], "activity_id string, status_id string, status_approval string")
    p = P.SalesParams(detail_from=dt.date(2025, 1, 1))
    found = basepack.basepack_detail(detail, sales.basepack_lines(lines, products, p), master, regular, p)
    last = dt.datetime(2025, 9, 30)
    quantity = {r["KODE TOKO"] + r.BASEPACK_TITLE: r.QUANTITY for r in found.collect()}
    for outlet in ("HOT", "T1", "T3"):
        for k in (0, 1):
            want = sum(r[4] for r in rows if r[0] == outlet and int(r[2][1]) % 2 == k and r[6] <= last)
            assert quantity[f"{outlet}BP{k}"] == want
    spread = basepack.invoice_distribution(lines, detail)
    assert spread.filter("outlet_id = 'HOT'").count() == sum(r[0] == "HOT" and r[6] <= last for r in rows)
    assert "au_month" in plan_text(spread) and "t_month" in plan_text(found)


@pytest.mark.parametrize("limit", [None, "100"])
def test_hot_document_in_the_growth_and_basepack_summaries(spark, skew_conf, limit):
    """A third of all injection invoices on one (outlet, activity): its rows are dealt over shares, targets
    without invoices stay, and the rows equal those of the plain join."""
    from tokoledger.operators import basepack, growth, injection
    from tokoledger.plans.joins import HOT_ROWS_KEY, left_join_dealt

    rows = [("HOT" if i % 3 == 0 else f"T{i % 97}", "0" if i % 9 else "1", "A1", f"I{i}", dt.datetime(2025, 7, 1) + dt.timedelta(hours=i),
             dt.datetime(2025, 8, 1), D(1), D(2 + i % 5), D(3)) for i in range(3000)]
    invoices = spark.createDataFrame(rows, "outlet_id string, sales_id string, document_ID string, invoice_no string, invoice_date timestamp_ntz, "
                                           "upload_date timestamp_ntz, invoice_amount decimal(18,2), expected_invoice_addt_reward decimal(18,2), payment_amount decimal(18,2)")
    outlets = ["HOT", "ALONE"] + [f"T{k}" for k in range(97)]
    start, end = dt.date(2025, 7, 1), dt.date(2025, 12, 31)
    targets = spark.createDataFrame(
        [("A1", "D1", o, o, "1", "t", 5, 1, 9, start, end) for o in outlets],
        "activity_id string, Dist_Code string, Outlet_id string, outlet_name string, Cluster string, Bar_Title_Target string, Target_toko int, "
        "POINT_didapat int, POINT_max int, periode_start date, periode_end date")
    master = spark.createDataFrame(
        [("A1", o, 2, 1, start, end, "1", 1, 9, "1") for o in outlets],
        "activity_id string, outlet_id string, total_basepack int, target int, periode_start date, periode_end date, status_id string, "
        "point_min int, point_max int, cluster string")
    detail = spark.createDataFrame([("A1", o, "R", "A", "D1", 1) for o in outlets],
                                   "activity_id string, `KODE TOKO` string, REGION string, AREA string, `KODE DISTI` string, PENCAPAIAN int")
    regular = spark.createDataFrame([("A1", "1", "OK")], "activity_id string, status_id string, status_approval string")
    p = P.SalesParams(as_of=dt.datetime(2025, 12, 1))

    def results():
        made = growth.growth_achievement(targets, sales.growth_sales_points(targets, invoices, p), regular, invoices, p)
        summed = basepack.basepack_summary(master, detail, sales.basepack_sales_points(master, invoices, p), regular, invoices, made, p)
        return made, summed

    plain = [df.exceptAll(df.limit(0)).cache() for df in results()]
    assert [df.count() > 3000 for df in plain] == [True, True] and plain[1].where("`KODE TOKO` = 'ALONE'").count() == 1
    if limit is None:
        return
    spark.conf.set(HOT_ROWS_KEY, limit)
    try:
        invoices = invoices.select("*")          # hot keys are remembered for a table
        hot = injection.hot_documents(invoices, p.injection_sales_id, p.feedback_sales_id)
        assert [tuple(r) for r in hot.collect()] == [("HOT", "A1", 10)]
        for before, df in zip(plain, results(), strict=True):
            assert "share_l" in plan_text(df)
            assert df.exceptAll(before).count() == 0 and before.exceptAll(df).count() == 0
        kind = injection.invoices_of_kind(invoices, "0", "inm_", ["invoice_no"], max_invoice_no=False)
        keys = targets.select("Outlet_id", "activity_id")
        dealt = left_join_dealt(keys, kind, ["Outlet_id", "activity_id"], ["inm_outlet_id", "inm_document_ID"], hot)
        assert dealt.where("inm_invoice_no is null").count() == keys.join(kind, F.col("Outlet_id") == F.col("inm_outlet_id"), "left_anti").count()
    finally:
        spark.conf.unset(HOT_ROWS_KEY)
