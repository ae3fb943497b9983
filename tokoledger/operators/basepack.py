"""Basepack (product bundle) targets: detail O8, summary O9, drill-down O10.

Row multiplicity is part of the reference's result: duplicate dimension rows
multiply the sums (T7). Instead of materialising the joined product, every
side is first reduced to one row per (join key, attributes) with a row count,
and the sums are multiplied by the counts -- same numbers, no fan-out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.exprs import NUMERIC, capped_points, clamp_at_zero, numeric
from ..params import SalesParams
from ..plans.joins import bounded_broadcast, by_month, left_join_dealt, month_bucket
from .injection import hot_documents, injection_columns, invoices_of_kind
from .sales import date_periods, day_grain, in_date_period, period_window, within_window


def _outlet_regions(outlet_master: DataFrame) -> DataFrame:
    """``SELECT REGION, AREA, KODE_TOKO ... GROUP BY`` all three."""
    return outlet_master.select("REGION", "AREA", F.col("KODE_TOKO").alias("c_outlet_id")).distinct()


def _regular_counts(activities_regular: DataFrame, prefix: str) -> DataFrame:
    return bounded_broadcast(
        activities_regular.groupBy(
            F.col("activity_id").alias(f"{prefix}activity_id"),
            F.col("status_id").alias(f"{prefix}status_id"),
            F.col("status_approval").alias(f"{prefix}status_approval"),
        ).agg(F.count(F.lit(1)).alias(f"{prefix}n")),
        source=activities_regular,
    )


def basepack_detail(
    target_detail: DataFrame,
    lines: DataFrame,
    outlet_master: DataFrame,
    activities_regular: DataFrame,
    p: SalesParams = SalesParams(),
) -> DataFrame:
    """Quantity and value per basepack target; ``lines`` is O6.

    Only targets starting on or after ``p.detail_from`` are kept (T5).
    """
    x = target_detail.filter(
        (F.col("status") == "Y") & (F.col("status_id") != "3") & (F.col("periode_start") >= F.lit(p.detail_from))
    )
    lines = within_window(lines, period_window(x))     # row-group pruning on the line scan
    x = x.groupBy("activity_id", "outlet_id", "basepack_title", "target", "periode_start", "periode_end",
                  "dist_code").agg(F.count(F.lit(1)).alias("x_n"))
    regions = _outlet_regions(outlet_master)
    regular = _regular_counts(activities_regular, "d_")
    x = x.join(regions, x.outlet_id == regions.c_outlet_id, "left")
    x = x.join(regular, x.activity_id == regular.d_activity_id, "left")

    # lines reduced to one row per outlet, basepack and timestamp -- or, for
    # DATE periods, per day with midnight apart (exact) -- before the range join
    dated = date_periods(target_detail)
    if dated:
        day, at_midnight = day_grain(F.col("invoice_date"))
        grain = [day.alias("y_day"), at_midnight.alias("y_midnight")]
    else:
        grain = [F.col("invoice_date").alias("y_invoice_date")]
    sales = lines.groupBy(
        F.col("outlet_id").alias("y_outlet_id"), F.col("basepack").alias("y_basepack"), *grain,
    ).agg(
        F.sum(F.coalesce(F.col("quantity"), F.lit(0))).alias("y_qty"),
        F.sum(numeric(F.col("total"))).alias("y_value"),
    )
    # inner range join with the sales side streamed (AQE can split a hot
    # outlet), totals per target period, then back onto every target row
    periods = by_month(x.select("outlet_id", "basepack_title", "periode_start", "periode_end").distinct(),
                       "periode_start", "periode_end", "t_month")
    sales = sales.withColumn("y_month", month_bucket(F.col("y_day" if dated else "y_invoice_date")))
    if dated:
        in_period = in_date_period(periods.periode_start, periods.periode_end, sales.y_day, sales.y_midnight)
    else:
        in_period = (periods.periode_start <= sales.y_invoice_date) & (periods.periode_end >= sales.y_invoice_date)
    per_period = sales.join(
        periods,
        (periods.outlet_id == sales.y_outlet_id) & (periods.basepack_title == sales.y_basepack)
        & (periods.t_month == sales.y_month) & in_period,
        "inner",
    ).groupBy(
        F.col("outlet_id").alias("p_outlet_id"), F.col("basepack_title").alias("p_basepack"),
        F.col("periode_start").alias("p_start"), F.col("periode_end").alias("p_end"),
    ).agg(F.sum("y_qty").alias("y_qty"), F.sum("y_value").alias("y_value"))
    j = x.join(
        per_period,
        (x.outlet_id == per_period.p_outlet_id) & (x.basepack_title == per_period.p_basepack)
        & (x.periode_start == per_period.p_start) & (x.periode_end == per_period.p_end),
        "left",
    )
    mult = F.col("x_n") * F.coalesce(F.col("d_n"), F.lit(1))
    g = j.groupBy(
        "activity_id", "REGION", "AREA", "outlet_id", "basepack_title", "target", "d_status_id",
        "periode_start", "dist_code", "d_status_approval",
    ).agg(
        F.sum(F.coalesce(F.col("y_qty"), F.lit(0)) * mult).alias("QUANTITY"),
        F.sum(F.col("y_value") * mult).alias("VALUE"),
    )
    gap = F.coalesce(F.col("target"), F.lit(0)) - F.col("QUANTITY")
    return g.select(
        "activity_id",
        "REGION",
        "AREA",
        F.col("dist_code").alias("KODE DISTI"),
        F.col("outlet_id").alias("KODE TOKO"),
        F.col("basepack_title").alias("BASEPACK_TITLE"),
        F.col("target").alias("TARGET"),
        F.col("QUANTITY").cast("bigint").alias("QUANTITY"),
        F.coalesce(F.col("VALUE"), F.lit(0)).cast("decimal(38,0)").alias("VALUE"),
        F.when(gap <= 0, F.lit(1)).otherwise(F.lit(0)).alias("PENCAPAIAN"),
        clamp_at_zero(gap).cast("bigint").alias("SISA_TARGET"),
        F.year("periode_start").alias("YEAR"),
        F.month("periode_start").alias("MONTH"),
        F.col("d_status_id").alias("status_id"),
        F.col("d_status_approval").alias("status_approval"),
    )


def basepack_summary(
    target_master: DataFrame,
    detail: DataFrame,
    sales_points: DataFrame,
    activities_regular: DataFrame,
    invoices: DataFrame,
    growth: DataFrame,
    p: SalesParams = SalesParams(),
) -> DataFrame:
    """One row per basepack target and distinct attribute combination.

    ``detail`` is O8, ``sales_points`` O7, ``growth`` O12. With no detail rows
    the achievement is NULL and points fall through uncapped (T6).
    """
    a = target_master.filter(F.col("periode_start") >= F.lit(p.from_date))
    a = a.groupBy("activity_id", "outlet_id", "total_basepack", "target", "periode_start", "periode_end",
                  "status_id", "point_min", "point_max").agg(F.count(F.lit(1)).alias("a_n"))
    dd = detail.groupBy(
        F.col("activity_id").alias("dd_activity_id"), F.col("KODE TOKO").alias("dd_outlet_id"),
        F.col("REGION").alias("dd_REGION"), F.col("AREA").alias("dd_AREA"),
        F.col("KODE DISTI").alias("dd_KODE_DISTI"),
    ).agg(F.sum("PENCAPAIAN").alias("dd_sum"))
    ee = sales_points.groupBy(
        F.col("activity_id").alias("ee_activity_id"), F.col("outlet_id").alias("ee_outlet_id"),
        F.col("total_sales_temp").alias("ee_total"), F.col("Aktual_Point_temp").alias("ee_points"),
    ).agg(F.count(F.lit(1)).alias("ee_n"))
    ff = _regular_counts(activities_regular, "ff_")
    inm = invoices_of_kind(
        invoices, p.injection_sales_id, "inm_",
        ["invoice_no", "upload_date", "invoice_date", "expected_invoice_addt_reward"], max_invoice_no=False,
    )
    fb = invoices_of_kind(
        invoices, p.feedback_sales_id, "fb_",
        ["payment_amount", "expected_invoice_addt_reward", "invoice_no"], max_invoice_no=False,
    )
    grw = growth.groupBy(
        F.col("periode_start").alias("grw_start"), F.col("periode_end").alias("grw_end"),
        F.col("outlet_code").alias("grw_outlet"), F.col("status_achievment").alias("grw_status"),
    ).agg(F.count(F.lit(1)).alias("grw_n"))

    j = a.join(dd, (a.activity_id == dd.dd_activity_id) & (a.outlet_id == dd.dd_outlet_id), "left")
    j = j.join(ee, (j.activity_id == ee.ee_activity_id) & (j.outlet_id == ee.ee_outlet_id), "left")
    j = j.join(ff, j.activity_id == ff.ff_activity_id, "left")
    j = j.join(grw, (j.periode_start == grw.grw_start) & (j.periode_end == grw.grw_end)
               & (j.outlet_id == grw.grw_outlet), "left")
    mult = F.col("a_n")
    for n in ("ee_n", "ff_n", "grw_n"):
        mult = mult * F.coalesce(F.col(n), F.lit(1))
    # the SUM over the reference's groups, first on the target side (small) ...
    core = j.groupBy(
        "activity_id", "outlet_id", "total_basepack", "target", "ee_total", "ee_points", "periode_start",
        "status_id", "dd_REGION", "dd_AREA", "dd_KODE_DISTI", "ff_status_id", "ff_status_approval",
        "point_min", "point_max", "grw_status",
    ).agg(F.sum(F.col("dd_sum") * mult).alias("core_sum"))
    # ... then each distinct injection / feedback attribute row multiplies it by
    # its row count: every output row is produced once, no output-sized shuffle
    hot = hot_documents(invoices, p.injection_sales_id, p.feedback_sales_id)
    g = left_join_dealt(core, inm, ["outlet_id", "activity_id"], ["inm_outlet_id", "inm_document_ID"], hot)
    g = left_join_dealt(g, fb, ["outlet_id", "activity_id"], ["fb_outlet_id", "fb_document_ID"], hot)
    g = g.withColumn("achieved", F.col("core_sum") * F.coalesce(F.col("inm_n"), F.lit(1))
                     * F.coalesce(F.col("fb_n"), F.lit(1)))

    achieved = F.col("achieved")
    target = F.col("target")
    points = F.col("ee_points")
    # without an achievement (no detail rows) the points stay uncapped
    actual = capped_points(points, F.col("point_min"), F.col("point_max"),
                           failed=(F.col("grw_status") == "NA") | (achieved < target), applies=achieved >= target)
    return g.select(
        "activity_id",
        F.col("dd_REGION").alias("REGION"),
        F.col("dd_AREA").alias("AREA"),
        F.col("dd_KODE_DISTI").alias("KODE DISTI"),
        F.col("outlet_id").alias("KODE TOKO"),
        F.col("total_basepack").alias("TOTAL_BASEPACK"),
        F.col("target").alias("TARGET"),
        achieved.cast("bigint").alias("PENCAPAIAN"),
        clamp_at_zero(F.coalesce(target, F.lit(0)) - F.coalesce(achieved, F.lit(0))).cast("bigint").alias("SISA_TARGET"),
        F.lit(texts.IS_VALUE).alias("isValue"),
        numeric(F.coalesce(F.col("ee_total"), F.lit(0))).alias("Total_Sales"),
        "point_min",
        "point_max",
        F.col("grw_status").alias("Status_Target_Growth"),
        actual.cast("decimal(18,2)").alias("Aktual_Point"),
        *injection_columns(p.point_value),
        F.year("periode_start").alias("YEAR"),
        F.month("periode_start").alias("MONTH"),
        F.col("ff_status_id").alias("status_id"),
        F.col("ff_status_approval").alias("status_approval"),
    )


def invoice_distribution(lines: DataFrame, target_detail: DataFrame) -> DataFrame:
    """Invoice lines inside a basepack target period, one row per distinct
    raw line (deduplicated before the casts, T21)."""
    periods = target_detail.select(
        F.col("activity_id").alias("au_activity_id"), F.col("outlet_id").alias("au_outlet_id"),
        F.col("periode_start").alias("au_start"), F.col("periode_end").alias("au_end"),
    ).distinct()
    periods = by_month(periods, "au_start", "au_end", "au_month")
    lines = within_window(lines, period_window(target_detail)).withColumn("l_month", month_bucket(F.col("invoice_date")))
    j = lines.join(
        periods,
        (lines.outlet_id == periods.au_outlet_id) & (lines.l_month == periods.au_month)
        & (periods.au_start <= lines.invoice_date) & (periods.au_end >= lines.invoice_date),
        "inner",
    )
    d = j.select(
        F.col("au_activity_id").alias("activity_id"), "outlet_id", "invoice_no", "item_code", "price", "quantity",
        "total", "invoice_date",
    ).distinct()
    return d.select(
        "activity_id",
        "outlet_id",
        "invoice_no",
        "item_code",
        numeric(F.col("price")).alias("Harga"),
        "quantity",
        F.lit(texts.IS_VALUE).alias("isValue"),
        numeric(F.col("total")).alias("Total"),
        "invoice_date",
    )


__all__ = ["basepack_detail", "basepack_summary", "invoice_distribution", "NUMERIC"]
