"""Sales in a target period (H1) and the points derived from it."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import NUMERIC, numeric, ts_lit
from ..params import SalesParams, per_point
from ..plans.joins import bounded_broadcast, by_month, month_bucket


def sales_by_outlet_time(invoices: DataFrame) -> DataFrame:
    """Invoice amount per outlet and invoice timestamp (the reference groups by
    the raw datetime, so the per-group rounding happens at that grain)."""
    return (
        invoices.groupBy(F.col("outlet_id").alias("s_outlet_id"), F.col("invoice_date").alias("s_invoice_date"))
        .agg(F.sum("invoice_amount").alias("s_amount"))
    )


def sales_in_period(invoices: DataFrame, p: SalesParams = SalesParams(), periods: DataFrame | None = None) -> DataFrame:
    """H1 over the invoices from ``p.from_date`` on and inside the window of ``periods``, both ends at the scan."""
    rows = invoices.filter(F.col("invoice_date") >= ts_lit(p.from_date))
    if periods is not None:
        rows = within_window(rows, period_window(periods))
    return sales_by_outlet_time(rows)


BASEPACK, GROWTH = "basepack", "growth"


def target_totals(invoices: DataFrame, p: SalesParams = SalesParams(), target_master: DataFrame | None = None,
                  target_growth: DataFrame | None = None) -> DataFrame:
    """Sales of the targets of both kinds (or of the given one) in one pass: one row per
    (kind, activity_id, outlet_id, cluster) with sales in a period of it, with their ``total``.

    Raw datetimes are compared with a basepack target's dates, dates with a growth target's (T12): written as
    ``begin <= moment < until``, both kinds share one join. The period is no key (T23). The (large, possibly skewed)
    sales side is streamed, so AQE can split a hot outlet; an outlet's sales meet the periods of their own month.
    """
    both = []
    if target_master is not None:
        both.append(target_master.select(
            F.lit(BASEPACK).alias("kind"), "activity_id", "outlet_id", "cluster", "periode_start", "periode_end",
            (F.col("periode_end").cast("timestamp_ntz") + F.expr("INTERVAL '0.000001' SECOND")).alias("until")))
    if target_growth is not None:
        both.append(target_growth.filter(F.col("periode_start") >= F.lit(p.from_date)).select(
            F.lit(GROWTH).alias("kind"), "activity_id", F.col("Outlet_id").alias("outlet_id"), F.col("Cluster").alias("cluster"),
            "periode_start", "periode_end", F.date_add("periode_end", 1).cast("timestamp_ntz").alias("until")))
    periods = reduce(DataFrame.unionByName, both)
    sales = sales_in_period(invoices, p, periods).withColumn("s_month", month_bucket(F.col("s_invoice_date")))
    targets = by_month(periods, "periode_start", "periode_end", "t_month")
    joined = sales.join(
        targets,
        (targets.outlet_id == sales.s_outlet_id) & (targets.t_month == sales.s_month)
        & (targets.periode_start <= sales.s_invoice_date) & (targets.until > sales.s_invoice_date),
        "inner",
    )
    return joined.groupBy("kind", "activity_id", "outlet_id", "cluster").agg(F.sum(numeric(F.col("s_amount"))).alias("total"))


def date_periods(periods: DataFrame, start: str = "periode_start", end: str = "periode_end") -> bool:
    """Whether the period bounds are DATE columns (read from the schema)."""
    return all(isinstance(periods.schema[c].dataType, T.DateType) for c in (start, end))


def day_grain(ts: Column) -> tuple[Column, Column]:
    """``(day, at_midnight)`` of a timestamp. Against DATE bounds (compared at
    midnight) they decide ``start <= ts <= end`` exactly, see :func:`in_date_period`,
    so invoice lines can be summed per day before any shuffle."""
    day = F.to_date(ts)
    return day, ts == day.cast("timestamp_ntz")


def in_date_period(start: Column, end: Column, day: Column, at_midnight: Column) -> Column:
    """``start <= ts AND end >= ts`` for DATE bounds, from :func:`day_grain`."""
    return (start <= day) & ((end > day) | ((end == day) & at_midnight))


def period_window(periods: DataFrame, start: str = "periode_start", end: str = "periode_end"):
    """Earliest start and latest end over a (small) table of target periods:
    one aggregate row, used as literal bounds so the invoice scans prune
    Parquet row groups outside every period. ``None`` when there are no
    periods."""
    row = periods.agg(F.min(start).alias("lo"), F.max(end).alias("hi")).first()
    if row is None or row["lo"] is None or row["hi"] is None:
        return None
    return row["lo"], row["hi"]


def within_window(df: DataFrame, window, column: str = "invoice_date") -> DataFrame:
    """Keep rows whose timestamp falls on a day inside ``window`` (a superset
    of every exact period test applied later); no window keeps nothing."""
    if window is None:
        return df.limit(0)
    lo, hi = window
    kept = df.filter(F.col(column) >= ts_lit(lo))
    if hi == dt.date.max:  # an open end: there is no day after it
        return kept
    return kept.filter(F.col(column) < ts_lit(hi + dt.timedelta(days=1)))


def basepack_lines(invoice_lines: DataFrame, products_basepack: DataFrame, p: SalesParams = SalesParams()) -> DataFrame:
    """Invoice lines with their basepack, from ``p.from_date`` on."""
    products = bounded_broadcast(products_basepack.select("sku_code", "basepack"), source=products_basepack)
    lines = invoice_lines.filter(F.col("invoice_date") >= ts_lit(p.from_date))
    return lines.join(products, lines.item_code == products.sku_code, "inner").select(
        "outlet_id",
        "invoice_no",
        F.year("invoice_date").alias("invoice_year"),
        F.month("invoice_date").alias("invoice_month"),
        "invoice_date",
        "basepack",
        "quantity",
        "total",
    )


def basepack_sales_points(target_master: DataFrame, invoices: DataFrame, p: SalesParams = SalesParams(),
                          totals: DataFrame | None = None) -> DataFrame:
    """Sales of each basepack target in its period and the raw points.

    Points are ``FLOOR(CAST(total * rate / 4000 AS decimal(18,4)))`` (T13).
    ``totals`` is :func:`target_totals` when already computed.
    """
    totals = target_totals(invoices, p, target_master=target_master) if totals is None else totals
    factor = F.lit(per_point(p.basepack_rate, p.point_value))
    points = F.floor((F.col("total") * factor).cast("decimal(18,4)"))
    return totals.where(F.col("kind") == BASEPACK).select(
        "activity_id",
        "outlet_id",
        "cluster",
        F.col("total").cast("decimal(38,0)").alias("total_sales_temp"),
        F.coalesce(
            F.when(F.col("cluster").isin(*p.point_clusters), points).otherwise(F.lit(0)), F.lit(0)
        ).cast(NUMERIC).alias("Aktual_Point_temp"),
    )


def growth_sales_points(target_growth: DataFrame, invoices: DataFrame, p: SalesParams = SalesParams(),
                        totals: DataFrame | None = None) -> DataFrame:
    """Sales per growth target (LEFT: targets without sales stay) and points.

    Points are rounded, not floored (T13). A cluster outside the point clusters gets 0 points (the reference
    raises, T11). ``totals`` is :func:`target_totals` when already computed.
    """
    totals = target_totals(invoices, p, target_growth=target_growth) if totals is None else totals
    matched = totals.where(F.col("kind") == GROWTH).select(
        F.col("activity_id").alias("m_activity_id"), F.col("outlet_id").alias("m_outlet_id"),
        F.col("cluster").alias("m_cluster"), F.col("total").alias("pencapaian"))
    # targets without sales come back through the left join of the per-target
    # totals (same result as the reference's LEFT JOIN + GROUP BY)
    keys = target_growth.filter(F.col("periode_start") >= F.lit(p.from_date)).select("activity_id", "Outlet_id", "Cluster").distinct()
    out = keys.join(
        matched,
        (keys.activity_id.eqNullSafe(matched.m_activity_id)) & (keys.Outlet_id.eqNullSafe(matched.m_outlet_id))
        & (keys.Cluster.eqNullSafe(matched.m_cluster)),
        "left",
    )
    factor = F.lit(per_point(p.growth_rate, p.point_value))
    points = (F.col("pencapaian") * factor).cast(NUMERIC)
    return out.select(
        "activity_id",
        "Outlet_id",
        "Cluster",
        F.col("pencapaian").cast("decimal(38,0)").alias("pencapaian"),
        F.coalesce(F.when(F.col("Cluster").isin(*p.point_clusters), points), F.lit(0))
        .cast(NUMERIC)
        .alias("point_temp"),
    )
