"""Registered queries: every operator run over the stand-in tables of one
test-data directory (whole tables, no row caps)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import params as P
from .operators import activity, basepack, facts, growth, points, redeem, report, sales
from .sources import standins as S
from .sources.tables import Tables, from_testdata

_CACHE: dict[tuple[str, str], Tables] = {}


def standin_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Stand-ins of ``sf_dir``, built once per application (they are persisted)."""
    key = (spark.conf.get("spark.app.id", None) or str(id(spark)), sf_dir.rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = from_testdata(spark, sf_dir)
    return _CACHE[key]


# parameters matching the stand-in dates
SALES = P.SalesParams(from_date=S.STANDIN_FROM, detail_from=S.STANDIN_FROM, as_of=S.STANDIN_AS_OF)
SALES_DEFAULT_DETAIL = P.SalesParams(from_date=S.STANDIN_FROM, as_of=S.STANDIN_AS_OF)
ACTIVITY = P.ActivityParams(quarter=S.STANDIN_QUARTER, year=str(S.STANDIN_YEAR))
ACTIVITY_OUTLET_SCOPE = P.ActivityParams(quarter=S.STANDIN_QUARTER, year=str(S.STANDIN_YEAR), eco_scope="outlet")
POINTS = P.PointParams(ledger_years=S.STANDIN_LEDGER_YEARS)
REPORT = P.ReportParams(year=S.STANDIN_YEAR, as_of=S.STANDIN_AS_OF)
VIEWS = P.InvoiceViewParams(as_of=S.STANDIN_VIEW_AS_OF)
VIEWS_MONTH = P.InvoiceViewParams(year=S.STANDIN_YEAR, month=8, as_of=S.STANDIN_VIEW_AS_OF)
REDEEM = P.RedeemParams(points=POINTS, redeem_type=S.STANDIN_REDEEM_TYPE)
STORED_YEAR = 2030          # outside the ledger years: the stored balance applies


# ---- sales, growth, basepack ------------------------------------------------
def _o6(t: Tables, p=SALES) -> DataFrame:
    return sales.basepack_lines(t["invoice_detail_activity"], t["master_products_basepack_new"], p)


def _o7(t: Tables, p=SALES) -> DataFrame:
    return sales.basepack_sales_points(t["outlet_basepack_target_master"], t["invoice_master"], p)


def _o11(t: Tables, p=SALES) -> DataFrame:
    return sales.growth_sales_points(t["target_growth"], t["invoice_master"], p)


def _o12(t: Tables, p=SALES, found: facts.InvoiceFacts | None = None) -> DataFrame:
    found = facts.invoice_facts(t, p, basepack=False) if found is None else found
    made = sales.growth_sales_points(t["target_growth"], t["invoice_master"], p, found.totals)
    return growth.growth_achievement(t["target_growth"], made, t["activities_regular"], found.documents, p)


def _o8(t: Tables, p=SALES) -> DataFrame:
    return basepack.basepack_detail(
        t["outlet_basepack_target_detail"], _o6(t, p), t["temp_master_data_uli"], t["activities_regular"], p
    )


def _o9(t: Tables, p=SALES) -> DataFrame:
    found = facts.invoice_facts(t, p)
    made = sales.basepack_sales_points(t["outlet_basepack_target_master"], t["invoice_master"], p, found.totals)
    return basepack.basepack_summary(
        t["outlet_basepack_target_master"], _o8(t, p), made, t["activities_regular"], found.documents,
        _o12(t, p, found), p,
    )


def _o10(t: Tables) -> DataFrame:
    return basepack.invoice_distribution(t["invoice_detail_activity"], t["outlet_basepack_target_detail"])


# ---- activity quarter -------------------------------------------------------
def _o1(t: Tables, p=ACTIVITY) -> DataFrame:
    return activity.activity_sku_progress(
        t["invoice_detail_activity"], t["temp_act_outlet_list"], t["act_sku_eco"], t["activities"],
        t["temp_act_outlet_list_eco"], p,
    )


def _o2(t: Tables, p=ACTIVITY) -> DataFrame:
    return activity.activity_monthly_achievement(_o1(t, p))


def _o3(t: Tables, p=ACTIVITY) -> DataFrame:
    return activity.activity_achievement_pivot(_o2(t, p), p)


def _o4(t: Tables, p=ACTIVITY) -> DataFrame:
    return activity.activity_eco_summary(
        t["temp_act_outlet_list"], t["temp_act_outlet_list_eco"], _o3(t, p), t["activities"], p
    )


def _o5(t: Tables, p=ACTIVITY) -> DataFrame:
    return activity.activity_incentive_summary(
        t["temp_act_outlet_list"], t["activities"], t["ref_categories"], t["live_mechanism_list"],
        t["temp_act_outlet_list_eco"], _o4(t, p), p,
    )


# ---- points and daily report ------------------------------------------------
def _ledger(t: Tables, p=POINTS, components=points.COMPONENTS) -> DataFrame:
    return points.point_ledger(
        t["invoice_master"], t["point_redeem"], t["point_redeem_detail"], t["point_redeem_detail_cashback"],
        t["ppob_transaction_master"], t["ewallet_transaction_master"], t["redeem_item"], p, components,
    )


def _component(t: Tables, component: str) -> DataFrame:
    return points.component_points(_ledger(t, POINTS, (component,)), component)


def balance_pairs(t: Tables) -> DataFrame:
    """Every (outlet, year) with invoices, plus every redemption request."""
    inv = t["invoice_master"].select("outlet_id", F.year("invoice_date").alias("year"))
    req = t["requests"].select("outlet_id", F.col("year").cast("int").alias("year"))
    return inv.union(req).distinct()


def _balance(t: Tables) -> DataFrame:
    return points.point_balance(balance_pairs(t), _ledger(t), t["new_point_balance"], POINTS)


def _balance_stored(t: Tables) -> DataFrame:
    pairs = t["user_info"].select("outlet_id", F.lit(STORED_YEAR).alias("year")).distinct()
    return points.point_balance(pairs, _ledger(t), t["new_point_balance"], POINTS)


def _o15(t: Tables) -> DataFrame:
    return points.redeemed_by_outlet(t["point_redeem"], t["user_info"], t["temp_master_data_uli"], REPORT)


def _o16a(t: Tables) -> DataFrame:
    return points.injected_points_by_outlet(t["invoice_master"], REPORT)


def _o16(t: Tables) -> DataFrame:
    return report.daily_outlet_report(
        t["summary_outlet"], t["temp_master_data_uli"], t["outlet_monthly_mapping"], t["user_info"],
        t["master_peserta"], _o16a(t), _o15(t), REPORT,
    )


# ---- redemption batch -------------------------------------------------------
def _gate(t: Tables) -> DataFrame:
    return redeem.redemption_gate(
        t["requests"], _ledger(t), t["new_point_balance"], t["redeem_item"], t["user_info"], t["master_peserta"],
        t["log_validasi_redeem"], REDEEM,
    )


def builders() -> dict[str, Callable[[Tables], DataFrame]]:
    """Query name -> function of a :class:`Tables` (stand-ins or materialised)."""
    reg: dict[str, Callable[[Tables], DataFrame]] = {
        "basepack_lines": _o6,
        "basepack_sales_points": _o7,
        "basepack_detail": _o8,
        "basepack_summary": _o9,
        "basepack_summary_empty_detail": lambda t: _o9(t, SALES_DEFAULT_DETAIL),
        "invoice_distribution": _o10,
        "growth_sales_points": _o11,
        "growth_achievement": _o12,
        "activity_sku_progress": _o1,
        "activity_sku_progress_outlet_scope": lambda t: _o1(t, ACTIVITY_OUTLET_SCOPE),
        "activity_monthly_achievement": _o2,
        "activity_achievement_pivot": _o3,
        "activity_eco_summary": _o4,
        "activity_incentive_summary": _o5,
        "points_earned": lambda t: _component(t, points.EARNED),
        "points_catalogue": lambda t: _component(t, points.CATALOGUE),
        "points_cashback": lambda t: _component(t, points.CASHBACK),
        "points_ppob": lambda t: _component(t, points.PPOB),
        "points_ovo": lambda t: _component(t, points.OVO),
        "points_ewallet": lambda t: _component(t, points.EWALLET),
        "point_balance": _balance,
        "point_balance_stored": _balance_stored,
        "latest_address": lambda t: report.latest_address(t["alamat_pengiriman"]),
        "redeemed_by_outlet": _o15,
        "injected_points_by_outlet": _o16a,
        "daily_outlet_report": _o16,
        "invoice_lines_view": lambda t: report.invoice_lines_view(t["invoice_detail"], t["master_products"], VIEWS),
        "invoice_lines_view_month": lambda t: report.invoice_lines_view(
            t["invoice_detail"], t["master_products"], VIEWS_MONTH),
        "invoice_headers_view": lambda t: report.invoice_headers_view(t["invoice_master"], VIEWS),
        "invoice_headers_view_month": lambda t: report.invoice_headers_view(t["invoice_master"], VIEWS_MONTH),
        "redemption_gate": _gate,
        "redemption_rows": lambda t: redeem.redemption_rows(_gate(t), t["redeem_item"], REDEEM),
        "redemption_detail_rows": lambda t: redeem.redemption_detail_rows(
            _gate(t), t["alamat_pengiriman"], t["user_info"], REDEEM),
        "redemption_notifications": lambda t: redeem.redemption_notifications(_gate(t), t["redeem_item"]),
    }
    return reg


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for name, build in builders().items():
        out[name] = (lambda b: (lambda spark, sf_dir: b(standin_tables(spark, sf_dir))))(build)
    return out
