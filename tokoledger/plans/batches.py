"""The reference's entry points as batch runs.

* :func:`run_growth_basepack` -- growth achievement, then basepack detail,
  summary and drill-down (the growth procedure, then the basepack procedure)
* :func:`run_activity_quarter` -- O1-O5 (the activity detail and summary procedures)
* :func:`invoice_lines`, :func:`invoice_headers` -- the two invoice lookups (returned)
* :func:`daily_report` -- the daily outlet report (returned, not stored)
* :func:`run_redemption_batch` -- a batch of redemption requests, decided in one pass

Each table the reference persists is written to the sink and read back, which
also cuts the lineage: later steps scan the stored rows instead of re-running
the joins that produced them (a lost executor re-reads stored files).
"""

from __future__ import annotations

import datetime as dt
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import activity, basepack, facts, growth, points, redeem, report, sales
from ..params import ActivityParams, InvoiceViewParams, RedeemParams, ReportParams, SalesParams
from ..sources.sinks import Sink
from ..sources.tables import BALANCE, Tables
from .joins import bounded_broadcast

if TYPE_CHECKING:
    from .balances import BalanceStore

# output table names of the reference
GROWTH_TABLE = "achievement_growth_new"
BASEPACK_DETAIL_TABLE = "Basepack_Outlet_Detail"
BASEPACK_SUMMARY_TABLE = "Basepack_Outlet_Summary"
DISTRIBUTION_TABLE = "invoice_detail_distribution_2023"
ACTIVITY_TABLES = ("activity_detail_inv", "activity_detail_inv_achievement", "activity_detail_inv_summary",
                   "activity_summary_achievement")
REDEEM_TABLES = ("point_redeem", "point_redeem_detail", "notifications")
GATE_TABLE = "redeem_gate"
REQUEST_LOG = "redeem_request_log"


def run_growth_basepack(t: Tables, sink: Sink, p: SalesParams = SalesParams()) -> dict[str, DataFrame]:
    """Growth first (its table feeds the basepack summary), then basepack.

    The invoice table is read twice instead of six times: the targets' totals feed O11 and O7, the
    injection and feedback invoices O12 and O9 (see ``facts``). Both are stored, so a lost executor costs no scan.
    """
    invoices = t["invoice_master"]
    found = facts.invoice_facts(t, p)
    totals, kinds = found.totals, found.documents
    growth_points = sales.growth_sales_points(t["target_growth"], invoices, p, totals)
    grw = sink.overwrite(GROWTH_TABLE, growth.growth_achievement(
        t["target_growth"], growth_points, t["activities_regular"], kinds, p), ["outlet_code"])
    lines = sales.basepack_lines(t["invoice_detail_activity"], t["master_products_basepack_new"], p)
    detail = sink.overwrite(BASEPACK_DETAIL_TABLE, basepack.basepack_detail(
        t["outlet_basepack_target_detail"], lines, t["temp_master_data_uli"], t["activities_regular"], p),
        ["KODE TOKO"])
    pts = sales.basepack_sales_points(t["outlet_basepack_target_master"], invoices, p, totals)
    summary = sink.overwrite(BASEPACK_SUMMARY_TABLE, basepack.basepack_summary(
        t["outlet_basepack_target_master"], detail, pts, t["activities_regular"], kinds, grw, p),
        ["KODE TOKO"])
    dist = sink.overwrite(DISTRIBUTION_TABLE, basepack.invoice_distribution(
        t["invoice_detail_activity"], t["outlet_basepack_target_detail"]), ["outlet_id", "invoice_no"])
    return {GROWTH_TABLE: grw, BASEPACK_DETAIL_TABLE: detail, BASEPACK_SUMMARY_TABLE: summary,
            DISTRIBUTION_TABLE: dist}


def run_activity_quarter(t: Tables, sink: Sink, p: ActivityParams = ActivityParams()) -> dict[str, DataFrame]:
    detail_name, ach_name, sum_name, inc_name = ACTIVITY_TABLES
    progress = sink.overwrite(detail_name, activity.activity_sku_progress(
        t["invoice_detail_activity"], t["temp_act_outlet_list"], t["act_sku_eco"], t["activities"],
        t["temp_act_outlet_list_eco"], p), ["outlet_id"])      # the reference orders it by outlet
    pivot = sink.overwrite(ach_name, activity.activity_achievement_pivot(
        activity.activity_monthly_achievement(progress), p), ["outlet_id"])
    eco = sink.overwrite(sum_name, activity.activity_eco_summary(
        t["temp_act_outlet_list"], t["temp_act_outlet_list_eco"], pivot, t["activities"], p), ["outlet_id"])
    incentive = sink.overwrite(inc_name, activity.activity_incentive_summary(
        t["temp_act_outlet_list"], t["activities"], t["ref_categories"], t["live_mechanism_list"],
        t["temp_act_outlet_list_eco"], eco, p), ["Outlet_id"])
    return dict(zip(ACTIVITY_TABLES, (progress, pivot, eco, incentive)))


def daily_report(t: Tables, p: ReportParams = ReportParams()) -> DataFrame:
    redeemed = points.redeemed_by_outlet(t["point_redeem"], t["user_info"], t["temp_master_data_uli"], p)
    injected = points.injected_points_by_outlet(t["invoice_master"], p)
    return report.daily_outlet_report(t["summary_outlet"], t["temp_master_data_uli"], t["outlet_monthly_mapping"],
                                      t["user_info"], t["master_peserta"], injected, redeemed, p)


def _with_earlier_rounds(t: Tables, sink: Sink, name: str, cols: list[str], round_id: int) -> DataFrame:
    base = t[name].select(*cols)
    earlier = sink.rounds(name, before=round_id)
    return base if earlier is None else base.unionByName(earlier.select(*cols))


def round_ledger(t: Tables, sink: Sink, round_id: int, p: RedeemParams = RedeemParams()) -> DataFrame:
    """The ledger of the balance database's tables and of the committed rounds before ``round_id``."""
    t = t.source(BALANCE)
    redeemed = _with_earlier_rounds(t, sink, "point_redeem",
                                    ["redeem_no", "gift_code", "point_redeem", "point_year", "status_delivery"],
                                    round_id)
    detail = _with_earlier_rounds(t, sink, "point_redeem_detail", ["redeem_no", "outlet_id"], round_id)
    return points.point_ledger(t["invoice_master"], redeemed, detail, t["point_redeem_detail_cashback"],
                               t["ppob_transaction_master"], t["ewallet_transaction_master"], t["redeem_item"],
                               p.points)


def decided_before(sink: Sink, requests: DataFrame, round_id: int, p: RedeemParams = RedeemParams()) -> DataFrame | None:
    """redeemno of the requests that earlier rounds decided, looked up in the request log from ``p.lookback_days``
    before the earliest request on; the log is stored by day, so older files are not read."""
    log = sink.rounds(REQUEST_LOG, before=round_id)
    if log is None:
        return None
    first = requests.agg(F.min(F.to_date("request_ts"))).first()[0]
    if first is not None:
        log = log.filter(F.col("request_day") >= F.lit(first - dt.timedelta(days=p.lookback_days)))
    asked = requests.select(F.rtrim(F.col("redeemno")).alias("redeemno")).distinct()
    return log.join(bounded_broadcast(asked, source=requests), "redeemno", "left_semi").select("redeemno")


def run_redemption_batch(t: Tables, sink: Sink, requests: DataFrame, round_id: int | None = None,
                         p: RedeemParams = RedeemParams(), balances: "BalanceStore | None" = None) -> DataFrame:
    """Decide all requests of a batch in one pass, in the order of their calls, store the rows of the accepted ones
    (point_redeem, point_redeem_detail, notifications) and return the stored gate.

    The batch is one round: its tables become visible together or not at all, so a failure between two writes leaves
    no part of it. Rows of earlier rounds count in its balances. Without a ``round_id`` it comes after all
    stored rounds; only a retry names the id it repeats. Requests that an earlier round decided spend nothing.
    ``balances``: a maintained :class:`~tokoledger.plans.balances.BalanceStore` to take the
    opening balances from instead of the whole ledger.
    """
    if round_id is None:
        round_id = sink.next_round()
    b = t.source(BALANCE)
    opening = ledger = None
    if balances is None:
        ledger = round_ledger(t, sink, round_id, p)
    else:
        balances.absorb_rounds(before=round_id)
        pairs = redeem.clean_requests(requests).select("outlet_id", "year").distinct()
        opening = balances.balances(pairs, b["new_point_balance"], before=round_id, pairs_source=requests)
    with sink.round(round_id) as one:
        gate = one.write(GATE_TABLE, redeem.redemption_gate(
            requests, ledger, b["new_point_balance"], b["redeem_item"], b["user_info"], b["master_peserta"],
            t["log_validasi_redeem"], p, opening, decided_before(sink, requests, round_id, p),
            None if b is t else t["redeem_item"]))
        one.write("point_redeem", redeem.redemption_rows(gate, t["redeem_item"], p))
        one.write("point_redeem_detail", redeem.redemption_detail_rows(gate, t["alamat_pengiriman"], b["user_info"], p))
        one.write("notifications", redeem.redemption_notifications(gate, t["redeem_item"]))
        logged = gate.filter(F.col("redeemno").isNotNull()
                             & F.coalesce(F.col("reject_reason") != "duplicate_request", F.lit(True)))
        one.write(REQUEST_LOG, logged.select("redeemno", F.to_date("request_ts").alias("request_day")).sortWithinPartitions("request_day"))
    return gate


def invoice_lines(t: Tables, p: InvoiceViewParams) -> DataFrame:
    """The line view of the outlet, invoice and month in ``p``, with all of them at the scan."""
    rows = t.matching("invoice_detail", outlet_id=p.outlet_id, invoice_no=p.invoice_no)
    return report.invoice_lines_view(rows, t["master_products"], p)


def invoice_headers(t: Tables, p: InvoiceViewParams) -> DataFrame:
    """The header view of the outlet and month in ``p``, with both at the scan."""
    return report.invoice_headers_view(t.matching("invoice_master", outlet_id=p.outlet_id), p)
