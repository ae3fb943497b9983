"""Point balance (O13, set-based), redeemed points per outlet (O15) and
injected points per outlet (O16a).

The reference computes a balance one (outlet, year) at a time with six scalar
queries. Here all earning and spending channels become one signed ledger
(``unionByName``), aggregated once per (outlet, year) with map-side partial
aggregation, and joined to the requested pairs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import NUMERIC, POINTS4, ts_lit, year_range
from ..params import PointParams, ReportParams
from ..plans.joins import bounded_broadcast, is_bounded

EARNED, CATALOGUE, CASHBACK, PPOB, OVO, EWALLET = "earned", "catalogue", "cashback", "ppob", "ovo", "ewallet"
COMPONENTS = (EARNED, CATALOGUE, CASHBACK, PPOB, OVO, EWALLET)
_DETAIL = "detail"


def _years_filter(c, years) -> object:
    return F.coalesce(c.isin(*years), F.lit(False))


def point_ledger(
    invoices: DataFrame,
    point_redeem: DataFrame,
    redeem_detail: DataFrame,
    cashback: DataFrame,
    ppob: DataFrame,
    ewallet: DataFrame,
    items: DataFrame,
    p: PointParams = PointParams(),
    components: tuple[str, ...] = COMPONENTS,
) -> DataFrame:
    """Ledger rows ``(outlet_id, year, component, points)``; spends are positive
    here and subtracted in the balance.

    The channel tables are stacked and joined to ``point_redeem`` once (one
    shuffle on redeem_no) instead of one join per channel. ``components``
    limits the ledger to some channels (their tables are then not read).
    """
    lo, hi = min(p.ledger_years), max(p.ledger_years)
    earned = invoices.filter(
        (F.col("invoice_date") >= ts_lit(dt.datetime(lo, 1, 1)))
        & (F.col("invoice_date") < ts_lit(dt.datetime(hi + 1, 1, 1)))
    ).select(
        "outlet_id",
        F.year("invoice_date").alias("year"),
        F.lit(EARNED).alias("component"),
        (F.coalesce(F.col("expected_invoice_reward"), F.lit(0))
         + F.coalesce(F.col("expected_invoice_addt_reward"), F.lit(0))
         + F.coalesce(F.col("expected_invoice_npd_reward"), F.lit(0))).cast(POINTS4).alias("points"),
    ).filter(F.col("year").isin(*p.ledger_years))
    if components == (EARNED,):
        return earned

    stacked = []
    if CATALOGUE in components or OVO in components:
        stacked.append(redeem_detail.select("redeem_no", "outlet_id", F.lit(_DETAIL).alias("channel")))
    for name, table in ((CASHBACK, cashback), (PPOB, ppob), (EWALLET, ewallet)):
        if name in components:
            stacked.append(table.select("redeem_no", "outlet_id", F.lit(name).alias("channel")))
    channels = stacked[0]
    for more in stacked[1:]:
        channels = channels.unionByName(more)
    redeemed = point_redeem.filter(F.col("point_year").isin(*p.ledger_years)).select(
        F.col("redeem_no").alias("x_redeem_no"), "gift_code", "point_redeem", "point_year", "status_delivery"
    )
    j = redeemed.join(channels, redeemed.x_redeem_no == channels.redeem_no, "inner")
    # cashback, PPOB and e-wallet never look at the catalogue; a detail counts once for each catalogue row of its
    # gift and not at all without one (T19), so the catalogue is reduced to counts per code and the join emits no copies
    counted = [F.struct(F.col("channel").alias("component"), F.when(F.col("channel") != _DETAIL, 1).otherwise(0).alias("n"))]
    if CATALOGUE in components or OVO in components:
        is_ovo = F.coalesce(F.col("type_code"), F.lit("00")).isin(*p.ovo_type_codes).cast("int")
        gifts = bounded_broadcast(items.groupBy("redeem_code").agg(
            F.sum(is_ovo).cast("int").alias("n_ovo"), F.sum(1 - is_ovo).cast("int").alias("n_catalogue")), source=items)
        j = j.join(gifts, (j.gift_code == gifts.redeem_code) & (j.channel == _DETAIL), "left")
        delivered = F.col("status_delivery") != F.lit(p.failed_status)          # NULL status drops (T18)
        counted.append(F.struct(F.lit(CATALOGUE).alias("component"), F.coalesce("n_catalogue", F.lit(0)).alias("n")))
        counted.append(F.struct(F.lit(OVO).alias("component"), F.when(delivered, F.coalesce("n_ovo", F.lit(0))).otherwise(0).alias("n")))
    spent = j.select("outlet_id", F.col("point_year").alias("year"), "point_redeem", F.explode(F.array(*counted)).alias("c")).filter(
        (F.col("c.n") > 0) & F.col("c.component").isin(*components)).select(
        "outlet_id", "year", F.col("c.component").alias("component"),
        (F.coalesce(F.col("point_redeem"), F.lit(0)) * F.col("c.n")).cast(POINTS4).alias("points"))
    return earned.unionByName(spent) if EARNED in components else spent


def point_components(ledger: DataFrame) -> DataFrame:
    """Per (outlet, year, component) totals (O13a-f)."""
    return ledger.groupBy("outlet_id", "year", "component").agg(
        F.sum("points").cast(POINTS4).alias("points"))


def component_points(ledger: DataFrame, component: str) -> DataFrame:
    return (
        ledger.filter(F.col("component") == component)
        .groupBy("outlet_id", "year")
        .agg(F.sum("points").cast(POINTS4).alias("points"))
    )


def point_balance(pairs: DataFrame, ledger: DataFrame, stored: DataFrame, p: PointParams = PointParams(),
                  pairs_source: DataFrame | None = None) -> DataFrame:
    """Balance per requested ``(outlet_id, year)``.

    Ledger years: earned minus the five spends; other years: the stored
    balance whatever the year (T20); nothing found: 0. A stored balance held
    twice for one outlet (the reference raises) counts once, the larger.

    ``pairs_source`` is a table the pairs come from row by row (e.g. a batch
    of requests). When it is small enough to broadcast, the ledger is cut to
    the requested pairs map-side, before its aggregation shuffle.
    """
    in_ledger = _years_filter(F.col("year"), p.ledger_years)
    req = pairs.select("outlet_id", F.col("year").cast("int").alias("year"))
    signed = F.when(F.col("component") == EARNED, F.col("points")).otherwise(-F.col("points"))
    if pairs_source is not None and is_bounded(pairs, source=pairs_source):
        wanted = F.broadcast(req.filter(in_ledger).distinct())
        ledger = ledger.join(wanted, ["outlet_id", "year"], "left_semi")
        stored = stored.join(F.broadcast(req.filter(~in_ledger).select("outlet_id").distinct()), "outlet_id",
                             "left_semi")
    totals = ledger.groupBy(F.col("outlet_id").alias("l_outlet_id"), F.col("year").alias("l_year")).agg(
        F.sum(signed).alias("ledger_total"))
    return stored_or_ledger(req, totals, stored, p)


def stored_or_ledger(pairs: DataFrame, totals: DataFrame, stored: DataFrame, p: PointParams = PointParams()) -> DataFrame:
    """The balance of each pair: of a ledger year from ``totals`` (l_outlet_id, l_year, ledger_total), of another
    from ``stored``."""
    req = pairs.select("outlet_id", F.col("year").cast("int").alias("year"))
    in_ledger = _years_filter(F.col("year"), p.ledger_years)
    kept = stored.groupBy(F.col("outlet_id").alias("s_outlet_id")).agg(F.max("remain_point").alias("stored_total"))

    a = req.filter(in_ledger)
    a = a.join(totals, (a.outlet_id == totals.l_outlet_id) & (a.year == totals.l_year), "left").select(
        "outlet_id", "year", F.col("ledger_total").alias("total"))
    b = req.filter(~in_ledger)
    b = b.join(kept, b.outlet_id == kept.s_outlet_id, "left").select(
        "outlet_id", "year", F.col("stored_total").alias("total"))
    return a.unionByName(b).select(
        "outlet_id", "year", F.coalesce(F.col("total"), F.lit(0)).cast(POINTS4).alias("total_point"))


def redeemed_by_outlet(
    point_redeem: DataFrame, users: DataFrame, outlet_master: DataFrame, p: ReportParams = ReportParams()
) -> DataFrame:
    """Points redeemed per outlet in ``p.year``.

    Redemptions are summed per user before the joins; duplicate user or
    master rows multiply the sum as in the reference (T8), through counts.
    """
    per_user = point_redeem.filter(F.col("point_year") == F.lit(p.year)).groupBy(
        F.col("user_id").alias("p_user_id")).agg(F.sum("point_redeem").alias("user_total"))
    u = users.groupBy("user_id", "outlet_id").agg(F.count(F.lit(1)).alias("u_n"))
    passes = ~F.coalesce(F.col("KODE_DIS"), F.lit("")).like(p.excluded_dist_code)
    tm = outlet_master.groupBy(F.col("KODE_TOKO").alias("tm_outlet")).agg(
        F.sum(F.when(passes, 1).otherwise(0)).alias("tm_pass"))
    j = per_user.join(u, per_user.p_user_id == u.user_id, "inner")
    j = j.filter(~F.col("outlet_id").like(p.excluded_outlet_pattern)
                 & ~F.left(F.col("outlet_id"), F.lit(3)).isin(*p.excluded_outlet_prefixes))
    j = j.join(tm, j.outlet_id == tm.tm_outlet, "left")
    mult = F.col("u_n") * F.coalesce(F.col("tm_pass"), F.lit(1))
    return (
        j.filter(mult > 0)
        .groupBy(F.rtrim(F.col("outlet_id")).alias("outlet_id"))
        .agg(F.sum(F.col("user_total") * mult).cast("decimal(38,4)").alias("total_redeem"))
    )


def injected_points_by_outlet(invoices: DataFrame, p: ReportParams = ReportParams()) -> DataFrame:
    """Additional reward of non-header invoices in ``p.year`` per outlet
    (a NULL invoice type is dropped, T10)."""
    rows = invoices.filter(year_range(F.col("invoice_date"), p.year)
                           & (F.col("invoice_type") != F.lit(p.header_invoice_type)))
    return rows.groupBy("outlet_id").agg(
        F.sum("expected_invoice_addt_reward").cast(NUMERIC).alias("total_point"))
