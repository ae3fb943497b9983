"""Activity (ECO programme) operators O1-O5.

The reference joins several lists whose duplicate rows multiply its sums
(T1, T3). Here each list is first reduced to one row per key with a row count
and the sums are multiplied by those counts: identical numbers, but the join
never emits the product rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import NUMERIC, flag, numeric
from ..params import ActivityParams, per_point
from ..plans.joins import bounded_broadcast
from .sales import period_window, within_window

MONEY = "decimal(18,2)"


def _counted(df: DataFrame, keys: list, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _program_activities(activities: DataFrame, p: ActivityParams, with_status: bool = True) -> DataFrame:
    cond = F.col("mechanism_id") == F.lit(p.mechanism_id)
    if with_status:
        cond = cond & F.col("status_activities").isin(*p.statuses)
    return activities.filter(cond)


def activity_sku_progress(
    lines: DataFrame,
    outlet_list: DataFrame,
    sku_targets: DataFrame,
    activities: DataFrame,
    eco: DataFrame,
    p: ActivityParams = ActivityParams(),
) -> DataFrame:
    """O1: quantity and value per activity, outlet, SKU and invoice month.

    ``p.eco_scope="activity"`` reproduces the reference: every ECO row of the
    activity in the quarter multiplies the sums (T1); ``"outlet"`` counts only
    the outlet's own ECO rows.
    """
    outlets = _counted(outlet_list, [F.col("activity_id").alias("b_activity_id"),
                                     F.col("Outlet_id").alias("b_outlet_id")], "b_n")
    skus = bounded_broadcast(_counted(sku_targets, [F.col("activity_id").alias("c_activity_id"), "sku_code",
                                                    "ispcs"], "c_n"), source=sku_targets)
    acts = bounded_broadcast(_counted(
        _program_activities(activities, p),
        [F.col("activity_id").alias("d_activity_id"), "periode_start", "periode_end"], "d_n"), source=activities)
    eco_rows = eco.filter((F.col("quarter") == F.lit(p.quarter)) & (F.col("year") == F.lit(p.year)))
    eco_keys = [F.col("activity_id").alias("e_activity_id")]
    if p.eco_scope == "outlet":
        eco_keys.append(F.col("Outlet_id").alias("e_outlet_id"))
    elif p.eco_scope != "activity":
        raise ValueError(f"eco_scope must be 'activity' or 'outlet', not {p.eco_scope!r}")
    eco_n = _counted(eco_rows, eco_keys, "e_n")

    # the programme's overall period cuts the line scan (Parquet row-group
    # pruning) before the outlet shuffle; the exact per-activity test follows
    lines = within_window(lines, period_window(_program_activities(activities, p)))
    # No separate pre-aggregation of the lines: it would be a shuffle of its
    # own (lines rarely repeat an item per outlet and day), while the
    # aggregation below combines map-side after the single outlet shuffle.
    j = lines.join(outlets, lines.outlet_id == outlets.b_outlet_id, "inner")
    j = j.join(skus, (j.item_code == skus.sku_code) & (j.b_activity_id == skus.c_activity_id), "inner")
    j = j.join(acts, (j.b_activity_id == acts.d_activity_id)
               & (j.invoice_date >= acts.periode_start) & (j.invoice_date <= acts.periode_end), "inner")
    when = F.col("invoice_date")
    if p.eco_scope == "outlet":
        j = j.join(eco_n, (j.b_activity_id == eco_n.e_activity_id) & (j.outlet_id == eco_n.e_outlet_id), "inner")
    else:
        j = j.join(bounded_broadcast(eco_n, source=eco), j.b_activity_id == eco_n.e_activity_id, "inner")
    mult = F.col("b_n") * F.col("c_n") * F.col("d_n") * F.col("e_n")
    g = j.groupBy(
        F.col("b_activity_id").alias("activity_id"), "outlet_id", "sku_code",
        F.year(when).alias("invoice_year"), F.month(when).alias("invoice_month"), "ispcs",
    ).agg(
        F.sum(F.col("quantity") * mult).alias("total_qty"),
        F.sum(F.col("total") * mult).alias("total_value"),
    )
    remaining = F.col("ispcs") - F.col("total_qty")
    return g.select(
        "activity_id",
        F.lit(p.quarter).alias("quarter"),
        "outlet_id",
        "sku_code",
        F.col("ispcs").alias("target"),
        F.col("total_qty").cast("bigint").alias("total_qty"),
        remaining.cast("bigint").alias("sisa_target"),
        flag(remaining <= 0).alias("status"),
        numeric(F.col("total_value")).alias("total_value"),
        "invoice_year",
        "invoice_month",
    )


def activity_monthly_achievement(progress: DataFrame) -> DataFrame:
    """O2: number of achieved SKUs per activity, outlet and month."""
    return (
        progress.filter(F.col("status") == "A")
        .groupBy("activity_id", "outlet_id", "invoice_year", "invoice_month", "quarter")
        .agg(F.count("status").alias("Achievement"))
        .select("activity_id", "quarter", "outlet_id", "Achievement", "invoice_year", "invoice_month")
    )


def activity_achievement_pivot(monthly: DataFrame, p: ActivityParams = ActivityParams()) -> DataFrame:
    """O3: the three months of the quarter side by side (one pass, no pivot
    shuffle); years are not a key, two years collapse by MAX (T2)."""
    cols = [
        F.coalesce(F.max(F.when(F.col("invoice_month") == m, F.col("Achievement"))), F.lit(0))
        .cast("bigint").alias(f"achievement_{i}")
        for i, m in enumerate(p.months, start=1)
    ]
    return (
        monthly.groupBy("activity_id", "outlet_id", "quarter")
        .agg(*cols, F.max("invoice_year").alias("invoice_year"))
        .select("activity_id", "quarter", "outlet_id", "achievement_1", "achievement_2", "achievement_3",
                "invoice_year")
    )


def activity_eco_summary(
    outlet_list: DataFrame,
    eco: DataFrame,
    pivot: DataFrame,
    activities: DataFrame,
    p: ActivityParams = ActivityParams(),
) -> DataFrame:
    """ECO targets against the monthly achievements. Remark_ECO is a SUM
    over the joined rows, so duplicate list rows inflate it (T3)."""
    ta = _counted(outlet_list, ["activity_id", F.col("Outlet_id").alias("outlet_id")], "ta_n")
    le = _counted(
        eco.filter((F.col("quarter") == F.lit(p.quarter)) & (F.col("year") == F.lit(p.year))),
        [F.col("activity_id").alias("le_activity_id"), F.col("Outlet_id").alias("le_outlet_id"), "quarter",
         "year", "target_1", "target_2", "target_3"], "le_n")
    ac = bounded_broadcast(_counted(_program_activities(activities, p, with_status=False),
                                    [F.col("activity_id").alias("ac_activity_id")], "ac_n"), source=activities)
    ia = _counted(pivot, [F.col("activity_id").alias("ia_activity_id"), F.col("outlet_id").alias("ia_outlet_id"),
                          F.col("quarter").alias("ia_quarter"), F.col("achievement_1").alias("ia_1"),
                          F.col("achievement_2").alias("ia_2"), F.col("achievement_3").alias("ia_3")], "ia_n")
    j = ta.join(le, (ta.activity_id == le.le_activity_id) & (ta.outlet_id == le.le_outlet_id), "inner")
    j = j.join(ac, j.activity_id == ac.ac_activity_id, "inner")
    j = j.join(ia, (j.activity_id == ia.ia_activity_id) & (j.outlet_id == ia.ia_outlet_id)
               & (j.quarter == ia.ia_quarter), "left")
    g = j.groupBy("activity_id", "outlet_id", "quarter", "year", "target_1", "ia_1", "target_2", "ia_2",
                  "target_3", "ia_3").agg(
        F.sum(F.col("ta_n") * F.col("le_n") * F.col("ac_n") * F.coalesce(F.col("ia_n"), F.lit(1))).alias("rows"))

    def remark(i: int):
        return F.when(F.col(f"target_{i}") - F.coalesce(F.col(f"ia_{i}"), F.lit(0)) <= 0, F.lit(1)).otherwise(F.lit(0))

    out = [F.col("activity_id"), F.col("quarter"), F.col("outlet_id")]
    for i in (1, 2, 3):
        out += [
            F.col(f"target_{i}"),
            F.coalesce(F.col(f"ia_{i}"), F.lit(0)).cast("bigint").alias(f"achievement_{i}"),
            remark(i).alias(f"Remark_{i}"),
        ]
    out.append(((remark(1) + remark(2) + remark(3)) * F.col("rows")).cast("bigint").alias("Remark_ECO"))
    return g.select(*out)


def activity_incentive_summary(
    outlet_list: DataFrame,
    activities: DataFrame,
    categories: DataFrame,
    live_mechanism: DataFrame,
    eco: DataFrame,
    eco_summary: DataFrame,
    p: ActivityParams = ActivityParams(),
) -> DataFrame:
    """One incentive row per outlet and activity.

    The reference's GROUP BY without aggregates is a DISTINCT over its keys,
    one of which (the ECO list's vrr) is not in the output. Each side is made
    distinct on the columns it contributes, which makes the joined rows
    distinct without a final shuffle over the output.
    """
    a = outlet_list.select("activity_id", "Region", "Area", "Dist_Code", "Dist_Name", "Outlet_id", "Outlet_Name",
                           "Target_Toko", "VRR", "Simulasi_Point", "VRR_Addt").distinct()
    cats = bounded_broadcast(categories.select(F.col("category_id").alias("bb_category_id"), "category_name"),
                             source=categories)
    acts = _program_activities(activities, p).select("activity_id", "category_id")
    b = acts.join(cats, acts.category_id == cats.bb_category_id, "left").select(
        F.col("activity_id").alias("b_activity_id"), "category_name").distinct()
    c = live_mechanism.select(F.col("outlet_code").alias("c_outlet"), F.col("activity_id").alias("c_activity_id"),
                              "rpp_capai").distinct()
    d = eco.filter((F.col("quarter") == F.lit(p.quarter)) & (F.col("year") == F.lit(p.year))).select(
        F.col("activity_id").alias("d_activity_id"), F.col("Outlet_id").alias("d_outlet_id"),
        F.col("year"), F.col("vrr").alias("d_vrr")).distinct()
    e = eco_summary.select(
        F.col("outlet_id").alias("e_outlet_id"), F.col("activity_id").alias("e_activity_id"), "quarter",
        *[F.col(f"{k}_{i}") for i in (1, 2, 3) for k in ("target", "achievement", "Remark")], "Remark_ECO",
    ).distinct()
    j = a.join(bounded_broadcast(b), a.activity_id == b.b_activity_id, "inner")
    j = j.join(c, (j.Outlet_id == c.c_outlet) & (j.activity_id == c.c_activity_id), "left")
    j = j.join(d, (j.activity_id == d.d_activity_id) & (j.Outlet_id == d.d_outlet_id), "inner")
    j = j.join(e, (j.Outlet_id == e.e_outlet_id) & (j.activity_id == e.e_activity_id), "left")

    met = (F.col("Target_Toko") - F.col("rpp_capai")) <= 0
    eco_bonus = F.round(F.col("Target_Toko") * F.lit(per_point(p.incentive_rate, p.point_value)), 0)
    all_months = (F.col("Remark_1") == 1) & (F.col("Remark_2") == 1) & (F.col("Remark_3") == 1)
    zero = F.lit(Decimal(0))
    cols = [
        "activity_id",
        F.col("quarter").alias("Periode"),
        "year",
        "category_name",
        "Region", "Area", "Dist_Code", "Dist_Name", "Outlet_id", "Outlet_Name",
        F.col("Target_Toko").alias("Target_Sales_Q1"),
        F.coalesce(F.col("rpp_capai"), zero).cast(MONEY).alias("Ach_Sales"),
        flag(met).alias("Remark"),
        F.concat(F.ceil(F.col("VRR")).cast("string"), F.lit("%")).alias("VRR"),
        F.when(met, F.col("Simulasi_Point")).otherwise(zero).cast(MONEY).alias("Incentive_Target_Sales"),
    ]
    for word, i in (("One", 1), ("Two", 2), ("Tri", 3)):
        cols += [
            F.col(f"target_{i}").alias(f"{word}_Target_ECO"),
            F.col(f"achievement_{i}").alias(f"{word}_Actual_ECO"),
            F.when(F.col(f"Remark_{i}") == 0, F.lit("NA")).otherwise(F.lit("A")).alias(f"{word}_Remark_ECO"),
        ]
    cols += [
        flag(F.col("Remark_ECO") == 3).alias("Remark_Q1_ECO"),
        F.concat(F.col("VRR_Addt").cast("string"), F.lit("%")).alias("VRR_ECO"),
        F.when(F.col("Remark_ECO") == 3, eco_bonus).otherwise(zero).cast(MONEY).alias("Incentive_Q1_ECO"),
        F.when(met & all_months, F.col("Simulasi_Point") + eco_bonus).otherwise(zero).cast(MONEY)
        .alias("Total_Incentive"),
    ]
    return j.select(*cols)


__all__ = [
    "activity_sku_progress", "activity_monthly_achievement", "activity_achievement_pivot",
    "activity_eco_summary", "activity_incentive_summary", "NUMERIC",
]
