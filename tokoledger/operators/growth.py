"""Sales-growth target achievement and capped points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.exprs import capped_points, flag, numeric, now_or
from ..params import SalesParams
from ..plans.joins import bounded_broadcast, left_join_dealt
from .injection import INJECTION_OUTPUT, hot_documents, injection_columns, invoices_of_kind

CORE_KEYS = [
    "activity_id", "Dist_Code", "Outlet_id", "outlet_name", "Bar_Title_Target", "Target_toko", "pencapaian",
    "POINT_didapat", "POINT_max", "point_temp", "Cluster", "periode_start", "periode_end", "status_id",
    "status_approval",
]


def growth_achievement(
    target_growth: DataFrame,
    growth_points: DataFrame,
    activities_regular: DataFrame,
    invoices: DataFrame,
    p: SalesParams = SalesParams(),
) -> DataFrame:
    """One row per growth target and distinct injection/feedback combination.

    ``growth_points`` is O11. The injection invoice number is not a grouping
    key, so it is a real MAX over the group (T22).
    """
    tc = target_growth.filter(F.col("periode_start") >= F.lit(p.from_date))
    pts = growth_points.select(
        F.col("activity_id").alias("g_activity_id"), F.col("Outlet_id").alias("g_Outlet_id"),
        "pencapaian", "point_temp",
    )
    regular = bounded_broadcast(activities_regular.select(
        F.col("activity_id").alias("r_activity_id"), "status_id", "status_approval").distinct(),
        source=activities_regular)
    inm = invoices_of_kind(
        invoices, p.injection_sales_id, "inm_",
        ["invoice_date", "upload_date", "expected_invoice_addt_reward"], max_invoice_no=True,
    ).drop("inm_n")
    fb = invoices_of_kind(
        invoices, p.feedback_sales_id, "fb_",
        ["expected_invoice_addt_reward", "payment_amount", "invoice_no"], max_invoice_no=False,
    ).drop("fb_n")

    j = tc.join(pts, (tc.activity_id == pts.g_activity_id) & (tc.Outlet_id == pts.g_Outlet_id), "left")
    j = j.join(regular, j.activity_id == regular.r_activity_id, "left")
    # The GROUP BY of the reference is a DISTINCT over the target-side keys
    # times the distinct injection / feedback attributes. Both invoice sides
    # are already distinct on their attributes (MAX(invoice_no) taken), so the
    # DISTINCT runs on the small target side and the joins below produce each
    # output row once: no shuffle over the expanded output.
    core = j.select(*CORE_KEYS, "g_activity_id").distinct()
    # the reference matches the invoices' document on O11's activity (NULL without sales)
    hot = hot_documents(invoices, p.injection_sales_id, p.feedback_sales_id)
    g = left_join_dealt(core, inm, ["Outlet_id", "g_activity_id"], ["inm_outlet_id", "inm_document_ID"], hot)
    g = left_join_dealt(g, fb, ["Outlet_id", "g_activity_id"], ["fb_outlet_id", "fb_document_ID"], hot)

    target_n = numeric(F.col("Target_toko"))
    capai_n = numeric(F.coalesce(F.col("pencapaian"), F.lit(0)))
    remaining = (
        F.when(target_n - capai_n <= 0, F.lit(0))
        .when(capai_n <= 0, target_n)
        .otherwise(target_n - capai_n)
    )
    actual = capped_points(F.col("point_temp"), F.col("POINT_didapat"), F.col("POINT_max"),
                           failed=F.col("pencapaian") < F.col("Target_toko"))
    cluster_name = F.lit(texts.NONE_MARK)
    for code, name in reversed(p.cluster_names):
        cluster_name = F.when(F.col("Cluster") == F.lit(code), F.lit(name)).otherwise(cluster_name)

    return g.select(
        F.lit(0).alias("Bar_seq"),
        "activity_id",
        "Dist_Code",
        F.col("Outlet_id").alias("outlet_code"),
        F.col("outlet_name").alias("nama_toko"),
        "Bar_Title_Target",
        F.lit(texts.BAR_TARGET).alias("Bar_Target"),
        F.lit(texts.IS_VALUE).alias("isValue"),
        target_n.alias("rpp_target"),
        F.lit(texts.BAR_TITLE_ACHIEVED).alias("Bar_Title_Capai"),
        capai_n.alias("rpp_capai"),
        F.lit(texts.BAR_TITLE_REMAINING).alias("Bar_Title_Sisa"),
        remaining.cast("decimal(19,0)").alias("rpp_sisa"),
        F.lit(texts.BAR_TITLE_MIN).alias("Bar_Title_Simulasi"),
        F.coalesce(F.col("POINT_didapat"), F.lit(0)).cast("decimal(18,2)").alias("rpp_simulasi"),
        F.lit(texts.BAR_TITLE_MAX).alias("Bar_Title_Simulasi_max"),
        F.coalesce(F.col("POINT_max"), F.lit(0)).cast("decimal(18,2)").alias("rpp_simulasi_max"),
        F.lit(texts.BAR_TITLE_ACTUAL).alias("Bar_Title_Aktual_Point"),
        actual.cast("decimal(18,2)").alias("rpp_aktual_point"),
        F.lit(0).alias("flag"),
        cluster_name.alias("cluster"),
        "periode_start",
        "periode_end",
        F.year("periode_start").alias("Year"),
        F.month("periode_start").alias("Month"),
        *injection_columns(p.point_value),
        "status_id",
        "status_approval",
        flag(F.col("pencapaian") >= F.col("Target_toko")).alias("status_achievment"),
        now_or(p.as_of).alias("update_date"),
    )


OUTPUT_COLUMNS = [
    "Bar_seq", "activity_id", "Dist_Code", "outlet_code", "nama_toko", "Bar_Title_Target", "Bar_Target", "isValue",
    "rpp_target", "Bar_Title_Capai", "rpp_capai", "Bar_Title_Sisa", "rpp_sisa", "Bar_Title_Simulasi", "rpp_simulasi",
    "Bar_Title_Simulasi_max", "rpp_simulasi_max", "Bar_Title_Aktual_Point", "rpp_aktual_point", "flag", "cluster",
    "periode_start", "periode_end", "Year", "Month", *INJECTION_OUTPUT, "status_id", "status_approval",
    "status_achievment", "update_date",
]
