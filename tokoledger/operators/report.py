"""Latest address (O14), daily outlet report (O16) and the two app invoice
views (O17 lines, O18 headers)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.exprs import NUMERIC, id_date, id_long_date, money_text, numeric, now_or, month_range, year_range
from ..params import InvoiceViewParams, ReportParams
from ..plans.joins import bounded_broadcast

ADDRESS_COLUMNS = ["nama_penerima", "nama_jalan", "no_rumah", "kelurahan", "kecamatan", "kota", "kode_pos",
                   "lokasi", "alamat_detail", "image_lokasi", "url"]


def latest_address(addresses: DataFrame, columns: list[str] = ADDRESS_COLUMNS, trim_key: bool = False) -> DataFrame:
    """The address row with the highest id per outlet.

    A ``max(struct(id, ...))`` aggregate instead of ROW_NUMBER: it combines
    map-side, so an outlet holding most of the rows never lands whole in one
    task. Ties on id are broken by the remaining columns (deterministic).
    """
    key = F.rtrim(F.col("outlet_id")) if trim_key else F.col("outlet_id")
    best = addresses.groupBy(key.alias("outlet_id")).agg(
        F.max(F.struct(F.col("id").cast("int").alias("id"), *[F.col(c) for c in columns])).alias("best"))
    return best.select(
        F.col("best.id").alias("id"), "outlet_id", *[F.col(f"best.{c}").alias(c) for c in columns],
        F.lit(1).alias("RowNum"),
    )


def daily_outlet_report(
    summary_outlet: DataFrame,
    outlet_master: DataFrame,
    mapping: DataFrame,
    users: DataFrame,
    participants: DataFrame,
    injected: DataFrame,
    redeemed: DataFrame,
    p: ReportParams = ReportParams(),
) -> DataFrame:
    """One row per master row (outer side) and matching mapping / user /
    participant row. ``injected`` is O16a, ``redeemed`` O15. Duplicate mapping,
    user or participant rows repeat the report row (T8); a NULL distributor
    code drops the row here although O15 keeps it (T9).
    """
    b = outlet_master.filter(F.col("KODE_DIS") != F.lit(p.excluded_dist_code)).select(
        F.col("KODE_TOKO").alias("b_outlet"), "Remark_freeze")
    a = summary_outlet.select("REGION", "AREA", "KODE_DISTRIBUTOR", "KODE_OUTLET")
    c = mapping.select(F.col("outlet_code").alias("c_outlet"), "dt_code_latest")
    d = users.select(F.col("outlet_id").alias("d_outlet"), "user_id")
    e = participants.select(F.col("KODE_OUTLET").alias("e_outlet"))
    g = injected.select(F.col("outlet_id").alias("g_outlet"), "total_point")
    h = redeemed.select(F.col("outlet_id").alias("h_outlet"), "total_redeem")

    j = b.join(a, b.b_outlet == a.KODE_OUTLET, "left")
    j = j.join(c, j.KODE_OUTLET == c.c_outlet, "left")
    j = j.join(d, j.KODE_OUTLET == d.d_outlet, "left")
    j = j.join(e, j.KODE_OUTLET == e.e_outlet, "left")
    j = j.join(g, j.KODE_OUTLET == g.g_outlet, "left")
    j = j.join(h, j.KODE_OUTLET == h.h_outlet, "left")

    total = F.coalesce(F.col("total_point"), F.lit(0).cast(NUMERIC))
    redeem = F.coalesce(F.col("total_redeem"), F.lit(0)).cast("decimal(38,4)")
    region = F.when(F.col("REGION").like(texts.REGION_KEEP_PATTERN), F.col("REGION")).otherwise(
        F.concat(F.lit(texts.REGION_PREFIX), F.col("REGION")))
    area = (
        F.when(F.col("AREA").like(texts.AREA_KEEP_PATTERN), F.col("AREA"))
        .when(F.col("AREA") == F.lit(texts.AREA_KEEP_EXACT), F.lit(texts.AREA_KEEP_EXACT))
        .otherwise(F.concat(F.lit(texts.AREA_PREFIX), F.col("AREA")))
    )
    return j.select(
        region.alias("REGION"),
        area.alias("AREA"),
        "KODE_DISTRIBUTOR",
        "KODE_OUTLET",
        "user_id",
        total.cast(NUMERIC).alias("TOTAL_POINT"),
        redeem.alias("REDEEM_POINT"),
        (total - redeem).cast("decimal(38,4)").alias("POINT_SAAT_INI"),
        F.col("dt_code_latest").alias("MAPPING_DT_CODE"),
        F.col("Remark_freeze").alias("Remark_Freeze"),
        F.lit(str(p.year)).alias("YEAR"),
        now_or(p.as_of).alias("update_date"),
    )


def _view_filters(df: DataFrame, p: InvoiceViewParams, with_invoice: bool) -> DataFrame:
    if p.year is not None and p.month is not None:
        df = df.filter(month_range(F.col("invoice_date"), int(p.year), int(p.month)))
    elif p.year is not None:
        df = df.filter(year_range(F.col("invoice_date"), int(p.year)))
    elif p.month is not None:
        df = df.filter(F.month("invoice_date") == F.lit(int(p.month)))
    if p.outlet_id is not None:
        df = df.filter(F.rtrim(F.col("outlet_id")) == F.lit(p.outlet_id.rstrip(" ")))
    if with_invoice and p.invoice_no is not None:
        df = df.filter(F.rtrim(F.col("invoice_no")) == F.lit(p.invoice_no.rstrip(" ")))
    return df


def invoice_lines_view(invoice_detail: DataFrame, products: DataFrame,
                       p: InvoiceViewParams = InvoiceViewParams()) -> DataFrame:
    """Formatted invoice lines; filters are optional (``None`` = all)."""
    lines = _view_filters(invoice_detail, p, with_invoice=True)
    prod = bounded_broadcast(products.select(F.col("sku_code"), F.col("product_description")), source=products)
    j = lines.join(prod, lines.item_code == prod.sku_code, "left")
    return j.select(
        F.rtrim(F.col("outlet_id")).alias("outlet_id"),
        F.rtrim(F.col("invoice_no")).alias("invoice_no"),
        F.concat(F.col("product_description"), F.lit(" ("), F.rtrim(F.col("item_code")), F.lit(")"))
        .alias("product_name"),
        F.lit(texts.BAR_PRICE).alias("bar_harga"),
        money_text(F.col("price")).alias("price"),
        F.lit(texts.BAR_QTY).alias("bar_qty"),
        "quantity",
        F.lit(texts.BAR_TOTAL).alias("bar_total"),
        money_text(F.col("total")).alias("total"),
        F.year("invoice_date").alias("year"),
        F.month("invoice_date").alias("month"),
    )


def invoice_headers_view(invoices: DataFrame, p: InvoiceViewParams = InvoiceViewParams()) -> DataFrame:
    """Formatted invoice headers; Indonesian dates, 'Hari ini' for the
    ``p.as_of`` day."""
    rows = _view_filters(invoices.filter(F.col("invoice_type") == F.lit(p.header_invoice_type)), p,
                         with_invoice=False)
    today = F.to_date(F.col("invoice_date")) == F.to_date(now_or(p.as_of))
    return rows.select(
        F.rtrim(F.col("outlet_id")).alias("outlet_id"),
        F.when(today, F.concat(F.lit(texts.TODAY_PREFIX), id_date(F.col("invoice_date"))))
        .otherwise(id_long_date(F.col("invoice_date"))).alias("invoice_date"),
        F.lit(texts.BAR_INVOICE).alias("bar_invoice"),
        F.concat(F.lit("#"), F.rtrim(F.col("invoice_no"))).alias("invoice_no"),
        F.lit(texts.BAR_INVOICE_TOTAL).alias("bar_total"),
        money_text(F.col("invoice_amount")).alias("invoice_amount"),
        numeric(F.col("invoice_amount")).alias("cek"),
        F.year("invoice_date").alias("year"),
        F.month("invoice_date").alias("month"),
    )
