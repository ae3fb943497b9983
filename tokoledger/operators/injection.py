"""Injection / feedback invoices (H2) and the 13 columns derived from them.

Injection invoices carry ``sales_id = '0'``, feedback invoices ``'1'``; both
point at an activity through ``document_ID``. The reference LEFT-joins both to
every target row and then GROUPs BY their attributes, so each consumer gets
them here already reduced to one row per (outlet, activity, attributes) with a
row count -- joining two raw invoice sets would emit every injection x
feedback pair of an outlet before the GROUP BY collapses them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.exprs import NUMERIC, col, numeric
from ..plans.joins import hot_keys


def invoices_of_kind(invoices: DataFrame, sales_id: str, prefix: str, attrs: list[str], max_invoice_no: bool) -> DataFrame:
    """One row per (outlet, document, ``attrs``) with ``{prefix}n`` = row count.

    With ``max_invoice_no`` the invoice number is aggregated (MAX) instead of
    being one of the attributes.
    """
    rows = invoices.filter(F.col("sales_id") == F.lit(sales_id))
    keys = [F.col("outlet_id").alias(f"{prefix}outlet_id"), F.col("document_ID").alias(f"{prefix}document_ID")]
    keys += [F.col(a).alias(f"{prefix}{a}") for a in attrs]
    aggs = [F.count(F.lit(1)).alias(f"{prefix}n")]
    if max_invoice_no:
        aggs.append(F.max("invoice_no").alias(f"{prefix}invoice_no"))
    return rows.groupBy(*keys).agg(*aggs)


def injection_feedback_rows(invoices: DataFrame, injection_sales_id: str, feedback_sales_id: str) -> DataFrame:
    """The (few) injection and feedback invoices with the columns H2 uses: one
    narrow slice that several consumers can share instead of rescanning."""
    return invoices.filter(F.col("sales_id").isin(injection_sales_id, feedback_sales_id)).select(
        "sales_id", "outlet_id", "document_ID", "invoice_no", "invoice_date", "upload_date",
        "expected_invoice_addt_reward", "payment_amount")


def hot_documents(invoices: DataFrame, injection_sales_id: str, feedback_sales_id: str) -> DataFrame | None:
    """The (outlet, document) pairs with very many injection and feedback invoices, see ``joins.hot_keys``."""
    kinds = invoices.filter(F.col("sales_id").isin(injection_sales_id, feedback_sales_id))
    return hot_keys(kinds, "outlet_id", "document_ID", source=invoices)


def injection_columns(point_value: int, inj_no: str = "inm_invoice_no", fb_no: str = "fb_invoice_no") -> list:
    """The 13 injection/feedback output columns over prefixed ``inm_`` / ``fb_`` columns."""
    inj = numeric(F.col("inm_expected_invoice_addt_reward"))
    fb = numeric(F.col("fb_expected_invoice_addt_reward"))
    inj0 = F.coalesce(inj, F.lit(0).cast(NUMERIC))
    fb0 = F.coalesce(fb, F.lit(0).cast(NUMERIC))
    pv = F.lit(point_value)
    return [
        F.coalesce(F.col(inj_no), F.lit(texts.NONE_MARK)).alias("Injection Code"),
        F.when(F.col("inm_upload_date").isNull(), F.lit(texts.NONE_MARK))
        .otherwise(F.date_format("inm_upload_date", texts.INJECTION_DATE_FORMAT))
        .alias("Injection Date"),
        inj0.cast(NUMERIC).alias("Point Injected"),
        F.coalesce(inj * pv, F.lit(0)).cast("decimal(22,0)").alias("Budget Utilized Initital"),
        fb0.cast(NUMERIC).alias("Gap Point Injected"),
        (inj0 + fb0).cast("decimal(19,0)").alias("Final Point Injected"),
        ((inj0 + fb0) * pv).cast("decimal(23,0)").alias("Budget Utilized Final"),
        F.when(F.col("fb_payment_amount").isNull(), F.lit(0))
        .otherwise(numeric(F.col("fb_payment_amount")))
        .cast(NUMERIC)
        .alias("Feedback Ach sales"),
        F.coalesce(F.col(fb_no), F.lit(texts.NONE_MARK)).alias("Feedback Injection Code"),
        F.when(F.col(fb_no).isNull(), F.lit(texts.NONE_MARK)).otherwise(F.lit(texts.APPROVED)).alias("Feedback Remark"),
        fb0.cast(NUMERIC).alias("Feedback Point"),
        fb0.cast(NUMERIC).alias("Gap"),
        (inj0 + fb0).cast("decimal(19,0)").alias("Final Point"),
    ]


INJECTION_OUTPUT = [
    "Injection Code", "Injection Date", "Point Injected", "Budget Utilized Initital", "Gap Point Injected",
    "Final Point Injected", "Budget Utilized Final", "Feedback Ach sales", "Feedback Injection Code",
    "Feedback Remark", "Feedback Point", "Gap", "Final Point",
]

__all__ = ["invoices_of_kind", "injection_columns", "INJECTION_OUTPUT", "col"]
