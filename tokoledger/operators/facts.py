"""What the growth and basepack batch asks of the invoices, each read once and stored.

O7 and O11 need the sales inside target periods: one scan with both period ends pushed down, one join with
the periods of both kinds and one aggregation give the totals of every target. O9 and O12 need the injection
and feedback invoices: a second, narrow scan with the kinds of ``sales_id`` pushed down. Both results
are small against the invoices (rows per target, rows per injected invoice).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..params import SalesParams
from ..plans.stored import stored
from ..sources.tables import Tables
from .injection import injection_feedback_rows
from .sales import target_totals


@dataclass(frozen=True)
class InvoiceFacts:
    totals: DataFrame       # ``sales.target_totals`` of the basepack and the growth targets
    documents: DataFrame    # ``injection.injection_feedback_rows``


def invoice_facts(t: Tables, p: SalesParams = SalesParams(), basepack: bool = True) -> InvoiceFacts:
    """Without ``basepack`` only the growth targets' totals are there."""
    master = t["outlet_basepack_target_master"] if basepack else None
    few = t.matching("invoice_master", sales_id=(p.injection_sales_id, p.feedback_sales_id))
    return InvoiceFacts(
        stored(target_totals(t["invoice_master"], p, master, t["target_growth"]), "target-totals"),
        stored(injection_feedback_rows(few, p.injection_sales_id, p.feedback_sales_id), "injected-invoices"),
    )
