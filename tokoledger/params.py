"""Parameter objects.

Every literal the reference procedures hard-code (periods, codes, rates) is a
field here; the defaults are the reference's own values.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
ACTIVE_STATUSES = ("14", "15", "16", "31", "30")
ECO_MECHANISM = "2"
QUARTER = "Q3"
PROGRAM_YEAR = "2025"
QUARTER_MONTHS = (7, 8, 9)
SALES_FROM = dt.date(2025, 1, 1)
BASEPACK_DETAIL_FROM = dt.date(2035, 1, 1)
POINT_VALUE_RP = 4000                 # rupiah per point
BASEPACK_RATE = Decimal("0.004")      # share of sales paid as points
GROWTH_RATE = Decimal("0.005")
ECO_INCENTIVE_RATE = Decimal("0.02")
POINT_CLUSTERS = ("1", "2", "3")
CLUSTER_NAMES = (("1", "Small"), ("2", "Medium"), ("3", "Big"))
LEDGER_YEARS = tuple(range(2018, 2026))
OVO_TYPE_CODES = ("12",)
FAILED_DELIVERY = "Failed"
INJECTION_SALES_ID = "0"
FEEDBACK_SALES_ID = "1"
HEADER_INVOICE_TYPE = "I"
EXCLUDED_DIST_CODE = "99999999"
EXCLUDED_OUTLET_PATTERN = "R-%"
EXCLUDED_OUTLET_PREFIXES = ("888", "999")
COOLDOWN_MINUTES = 2


def per_point(rate: Decimal, point_value: int = POINT_VALUE_RP) -> Decimal:
    """``amount * rate / point_value`` is linear: fold it into one exact factor."""
    return rate / Decimal(point_value)


@dataclass(frozen=True)
class ActivityParams:
    mechanism_id: str = ECO_MECHANISM
    statuses: tuple[str, ...] = ACTIVE_STATUSES
    quarter: str = QUARTER
    year: str = PROGRAM_YEAR
    months: tuple[int, int, int] = QUARTER_MONTHS
    # The reference joins the ECO list on activity only, multiplying sums
    # by the number of ECO rows of the activity; "outlet" joins on outlet too.
    eco_scope: str = "activity"
    incentive_rate: Decimal = ECO_INCENTIVE_RATE
    point_value: int = POINT_VALUE_RP


@dataclass(frozen=True)
class SalesParams:
    """Shared by the basepack (O6-O10) and growth (O11-O12) batches."""
    from_date: dt.date = SALES_FROM
    detail_from: dt.date = BASEPACK_DETAIL_FROM   # T5: detail starts later
    basepack_rate: Decimal = BASEPACK_RATE
    growth_rate: Decimal = GROWTH_RATE
    point_value: int = POINT_VALUE_RP
    point_clusters: tuple[str, ...] = POINT_CLUSTERS
    cluster_names: tuple[tuple[str, str], ...] = CLUSTER_NAMES
    injection_sales_id: str = INJECTION_SALES_ID
    feedback_sales_id: str = FEEDBACK_SALES_ID
    as_of: dt.datetime | None = None      # GETDATE(): the time of the query, if not given


@dataclass(frozen=True)
class PointParams:
    ledger_years: tuple[int, ...] = LEDGER_YEARS
    ovo_type_codes: tuple[str, ...] = OVO_TYPE_CODES
    failed_status: str = FAILED_DELIVERY


@dataclass(frozen=True)
class ReportParams:
    year: int = int(PROGRAM_YEAR)
    excluded_dist_code: str = EXCLUDED_DIST_CODE
    excluded_outlet_pattern: str = EXCLUDED_OUTLET_PATTERN
    excluded_outlet_prefixes: tuple[str, ...] = EXCLUDED_OUTLET_PREFIXES
    header_invoice_type: str = HEADER_INVOICE_TYPE
    as_of: dt.datetime | None = None      # GETDATE(): the time of the query, if not given


@dataclass(frozen=True)
class InvoiceViewParams:
    """Optional filters of the two invoice views; ``None`` keeps all rows."""
    year: int | None = None
    month: int | None = None
    outlet_id: str | None = None
    invoice_no: str | None = None
    header_invoice_type: str = HEADER_INVOICE_TYPE
    as_of: dt.datetime | None = None      # GETDATE(): the time of the query, if not given


@dataclass(frozen=True)
class RedeemParams:
    cooldown_minutes: int = COOLDOWN_MINUTES
    point_value: int = POINT_VALUE_RP
    # The reference checks the balance against ONE unit of the gift
    check: str = "unit"
    # redeem_type of the detail rows; NULL unless the caller names one
    redeem_type: str | None = None
    # days before a batch's earliest request in which the request log is searched for its redeemnos
    lookback_days: int = 7
    points: PointParams = field(default_factory=PointParams)
