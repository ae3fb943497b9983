"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import texts

NUMERIC = "decimal(18,0)"      # T-SQL ``numeric`` without precision
POINTS4 = "decimal(18,4)"      # the balance function's variables


def col(name: str) -> Column:
    """Column by name; names with blanks or dots are quoted."""
    return F.col(f"`{name}`") if (" " in name or "." in name) else F.col(name)


def numeric(c: Column) -> Column:
    """``CAST(x AS numeric)``: decimal(18,0), rounds half away from zero."""
    return c.cast(NUMERIC)


def ts_lit(value: dt.datetime | dt.date | str) -> Column:
    """A zone-less timestamp literal (T-SQL ``datetime``)."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(value).cast("timestamp_ntz")


def clamp_at_zero(diff: Column) -> Column:
    """``CASE WHEN d <= 0 THEN 0 ELSE d END`` (NULL stays NULL)."""
    return F.when(diff <= 0, F.lit(0)).otherwise(diff)


def flag(cond: Column, yes: str = "A", no: str = "NA") -> Column:
    """Achievement flag; an unknown (NULL) condition gives ``no``."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def money_text(amount: Column) -> Column:
    """``'Rp. ' + FORMAT(CAST(x AS numeric(18,0)), '#,###')``.

    The .NET ``#`` pattern prints nothing for zero, so 0 becomes ``'Rp. '``.
    """
    n = numeric(amount)
    body = F.when(n == 0, F.lit("")).otherwise(F.call_function("format_number", n, F.lit("#,###")))
    return F.concat(F.lit(texts.MONEY_PREFIX), body)


def _id_day_month_year(ts: Column) -> Column:
    months = F.array(*[F.lit(m) for m in texts.ID_MONTH_NAMES])
    return F.concat(
        F.lpad(F.dayofmonth(ts).cast("string"), 2, "0"), F.lit(" "),
        F.element_at(months, F.month(ts)), F.lit(", "),
        F.lpad(F.year(ts).cast("string"), 4, "0"),
    )


def id_date(ts: Column) -> Column:
    """``FORMAT(d, 'dd MMMM, yyyy', 'id-ID')``."""
    return _id_day_month_year(ts)


def id_long_date(ts: Column) -> Column:
    """``FORMAT(d, 'dddd, dd MMMM, yyyy', 'id-ID')``."""
    days = F.array(*[F.lit(d) for d in texts.ID_DAY_NAMES])
    return F.concat(F.element_at(days, F.dayofweek(ts)), F.lit(", "), _id_day_month_year(ts))


def year_range(c: Column, year: int) -> Column:
    """``YEAR(c) = year`` as a range so Parquet statistics can prune."""
    return (c >= ts_lit(dt.datetime(year, 1, 1))) & (c < ts_lit(dt.datetime(year + 1, 1, 1)))


def month_range(c: Column, year: int, month: int) -> Column:
    """``YEAR(c) = year AND MONTH(c) = month`` as one range."""
    after = dt.datetime(year + month // 12, month % 12 + 1, 1)
    return (c >= ts_lit(dt.datetime(year, month, 1))) & (c < ts_lit(after))


def now_or(as_of: dt.datetime | None) -> Column:
    """The given moment, or that of the query."""
    return F.current_timestamp().cast("timestamp_ntz") if as_of is None else ts_lit(as_of)


def capped_points(points: Column, least: Column, most: Column, failed: Column, applies: Column | None = None) -> Column:
    """H3: no points if ``failed`` or below ``least``, never more than ``most``. An unknown comparison counts as
    not met, so a NULL bound does not bind. Bounds only hold where ``applies`` is true, if given."""
    bound = F.lit(True) if applies is None else applies
    return F.when(failed, F.lit(0)).when(bound & (points < least), F.lit(0)).when(bound & (points >= most), most).otherwise(points)
