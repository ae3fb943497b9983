"""Join-strategy helpers.

Dimension sides (activities, gift catalogue, SKU targets ...) are broadcast only
after their size is proven: a bounded ``limit(n + 1).count()``. Above the
bound the side is left to the planner (sort-merge join, with AQE free to
convert it at runtime from measured shuffle sizes).

A side derived from one table by filters, projections, aggregation or
DISTINCT never has more rows than that table, so the bound can be proven on
the table itself (``source=``): one cheap count per table and session instead
of one job per derived side.
"""

from __future__ import annotations

import weakref
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stored import stored

# months that interval joins tell apart; what lies before or after counts to the first or last one
BUCKETS_FROM, BUCKETS_TO = (1990, 1), (2060, 12)

MAX_ROWS_KEY = "tokoledger.broadcast.maxRows"
DEFAULT_MAX_ROWS = 200_000

HOT_ROWS_KEY = "tokoledger.join.hotRows"
DEFAULT_HOT_ROWS = 100_000

_HOT: "weakref.WeakKeyDictionary[DataFrame, dict[tuple, DataFrame | None]]" = weakref.WeakKeyDictionary()
_PROVEN: "weakref.WeakKeyDictionary[DataFrame, tuple[int, bool]]" = weakref.WeakKeyDictionary()


def broadcast_limit(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(MAX_ROWS_KEY, None)
    return int(value) if value else DEFAULT_MAX_ROWS


def _within(df: DataFrame, bound: int) -> bool:
    try:
        cached = _PROVEN.get(df)
    except TypeError:          # not weak-referenceable: just count
        cached = None
    if cached is not None and cached[0] == bound:
        return cached[1]
    ok = df.limit(bound + 1).count() <= bound
    try:
        _PROVEN[df] = (bound, ok)
    except TypeError:
        pass
    return ok


def is_bounded(df: DataFrame, max_rows: int | None = None, source: DataFrame | None = None) -> bool:
    """Whether ``df`` (or ``source``) provably has at most the broadcast bound of rows."""
    bound = broadcast_limit(df) if max_rows is None else max_rows
    return bound > 0 and _within(df if source is None else source, bound)


def bounded_broadcast(df: DataFrame, max_rows: int | None = None, source: DataFrame | None = None) -> DataFrame:
    """``broadcast(df)`` when ``df`` (or ``source``, a table it is derived from
    without joins) has at most ``max_rows`` rows, else ``df`` unchanged."""
    bound = broadcast_limit(df) if max_rows is None else max_rows
    if bound <= 0:
        return df
    return F.broadcast(df) if _within(df if source is None else source, bound) else df


def month_bucket(when: Column) -> Column:
    """The month of a date or timestamp as a number, see :func:`by_month`."""
    (y0, m0), (y1, m1) = BUCKETS_FROM, BUCKETS_TO
    number = F.year(when) * 12 + F.month(when)
    return F.least(F.greatest(number, F.lit(y0 * 12 + m0)), F.lit(y1 * 12 + m1))


def by_month(periods: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """One row per period and month that it touches, with the month in ``name``.

    An interval join on (key, month) with the exact interval as residual gives what the join on the key
    alone gives: a moment has one month, and a period that holds the moment touches that month. A row then
    meets the periods of its own month instead of all of its key's, and a key with very many rows is dealt over its months.
    Open-ended periods stay short, as all months outside a fixed range count as its edges.
    """
    months = F.sequence(month_bucket(F.col(start)), month_bucket(F.col(end)))
    return periods.withColumn(name, F.explode(F.when(F.col(start) <= F.col(end), months).otherwise(F.array().cast("array<int>"))))


def hot_keys(rows: DataFrame, *keys: str, source: DataFrame | None = None) -> DataFrame | None:
    """The keys with more than ``tokoledger.join.hotRows`` rows and the number of shares that each is dealt
    into (``key_0``, ..., ``shares``), stored; ``None`` where there is none. One aggregate, remembered for ``source``."""
    limit = int(rows.sparkSession.conf.get(HOT_ROWS_KEY, None) or DEFAULT_HOT_ROWS)
    known = _HOT.setdefault(rows if source is None else source, {})
    if (keys, limit) not in known:
        named = [F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)]
        counts = rows.groupBy(*named).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
        hot = counts.select(*[f"key_{i}" for i in range(len(keys))], F.ceil(F.col("n") / limit).cast("int").alias("shares"))
        known[keys, limit] = None if hot.isEmpty() else stored(hot, "hot-keys")
    return known[keys, limit]


def left_join_dealt(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], hot: DataFrame | None) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on equal keys, where a key of ``right`` may hold a third of all rows.

    AQE splits a hot key only on the preserved side of an outer join, and here the other side is hot. The rows of a hot
    key are dealt over its shares by a hash of the whole row, and the left rows of that key are repeated for each share.
    A repeated left row that meets no row in a share is dropped: a hot key has rows, so the left
    row meets them in other shares. Rows of all other keys are joined as ever. The names of the two sides must differ.
    """
    equal = reduce(and_, [F.col(a) == F.col(b) for a, b in zip(left_keys, right_keys, strict=True)])
    if hot is None:
        return left.join(right, equal, "left")

    def shares(side: DataFrame, keys: list[str], name: str) -> DataFrame:
        named = hot.select(*[F.col(f"key_{i}").alias(f"{name}_{i}") for i in range(len(keys))], F.col("shares").alias(name))
        on = reduce(and_, [F.col(k) == F.col(f"{name}_{i}") for i, k in enumerate(keys)])
        return side.join(bounded_broadcast(named, source=hot), on, "left")

    repeated = shares(left, left_keys, "shares_l").withColumn(
        "share_l", F.explode(F.sequence(F.lit(0), F.coalesce("shares_l", F.lit(1)) - 1)))
    dealt = shares(right, right_keys, "shares_r").withColumn(
        "share_r", F.pmod(F.xxhash64(*right.columns), F.coalesce("shares_r", F.lit(1))).cast("int"))
    joined = repeated.join(dealt, equal & (F.col("share_l") == F.col("share_r")), "left")
    return joined.where(F.col("shares_l").isNull() | F.col("share_r").isNotNull()).select(*left.columns, *right.columns)
