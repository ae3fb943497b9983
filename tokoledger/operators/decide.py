"""Decisions in order: every redemption call of an (outlet, year) against the balance that
the accepted calls before it have left.

Three steps, so that an outlet with very many calls is still spread:

1. Running sums in two levels. Within a time bucket a window adds up what the calls would
   spend if all were accepted; the bucket totals, a small table, are added up over the
   buckets. An hour of one outlet is the largest group that a window sees.
2. While no call fails under that assumption, it holds: all calls before the first failing
   bucket of an (outlet, year) are decided with these sums. Most outlets end here.
3. From the first failing bucket on each decision depends on the one before. These calls
   are dealt by (outlet, year), sorted, and folded in one pass per partition that carries
   one balance from call to call (and from Arrow batch to Arrow batch), so memory does not
   grow with the number of calls.

The fold is the one place of these operators that needs Python: a sum that depends on its own
earlier outcome is no window or aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.joins import bounded_broadcast
from ..session import checkpoint_dir

BALANCE = T.DecimalType(28, 4)
ORDER = ["request_ts", "redeemno", "giftcode", "qty"]
_HIDDEN = ["d_bucket", "d_sum", "d_prior", "d_start"]


def _fold(names: list[str]):
    """Arrow batches sorted by (outlet, year, order) with ``d_start`` -> the same with ``balance_before``.
    Everything it needs is in here, so workers need not import this package."""
    import decimal

    import pyarrow as pa

    def run(batches):
        key, left = None, 0
        for batch in batches:
            row = {n: batch.column(k).to_pylist() for k, n in enumerate(names) if n in ("outlet_id", "year", "d_start", "charge", "effect", "eligible")}
            before = []
            for outlet, year, start, charge, effect, eligible in zip(
                    row["outlet_id"], row["year"], row["d_start"], row["charge"], row["effect"], row["eligible"]):
                if (outlet, year) != key:
                    key, left = (outlet, year), start
                before.append(left)
                whole = left.quantize(decimal.Decimal(1), rounding=decimal.ROUND_HALF_UP)
                if eligible and (charge is None or whole >= charge):
                    left -= effect
            added = pa.array(before, pa.decimal128(28, 4))
            yield pa.RecordBatch.from_arrays([*batch.columns, added], names=[*names, "balance_before"])

    return run


def balances_before(calls: DataFrame, source: DataFrame | None = None, bucket: str = "hour") -> DataFrame:
    """``calls`` with ``balance_before``: the balance that a call meets.

    ``calls`` holds outlet_id, year, the columns of ``ORDER``, ``balance`` (of the outlet and
    year before all of them, equal in all its rows), ``charge`` (what the rounded balance must
    reach; null passes), ``effect`` (what an accepted call takes off, not null) and ``eligible``
    (false: cannot be accepted). ``source`` bounds the number of calls for broadcasts.
    The calls are stored once (checkpoint), as all three steps read them.
    Calls without an outlet or year are on their own: their balance is as given.
    """
    key = ["outlet_id", "year"]
    spent = F.when(F.col("eligible"), F.col("effect")).otherwise(F.lit(0))
    calls = calls.withColumn("balance", F.col("balance").cast(BALANCE)).withColumn(
        "d_bucket", F.coalesce(F.date_trunc(bucket, "request_ts"), F.lit("0001-01-01").cast("timestamp")).cast("timestamp_ntz"))
    inside = Window.partitionBy(*key, "d_bucket").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    checkpoint_dir(calls.sparkSession)
    calls = calls.checkpoint()
    rows = calls.withColumn("d_sum", F.coalesce(F.sum(spent).over(inside), F.lit(0)).cast(BALANCE))

    over = Window.partitionBy(*key).orderBy("d_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = calls.groupBy(*key, "d_bucket").agg(F.sum(spent).alias("t")).select(
        *[F.col(k).alias(f"p_{k}") for k in key], F.col("d_bucket").alias("p_bucket"),
        F.coalesce(F.sum("t").over(over), F.lit(0)).cast(BALANCE).alias("d_prior"))
    rows = rows.join(totals, (F.col("outlet_id") == F.col("p_outlet_id")) & (F.col("year") == F.col("p_year"))
                     & (F.col("d_bucket") == F.col("p_bucket")), "left").drop("p_outlet_id", "p_year", "p_bucket")
    rows = rows.withColumn("d_prior", F.coalesce("d_prior", F.lit(0).cast(BALANCE)))

    if_all = F.when(F.col("outlet_id").isNull() | F.col("year").isNull(), F.col("balance")).otherwise(
        (F.col("balance") - F.col("d_prior") - F.col("d_sum")).cast(BALANCE))
    fails = rows.filter(F.col("eligible") & (if_all.cast("decimal(18,0)") < F.col("charge")))
    first = fails.groupBy(F.col("outlet_id").alias("f_outlet"), F.col("year").alias("f_year")).agg(
        F.min(F.struct("d_bucket", "d_prior")).alias("f_first"))
    rows = rows.join(bounded_broadcast(first, source=source), (F.col("outlet_id") == F.col("f_outlet"))
                     & (F.col("year") == F.col("f_year")), "left")
    sure = F.col("f_first").isNull() | (F.col("d_bucket") < F.col("f_first.d_bucket"))
    decided = rows.filter(sure).withColumn("balance_before", if_all).drop("f_outlet", "f_year", "f_first", *_HIDDEN)

    rest = rows.filter(~sure).withColumn("d_start", (F.col("balance") - F.col("f_first.d_prior")).cast(BALANCE)).drop(
        "f_outlet", "f_year", "f_first")
    rest = rest.repartition(*key).sortWithinPartitions(*key, *ORDER)
    schema = T.StructType([*rest.schema.fields, T.StructField("balance_before", BALANCE)])
    folded = rest.mapInArrow(_fold(rest.columns), schema).drop(*_HIDDEN)
    return decided.unionByName(folded)
