"""Storage for single lookups: invoice tables by month and outlet bucket.

The line and header views are asked for one outlet and month (and invoice) at a time. Stored as
``inv_month=<yyyymm>/outlet_bucket=<n>`` folders, such a question opens one folder: both are conditions on
partition columns alone, so the planner drops all other folders before it reads a footer. Inside the folder files are
sorted by outlet and invoice, and the keys' pushed conditions skip row groups.

The number of buckets is a partition column itself (``buckets=<n>``), so readers need not be told and a table
may be written again with more buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import InvoiceViewParams
from .tables import Tables, from_parquet

BUCKETS = 64
LAYOUT = ("buckets", "inv_month", "outlet_bucket")
LOOKUP_TABLES = ("invoice_detail", "invoice_master")


def _bucket(outlet, buckets):
    return F.pmod(F.xxhash64(outlet), buckets).cast("int")


def write_lookup(df: DataFrame, path: str, buckets: int = BUCKETS, files: int = 8) -> None:
    """Store an invoice table by month and outlet bucket. A folder gets up to ``files`` files, dealt by invoice, so a
    hot outlet's month is not written by one task."""
    laid = df.withColumns({
        "buckets": F.lit(buckets),
        "inv_month": (F.year("invoice_date") * 100 + F.month("invoice_date")).cast("int"),
        "outlet_bucket": _bucket(F.rtrim(F.col("outlet_id")), F.lit(buckets)),
    })
    laid = laid.repartition("inv_month", "outlet_bucket", F.pmod(F.xxhash64("invoice_no"), F.lit(files)))
    laid.sortWithinPartitions(*LAYOUT, "outlet_id", "invoice_no").write.mode("overwrite").partitionBy(*LAYOUT).parquet(path)


class LookupTables(Tables):
    """Tables below a folder, of which the invoice tables are laid out for lookups; ``at`` names the month and outlet."""

    def __init__(self, spark: SparkSession, root: str):
        self._plain = from_parquet(spark, root)
        super().__init__(self._plain._loader, self._plain._raw)

    def at(self, p: InvoiceViewParams) -> Tables:
        """The same tables, the invoice tables cut to the folders that ``p`` asks for."""

        def cut(df: DataFrame) -> DataFrame:
            if not set(LAYOUT) <= set(df.columns):
                return df
            if p.year is not None and p.month is not None:
                df = df.filter(F.col("inv_month") == int(p.year) * 100 + int(p.month))
            elif p.year is not None:
                df = df.filter(F.col("inv_month").between(int(p.year) * 100 + 1, int(p.year) * 100 + 12))
            if p.outlet_id is not None:
                df = df.filter(F.col("outlet_bucket") == _bucket(F.lit(p.outlet_id.rstrip(" ")), F.col("buckets")))
            return df.drop(*LAYOUT)

        return Tables(lambda name: cut(self._plain[name]), lambda name: cut(self._plain._raw(name)))


def materialize_lookup(tables: Tables, root: str, names=LOOKUP_TABLES, buckets: int = BUCKETS) -> None:
    """Store the invoice tables of ``tables`` below ``root`` for lookups."""
    for name in names:
        write_lookup(tables[name], f"{root.rstrip('/')}/{name}", buckets)
