"""Table sources.

``Tables`` maps a reference table name (``invoice_master``, ``point_redeem`` ...)
to a DataFrame. Three sources:

* ``from_parquet(spark, root)``  -- one Parquet dataset per table under ``root``
* ``from_catalog(spark, db)``    -- catalog tables (the reference's two databases
  are a ``Tables`` with a second one as its ``source``, T24)
* ``from_testdata(spark, dir)``  -- stand-ins derived from the driver's test data

String keys are right-trimmed once at load (T-SQL ``=`` ignores trailing
blanks, Spark's does not).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.joins import bounded_broadcast
from . import standins

# key columns compared with ``=`` in the reference; trimmed at load
KEY_COLUMNS: dict[str, tuple[str, ...]] = {
    "invoice_master": ("invoice_no", "outlet_id", "document_ID", "sales_id", "invoice_type"),
    "invoice_detail": ("outlet_id", "invoice_no", "item_code"),
    "invoice_detail_activity": ("outlet_id", "invoice_no", "item_code"),
    "master_products": ("sku_code",),
    "master_products_basepack_new": ("sku_code", "basepack"),
    "temp_act_outlet_list": ("activity_id", "Outlet_id"),
    "temp_act_outlet_list_eco": ("activity_id", "Outlet_id", "quarter", "year"),
    "act_sku_eco": ("activity_id", "sku_code"),
    "activities": ("activity_id", "category_id", "mechanism_id", "status_activities"),
    "activities_regular": ("activity_id",),
    "ref_categories": ("category_id",),
    "live_mechanism_list": ("activity_id", "outlet_code"),
    "outlet_basepack_target_master": ("activity_id", "outlet_id", "cluster"),
    "outlet_basepack_target_detail": ("activity_id", "outlet_id", "basepack_title", "status", "status_id"),
    "target_growth": ("activity_id", "Outlet_id", "Cluster"),
    "temp_master_data_uli": ("KODE_TOKO", "KODE_DIS"),
    "summary_outlet": ("KODE_OUTLET", "AREA"),
    "outlet_monthly_mapping": ("outlet_code",),
    "master_peserta": ("KODE_OUTLET",),
    "user_info": ("user_id", "outlet_id"),
    "point_redeem": ("redeem_no", "user_id", "gift_code", "status_delivery"),
    "point_redeem_detail": ("redeem_no", "outlet_id"),
    "point_redeem_detail_cashback": ("redeem_no", "outlet_id"),
    "ppob_transaction_master": ("redeem_no", "outlet_id"),
    "ewallet_transaction_master": ("redeem_no", "outlet_id"),
    "redeem_item": ("redeem_code", "type_code", "vendor_code"),
    "new_point_balance": ("outlet_id",),
    "log_validasi_redeem": ("user_id",),
    "alamat_pengiriman": ("outlet_id",),
}


def trim_keys(name: str, df: DataFrame) -> DataFrame:
    keys = [c for c in KEY_COLUMNS.get(name, ()) if c in df.columns]
    if not keys:
        return df
    return df.withColumns({c: F.rtrim(F.col(c)) for c in keys})


def zone_less(df: DataFrame) -> DataFrame:
    """Timestamps as T-SQL ``datetime`` (no zone): a ``TIMESTAMP '...'``
    literal is zoned when the session's default timestamp type is, so zoned
    columns are turned back into wall-clock values."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    if not zoned:
        return df
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


class Tables:
    """Lazy, memoised name -> DataFrame mapping.

    The reference reads some tables from a second database. ``with_source(name, tables)`` names
    another ``Tables``, and ``source(name)`` gives it -- or this one, where all tables are in one place.
    """

    def __init__(self, loader: Callable[[str], DataFrame], raw: Callable[[str], DataFrame] | None = None):
        self._loader, self._raw = loader, raw
        self._frames: dict[str, DataFrame] = {}
        self._given: dict[str, DataFrame] = {}
        self._sources: dict[str, Tables] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._loader(name)
        return self._frames[name]

    def with_overrides(self, **frames: DataFrame) -> "Tables":
        """Same source with some tables replaced (e.g. hand-made test rows)."""
        out = Tables(self._loader, self._raw)
        out._frames = {**self._frames, **frames}
        out._given = {**self._given, **frames}
        out._sources = dict(self._sources)
        return out

    def with_source(self, name: str, tables: "Tables") -> "Tables":
        out = self.with_overrides()
        out._sources[name] = tables
        return out

    def source(self, name: str) -> "Tables":
        return self._sources.get(name, self)

    def reloaded(self) -> "Tables":
        """Same source with every table opened anew, so that rows stored since count."""
        out = Tables(self._loader, self._raw)
        out._given = dict(self._given)
        out._frames = dict(self._given)
        out._sources = {name: tables.reloaded() for name, tables in self._sources.items()}
        return out

    def matching(self, name: str, **keys: "str | tuple[str, ...] | None") -> DataFrame:
        """Rows of ``name`` whose key columns equal the given values, blank-padded or not (``None``: any).

        The trimmed column that ``[]`` gives hides the stored one, so an equality on it never reaches the
        Parquet scan. Here the stored column must begin with the value -- true of every padded spelling, and
        pushed to the scan, where it skips row groups -- and the trimmed one equals it.
        """
        wanted = {c: (v,) if isinstance(v, str) else tuple(v) for c, v in keys.items() if v is not None}
        if name in self._given or self._raw is None:
            df, kept = self[name], self[name]
        else:
            df = self._raw(name)
            for column, values in wanted.items():
                begins = [F.col(column).startswith(v.rstrip(" ")) for v in values]
                df = df.filter(reduce(or_, begins))
            kept = trim_keys(name, df)
        for column, values in wanted.items():
            kept = kept.filter(F.rtrim(F.col(column)).isin(*[v.rstrip(" ") for v in values]))
        return kept


def from_frames(**frames: DataFrame) -> Tables:
    def missing(name: str) -> DataFrame:
        raise KeyError(f"table {name!r} not supplied")

    out = Tables(missing)
    out._frames = dict(frames)
    out._given = dict(frames)
    return out


def _opened(open_table: Callable[[str], DataFrame], trim: bool) -> Tables:
    def raw(name: str) -> DataFrame:
        return zone_less(open_table(name))

    return Tables(lambda name: trim_keys(name, raw(name)) if trim else raw(name), raw)


def from_parquet(spark: SparkSession, root: str, trim: bool = True) -> Tables:
    return _opened(lambda name: spark.read.parquet(f"{root.rstrip('/')}/{name}"), trim)


def from_catalog(spark: SparkSession, database: str, trim: bool = True) -> Tables:
    return _opened(lambda name: spark.table(f"{database}.{name}"), trim)


def from_spec(spark: SparkSession, spec: str, trim: bool = True) -> Tables:
    """``catalog:<database>`` or a folder with one Parquet dataset per table."""
    if spec.startswith("catalog:"):
        return from_catalog(spark, spec.split(":", 1)[1], trim)
    return from_parquet(spark, spec, trim)


#: Name of the second database: gifts, users, participants and the point ledger that a redemption reads.
BALANCE = "balance"


def from_testdata(spark: SparkSession, sf_dir: str) -> Tables:
    """Stand-in tables over ``{sf_dir}/{table}.parquet`` (see FIXTURES.md).

    The invoice lines are joined and kept once: the invoices, both line tables and the basepack targets read the kept rows.
    """
    base: dict[str, DataFrame] = {}
    tables: Tables

    def load(name: str) -> DataFrame:
        if name in standins.BASE_TABLES:
            if name not in base:
                base[name] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
            return base[name]
        deps = {d: (load(d) if d in standins.BASE_TABLES else tables[d]) for d in standins.dependencies(name)}
        if name == "so_lines":
            deps["so_outlets"] = bounded_broadcast(deps["so_outlets"])
        # views of our own: spark.sql drops its views of the frames it is given, which also forgets what is persisted of them
        views = {d: f"standin_{d}_{uuid.uuid4().hex}" for d in deps}
        for d, view in views.items():
            deps[d].createTempView(view)
        made = zone_less(spark.sql(standins.sql_text(name).format(**views)))
        if name in standins.LINE_TABLES:
            return made             # columns of the kept lines
        # kept once per session: every registered query reads the same stand-ins
        return made.persist()

    tables = Tables(load)
    return tables


# fact tables are written sorted (within each file) by the column their scans
# filter on, so Parquet row groups carry narrow ranges and pushed filters skip them
SORT_ON_WRITE = {
    "invoice_master": ("invoice_date",),
    "invoice_detail": ("invoice_date",),
    "invoice_detail_activity": ("invoice_date",),
    "point_redeem": ("point_year",),
    "log_validasi_redeem": ("user_id",),
}


def materialize(tables: Tables, root: str, names=standins.STANDIN_TABLES, sort: bool = False) -> None:
    """Write every table once as Parquet under ``root``.

    ``sort=True`` orders the fact tables inside each file (``SORT_ON_WRITE``):
    worth it when files hold many row groups (large data); at a few MB per
    file it only costs the sort.
    """
    for name in names:
        df = tables[name]
        if sort and name in SORT_ON_WRITE:
            df = df.sortWithinPartitions(*SORT_ON_WRITE[name])
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
