"""A maintained point balance: what O13 computes from the whole ledger, kept up to date from changes.

``refresh`` runs one Structured Streaming pass (available now) over the ledger tables' folders. The
streaming checkpoint knows which files were seen, so a pass reads new files only. Spends need two
tables (the redemption and its channel row, in either order of arrival): a stream-stream join keeps what is
not yet matched in the state store, keyed by redeem_no. Each pass is summed per (outlet, year) and stored as
one delta folder that a repeated pass overwrites.

``absorb_rounds`` does the same for the committed redemption rounds of a sink. ``compact`` folds all deltas into
a snapshot; a manifest row names it, so a reader sees either the old state or the new.

``balances`` reads the snapshot and the deltas after it, cut to the requested pairs, and no ledger table.

The tables must only grow (rows are added, as the reference's INSERTs do). The gift catalogue is read
as it is at a pass; after a change of rows already counted, start a new store.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.points import EARNED, point_ledger, stored_or_ledger
from ..params import PointParams
from ..sources.sinks import ATTEMPT, ROUND, Sink
from ..sources.tables import trim_keys, zone_less
from .joins import bounded_broadcast, is_bounded

LEDGER_TABLES = ("invoice_master", "point_redeem", "point_redeem_detail", "point_redeem_detail_cashback",
                 "ppob_transaction_master", "ewallet_transaction_master")
_SCHEMA = "outlet_id string, year int, points decimal(38,4)"


def _sums(ledger: DataFrame) -> DataFrame:
    signed = F.when(F.col("component") == EARNED, F.col("points")).otherwise(-F.col("points"))
    return ledger.groupBy("outlet_id", F.col("year").cast("int").alias("year")).agg(
        F.sum(signed).cast("decimal(38,4)").alias("points"))


class BalanceStore:
    """Balances below ``root`` (shared storage) of the Parquet tables below ``tables_root`` and, where given, of the
    redemption rounds of ``sink``."""

    def __init__(self, spark: SparkSession, tables_root: str, root: str, p: PointParams = PointParams(),
                 sink: Sink | None = None):
        self.spark, self.p, self.sink = spark, p, sink
        self.tables_root, self.root = tables_root.rstrip("/"), root.rstrip("/")

    # ---- changes ---------------------------------------------------------------------------------
    def _changes(self, name: str) -> DataFrame:
        path = f"{self.tables_root}/{name}"
        schema = self.spark.read.parquet(path).schema
        return trim_keys(name, zone_less(self.spark.readStream.schema(schema).parquet(path)))

    def refresh(self) -> None:
        """Add what came to the ledger tables since the last call."""
        items = trim_keys("redeem_item", self.spark.read.parquet(f"{self.tables_root}/redeem_item"))
        ledger = point_ledger(*[self._changes(n) for n in LEDGER_TABLES], items, self.p)

        def write(batch: DataFrame, batch_id: int) -> None:
            _sums(batch).write.mode("overwrite").parquet(f"{self.root}/deltas/batch={batch_id}")

        query = (ledger.writeStream.foreachBatch(write).option("checkpointLocation", f"{self.root}/checkpoint")
                 .trigger(availableNow=True).start())
        query.awaitTermination()

    def absorb_rounds(self, before: int | None = None) -> None:
        """Add the spends of committed rounds that are not stored yet."""
        sink = self.sink
        commits = None if sink is None else sink.commits()
        if commits is None:
            return
        if before is not None:
            commits = commits.filter(F.col(ROUND) < int(before))
        known = self._read("rounds", f"{_SCHEMA}, {ROUND} long, {ATTEMPT} string").select(ROUND, ATTEMPT).distinct()
        new = commits.join(known, [ROUND, ATTEMPT], "left_anti").select(ROUND, ATTEMPT)
        rows = sink.read("point_redeem").withColumn(ROUND, F.col(ROUND).cast("long")).join(
            bounded_broadcast(new), [ROUND, ATTEMPT], "left_semi")
        outlets = sink.read("point_redeem_detail").withColumn(ROUND, F.col(ROUND).cast("long")).select(
            ROUND, ATTEMPT, "redeem_no", "outlet_id")
        spent = rows.filter(F.col("point_year").isin(*self.p.ledger_years)).join(outlets, [ROUND, ATTEMPT, "redeem_no"]).groupBy(
            "outlet_id", F.col("point_year").alias("year"), ROUND, ATTEMPT).agg(
            (-F.sum(F.coalesce("point_redeem", F.lit(0)))).cast("decimal(38,4)").alias("points"))
        spent.write.mode("append").partitionBy(ROUND, ATTEMPT).parquet(f"{self.root}/rounds")

    # ---- state -----------------------------------------------------------------------------------
    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def _snapshot(self) -> tuple[int, DataFrame]:
        last = self._read("manifest", "upto long, snapshot string").agg(F.max(F.struct("upto", "snapshot"))).first()[0]
        if last is None:
            return -1, self.spark.createDataFrame([], _SCHEMA)
        return last.upto, self.spark.read.schema(_SCHEMA).parquet(f"{self.root}/{last.snapshot}")

    def _ledger_sums(self) -> DataFrame:
        upto, snapshot = self._snapshot()
        deltas = self._read("deltas", f"{_SCHEMA}, batch long").filter(F.col("batch") > upto)
        return snapshot.unionByName(deltas.drop("batch"))

    def compact(self) -> None:
        """Fold the deltas so far into a new snapshot, sorted so that a lookup skips most of its row groups."""
        upto = self._read("deltas", f"{_SCHEMA}, batch long").agg(F.max("batch")).first()[0]
        if upto is None:
            return
        name = f"snapshot-{upto}"
        sums = self._ledger_sums().groupBy("outlet_id", "year").agg(F.sum("points").cast("decimal(38,4)").alias("points"))
        sums.sortWithinPartitions("outlet_id", "year").write.mode("overwrite").parquet(f"{self.root}/{name}")
        self.spark.createDataFrame([(upto, name)], "upto long, snapshot string").coalesce(1).write.mode("append").parquet(
            f"{self.root}/manifest")

    def balances(self, pairs: DataFrame, stored: DataFrame, before: int | None = None,
                 pairs_source: DataFrame | None = None) -> DataFrame:
        """(outlet_id, year, total_point) of the pairs, as :func:`points.point_balance` gives them; ``before``: only the
        redemption rounds before it count."""
        sums = self._ledger_sums()
        commits = None if self.sink is None else self.sink.commits()
        if commits is not None:      # of a repeated round the last attempt
            rounds = self._read("rounds", f"{_SCHEMA}, {ROUND} long, {ATTEMPT} string")
            rounds = rounds.join(bounded_broadcast(commits), [ROUND, ATTEMPT], "left_semi")
            if before is not None:
                rounds = rounds.filter(F.col(ROUND) < int(before))
            sums = sums.unionByName(rounds.select("outlet_id", "year", "points"))
        if pairs_source is not None and is_bounded(pairs, source=pairs_source):
            sums = sums.join(F.broadcast(pairs.select("outlet_id", "year").distinct()), ["outlet_id", "year"], "left_semi")
        totals = sums.groupBy(F.col("outlet_id").alias("l_outlet_id"), F.col("year").alias("l_year")).agg(
            F.sum("points").alias("ledger_total"))
        return stored_or_ledger(pairs, totals, stored, self.p)
