"""Sinks for the batch outputs.

The reference writes its results with DROP + SELECT INTO (overwrite) and
INSERT ... SELECT (append). A sink does the same on a shared Parquet folder or
a catalog database and hands back the table as stored, so later steps read
the written rows instead of recomputing the lineage.

The three inserts of a redemption belong together. A :class:`Round` writes its tables
under an attempt id of its own; they become visible together when one row is
added to the manifest table, which names the attempt and its tables. An attempt that
fails anywhere before leaves nothing that a reader sees, and a repeated round replaces the
earlier one by a later manifest row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..plans.joins import bounded_broadcast

ROUND = "round_id"
ATTEMPT = "attempt"
MANIFEST = "redeem_rounds"


def _sorted(df: DataFrame, sort_by: list[str] | None) -> DataFrame:
    """Rows sorted inside each output file (no shuffle): Parquet row groups
    then hold narrow key ranges, so lookups by that key skip most of them."""
    if not sort_by:
        return df
    return df.sortWithinPartitions(*[F.col(f"`{c}`") for c in sort_by])


class Sink:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def overwrite(self, name: str, df: DataFrame, sort_by: list[str] | None = None) -> DataFrame:
        raise NotImplementedError

    def read(self, name: str, schema=None) -> DataFrame:
        raise NotImplementedError

    def exists(self, name: str) -> bool:
        raise NotImplementedError

    def _write_attempt(self, name: str, df: DataFrame, round_id: int, attempt: str) -> DataFrame:
        """Store the rows of one attempt at a round; returns them as stored."""
        raise NotImplementedError

    def _append(self, name: str, df: DataFrame) -> None:
        raise NotImplementedError

    def round(self, round_id: int) -> "Round":
        return Round(self, int(round_id))

    def commits(self) -> DataFrame | None:
        """(round_id, attempt) of every round: its last committed attempt (``None``: no round yet)."""
        if not self.exists(MANIFEST):
            return None
        last = self.read(MANIFEST).groupBy(ROUND).agg(F.max(F.struct("seq", ATTEMPT)).alias("last"))
        return last.select(ROUND, F.col(f"last.{ATTEMPT}").alias(ATTEMPT))

    def rounds(self, name: str, before: int | None = None) -> DataFrame | None:
        """The committed rows of a table with their ``round_id``, of the rounds before ``before`` if given
        (``None`` if no round was committed). The manifest prunes the partitions that are read."""
        commits = self.commits()
        if commits is None or not self.exists(name):
            return None
        rows = self.read(name).withColumn(ROUND, F.col(ROUND).cast("long"))
        if before is not None:
            rows = rows.filter(F.col(ROUND) < int(before))
            commits = commits.filter(F.col(ROUND) < int(before))
        return rows.join(bounded_broadcast(commits), [ROUND, ATTEMPT], "left_semi").drop(ATTEMPT)

    def next_round(self) -> int:
        """The first round id after all committed ones."""
        commits = self.commits()
        last = None if commits is None else commits.agg(F.max(ROUND)).first()[0]
        return 0 if last is None else int(last) + 1


class Round:
    """One attempt at a round, as a context: committed at its end, dropped on an error."""

    def __init__(self, sink: Sink, round_id: int):
        self.sink, self.round_id = sink, round_id
        self.attempt = f"a{uuid.uuid4().hex}"        # never reads as a number
        self.tables: list[str] = []

    def write(self, name: str, df: DataFrame) -> DataFrame:
        stored = self.sink._write_attempt(name, df, self.round_id, self.attempt)
        self.tables.append(name)
        return stored

    def __enter__(self) -> "Round":
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()

    def commit(self) -> None:
        """One row in one file: it is there or it is not."""
        seq = 0
        if self.sink.exists(MANIFEST):
            seq = (self.sink.read(MANIFEST).agg(F.max("seq")).first()[0] or 0) + 1
        row = [(self.round_id, self.attempt, seq, self.tables)]
        schema = f"{ROUND} long, {ATTEMPT} string, seq long, tables array<string>"
        self.sink._append(MANIFEST, self.sink.spark.createDataFrame(row, schema).coalesce(1))


class ParquetSink(Sink):
    """One Parquet dataset per table under ``root`` (a shared, durable folder)."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark)
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def overwrite(self, name: str, df: DataFrame, sort_by: list[str] | None = None) -> DataFrame:
        _sorted(df, sort_by).write.mode("overwrite").parquet(self.path(name))
        return self.read(name)

    def _append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(name))

    def read(self, name: str, schema=None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(name))

    def _write_attempt(self, name: str, df: DataFrame, round_id: int, attempt: str) -> DataFrame:
        folder = f"{self.path(name)}/{ROUND}={round_id}/{ATTEMPT}={attempt}"      # also there without rows
        df.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def exists(self, name: str) -> bool:
        try:
            self.spark.read.parquet(self.path(name)).schema
        except AnalysisException:
            return False
        return True


class CatalogSink(Sink):
    """Managed tables in a catalog database."""

    def __init__(self, spark: SparkSession, database: str):
        super().__init__(spark)
        self.database = database

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def overwrite(self, name: str, df: DataFrame, sort_by: list[str] | None = None) -> DataFrame:
        _sorted(df, sort_by).write.mode("overwrite").saveAsTable(self.table(name))
        return self.read(name)

    def _append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").saveAsTable(self.table(name))

    def read(self, name: str, schema=None) -> DataFrame:
        return self.spark.table(self.table(name))

    def _write_attempt(self, name: str, df: DataFrame, round_id: int, attempt: str) -> DataFrame:
        stamped = df.withColumns({ROUND: F.lit(round_id).cast("long"), ATTEMPT: F.lit(attempt)})
        if self.exists(name):
            stamped.select(*self.read(name).columns).write.insertInto(self.table(name))
        else:
            stamped.write.partitionBy(ROUND, ATTEMPT).saveAsTable(self.table(name))
        return self.read(name).filter((F.col(ROUND) == round_id) & (F.col(ATTEMPT) == attempt)).drop(ROUND, ATTEMPT)

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.table(name))


def default_sink(spark: SparkSession, name: str = "tokoledger") -> ParquetSink:
    """A Parquet sink in the shared folder the cluster names in
    ``spark.checkpoint.dir`` (a local scratch folder only when it is unset)."""
    from ..session import checkpoint_dir

    return ParquetSink(spark, f"{checkpoint_dir(spark).rstrip('/')}/{name}")
