"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable

import pyarrow as pa
import tokoledger
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokoledger.session import checkpoint_dir

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's source to Spark (``addPyFile``), so that Python workers
    can import it on any node. Once per application; not needed where the
    package itself came in an archive."""
    sc = spark.sparkContext
    root = os.path.dirname(tokoledger.__file__)
    if sc.applicationId in _shipped or not os.path.isdir(root):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tokoledger-src-"), "tokoledger-src.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


_of_worker: dict[tuple, object] = {}


def of_worker(module: str, key: tuple, make: Callable):
    """``make()``, which a worker remembers until it gets a task of another module (see ``in_arrow``)."""
    if (module, *key) not in _of_worker:
        _of_worker[module, *key] = make()
    return _of_worker[module, *key]


def give_back() -> None:
    """Give the worker's freed memory back."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):    # glibc keeps most of it else
        trim(0)


def forget_others(module: str) -> None:
    """Drop what the worker remembers for other modules, and give its memory back."""
    others = [key for key in _of_worker if key[0] != module]
    for key in others:
        del _of_worker[key]
    if others:
        give_back()


def in_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers. Whole texts are large rows:
    where the session does not say, Arrow batches hold 1000 rows instead of 10,000, and a
    worker gives freed memory back at the end of its task. Workers outlive an operator: at the
    start of a task they forget what they remember for other modules' functions."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(BATCH_ROWS, None) is None:
        spark.conf.set(BATCH_ROWS, "1000")

    module = function.__module__

    def run(batches):
        forget_others(module)
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder (survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def held(df: DataFrame) -> DataFrame:
    """Computed and kept on the executors' disks until it is unpersisted: for what only the operator's next
    steps read. Lost blocks are computed again. Unlike ``stored`` it makes no files in a file system, for each of
    which a local one starts a process (chmod) that counts the executor's memory twice until it runs."""
    df = df.persist(StorageLevel.DISK_ONLY)
    df.count()
    return df


def id_bucket(col: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(parts))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
