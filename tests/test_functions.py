from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tokoledger.functions.exprs import id_date, id_long_date, money_text, numeric
from tokoledger.params import per_point


def test_per_point_factors_are_exact():
    assert per_point(Decimal("0.004")) == Decimal("0.000001")
    assert per_point(Decimal("0.005")) == Decimal("0.00000125")
    assert per_point(Decimal("0.02")) == Decimal("0.000005")


def test_money_text(spark):
    df = spark.createDataFrame(
        [(Decimal("0.00"),), (Decimal("1234567.49"),), (Decimal("1234567.50"),), (Decimal("-1234.00"),), (None,)],
        "x decimal(18,2)")
    got = [r[0] for r in df.select(money_text(F.col("x"))).collect()]
    assert got == ["Rp. ", "Rp. 1,234,567", "Rp. 1,234,568", "Rp. -1,234", None]


def test_numeric_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("2.5"),), (Decimal("-2.5"),), (Decimal("2.49"),)], "x decimal(18,2)")
    assert [r[0] for r in df.select(numeric(F.col("x"))).collect()] == [Decimal(3), Decimal(-3), Decimal(2)]


def test_indonesian_dates(spark):
    df = spark.createDataFrame([(dt.datetime(1999, 8, 2, 10, 0),), (dt.datetime(2025, 1, 5),)], "d timestamp_ntz")
    rows = df.select(id_long_date(F.col("d")), id_date(F.col("d"))).collect()
    assert tuple(rows[0]) == ("Senin, 02 Agustus, 1999", "02 Agustus, 1999")
    assert tuple(rows[1]) == ("Minggu, 05 Januari, 2025", "05 Januari, 2025")


def test_capped_points(spark):
    from pyspark.sql import functions as F

    from tokoledger.functions.exprs import capped_points

    rows = [(5, 3, 9, False, True, 5), (2, 3, 9, False, True, 0), (3, 3, 9, False, True, 3), (9, 3, 9, False, True, 9), (12, 3, 9, False, True, 9),
            (12, 3, 9, True, True, 0), (12, 3, 9, None, True, 9), (12, 3, None, False, True, 12), (2, None, 9, False, True, 2),
            (12, 3, 9, False, None, 12), (2, 3, 9, False, None, 2), (2, 3, 9, False, False, 2), (None, 3, 9, False, True, None)]
    df = spark.createDataFrame(rows, "points int, least int, most int, failed boolean, applies boolean, want int")
    got = df.select("want", capped_points(F.col("points"), F.col("least"), F.col("most"), F.col("failed"), F.col("applies")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    free = df.filter("applies").select("want", capped_points(F.col("points"), F.col("least"), F.col("most"), F.col("failed")).alias("got")).collect()
    assert [r.got for r in free] == [r.want for r in free]
