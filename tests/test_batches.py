"""Batch runners write the reference's tables; a redemption batch is one round,
visible as a whole or not at all; the stream runs rounds."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from oracle_compare import table_rows
from tokoledger import catalog
from tokoledger.plans import batches
from tokoledger.sources.sinks import ParquetSink
from tokoledger.streaming.redeem_stream import start_redemption_stream


@pytest.fixture(scope="module")
def tables(spark, small_sf):
    return catalog.standin_tables(spark, small_sf)


def _same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    assert table_rows(a.toArrow())[1] == table_rows(b.toArrow())[1]


def test_growth_basepack_batch_writes_the_tables(spark, tables):
    sink = ParquetSink(spark, tempfile.mkdtemp(prefix="tl-batch-"))
    out = batches.run_growth_basepack(tables, sink, catalog.SALES)
    qs = catalog.builders()
    _same(out[batches.BASEPACK_SUMMARY_TABLE], qs["basepack_summary"](tables))
    _same(out[batches.GROWTH_TABLE], qs["growth_achievement"](tables))
    _same(sink.read(batches.DISTRIBUTION_TABLE), qs["invoice_distribution"](tables))
    assert "KODE TOKO" in sink.read(batches.BASEPACK_DETAIL_TABLE).columns


def test_activity_batch_writes_the_tables(spark, tables):
    sink = ParquetSink(spark, tempfile.mkdtemp(prefix="tl-batch-"))
    out = batches.run_activity_quarter(tables, sink, catalog.ACTIVITY)
    _same(out["activity_summary_achievement"], catalog.builders()["activity_incentive_summary"](tables))


def test_daily_report(spark, tables):
    _same(batches.daily_report(tables, catalog.REPORT), catalog.builders()["daily_outlet_report"](tables))


def test_a_redemption_batch_is_one_round_and_can_be_repeated(spark, tables):
    sink = ParquetSink(spark, tempfile.mkdtemp(prefix="tl-redeem-"))
    g1 = batches.run_redemption_batch(tables, sink, tables["requests"], 0, catalog.REDEEM)
    _same(g1, catalog.builders()["redemption_gate"](tables))
    first = table_rows(sink.rounds("point_redeem").toArrow())[1]
    g2 = batches.run_redemption_batch(tables, sink, tables["requests"], 0, catalog.REDEEM)   # retry of round 0
    _same(g1, g2)
    assert table_rows(sink.rounds("point_redeem").toArrow())[1] == first and len(first) == g1.filter("accepted").count() > 0
    assert sink.rounds("notifications").count() == sink.rounds("point_redeem_detail").count() == len(first)
    assert sink.next_round() == 1


def test_a_failure_between_two_writes_leaves_nothing(spark, tables, monkeypatch):
    sink = ParquetSink(spark, tempfile.mkdtemp(prefix="tl-atomic-"))
    whole = batches.redeem.redemption_notifications

    def fails(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(batches.redeem, "redemption_notifications", fails)
    for _ in range(2):
        with pytest.raises(RuntimeError):
            batches.run_redemption_batch(tables, sink, tables["requests"], p=catalog.REDEEM)
        assert sink.rounds("point_redeem") is None and sink.next_round() == 0
    monkeypatch.setattr(batches.redeem, "redemption_notifications", whole)
    gate = batches.run_redemption_batch(tables, sink, tables["requests"], p=catalog.REDEEM)
    _same(gate, catalog.builders()["redemption_gate"](tables))          # nothing of the lost attempts counts
    kept = table_rows(sink.rounds("point_redeem").toArrow())[1]
    monkeypatch.setattr(batches.redeem, "redemption_notifications", fails)
    with pytest.raises(RuntimeError):                                   # a lost repetition keeps the round as it was
        batches.run_redemption_batch(tables, sink, tables["requests"].limit(1), 0, catalog.REDEEM)
    assert table_rows(sink.rounds("point_redeem").toArrow())[1] == kept


def test_a_request_delivered_again_in_a_later_batch_spends_nothing(spark, tables):
    sink = ParquetSink(spark, tempfile.mkdtemp(prefix="tl-again-"))
    requests = tables["requests"]
    once = batches.run_redemption_batch(tables, sink, requests.unionByName(requests), p=catalog.REDEEM)
    assert once.count() == requests.distinct().count()
    spent = sink.rounds("point_redeem").count()
    again = requests.limit(20).withColumn("redeemno", F.concat("redeemno", F.lit("  ")))      # padded: the same number
    new = requests.limit(5).withColumn("redeemno", F.concat("redeemno", F.lit("-n")))
    gate = batches.run_redemption_batch(tables, sink, again.unionByName(new), p=catalog.REDEEM)
    reasons = {r.redeemno: r.reject_reason for r in gate.collect()}
    assert sum(v == "duplicate_request" for v in reasons.values()) == again.select("redeemno").distinct().count()
    assert not any(v == "duplicate_request" for k, v in reasons.items() if k.endswith("-n"))
    assert sink.rounds("point_redeem").count() == spent + gate.filter("accepted").count()
    assert sink.rounds("point_redeem", before=1).count() == spent


def test_redemption_stream(spark, tables):
    root = tempfile.mkdtemp(prefix="tl-stream-")
    src = f"{root}/requests"
    reqs = tables["requests"]
    late = F.col("redeemno").endswith("-2")
    reqs.filter(late).write.parquet(f"{src}/b")
    reqs.filter(~late).write.parquet(f"{src}/a")
    sink = ParquetSink(spark, f"{root}/sink")
    q = start_redemption_stream(spark, tables, sink, f"{src}/*", f"{root}/checkpoint", catalog.REDEEM,
                                files_per_trigger=100, available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None
    gates = sink.rounds(batches.GATE_TABLE)
    assert gates.count() == reqs.distinct().count()                    # each request decided once
    assert sink.rounds("point_redeem").count() == gates.filter("accepted").count() > 0


def test_command_line_runs_the_jobs(spark, tables):
    from tokoledger.__main__ import main
    from tokoledger.sources.tables import materialize

    root = tempfile.mkdtemp(prefix="tl-cli-")
    materialize(tables, f"{root}/tables")
    tables["requests"].write.parquet(f"{root}/requests")
    common = ["--tables", f"{root}/tables", "--sink", f"{root}/out"]
    assert main(["growth-basepack", *common, "--from-date", "1999-01-01", "--detail-from", "1999-01-01"]) == 0
    assert main(["activity-quarter", *common, "--quarter", "Q3", "--year", "1999"]) == 0
    assert main(["daily-report", *common, "--year", "1999"]) == 0
    assert main(["redeem", *common, "--requests", f"{root}/requests", "--ledger-years", "1995-2001"]) == 0
    out = ParquetSink(spark, f"{root}/out")
    qs = catalog.builders()
    assert out.read(batches.BASEPACK_SUMMARY_TABLE).count() == qs["basepack_summary"](tables).count()
    assert out.read("activity_summary_achievement").count() == qs["activity_incentive_summary"](tables).count()
    assert out.read("daily_report").count() == qs["daily_outlet_report"](tables).count()
    gates = out.rounds(batches.GATE_TABLE)
    _same(gates.drop("round_id"), qs["redemption_gate"](tables))       # same decisions as the registered query
    assert out.rounds("point_redeem").count() == gates.filter("accepted").count()


def test_catalog_sink_and_source(spark):
    from pyspark.sql import functions as F

    from tokoledger.sources.sinks import CatalogSink
    from tokoledger.sources.tables import from_catalog

    root = tempfile.mkdtemp(prefix="tl-catalog-")
    db = "tl_" + root.rsplit("-", 1)[-1].lower()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/db'")
    sink = CatalogSink(spark, db)
    rows = spark.createDataFrame([("T1 ", "G1"), ("T2", "G2")], "outlet_id string, redeem_code string")
    assert sink.overwrite("new_point_balance", rows.withColumn("remain_point", F.lit(1))).count() == 2
    for _ in range(2):                                    # the same round twice: no duplicates
        with sink.round(0) as one:
            assert one.write("notifications", rows).count() == 2
    with sink.round(1) as one:
        one.write("notifications", rows.limit(1))
    assert sink.rounds("notifications").count() == 3 and sink.next_round() == 2
    assert sink.rounds("notifications", before=1).count() == 2
    with sink.round(1) as one:                            # a repetition without rows clears its round
        one.write("notifications", rows.limit(0))
    assert sink.rounds("notifications").count() == 2
    t = from_catalog(spark, db)
    assert sorted(r.outlet_id for r in t["new_point_balance"].collect()) == ["T1", "T2"]   # keys trimmed


def test_padded_keys_match_after_load(spark):
    import datetime as dt
    from decimal import Decimal as D

    from tokoledger import params as P
    from tokoledger.operators import sales
    from tokoledger.sources.tables import from_parquet

    root = tempfile.mkdtemp(prefix="tl-pad-")
    spark.createDataFrame(
        [("I1", "T1  ", dt.datetime(2025, 7, 3), D("2000000"))],
        "invoice_no string, outlet_id string, invoice_date timestamp_ntz, invoice_amount decimal(18,2)",
    ).write.parquet(f"{root}/invoice_master")
    spark.createDataFrame(
        [("A1", "T1", "1", dt.date(2025, 7, 1), dt.date(2025, 9, 30))],
        "activity_id string, Outlet_id string, Cluster string, periode_start date, periode_end date",
    ).write.parquet(f"{root}/target_growth")
    trimmed = from_parquet(spark, root)
    (r,) = sales.growth_sales_points(trimmed["target_growth"], trimmed["invoice_master"], P.SalesParams()).collect()
    assert (r.pencapaian, r.point_temp) == (D(2000000), D(3))        # 'T1  ' = 'T1' as in T-SQL
    raw = from_parquet(spark, root, trim=False)
    (r,) = sales.growth_sales_points(raw["target_growth"], raw["invoice_master"], P.SalesParams()).collect()
    assert r.pencapaian is None
