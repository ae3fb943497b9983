"""Blank-padded keys that reach the scan, the lookup layout, and two databases."""

from __future__ import annotations

import datetime as dt
import tempfile
from decimal import Decimal as D

import pytest

from oracle_compare import table_rows
from tokoledger import catalog, params as P
from tokoledger.operators import report
from tokoledger.plans import batches
from tokoledger.plans.checks import plan_text, scans
from tokoledger.sources.lookup import LookupTables, materialize_lookup
from tokoledger.sources.sinks import ParquetSink
from tokoledger.sources.tables import BALANCE, from_frames, from_parquet

JULY = dt.datetime(2025, 7, 3)


@pytest.fixture(scope="module")
def padded(spark):
    root = tempfile.mkdtemp(prefix="tl-lookup-")
    lines = [("T1", "I1", "S1", D(10), 1, D(10), JULY), ("T1  ", "I1 ", "S1 ", D(20), 2, D(20), JULY), ("T1", "I12", "S1", D(30), 3, D(30), JULY),
             ("T12", "I1", "S1", D(40), 4, D(40), JULY), (" T1", "I1", "S1", D(50), 5, D(50), JULY), ("T1", "I1", "S2", D(60), 6, D(60), dt.datetime(2025, 8, 1)),
             ("T1", "I1", "S1", D(70), 7, D(70), dt.datetime(2024, 7, 3))]
    spark.createDataFrame(lines, "outlet_id string, invoice_no string, item_code string, price decimal(18,2), quantity int, "
                                 "total decimal(18,2), invoice_date timestamp_ntz").write.parquet(f"{root}/invoice_detail")
    heads = [("I1", "T1 ", JULY, D(30), "I"), ("I2", "T12", JULY, D(5), "I"), ("I3", "T1", JULY, D(7), "P"), ("I4", "T1", dt.datetime(2025, 7, 31, 23, 59), D(9), "I")]
    spark.createDataFrame(heads, "invoice_no string, outlet_id string, invoice_date timestamp_ntz, invoice_amount decimal(18,2), "
                                 "invoice_type string").write.parquet(f"{root}/invoice_master")
    spark.createDataFrame([("S1", "Soap")], "sku_code string, product_description string").write.parquet(f"{root}/master_products")
    return root


ASKED = P.InvoiceViewParams(year=2025, month=7, outlet_id="T1 ", invoice_no="I1", as_of=JULY)


def test_padded_keys_match_and_reach_the_scan(spark, padded):
    t = from_parquet(spark, padded)
    found = batches.invoice_lines(t, ASKED)
    assert sorted(r.quantity for r in found.collect()) == [1, 2]           # blanks behind a key do not count, before it they do
    (scan,) = [s for s in scans(found) if "invoice_detail" in s["Location"]]
    for wanted in ("StringStartsWith(outlet_id,T1)", "StringStartsWith(invoice_no,I1)", "GreaterThanOrEqual(invoice_date", "LessThan(invoice_date"):
        assert wanted in scan["PushedFilters"], scan
    heads = batches.invoice_headers(t, ASKED)
    assert sorted(r.invoice_no for r in heads.collect()) == ["#I1", "#I4"]
    (scan,) = [s for s in scans(heads) if "invoice_master" in s["Location"]]
    assert "StringStartsWith(outlet_id,T1)" in scan["PushedFilters"]


def test_matching_several_values(spark, padded):
    t = from_parquet(spark, padded)
    assert t.matching("invoice_master", outlet_id=("T1", "T12")).count() == 4
    assert t.matching("invoice_master", outlet_id=None).count() == 4
    given = t.with_overrides(invoice_master=t["invoice_master"].limit(0))
    assert given.matching("invoice_master", outlet_id="T1").count() == 0


def test_injection_invoices_are_filtered_at_the_scan(spark, small_sf):
    from tokoledger.sources.tables import materialize

    root = tempfile.mkdtemp(prefix="tl-kinds-")
    materialize(catalog.standin_tables(spark, small_sf), root, names=("invoice_master",))
    t = from_parquet(spark, root)
    few = t.matching("invoice_master", sales_id=("0", "1"))
    assert few.count() == t["invoice_master"].filter("sales_id IN ('0', '1')").count() > 0
    (scan,) = scans(few)
    assert "StringStartsWith(sales_id,0)" in scan["PushedFilters"]


def test_lookup_layout_opens_one_month_and_bucket(spark, padded):
    root = tempfile.mkdtemp(prefix="tl-layout-")
    plain = from_parquet(spark, padded, trim=False)
    materialize_lookup(plain, root, buckets=4)
    plain["master_products"].write.parquet(f"{root}/master_products")
    t = LookupTables(spark, root)
    found = batches.invoice_lines(t.at(ASKED), ASKED)
    assert sorted(r.quantity for r in found.collect()) == [1, 2]
    text = plan_text(found)
    (line,) = [x for x in text.splitlines() if x.startswith("PartitionFilters") and "inv_month" in x]
    assert "outlet_bucket" in line and "202507" in line
    month = t._plain["invoice_detail"].filter("inv_month = 202507")
    one = t.at(ASKED)._raw("invoice_detail")
    assert one.count() < month.count()                                     # other buckets of the month are not read
    everything = P.InvoiceViewParams(as_of=JULY)
    whole = batches.invoice_lines(t.at(everything), everything)
    want = report.invoice_lines_view(from_parquet(spark, padded)["invoice_detail"], plain["master_products"], everything)
    assert table_rows(whole.toArrow())[1] == table_rows(want.toArrow())[1]


def test_now_is_the_time_of_the_query(spark, padded):
    t = from_parquet(spark, padded)
    today = t["invoice_master"].limit(1).selectExpr("invoice_no", "outlet_id", "cast(current_timestamp() as timestamp_ntz) AS invoice_date", "invoice_amount", "'I' AS invoice_type")
    (r,) = report.invoice_headers_view(today).collect()
    assert r.invoice_date.startswith("Hari ini, ")


def test_a_redemption_reads_one_database_and_writes_another(spark):
    requests = spark.createDataFrame([("T1", "G1", 2, 2025, "R1", JULY), ("T1", "G1", 1, 2025, "R2", JULY + dt.timedelta(minutes=5))],
                                     "outlet_id string, giftcode string, qty int, year int, redeemno string, request_ts timestamp_ntz")
    item = "redeem_code string, type_code string, vendor_code string, gift_name string, point decimal(18,4)"
    user = "user_id string, outlet_id string, no_hp string"
    link = spark.createDataFrame([], "redeem_no string, outlet_id string")
    ledger = from_frames(
        invoice_master=spark.createDataFrame([("T1", JULY, D(100), D(0), D(0))], "outlet_id string, invoice_date timestamp_ntz, "
                                             "expected_invoice_reward decimal(18,4), expected_invoice_addt_reward decimal(18,4), expected_invoice_npd_reward decimal(18,4)"),
        point_redeem=spark.createDataFrame([], "redeem_no string, gift_code string, point_redeem decimal(18,4), point_year int, status_delivery string"),
        point_redeem_detail=link, point_redeem_detail_cashback=link, ppob_transaction_master=link, ewallet_transaction_master=link,
        redeem_item=spark.createDataFrame([("G1", "08", "V01", "Cup", D(10))], item),
        user_info=spark.createDataFrame([("u1", "T1", "0812 ")], user),
        master_peserta=spark.createDataFrame([], "KODE_OUTLET string"),
        new_point_balance=spark.createDataFrame([], "outlet_id string, remain_point decimal(18,4)"))
    main = from_frames(
        redeem_item=spark.createDataFrame([("G1", "08", "V01", "Cup", D(48))], item),       # another price here
        log_validasi_redeem=spark.createDataFrame([], "user_id string, redeem_code string, created_date timestamp_ntz"),
        alamat_pengiriman=spark.createDataFrame([], "id int, outlet_id string, nama_penerima string, nama_jalan string, no_rumah string, "
                                                "kelurahan string, kecamatan string, provinsi string, kota string, kode_pos string"))
    sink = ParquetSink(spark, tempfile.mkdtemp(prefix="tl-two-"))
    gate = batches.run_redemption_batch(main.with_source(BALANCE, ledger), sink, requests)
    got = {r.redeemno: (r.total_point, r.berapa, r.accepted) for r in gate.collect()}
    # checked against the balance database's price, charged at the other's
    assert got == {"R1": (D(100), D(90), True), "R2": (D(4), D(-6), False)}
    assert [r.point_redeem for r in sink.rounds("point_redeem").collect()] == [D(96)]
