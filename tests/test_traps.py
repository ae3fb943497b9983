"""Hand-made cases for the reference behaviours that are easy to lose (SURVEY
section 2.3, T1-T20), each with literal expected values."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tokoledger import params as P
from tokoledger.operators import activity, basepack, growth, points, redeem, report, sales

TS = dt.datetime
DT = dt.date

INVOICES = ("invoice_no string, outlet_id string, invoice_date timestamp_ntz, upload_date timestamp_ntz, "
            "invoice_amount decimal(18,2), payment_amount decimal(18,2), invoice_type string, sales_id string, "
            "document_ID string, expected_invoice_reward decimal(18,4), expected_invoice_addt_reward decimal(18,4), "
            "expected_invoice_npd_reward decimal(18,4)")
GROWTH = ("activity_id string, Outlet_id string, outlet_name string, Dist_Code string, Cluster string, "
          "Bar_Title_Target string, Target_toko decimal(18,2), POINT_didapat decimal(18,0), POINT_max decimal(18,0), "
          "periode_start date, periode_end date")
MASTER = ("activity_id string, outlet_id string, cluster string, status_id string, total_basepack int, target int, "
          "point_min decimal(18,0), point_max decimal(18,0), periode_start date, periode_end date")
REGULAR = "activity_id string, status_id string, status_approval string"
Q3 = (DT(2025, 7, 1), DT(2025, 9, 30))
SP = P.SalesParams(as_of=TS(2025, 10, 7, 10, 0))


def inv(no, outlet, when, amount, sales_id="S", doc=None, addt=None, itype="I"):
    return (no, outlet, when, when, D(amount), D(amount), itype, sales_id, doc, None,
            None if addt is None else D(addt), None)


# --- T12 / T13 / T11: points from period sales --------------------------------
def test_basepack_points_floor_after_4dp_and_raw_datetime(spark):
    invoices = spark.createDataFrame([
        inv("I1", "T1", TS(2025, 7, 3), "999950.00"),          # 0.99995 -> 1.0000 -> 1 (T13)
        inv("I2", "T1", TS(2025, 9, 30, 10, 0), "5000000"),     # 10:00 on the last day: outside (T12)
        inv("I3", "T2", TS(2025, 9, 30, 0, 0), "2999900.00"),   # midnight of the last day: inside; 2.9999 -> 2
        inv("I4", "T3", TS(2025, 8, 1), "9000000"),             # cluster '0': no points (T11)
    ], INVOICES)
    master = spark.createDataFrame([
        ("A1", "T1", "1", "1", 6, 2, D(300), D(1500), *Q3),
        ("A1", "T2", "2", "1", 6, 2, D(300), D(1500), *Q3),
        ("A1", "T3", "0", "1", 6, 2, D(300), D(1500), *Q3),
    ], MASTER)
    got = {r.outlet_id: (r.total_sales_temp, r.Aktual_Point_temp)
           for r in sales.basepack_sales_points(master, invoices, SP).collect()}
    assert got == {"T1": (D(999950), D(1)), "T2": (D(2999900), D(2)), "T3": (D(9000000), D(0))}


def test_growth_points_round_and_date_cast(spark):
    invoices = spark.createDataFrame([
        inv("I1", "T1", TS(2025, 7, 3), "1200000"),             # 1.5 -> 2 (rounded, T13)
        inv("I2", "T5", TS(2025, 9, 30, 10, 0), "400000"),      # last day at 10:00: inside (T12); 0.5 -> 1
        inv("I3", "T3", TS(2025, 8, 1), "9000000"),             # cluster '0' -> 0 (T11)
    ], INVOICES)
    targets = spark.createDataFrame([
        ("A1", "T1", "n1", "D1", "1", "t", D(1), D(1), D(9), *Q3),
        ("A1", "T3", "n3", "D1", "0", "t", D(1), D(1), D(9), *Q3),
        ("A1", "T4", "n4", "D1", "2", "t", D(1), D(1), D(9), *Q3),   # no sales: NULL total, 0 points
        ("A1", "T5", "n5", "D1", "3", "t", D(1), D(1), D(9), *Q3),
    ], GROWTH)
    got = {r.Outlet_id: (r.pencapaian, r.point_temp)
           for r in sales.growth_sales_points(targets, invoices, SP).collect()}
    assert got == {"T1": (D(1200000), D(2)), "T3": (D(9000000), D(0)), "T4": (None, D(0)),
                   "T5": (D(400000), D(1))}


# --- T6 / T7: basepack summary --------------------------------------------------
def _summary_inputs(spark, detail_rows, regular_rows):
    master = spark.createDataFrame([("A1", "T1", "1", "1", 6, 2, D(300), D(1500), *Q3)], MASTER)
    detail = spark.createDataFrame(detail_rows, (
        "activity_id string, REGION string, AREA string, `KODE DISTI` string, `KODE TOKO` string, "
        "BASEPACK_TITLE string, TARGET int, QUANTITY bigint, VALUE decimal(38,0), PENCAPAIAN int, "
        "SISA_TARGET bigint, YEAR int, MONTH int, status_id string, status_approval string"))
    pts = spark.createDataFrame([("A1", "T1", "1", D(1), D(2000))],
                                "activity_id string, outlet_id string, cluster string, total_sales_temp decimal(38,0), "
                                "Aktual_Point_temp decimal(18,0)")
    regular = spark.createDataFrame(regular_rows, REGULAR)
    invoices = spark.createDataFrame([], INVOICES)
    grw = spark.createDataFrame([(DT(2025, 7, 1), DT(2025, 9, 30), "T1", "A")],
                                "periode_start date, periode_end date, outlet_code string, status_achievment string")
    return master, detail, pts, regular, invoices, grw


def test_summary_without_detail_keeps_uncapped_points(spark):
    args = _summary_inputs(spark, [], [("A1", "1", "OK")])
    (row,) = basepack.basepack_summary(*args, SP).collect()
    assert row.PENCAPAIAN is None and row.SISA_TARGET == 2
    assert row.Aktual_Point == D(2000)          # T6: NULL comparisons fall to ELSE, not capped at 1500


def test_summary_duplicate_regular_rows_double_achievement(spark):
    det = [("A1", "R", "A", "D", "T1", "BP1", 10, 10, D(0), 1, 0, 2025, 7, "1", "OK"),
           ("A1", "R", "A", "D", "T1", "BP2", 10, 0, D(0), 0, 10, 2025, 7, "1", "OK")]
    one = basepack.basepack_summary(*_summary_inputs(spark, det, [("A1", "1", "OK")]), SP).collect()
    two = basepack.basepack_summary(*_summary_inputs(spark, det, [("A1", "1", "OK")] * 2), SP).collect()
    assert [r.PENCAPAIAN for r in one] == [1] and [r.PENCAPAIAN for r in two] == [2]   # T7
    assert one[0].Aktual_Point == D(0) and two[0].Aktual_Point == D(1500)


def test_detail_empty_with_reference_start_date(spark):
    detail = spark.createDataFrame([("A1", "T1", "D1", "BP1", "Y", "1", 5, *Q3)],
                                   "activity_id string, outlet_id string, dist_code string, basepack_title string, "
                                   "status string, status_id string, target int, periode_start date, periode_end date")
    lines = spark.createDataFrame([], "outlet_id string, invoice_no string, invoice_year int, invoice_month int, "
                                      "invoice_date timestamp_ntz, basepack string, quantity int, total decimal(18,2)")
    master = spark.createDataFrame([], "REGION string, AREA string, KODE_TOKO string, KODE_DIS string")
    regular = spark.createDataFrame([], REGULAR)
    assert basepack.basepack_detail(detail, lines, master, regular, P.SalesParams()).count() == 0   # T5
    got = basepack.basepack_detail(detail, lines, master, regular, P.SalesParams(detail_from=DT(2025, 1, 1)))
    (row,) = got.collect()
    assert (row.QUANTITY, row.VALUE, row.PENCAPAIAN, row.SISA_TARGET) == (0, D(0), 0, 5)


# --- T1 / T3 / T4: activity ------------------------------------------------------
LINES = ("outlet_id string, invoice_no string, item_code string, price decimal(18,2), quantity int, "
         "total decimal(18,2), invoice_date timestamp_ntz")
OUTLETS = ("activity_id string, Outlet_id string, Outlet_Name string, Region string, Area string, Dist_Code string, "
           "Dist_Name string, Target_Toko decimal(18,2), Simulasi_Point decimal(18,2), VRR decimal(18,2), "
           "VRR_Addt decimal(18,2)")
ECO = ("activity_id string, Outlet_id string, quarter string, year string, target_1 int, target_2 int, "
       "target_3 int, vrr decimal(18,2)")
ACTS = ("activity_id string, category_id string, mechanism_id string, status_activities string, "
        "periode_start date, periode_end date")


def _activity_inputs(spark, eco_rows):
    lines = spark.createDataFrame([("T1", "I1", "S1", D(1), 5, D("100.00"), TS(2025, 7, 3))], LINES)
    outlets = spark.createDataFrame([
        ("A1", "T1", "n", "R", "A", "D", "DN", D(100), D(10), D("1.2"), D("0.5")),
        ("A1", "T2", "n", "R", "A", "D", "DN", D(100), D(10), D("1.2"), D("0.5")),
    ], OUTLETS)
    skus = spark.createDataFrame([("A1", "S1", 8)], "activity_id string, sku_code string, ispcs int")
    acts = spark.createDataFrame([("A1", "C1", "2", "14", *Q3)], ACTS)
    eco = spark.createDataFrame(eco_rows, ECO)
    return lines, outlets, skus, acts, eco


def test_eco_rows_of_the_activity_multiply_sums(spark):
    eco = [("A1", "T1", "Q3", "2025", 1, 1, 1, D(0)), ("A1", "T2", "Q3", "2025", 1, 1, 1, D(0)),
           ("A1", "T2", "Q2", "2025", 1, 1, 1, D(0))]
    args = _activity_inputs(spark, eco)
    (r,) = activity.activity_sku_progress(*args, P.ActivityParams()).collect()
    assert (r.total_qty, r.total_value, r.sisa_target, r.status) == (10, D(200), -2, "A")          # T1
    (r,) = activity.activity_sku_progress(*args, P.ActivityParams(eco_scope="outlet")).collect()
    assert (r.total_qty, r.total_value, r.sisa_target, r.status) == (5, D(100), 3, "NA")


def test_duplicate_eco_rows_inflate_remark_eco_and_missing_summary_is_achieved(spark):
    eco = [("A1", "T1", "Q3", "2025", 0, 0, 0, D(0)), ("A1", "T1", "Q3", "2025", 0, 0, 0, D(0))]
    lines, outlets, skus, acts, eco_df = _activity_inputs(spark, eco)
    pivot = spark.createDataFrame([], "activity_id string, quarter string, outlet_id string, achievement_1 bigint, "
                                      "achievement_2 bigint, achievement_3 bigint, invoice_year int")
    summary = activity.activity_eco_summary(outlets, eco_df, pivot, acts, P.ActivityParams())
    got = {r.outlet_id: r.Remark_ECO for r in summary.collect()}
    assert got == {"T1": 6}                          # T3: 3 remarks x 2 duplicate rows
    cats = spark.createDataFrame([], "category_id string, category_name string")
    live = spark.createDataFrame([("T1", "A1", D(500))], "outlet_code string, activity_id string, rpp_capai decimal(18,2)")
    empty = summary.limit(0)
    (row,) = activity.activity_incentive_summary(outlets, acts, cats, live, eco_df, empty, P.ActivityParams()).collect()
    assert (row.One_Remark_ECO, row.Remark_Q1_ECO, row.Remark) == ("A", "NA", "A")                 # T4
    assert row.VRR == "2%" and row.VRR_ECO == "0.50%" and row.Total_Incentive == D(0)


# --- T18 / T19 / T20: balance ------------------------------------------------------
REDEEMS = ("redeem_no string, redeem_date timestamp_ntz, user_id string, gift_code string, point_redeem decimal(18,4), "
           "amount decimal(22,4), status_delivery string, point_year int")
ITEMS = "redeem_code string, type_code string, vendor_code string, gift_name string, point decimal(18,4)"


def _ledger(spark):
    invoices = spark.createDataFrame([
        ("I1", "T1", TS(2025, 2, 1), TS(2025, 2, 1), D(1), D(1), "I", "S", None, D(100), D("50.5"), None),
    ], INVOICES)
    redeems = spark.createDataFrame([
        ("R1", TS(2025, 3, 1), "u1", "G1", D(10), None, "Failed", 2025),     # failed catalogue: still counts
        ("R2", TS(2025, 3, 1), "u1", "G2", D(20), None, None, 2025),         # OVO, NULL status: dropped
        ("R3", TS(2025, 3, 1), "u1", "G2", D(30), None, "DIPROSES", 2025),   # OVO counts
        ("R4", TS(2025, 3, 1), "u1", "G9", D(40), None, "DIPROSES", 2025),   # no catalogue item: vanishes
        ("R5", TS(2025, 3, 1), "u1", "G1", D(5), None, "DIPROSES", 2025),    # two detail rows: counted twice
        ("R6", TS(2025, 3, 1), "u1", "G1", D(7), None, "DIPROSES", 2025),    # cashback
    ], REDEEMS)
    detail = spark.createDataFrame([("R1", "T1"), ("R2", "T1"), ("R3", "T1"), ("R4", "T1"), ("R5", "T1"),
                                    ("R5", "T1")], "redeem_no string, outlet_id string")
    cashback = spark.createDataFrame([("R6", "T1")], "redeem_no string, outlet_id string")
    none = spark.createDataFrame([], "redeem_no string, outlet_id string")
    items = spark.createDataFrame([("G1", "08", "V03", "Kompor", D(10)), ("G2", "12", "V01", "OVO", D(5))], ITEMS)
    return points.point_ledger(invoices, redeems, detail, cashback, none, none, items, P.PointParams())


def test_ledger_components_and_balance(spark):
    ledger = _ledger(spark)
    comp = {(r.component): r.points for r in points.point_components(ledger).collect()}
    assert comp == {"earned": D("150.5"), "catalogue": D(20), "ovo": D(30), "cashback": D(7)}
    pairs = spark.createDataFrame([("T1", 2025), ("T1", 2030), ("T9", 2025)], "outlet_id string, year int")
    stored = spark.createDataFrame([("T1", D("99.5"))], "outlet_id string, remain_point decimal(18,4)")
    got = {(r.outlet_id, r.year): r.total_point for r in points.point_balance(pairs, ledger, stored).collect()}
    assert got == {("T1", 2025): D("93.5"), ("T1", 2030): D("99.5"), ("T9", 2025): D(0)}           # T20


# --- T14-T17 and the snapshot rule: redemption --------------------------------------
def test_redemption_gate_and_rows(spark):
    ledger = _ledger(spark).limit(0)
    stored = spark.createDataFrame([("T1", D("99.5")), ("T2", D("99.4")), ("T3", D(500))],
                                   "outlet_id string, remain_point decimal(18,4)")
    items = spark.createDataFrame([("G100", "08", "V03", "Kompor  ", D(100)), ("GN", "4", "V01", "Tv", None),
                                   ("GX", "X", None, "Lain", D(1))], ITEMS)
    users = spark.createDataFrame([("u1", "T1", "s", "e", "0812 "), ("u2", "T2", "s", "e", "0813"),
                                   ("u3", "T3", "s", "e", "0814"), ("u4", "T4", "s", "e", "0815"),
                                   ("u5", "T5", "s", "e", "1"), ("u6", "T5", "s", "e", "2")],
                                  "user_id string, outlet_id string, store_name string, user_email string, no_hp string")
    part = spark.createDataFrame([], "KODE_OUTLET string, jenis string")
    now = TS(2025, 10, 7, 10, 0)
    log = spark.createDataFrame([("u4", "G100", now - dt.timedelta(minutes=1)),
                                 ("u3", "G100", now - dt.timedelta(minutes=5))],
                                "user_id string, redeem_code string, created_date timestamp_ntz")
    reqs = spark.createDataFrame([
        ("T1", "G100", 1, 2030, "Q1", now),      # 99.5 rounds to 100 >= 100: accepted (T15)
        ("T2", "G100", 1, 2030, "Q2", now),      # 99.4 -> 99 < 100: rejected
        ("T3", "GN", 3, 2030, "Q3", now),        # NULL price passes (T16)
        ("T3", "G100", 1, 2030, "Q3b", now + dt.timedelta(minutes=1)),   # second call: also decided
        ("T4", "GX", 1, 2030, "Q4", now),        # log 1 minute ago: cooldown
        ("T5", "GX", 1, 2030, "Q5", now),        # two users: ambiguous
        ("T6", "GX", 1, 2030, "Q6", now),        # unknown outlet
        ("T1", "G404", 1, 2030, "Q7", now + dt.timedelta(minutes=9)),    # no such gift
    ], "outlet_id string, giftcode string, qty int, year int, redeemno string, request_ts timestamp_ntz")
    gate = redeem.redemption_gate(reqs, ledger, stored, items, users, part, log, P.RedeemParams())
    got = {r.redeemno: (r.accepted, r.reject_reason) for r in gate.collect()}
    assert got == {
        "Q1": (True, None), "Q2": (False, "insufficient_points"), "Q3": (True, None), "Q3b": (True, None),
        "Q4": (False, "cooldown"), "Q5": (False, "ambiguous_user"), "Q6": (False, "unknown_outlet"),
        "Q7": (False, "unknown_gift"),
    }
    total = redeem.redemption_gate(reqs, ledger, stored, items, users, part, log, P.RedeemParams(check="total"))
    assert {r.redeemno: r.reject_reason for r in total.collect()}["Q1"] is None   # qty 1: same as unit (T14)

    rows = {r.redeem_no: r for r in redeem.redemption_rows(gate, items).collect()}
    assert rows["Q1"].point_redeem == D(100) and rows["Q1"].amount == D(400000)
    assert rows["Q3"].point_redeem is None                                     # T16: NULL points stored
    notes = {r.outlet_id: r for r in redeem.redemption_notifications(gate, items).collect()}
    assert notes["T1"].notification_title == "Redeem Peralatan Rumah Tangga"   # '08' compared as 8 (T17)
    titles = [r.notification_title for r in redeem.redemption_notifications(gate, items).collect() if r.outlet_id == "T3"]
    assert sorted(titles) == ["Redeem Elektronik", "Redeem Peralatan Rumah Tangga"]
    assert notes["T1"].notification_detail == (
        "Selamat! Penukaran point Juragan Anda untuk Kompor dengan nomor redeem Q1 akan segera diproses. "
        "Terima Kasih.")
    addr = spark.createDataFrame([(1, "T1 ", "old", "j", "n", "k", "c", "p", "kt", "kp"),
                                  (2, "T1", "new", "j", "n", "k", "c", "p", "kt", "kp")],
                                 "id int, outlet_id string, nama_penerima string, nama_jalan string, no_rumah string, "
                                 "kelurahan string, kecamatan string, provinsi string, kota string, kode_pos string")
    det = {r.redeem_no: r for r in redeem.redemption_detail_rows(gate, addr, users).collect()}
    assert det["Q1"].nama_penerima == "new" and det["Q1"].no_telp == "0812"
    assert det["Q3"].nama_penerima is None                                     # no address: row still written


# --- T9 / T8: daily report --------------------------------------------------------------
def test_null_distributor_kept_by_redeemed_dropped_by_report(spark):
    redeems = spark.createDataFrame([("R1", TS(2025, 3, 1), "u1", "G1", D(10), None, "DIPROSES", 2025),
                                     ("R2", TS(2025, 3, 1), "u2", "G1", D(20), None, "DIPROSES", 2025)], REDEEMS)
    users = spark.createDataFrame([("u1", "T1"), ("u2", "R-2")], "user_id string, outlet_id string")
    master = spark.createDataFrame([("R", "A", "T1", None, "ACTIVE"), ("R", "A", "T1", "D1", "MOVED")],
                                   "REGION string, AREA string, KODE_TOKO string, KODE_DIS string, Remark_freeze string")
    rp = P.ReportParams()
    red = {r.outlet_id: r.total_redeem for r in points.redeemed_by_outlet(redeems, users, master, rp).collect()}
    assert red == {"T1": D(20)}          # both master rows pass (NULL -> ''), so the sum doubles (T8, T9)
    summary = spark.createDataFrame([("ASIA LMT", "BUH BALI", "D1", "T1")],
                                    "REGION string, AREA string, KODE_DISTRIBUTOR string, KODE_OUTLET string")
    mapping = spark.createDataFrame([], "outlet_code string, dt_code_latest string")
    part = spark.createDataFrame([("T1",), ("T1",)], "KODE_OUTLET string")
    injected = spark.createDataFrame([("T1", D(50))], "outlet_id string, total_point decimal(18,0)")
    rows = report.daily_outlet_report(summary, master, mapping, users, part, injected,
                                      points.redeemed_by_outlet(redeems, users, master, rp), rp).collect()
    assert len(rows) == 2                # NULL KODE_DIS row dropped; participant duplicates repeat the row
    assert {(r.REGION, r.AREA, r.TOTAL_POINT, r.REDEEM_POINT, r.POINT_SAAT_INI) for r in rows} == {
        ("ASIA LMT", "BUH BALI", D(50), D(20), D(30))}


def test_latest_address_and_views(spark):
    addr = spark.createDataFrame([(1, "T1", "a"), (3, "T1", "c"), (2, "T1", "b"), (5, "T2", "z")],
                                 "id int, outlet_id string, nama_penerima string")
    got = {r.outlet_id: (r.id, r.nama_penerima, r.RowNum)
           for r in report.latest_address(addr, ["nama_penerima"]).collect()}
    assert got == {"T1": (3, "c", 1), "T2": (5, "z", 1)}

    inv_rows = spark.createDataFrame([inv("I1 ", "T1", TS(1999, 8, 2, 10), "0"),
                                      inv("I2", "T1", TS(1999, 8, 3), "1234567.5")], INVOICES)
    vp = P.InvoiceViewParams(as_of=TS(1999, 8, 2, 9, 0))
    got = {r.invoice_no: (r.invoice_date, r.invoice_amount, r.cek)
           for r in report.invoice_headers_view(inv_rows, vp).collect()}
    assert got == {"#I1": ("Hari ini, 02 Agustus, 1999", "Rp. ", D(0)),
                   "#I2": ("Selasa, 03 Agustus, 1999", "Rp. 1,234,568", D(1234568))}


@pytest.mark.parametrize("scope", ["nope"])
def test_bad_eco_scope(spark, scope):
    with pytest.raises(ValueError):
        activity.activity_sku_progress(*_activity_inputs(spark, []), P.ActivityParams(eco_scope=scope))


def test_growth_achievement_branches(spark):
    invoices = spark.createDataFrame([
        inv("I1", "T1", TS(2025, 7, 3), "400000000"),               # 500 points, target met, inside [300, 1500]
        inv("J1", "T1", TS(2025, 7, 4), "1", sales_id="0", doc="A1", addt="10.5"),
        inv("J2", "T1", TS(2025, 7, 4), "1", sales_id="0", doc="A1", addt="10.5"),   # same attributes: MAX(no)
        inv("K1", "T1", TS(2025, 7, 5), "7", sales_id="1", doc="A1", addt="2.4"),
    ], INVOICES)
    targets = spark.createDataFrame([("A1", "T1", "n1", "D1", "3", "t", D(300000000), D(300), D(1500), *Q3),
                                     ("A1", "T2", "n2", "D1", "9", "t", D(5), D(300), D(1500), *Q3)], GROWTH)
    regular = spark.createDataFrame([("A1", "1", "OK")], REGULAR)
    g = growth.growth_achievement(targets, sales.growth_sales_points(targets, invoices, SP), regular, invoices, SP)
    rows = {r.outlet_code: r for r in g.collect()}
    t1 = rows["T1"]
    assert (t1.rpp_aktual_point, t1.status_achievment, t1.cluster) == (D(500), "A", "Big")
    assert (t1["Injection Code"], t1["Point Injected"], t1["Gap Point Injected"], t1["Final Point"]) == (
        "J2", D(11), D(2), D(13))
    assert (t1["Feedback Remark"], t1["Feedback Ach sales"], t1["Budget Utilized Final"]) == ("Approved", D(7), D(52000))
    t2 = rows["T2"]
    assert (t2.rpp_sisa, t2.rpp_aktual_point, t2.status_achievment, t2.cluster) == (D(5), D(0), "NA", "-")
    assert t2["Injection Code"] == "-" and t2["Injection Date"] == "-"


def test_no_python_udf_in_library():
    import pathlib

    src = pathlib.Path(__file__).resolve().parents[1] / "tokoledger"
    text = "\n".join(p.read_text() for p in src.rglob("*.py"))
    assert "@udf" not in text and "F.udf(" not in text and ".rdd" not in text and "localCheckpoint" not in text
    assert F is not None


# --- T2 / T10 / T21 / T23 -------------------------------------------------------------
def test_pivot_collapses_years_by_max(spark):
    monthly = spark.createDataFrame([("A1", "Q3", "T1", 4, 2024, 7), ("A1", "Q3", "T1", 2, 2025, 7),
                                     ("A1", "Q3", "T1", 1, 2025, 9)],
                                    "activity_id string, quarter string, outlet_id string, Achievement bigint, "
                                    "invoice_year int, invoice_month int")
    (r,) = activity.activity_achievement_pivot(monthly, P.ActivityParams()).collect()
    assert (r.achievement_1, r.achievement_2, r.achievement_3, r.invoice_year) == (4, 0, 1, 2025)     # T2


def test_injected_points_use_non_header_invoices_only(spark):
    rows = [inv("I1", "T1", TS(2025, 2, 1), "1", addt="10.4", itype="P"),
            inv("I2", "T1", TS(2025, 3, 1), "1", addt="5", itype="I"),        # header invoice: not counted
            inv("I3", "T1", TS(2025, 4, 1), "1", addt="7", itype=None),       # NULL type: dropped (T10)
            inv("I4", "T1", TS(2024, 4, 1), "1", addt="9", itype="P")]        # other year
    got = points.injected_points_by_outlet(spark.createDataFrame(rows, INVOICES), P.ReportParams()).collect()
    assert [(r.outlet_id, r.total_point) for r in got] == [("T1", D(10))]


def test_distribution_dedups_raw_values_before_rounding(spark):
    lines = spark.createDataFrame([
        ("T1", "I1", "S1", D("10.40"), 1, D("10.40"), TS(2025, 7, 2)),
        ("T1", "I1", "S1", D("10.40"), 1, D("10.40"), TS(2025, 7, 2)),     # exact duplicate: one row
        ("T1", "I1", "S1", D("10.20"), 1, D("10.20"), TS(2025, 7, 2)),     # rounds to the same 10: kept (T21)
        ("T1", "I2", "S1", D("5.00"), 1, D("5.00"), TS(2025, 10, 2)),      # outside the period
    ], LINES)
    detail = spark.createDataFrame([("A1", "T1", "D1", "BP1", "Y", "1", 5, *Q3), ("A1", "T1", "D1", "BP2", "Y", "1", 5, *Q3)],
                                   "activity_id string, outlet_id string, dist_code string, basepack_title string, "
                                   "status string, status_id string, target int, periode_start date, periode_end date")
    got = sorted((r.invoice_no, r.Harga, r.Total) for r in basepack.invoice_distribution(lines, detail).collect())
    assert got == [("I1", D(10), D(10)), ("I1", D(10), D(10))]


def test_growth_total_spans_periods_of_one_target(spark):
    invoices = spark.createDataFrame([inv("I1", "T1", TS(2025, 7, 3), "1000000"),
                                      inv("I2", "T1", TS(2025, 11, 3), "2000000")], INVOICES)
    targets = spark.createDataFrame([
        ("A1", "T1", "n1", "D1", "1", "t", D(1), D(1), D(9), *Q3),
        ("A1", "T1", "n1", "D1", "1", "t", D(1), D(1), D(9), DT(2025, 10, 1), DT(2025, 12, 31)),
    ], GROWTH)
    (r,) = sales.growth_sales_points(targets, invoices, SP).collect()
    assert (r.pencapaian, r.point_temp) == (D(3000000), D(4))          # T23: one total for both periods


def test_day_grain_keeps_the_period_boundaries_exact(spark):
    lines = spark.createDataFrame([
        ("T1", "I1", "S1", D(1), 1, D("1.00"), TS(2025, 7, 1, 10, 0)),      # first day, 10:00: inside
        ("T1", "I2", "S1", D(1), 2, D("2.00"), TS(2025, 9, 30, 0, 0)),      # last day at midnight: inside
        ("T1", "I3", "S1", D(1), 4, D("4.00"), TS(2025, 9, 30, 10, 0)),     # last day, 10:00: outside (T12)
        ("T1", "I4", "S1", D(1), 8, D("8.00"), TS(2025, 6, 30, 23, 0)),     # day before: outside
    ], LINES)
    outlets = spark.createDataFrame([("A1", "T1", "n", "R", "A", "D", "DN", D(100), D(10), D(1), D(0))], OUTLETS)
    skus = spark.createDataFrame([("A1", "S1", 99)], "activity_id string, sku_code string, ispcs int")
    acts = spark.createDataFrame([("A1", "C1", "2", "14", *Q3)], ACTS)
    eco = spark.createDataFrame([("A1", "T1", "Q3", "2025", 1, 1, 1, D(0))], ECO)
    got = {(r.invoice_month, r.total_qty) for r in
           activity.activity_sku_progress(lines, outlets, skus, acts, eco, P.ActivityParams()).collect()}
    assert got == {(7, 1), (9, 2)}
    bp_lines = lines.select("outlet_id", "invoice_no", F.lit(2025).alias("invoice_year"), F.lit(7).alias("invoice_month"),
                            "invoice_date", F.lit("BP1").alias("basepack"), "quantity", "total")
    detail = spark.createDataFrame([("A1", "T1", "D1", "BP1", "Y", "1", 5, *Q3)],
                                   "activity_id string, outlet_id string, dist_code string, basepack_title string, "
                                   "status string, status_id string, target int, periode_start date, periode_end date")
    master = spark.createDataFrame([], "REGION string, AREA string, KODE_TOKO string, KODE_DIS string")
    regular = spark.createDataFrame([], REGULAR)
    (row,) = basepack.basepack_detail(detail, bp_lines, master, regular,
                                      P.SalesParams(detail_from=DT(2025, 1, 1))).collect()
    assert (row.QUANTITY, row.VALUE, row.SISA_TARGET) == (3, D(3), 2)


def test_summary_duplicate_injection_rows_multiply_the_sum(spark):
    det = [("A1", "R", "A", "D", "T1", "BP1", 10, 10, D(0), 1, 0, 2025, 7, "1", "OK"),
           ("A1", "R", "A", "D", "T1", "BP2", 10, 0, D(0), 1, 10, 2025, 7, "1", "OK")]
    master, detail, pts, regular, _, grw = _summary_inputs(spark, det, [("A1", "1", "OK")])
    dup = inv("J1", "T1", TS(2025, 7, 4), "1", sales_id="0", doc="A1", addt="3")
    invoices = spark.createDataFrame([dup, dup,                                   # the same row twice
                                      inv("J2", "T1", TS(2025, 7, 5), "1", sales_id="0", doc="A1", addt="4"),
                                      inv("K1", "T1", TS(2025, 7, 6), "9", sales_id="1", doc="A1", addt="1")],
                                     INVOICES)
    rows = {r["Injection Code"]: r for r in
            basepack.basepack_summary(master, detail, pts, regular, invoices, grw, SP).collect()}
    assert sorted(rows) == ["J1", "J2"]
    assert rows["J1"].PENCAPAIAN == 4 and rows["J2"].PENCAPAIAN == 2          # 2 detail rows x 2 (J1) / x 1 (J2)
    assert rows["J1"]["Feedback Injection Code"] == "K1" and rows["J1"]["Final Point"] == D(4)
    assert rows["J1"].Aktual_Point == D(1500) and rows["J1"].SISA_TARGET == 0


def test_duplicate_rows_on_every_counted_side_double_the_sums(spark):
    # O1: outlet list, SKU targets and activities each listed twice -> x8
    lines = spark.createDataFrame([("T1", "I1", "S1", D(1), 5, D("100.00"), TS(2025, 7, 3))], LINES)
    outlet_row = ("A1", "T1", "n", "R", "A", "D", "DN", D(100), D(10), D("1.2"), D("0.5"))
    outlets = spark.createDataFrame([outlet_row, outlet_row], OUTLETS)
    skus = spark.createDataFrame([("A1", "S1", 100)] * 2, "activity_id string, sku_code string, ispcs int")
    acts = spark.createDataFrame([("A1", "C1", "2", "14", *Q3)] * 2, ACTS)
    eco = spark.createDataFrame([("A1", "T1", "Q3", "2025", 1, 1, 1, D(0))], ECO)
    (r,) = activity.activity_sku_progress(lines, outlets, skus, acts, eco, P.ActivityParams()).collect()
    assert (r.total_qty, r.total_value) == (40, D(800))

    # The same target detail row twice -> quantity x2
    bp_lines = spark.createDataFrame([("T1", "I1", 2025, 7, TS(2025, 7, 3), "BP1", 3, D("7.00"))],
                                     "outlet_id string, invoice_no string, invoice_year int, invoice_month int, "
                                     "invoice_date timestamp_ntz, basepack string, quantity int, total decimal(18,2)")
    drow = ("A1", "T1", "D1", "BP1", "Y", "1", 5, *Q3)
    detail = spark.createDataFrame([drow, drow], "activity_id string, outlet_id string, dist_code string, "
                                                 "basepack_title string, status string, status_id string, "
                                                 "target int, periode_start date, periode_end date")
    master = spark.createDataFrame([], "REGION string, AREA string, KODE_TOKO string, KODE_DIS string")
    regular = spark.createDataFrame([], REGULAR)
    (row,) = basepack.basepack_detail(detail, bp_lines, master, regular,
                                      P.SalesParams(detail_from=DT(2025, 1, 1))).collect()
    assert (row.QUANTITY, row.VALUE, row.PENCAPAIAN, row.SISA_TARGET) == (6, D(14), 1, 0)

    # The same master row twice -> achievement x2
    det = [("A1", "R", "A", "D", "T1", "BP1", 10, 10, D(0), 1, 0, 2025, 7, "1", "OK")]
    m, d, pts, reg, invs, grw = _summary_inputs(spark, det, [("A1", "1", "OK")])
    m2 = m.unionByName(m)
    (row,) = basepack.basepack_summary(m2, d, pts, reg, invs, grw, SP).collect()
    assert (row.PENCAPAIAN, row.SISA_TARGET, row.Aktual_Point) == (2, 0, D(1500))


def test_duplicate_list_and_user_rows_multiply(spark):
    outlet_row = ("A1", "T1", "n", "R", "A", "D", "DN", D(100), D(10), D("1.2"), D("0.5"))
    outlets = spark.createDataFrame([outlet_row, outlet_row], OUTLETS)
    acts = spark.createDataFrame([("A1", "C1", "2", "14", *Q3)] * 2, ACTS)
    eco = spark.createDataFrame([("A1", "T1", "Q3", "2025", 0, 0, 0, D(0))], ECO)
    pivot = spark.createDataFrame([], "activity_id string, quarter string, outlet_id string, achievement_1 bigint, "
                                      "achievement_2 bigint, achievement_3 bigint, invoice_year int")
    (r,) = activity.activity_eco_summary(outlets, eco, pivot, acts, P.ActivityParams()).collect()
    assert r.Remark_ECO == 12                      # 3 remarks x 2 outlet rows x 2 activity rows

    redeems = spark.createDataFrame([("R1", TS(2025, 3, 1), "u1", "G1", D(10), None, "DIPROSES", 2025)], REDEEMS)
    users = spark.createDataFrame([("u1", "T1"), ("u1", "T1")], "user_id string, outlet_id string")
    master = spark.createDataFrame([], "REGION string, AREA string, KODE_TOKO string, KODE_DIS string, "
                                       "Remark_freeze string")
    got = points.redeemed_by_outlet(redeems, users, master, P.ReportParams()).collect()
    assert [(g.outlet_id, g.total_redeem) for g in got] == [("T1", D(20))]
