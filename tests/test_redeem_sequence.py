"""Redemption calls decided in one pass against call by call in plain Python, and the maintained balance."""

from __future__ import annotations

import datetime as dt
import random
import tempfile
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tokoledger import catalog, params as P
from tokoledger.operators import points, redeem
from tokoledger.plans import batches
from tokoledger.plans.balances import BalanceStore
from tokoledger.plans.checks import plan_text
from tokoledger.sources.sinks import ParquetSink
from tokoledger.sources.tables import from_parquet, materialize

START = dt.datetime(2025, 3, 1, 9, 0)
GIFTS = {"G1": D(100), "G2": D("10.5"), "G3": None, "G4": D(0), "GD": D(5), "G9": D(1000)}
REQUESTS = "outlet_id string, giftcode string, qty int, year int, redeemno string, request_ts timestamp_ntz"


def call_by_call(requests, opening, check="unit"):
    """(redeemno, moment, gift, qty) -> balance met, reason; ``opening``: (outlet, year) -> points."""
    left, out = dict(opening), {}
    first_use = {}
    for r in sorted(set(requests), key=lambda r: (r[5], r[0], r[1], r[2], r[3])):
        first_use.setdefault(r[4], r)
    for r in sorted(set(requests), key=lambda r: (r[5], r[4], r[1], r[2])):
        o, g, q, y, no, ts = r
        met = left.get((o, y), D(0))
        whole = met.quantize(D(1), ROUND_HALF_UP)
        price = GIFTS.get(g)
        charge = None if price is None else price * q if check == "total" else price
        if first_use[no] != r:
            reason = "duplicate_request"
        elif o == "T8":
            reason = "unknown_outlet"
        elif g not in GIFTS:
            reason = "unknown_gift"
        elif g == "GD":
            reason = "ambiguous_gift"
        elif charge is not None and whole < charge:
            reason = "insufficient_points"
        else:
            reason = None
            if y != 2030:
                left[o, y] = met - (price or D(0)) * q
        out[no, ts, g, q, o, y] = (whole, reason)
    return out


@pytest.fixture(scope="module")
def side(spark):
    items = [(c, "08", "V03", "x", p) for c, p in GIFTS.items()] + [("GD", "08", "V03", "x", D(5))]
    return {
        "items": spark.createDataFrame(items, "redeem_code string, type_code string, vendor_code string, gift_name string, point decimal(18,4)"),
        "users": spark.createDataFrame([(f"u{o}", o, "0812") for o in ("T0", "T1", "T2", "T3")], "user_id string, outlet_id string, no_hp string"),
        "participants": spark.createDataFrame([], "KODE_OUTLET string"),
        "redeem_log": spark.createDataFrame([], "user_id string, redeem_code string, created_date timestamp_ntz"),
    }


def decided(spark, side, requests, opening, check="unit"):
    balances = spark.createDataFrame([(o, y, b) for (o, y), b in opening.items()], "outlet_id string, year int, total_point decimal(18,4)")
    gate = redeem.redemption_gate(spark.createDataFrame(requests, REQUESTS), None, None, **side, balances=balances, p=P.RedeemParams(check=check))
    return {(r.redeemno, r.request_ts, r.giftcode, r.qty, r.outlet_id, r.year): (r.total_point, r.reject_reason) for r in gate.collect()}


def random_requests(seed, n, outlets=("T0", "T1", "T2", "T3", "T8"), hours=12):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        ts = START + dt.timedelta(minutes=rnd.randrange(60 * hours) // 7 * 7)
        no = f"Q{rnd.randrange(n)}" if rnd.random() < 0.1 else f"R{k}"
        out.append((rnd.choice(outlets), rnd.choice([*GIFTS, "G404"]), rnd.choice([0, 1, 1, 2, 3]), rnd.choice([2024, 2025, 2030]), no, ts))
    return out + out[: n // 20]


@pytest.mark.parametrize("check", ["unit", "total"])
def test_one_pass_equals_call_by_call(spark, side, check):
    requests = random_requests(1, 400)
    rnd = random.Random(2)
    opening = {(o, y): D(rnd.choice(["0", "150.5", "999.4", "4000", "100000"])) for o in ("T0", "T1", "T2", "T3", "T8") for y in (2024, 2025, 2030)}
    want = call_by_call(requests, opening, check)
    assert decided(spark, side, requests, opening, check) == want
    assert {r for _, r in want.values()} >= {None, "insufficient_points", "duplicate_request", "unknown_gift", "ambiguous_gift", "unknown_outlet"}


def test_one_outlet_with_most_calls_and_no_broadcasts(spark, side):
    requests = random_requests(3, 3000, outlets=("T0",) * 9 + ("T1",), hours=24 * 20)
    for balance in ("70000.5", "100000000"):            # runs out on the way; never runs out
        opening = {(o, y): D(balance) for o in ("T0", "T1") for y in (2024, 2025, 2030)}
        spark.conf.set("tokoledger.broadcast.maxRows", "0")
        try:
            assert decided(spark, side, requests, opening) == call_by_call(requests, opening)
        finally:
            spark.conf.unset("tokoledger.broadcast.maxRows")


def test_padded_and_null_request_keys(spark, side):
    requests = [("T0  ", "G1 ", 1, 2025, "A ", START), ("T0", "G1", 1, 2025, "B", START + dt.timedelta(minutes=1)),
                (None, "G1", 1, 2025, "C", START), ("T0", None, 1, 2025, "D", START), ("T0", "G1", None, 2025, "E", None),
                ("T0", "G1", 1, None, "F", START), ("T0", "G1", 1, 2025, None, START), ("T0", "G1", 2, 2025, None, START)]
    got = decided(spark, side, requests, {("T0", 2025): D(350)})
    reasons = {(k[0], k[3]): v for k, v in got.items()}
    assert reasons["C", 1][1] == "unknown_outlet" and reasons["D", 1][1] == "unknown_gift"
    assert reasons["F", 1] == (D(0), "insufficient_points")             # no year, no balance
    # E has no moment, so it comes first and, without a quantity, takes nothing; then the two without a number, A, B
    assert reasons["E", None] == (D(350), None)
    assert reasons[None, 1] == (D(350), None) and reasons[None, 2] == (D(250), None)
    assert reasons["A", 1] == (D(50), "insufficient_points") and reasons["B", 1] == (D(50), "insufficient_points")


def test_cooldown_over_midnight(spark, side):
    midnight = dt.datetime(2025, 3, 2)
    log = [("uT0", "G1", midnight - dt.timedelta(seconds=30)), ("uT1", "G1", midnight - dt.timedelta(seconds=150)),
           ("uT2", "G1", midnight + dt.timedelta(seconds=61)), ("uT3", "G1", midnight - dt.timedelta(seconds=60))]
    more = {**side, "redeem_log": spark.createDataFrame(log, "user_id string, redeem_code string, created_date timestamp_ntz")}
    requests = [(o, "G4", 1, 2030, f"R{o}", midnight + dt.timedelta(minutes=1)) for o in ("T0", "T1", "T2", "T3")]
    got = {k[0]: v[1] for k, v in decided(spark, more, requests, {}).items()}
    # the newest log row before the call, at most two minutes old (the edge counts); later rows do not count
    assert got == {"RT0": "cooldown", "RT1": None, "RT2": None, "RT3": "cooldown"}


# ---- the maintained balance ----------------------------------------------------------------------
def rows(df):
    return sorted((r.outlet_id, r.year, r.total_point) for r in df.collect())


def test_maintained_balance_equals_the_ledger_after_every_change(spark, small_sf):
    root = tempfile.mkdtemp(prefix="tl-balance-")
    materialize(catalog.standin_tables(spark, small_sf), f"{root}/tables")
    sink = ParquetSink(spark, f"{root}/out")
    store = BalanceStore(spark, f"{root}/tables", f"{root}/store", catalog.POINTS, sink)

    def whole():
        t = from_parquet(spark, f"{root}/tables")
        pairs = t["requests"].select("outlet_id", "year").distinct()
        ledger = batches.round_ledger(t, sink, sink.next_round(), catalog.REDEEM)
        return t, pairs, rows(points.point_balance(pairs, ledger, t["new_point_balance"], catalog.POINTS))

    def check():
        t, pairs, want = whole()
        store.refresh()
        store.absorb_rounds()
        found = store.balances(pairs, t["new_point_balance"], pairs_source=t["requests"])
        assert rows(found) == want
        text = plan_text(found)
        assert "/tables/invoice_master" not in text and "/tables/point_redeem" not in text
        return t, want

    t, first = check()
    # invoices come in, and a redemption whose detail comes only later
    inv = t["invoice_master"].filter("expected_invoice_reward > 0").limit(40).withColumn("invoice_no", F.concat("invoice_no", F.lit("-n")))
    inv.write.mode("append").parquet(f"{root}/tables/invoice_master")
    more = t["point_redeem"].filter("point_year = 1999").limit(30).withColumn("redeem_no", F.concat("redeem_no", F.lit("-n")))
    more.write.mode("append").parquet(f"{root}/tables/point_redeem")
    _, second = check()
    assert second != first
    outlets = t["point_redeem_detail_cashback"].select("redeem_no", "outlet_id").limit(1).first().outlet_id
    late = more.select("redeem_no", F.lit(outlets).alias("outlet_id"))
    late.write.mode("append").parquet(f"{root}/tables/point_redeem_detail_cashback")
    check()
    store.compact()
    check()
    # a redemption round, decided on maintained balances as on the ledger, and repeated
    t, _, _ = whole()
    by_ledger = batches.run_redemption_batch(t, ParquetSink(spark, f"{root}/plain"), t["requests"], p=catalog.REDEEM)
    by_store = batches.run_redemption_batch(t, sink, t["requests"], p=catalog.REDEEM, balances=store)
    assert sorted(map(str, by_ledger.collect())) == sorted(map(str, by_store.collect()))
    _, after = check()
    batches.run_redemption_batch(t, sink, t["requests"], 0, catalog.REDEEM, balances=store)
    assert check()[1] == after


def test_a_pass_reads_only_new_rows(spark, small_sf):
    root = tempfile.mkdtemp(prefix="tl-pass-")
    materialize(catalog.standin_tables(spark, small_sf), f"{root}/tables")
    store = BalanceStore(spark, f"{root}/tables", f"{root}/store", catalog.POINTS)
    store.refresh()
    before = spark.read.parquet(f"{root}/store/deltas").agg(F.max("batch")).first()[0]
    store.refresh()                                       # nothing new: no new delta
    assert spark.read.parquet(f"{root}/store/deltas").agg(F.max("batch")).first()[0] == before
    t = from_parquet(spark, f"{root}/tables")
    one = t["invoice_master"].filter("expected_invoice_reward > 0 AND year(invoice_date) = 1999").limit(1)
    one.withColumn("invoice_no", F.lit("new")).write.mode("append").parquet(f"{root}/tables/invoice_master")
    store.refresh()
    new = spark.read.parquet(f"{root}/store/deltas").filter(F.col("batch") > before)
    assert new.count() == 1                               # one outlet and year


def test_duplicate_catalogue_rows_count_for_details_only(spark):
    redeemed = spark.createDataFrame([("R1", "G1", D(100), 2025, "DIPROSES"), ("R2", "G1", D(7), 2025, "DIPROSES")],
                                     "redeem_no string, gift_code string, point_redeem decimal(18,4), point_year int, status_delivery string")
    items = spark.createDataFrame([("G1", "08"), ("G1", "12")], "redeem_code string, type_code string")
    detail = spark.createDataFrame([("R2", "T1")], "redeem_no string, outlet_id string")
    cash = spark.createDataFrame([("R1", "T1")], "redeem_no string, outlet_id string")
    none = cash.limit(0)
    invoices = spark.createDataFrame([], "outlet_id string, invoice_date timestamp_ntz, expected_invoice_reward decimal(18,4), "
                                         "expected_invoice_addt_reward decimal(18,4), expected_invoice_npd_reward decimal(18,4)")
    ledger = points.point_ledger(invoices, redeemed, detail, cash, none, none, items, P.PointParams())
    got = {r.component: r.points for r in points.point_components(ledger).collect()}
    assert got == {"cashback": D(100), "catalogue": D(7), "ovo": D(7)}
