"""Redemption requests as a batch: gate (O19) and the three rows an accepted
request writes -- point_redeem (O20), point_redeem_detail (O21) and
notifications (O22).

The reference validates one request per call, and its insert changes the next
call's balance. A batch decides all its requests in one pass, in the order of
(request_ts, redeemno, giftcode, qty) within each outlet and year, each against
the balance that the accepted ones before it leave (:mod:`decide`).
``request_ts`` replaces GETDATE(). Where the reference would raise (several
users for the outlet, several catalogue rows for the gift) the request is
rejected with a reason. A redeemno names one request: delivered again, or used
for another request, it is a ``duplicate_request`` and spends nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.exprs import POINTS4, numeric
from ..params import RedeemParams
from ..plans.joins import bounded_broadcast
from .decide import balances_before
from .points import point_balance
from .report import latest_address

DELIVERY_ADDRESS = ["nama_penerima", "nama_jalan", "no_rumah", "kelurahan", "kecamatan", "provinsi", "kota",
                    "kode_pos"]


REQUEST = ["outlet_id", "giftcode", "qty", "year", "redeemno", "request_ts"]


def clean_requests(requests: DataFrame) -> DataFrame:
    """The requests with blank-padded keys trimmed (``=`` ignores trailing blanks), identical deliveries once."""
    keys = [F.rtrim(F.col(c)).alias(c) for c in ("outlet_id", "giftcode")]
    return requests.select(*keys, "qty", F.col("year").cast("int").alias("year"), F.rtrim(F.col("redeemno")).alias("redeemno"),
                           "request_ts").distinct()


def _in_cooldown(calls: DataFrame, redeem_log: DataFrame, minutes: int, source: DataFrame) -> DataFrame:
    """(user, moment) of calls with a log row in the ``minutes`` before them.

    The newest log row up to the call is that young exactly if any is, so the join looks at the
    days that the interval touches, with (user, day) as its key, instead of all log rows of the user.
    """
    since = F.col("request_ts") - F.make_dt_interval(mins=F.lit(minutes))
    days = F.array_distinct(F.array(F.to_date(since), F.to_date("request_ts")))
    asked = calls.filter(F.col("user_id").isNotNull()).select(
        F.col("user_id").alias("c_user"), F.col("request_ts").alias("c_ts"), since.alias("c_since"),
        F.explode(days).alias("c_day")).distinct()
    logs = redeem_log.select(F.col("user_id").alias("l_user"), "created_date")
    asked = bounded_broadcast(asked, source=source)
    hit = asked.join(logs, (asked.c_user == logs.l_user) & (asked.c_day == F.to_date(logs.created_date))
                     & (logs.created_date >= asked.c_since) & (logs.created_date <= asked.c_ts), "inner")
    return hit.select("c_user", "c_ts").distinct()


def redemption_gate(
    requests: DataFrame,
    ledger: DataFrame | None,
    stored_balance: DataFrame | None,
    items: DataFrame,
    users: DataFrame,
    participants: DataFrame,
    redeem_log: DataFrame,
    p: RedeemParams = RedeemParams(),
    balances: DataFrame | None = None,
    decided: DataFrame | None = None,
    stored_items: DataFrame | None = None,
) -> DataFrame:
    """One row per request with the two checks and the decision.

    ``ledger`` is :func:`points.point_ledger`; the balance is rounded to whole
    points before the check (T15) and compared with ONE unit of the gift
    unless ``p.check == "total"`` (T14); a gift without a price passes (T16).
    An accepted request takes qty units off the balance that the next one of
    the outlet and year meets; balances of years outside the ledger are stored
    ones and stay (T20). ``balances`` (outlet_id, year, total_point), when given,
    replaces the balance computed from ``ledger`` and ``stored_balance``.
    ``decided`` (redeemno): requests of earlier batches. ``stored_items``: the catalogue whose
    price an accepted request stores, where it is not the one it is checked against (T24).
    """
    req = clean_requests(requests)
    same = Window.partitionBy("redeemno", F.when(F.col("redeemno").isNull(), F.xxhash64(*REQUEST))).orderBy(
        "request_ts", "outlet_id", "giftcode", "qty", "year")
    req = req.withColumn("again", F.row_number().over(same) > 1)
    if decided is not None:
        old = bounded_broadcast(decided.select(F.col("redeemno").alias("o_redeemno"), F.lit(True).alias("was")).distinct())
        req = req.join(old, req.redeemno == old.o_redeemno, "left").withColumn(
            "again", F.col("again") | F.coalesce("was", F.lit(False))).drop("o_redeemno", "was")

    people = users.groupBy(F.col("outlet_id").alias("u_outlet")).agg(
        F.count(F.lit(1)).alias("n_users"), F.max("user_id").alias("user_id"))
    extra = participants.groupBy(F.col("KODE_OUTLET").alias("m_outlet")).agg(F.count(F.lit(1)).alias("n_part"))
    gifts = bounded_broadcast(items.groupBy(F.col("redeem_code").alias("i_code")).agg(
        F.count(F.lit(1)).alias("n_items"), F.max("point").alias("point")), source=items)

    price = F.col("point")
    if stored_items is not None:
        prices = bounded_broadcast(stored_items.groupBy(F.col("redeem_code").alias("s_code")).agg(
            F.max("point").alias("s_point")), source=stored_items)
        price = F.col("s_point")

    if balances is None:
        balances = point_balance(req.select("outlet_id", "year").distinct(), ledger, stored_balance, p.points,
                                 pairs_source=requests)
    bal = balances.select(F.col("outlet_id").alias("b_outlet"), F.col("year").alias("b_year"), "total_point")

    j = req.join(people, req.outlet_id == people.u_outlet, "left")
    recent = _in_cooldown(j, redeem_log, p.cooldown_minutes, requests)
    j = j.join(extra, j.outlet_id == extra.m_outlet, "left")
    j = j.join(gifts, j.giftcode == gifts.i_code, "left")
    if stored_items is not None:
        j = j.join(prices, j.giftcode == prices.s_code, "left")
    j = j.join(bal, (j.outlet_id == bal.b_outlet) & (j.year == bal.b_year), "left")
    j = j.join(recent, (j.user_id == recent.c_user) & (j.request_ts == recent.c_ts), "left")

    cek_status = F.when(F.col("c_ts").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    info_rows = F.col("n_users") * F.greatest(F.coalesce(F.col("n_part"), F.lit(0)), F.lit(1))
    barred = (
        F.when(F.col("again"), F.lit("duplicate_request"))
        .when(F.col("n_users").isNull(), F.lit("unknown_outlet"))
        .when(info_rows > 1, F.lit("ambiguous_user"))
        .when(F.col("n_items").isNull(), F.lit("unknown_gift"))
        .when(F.col("n_items") > 1, F.lit("ambiguous_gift"))
        .when(cek_status == 1, F.lit("cooldown"))
    )
    charge = F.col("point") * F.col("qty") if p.check == "total" else F.col("point")
    counts = F.coalesce(F.col("year").isin(*p.points.ledger_years), F.lit(False))
    calls = balances_before(j.select(
        *REQUEST, "user_id", F.coalesce("total_point", F.lit(0)).alias("balance"), charge.cast("decimal(28,4)").alias("charge"),
        F.when(counts, F.coalesce((F.col("qty") * price).cast(POINTS4), F.lit(0))).otherwise(F.lit(0)).cast(POINTS4).alias("effect"),
        cek_status.alias("cek_status"), barred.alias("barred"), barred.isNull().alias("eligible")), source=requests)

    balance_n = numeric(F.col("balance_before"))
    remaining = balance_n - F.col("charge")
    cek_poin = F.when(remaining < 0, F.lit(1)).otherwise(F.lit(0))
    reason = F.coalesce("barred", F.when(cek_poin == 1, F.lit("insufficient_points")))
    return calls.select(
        *REQUEST, "user_id",
        balance_n.alias("total_point"),
        remaining.cast("decimal(20,4)").alias("berapa"),
        cek_poin.alias("cek_poin"),
        "cek_status",
        reason.isNull().alias("accepted"),
        reason.alias("reject_reason"),
    )


def _accepted_with_item(gate: DataFrame, items: DataFrame, cols: list[str]) -> DataFrame:
    ok = gate.filter(F.col("accepted"))
    gifts = bounded_broadcast(items.select(F.col("redeem_code").alias("i_code"), *cols), source=items)
    return ok.join(gifts, ok.giftcode == gifts.i_code, "left")


def redemption_rows(gate: DataFrame, items: DataFrame, p: RedeemParams = RedeemParams()) -> DataFrame:
    """The point_redeem rows of the accepted requests (append sink)."""
    j = _accepted_with_item(gate, items, ["point"])
    pts = (F.col("qty") * F.col("point")).cast(POINTS4)
    none_ts = F.lit(None).cast("timestamp_ntz")
    none_s = F.lit(None).cast("string")
    return j.select(
        F.col("redeemno").alias("redeem_no"),
        F.col("request_ts").alias("redeem_date"),
        "user_id",
        pts.alias("point_redeem"),
        F.col("giftcode").alias("gift_code"),
        (pts * F.lit(p.point_value)).cast("decimal(22,4)").alias("amount"),
        F.lit(texts.DELIVERY_IN_PROCESS).alias("status_delivery"),
        none_ts.alias("delivery_date"),
        none_ts.alias("return_date"),
        F.lit(None).cast(POINTS4).alias("minimum_point"),
        none_s.alias("no_voucher"),
        none_s.alias("trxNo"),
        F.col("year").alias("point_year"),
        none_ts.alias("received_date"),
        none_s.alias("url_image"),
        none_s.alias("note"),
        none_s.alias("email_user"),
        none_s.alias("is_directgift"),
    )


def redemption_detail_rows(gate: DataFrame, addresses: DataFrame, users: DataFrame,
                           p: RedeemParams = RedeemParams()) -> DataFrame:
    """The point_redeem_detail rows; a missing address leaves NULLs."""
    ok = gate.filter(F.col("accepted")).select("redeemno", "outlet_id")
    addr = latest_address(addresses, DELIVERY_ADDRESS, trim_key=True).select(
        F.col("outlet_id").alias("a_outlet"), *DELIVERY_ADDRESS)
    phone = users.select(F.col("outlet_id").alias("u_outlet"), F.rtrim(F.col("no_hp")).alias("no_telp"))
    j = ok.join(addr, ok.outlet_id == addr.a_outlet, "left").join(phone, ok.outlet_id == phone.u_outlet, "left")
    none_s = F.lit(None).cast("string")
    return j.select(
        F.col("redeemno").alias("redeem_no"),
        "outlet_id",
        F.lit(p.redeem_type).cast("string").alias("redeem_type"),
        *DELIVERY_ADDRESS,
        "no_telp",
        none_s.alias("foto_ktp"),
        none_s.alias("foto_kk"),
    )


def redemption_notifications(gate: DataFrame, items: DataFrame) -> DataFrame:
    """The notification rows; the gift category compares type_code as a
    number (T17)."""
    j = _accepted_with_item(gate, items, ["type_code", "vendor_code", "gift_name"])
    code = F.col("type_code").try_cast("int")
    category = F.lit(texts.GIFT_CATEGORY_DEFAULT)
    for value, name in reversed(texts.GIFT_CATEGORY_BY_TYPE):
        category = F.when(code == F.lit(value), F.lit(name)).otherwise(category)
    detail = F.when(
        F.col("vendor_code") == F.lit(texts.VENDOR_WITH_GIFT_NAME),
        F.concat(F.lit(texts.NOTE_GIFT_1), F.rtrim(F.col("gift_name")), F.lit(texts.NOTE_GIFT_2),
                 F.col("redeemno"), F.lit(texts.NOTE_GIFT_3)),
    ).otherwise(F.concat(F.lit(texts.NOTE_PLAIN_1), F.col("redeemno"), F.lit(texts.NOTE_PLAIN_2)))
    none_s = F.lit(None).cast("string")
    return j.select(
        "outlet_id",
        F.concat(F.lit(texts.NOTIFICATION_PREFIX), category).alias("notification_title"),
        detail.alias("notification_detail"),
        F.col("request_ts").alias("notification_date"),
        none_s.alias("area"),
        none_s.alias("status"),
    )
