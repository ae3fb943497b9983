"""Stand-in rewards tables derived from the driver's TPC-H-style test data.

Each table is one SQL text over the test tables (``{name}`` marks a table
reference). The same text runs in Spark (``spark.sql`` with DataFrame
arguments) and in DuckDB (as a CTE of the oracle query), so both engines see
identical inputs. Mapping rules are documented in FIXTURES.md; every rule is a
function of the data, nothing is generated from thin air.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable


BASE_TABLES = ("region", "nation", "supplier", "part", "orders", "lineitem", "events")

STANDIN_REDEEM_TYPE = "gift"

_SQL: dict[str, str] = {}


def _table(name: str, sql: str) -> None:
    _SQL[name] = sql.strip()


# outlet = supplier (dense at every scale)
_table("so_outlets", """
SELECT s.s_suppkey AS sk,
       CASE WHEN s.s_suppkey % 20 = 0 THEN 'R-' WHEN s.s_suppkey % 20 = 1 THEN '888' ELSE 'T0' END
         || lpad(CAST(s.s_suppkey AS STRING), 7, '0') AS outlet_id,
       s.s_name AS outlet_name,
       CASE WHEN r.r_name = 'ASIA' THEN 'ASIA LMT' ELSE r.r_name END AS region,
       CASE WHEN n.n_name = 'NATION_3' THEN 'BUH BALI'
            WHEN n.n_name = 'NATION_5' THEN 'NATION_5 KAM' ELSE n.n_name END AS area,
       'ACT' || CAST(n.n_regionkey AS STRING) AS activity_id,
       'D' || CAST(s.s_nationkey AS STRING) AS dist_code,
       'DIST ' || n.n_name AS dist_name,
       CAST(s.s_suppkey % 4 AS STRING) AS cluster,
       CAST(s.s_acctbal AS DECIMAL(18,2)) AS acctbal
FROM {supplier} s
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
""")

# invoice line = lineitem; invoice = (order, supplier)
_table("so_lines", """
SELECT o.outlet_id, o.activity_id, o.sk,
       'INV' || CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_suppkey AS STRING) AS invoice_no,
       'S' || CAST(l.l_partkey % 20 AS STRING) AS item_code,
       CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) * 1000 AS DECIMAL(18,2)) AS price,
       CAST(l.l_quantity AS INT) AS quantity,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 1000 AS DECIMAL(18,2)) AS total,
       CASE WHEN l.l_orderkey % 2 = 0 THEN od.o_orderdate + INTERVAL '10' HOUR
            ELSE od.o_orderdate END AS invoice_date,
       l.l_orderkey AS orderkey
FROM {lineitem} l
JOIN {orders} od ON l.l_orderkey = od.o_orderkey
JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {so_outlets} o ON l.l_suppkey = o.sk
""")

_table("invoice_detail_activity", """
SELECT outlet_id, invoice_no, item_code, price, quantity, total, invoice_date FROM {so_lines}
""")

_table("invoice_detail", """
SELECT outlet_id, invoice_no, item_code, price, quantity, total, invoice_date FROM {so_lines}
""")

_table("invoice_master", """
SELECT invoice_no,
       MAX(outlet_id) AS outlet_id,
       MAX(invoice_date) AS invoice_date,
       MAX(invoice_date) + INTERVAL '1' DAY AS upload_date,
       CAST(SUM(total) AS DECIMAL(18,2)) AS invoice_amount,
       CAST(SUM(total) AS DECIMAL(18,2)) AS payment_amount,
       CASE WHEN orderkey % 17 = 0 THEN NULL WHEN orderkey % 5 = 0 THEN 'P' ELSE 'I' END AS invoice_type,
       CASE WHEN orderkey % 50 = 0 THEN '0' WHEN orderkey % 50 = 1 THEN '1' ELSE 'S' END AS sales_id,
       CASE WHEN orderkey % 50 IN (0, 1) THEN MAX(activity_id) END AS document_ID,
       CAST(orderkey % 97 AS DECIMAL(18,4)) AS expected_invoice_reward,
       CAST(CAST(orderkey % 1200 AS DECIMAL(18,4)) * 0.25 AS DECIMAL(18,4)) AS expected_invoice_addt_reward,
       CASE WHEN orderkey % 3 = 0 THEN NULL
            ELSE CAST(orderkey % 11 AS DECIMAL(18,4)) END AS expected_invoice_npd_reward
FROM {so_lines}
GROUP BY invoice_no, orderkey
""")

_table("invoice_master", _SQL["invoice_master"] + """
UNION ALL
SELECT * FROM (""" + _SQL["invoice_master"] + """) dup WHERE dup.sales_id = '0' AND dup.invoice_no LIKE '%00-%'
""")

_table("master_products_basepack_new", """
SELECT DISTINCT 'S' || CAST(p_partkey % 20 AS STRING) AS sku_code,
       'BP' || CAST(p_partkey % 20 % 6 AS STRING) AS basepack
FROM {part} WHERE p_partkey % 20 <> 19
""")

_table("master_products", """
SELECT DISTINCT 'S' || CAST(p_partkey % 20 AS STRING) AS sku_code,
       'Produk ' || CAST(p_partkey % 20 AS STRING) AS product_description
FROM {part} WHERE p_partkey % 20 < 18
""")

_table("activities", """
SELECT 'ACT' || CAST(r_regionkey AS STRING) AS activity_id,
       'C' || CAST(r_regionkey % 2 AS STRING) AS category_id,
       CASE WHEN r_regionkey = 4 THEN '1' ELSE '2' END AS mechanism_id,
       CASE WHEN r_regionkey = 3 THEN '99' ELSE '14' END AS status_activities,
       DATE '1999-07-01' AS periode_start,
       DATE '1999-09-30' AS periode_end
FROM {region}
UNION ALL
SELECT 'ACT1', 'C1', '2', '14', DATE '1999-07-01', DATE '1999-09-30' FROM {region} WHERE r_regionkey = 1
""")

_table("activities_regular", """
SELECT 'ACT' || CAST(r_regionkey AS STRING) AS activity_id,
       CAST(r_regionkey % 3 AS STRING) AS status_id,
       CASE WHEN r_regionkey % 2 = 0 THEN 'APPROVED' ELSE 'PENDING' END AS status_approval
FROM {region}
UNION ALL
SELECT 'ACT' || CAST(r_regionkey AS STRING), CAST(r_regionkey % 3 AS STRING), 'APPROVED'
FROM {region} WHERE r_regionkey = 2
""")

_table("ref_categories", """
SELECT 'C' || CAST(r_regionkey AS STRING) AS category_id,
       CASE WHEN r_regionkey = 0 THEN 'FOODS' ELSE 'HOME CARE' END AS category_name
FROM {region} WHERE r_regionkey < 2
""")

_table("temp_act_outlet_list", """
SELECT activity_id, outlet_id AS Outlet_id, outlet_name AS Outlet_Name, region AS Region, area AS Area,
       dist_code AS Dist_Code, dist_name AS Dist_Name,
       CAST((200 + sk % 5 * 100) * 1000000 AS DECIMAL(18,2)) AS Target_Toko,
       CAST(100 + sk % 4 * 50 AS DECIMAL(18,2)) AS Simulasi_Point,
       CAST(CAST(sk % 7 AS DECIMAL(18,2)) * 0.75 + 1 AS DECIMAL(18,2)) AS VRR,
       CAST(CAST(sk % 4 AS DECIMAL(18,2)) * 0.5 AS DECIMAL(18,2)) AS VRR_Addt
FROM {so_outlets}
UNION ALL
SELECT activity_id, outlet_id, outlet_name, region, area, dist_code, dist_name,
       CAST((200 + sk % 5 * 100) * 1000000 AS DECIMAL(18,2)), CAST(100 + sk % 4 * 50 AS DECIMAL(18,2)),
       CAST(CAST(sk % 7 AS DECIMAL(18,2)) * 0.75 + 1 AS DECIMAL(18,2)),
       CAST(CAST(sk % 4 AS DECIMAL(18,2)) * 0.5 AS DECIMAL(18,2))
FROM {so_outlets} WHERE sk % 21 = 2
""")

_table("temp_act_outlet_list_eco", """
SELECT activity_id, outlet_id AS Outlet_id, 'Q3' AS quarter, '1999' AS year,
       CAST(1 + (sk + 1) % 3 AS INT) AS target_1, CAST(1 + (sk + 2) % 3 AS INT) AS target_2,
       CAST(1 + (sk + 3) % 3 AS INT) AS target_3, CAST(sk % 3 AS DECIMAL(18,2)) AS vrr
FROM {so_outlets}
UNION ALL
SELECT activity_id, outlet_id, 'Q2', '1999', CAST(1 AS INT), CAST(1 AS INT), CAST(1 AS INT),
       CAST(0 AS DECIMAL(18,2))
FROM {so_outlets} WHERE sk % 6 = 0
UNION ALL
SELECT activity_id, outlet_id, 'Q3', '1999',
       CAST(1 + (sk + 1) % 3 AS INT), CAST(1 + (sk + 2) % 3 AS INT), CAST(1 + (sk + 3) % 3 AS INT),
       CAST(sk % 3 AS DECIMAL(18,2))
FROM {so_outlets} WHERE sk % 8 = 0
UNION ALL
SELECT activity_id, outlet_id, 'Q3', '1999',
       CAST(1 + (sk + 1) % 3 AS INT), CAST(1 + (sk + 2) % 3 AS INT), CAST(1 + (sk + 3) % 3 AS INT),
       CAST(9 AS DECIMAL(18,2))
FROM {so_outlets} WHERE sk % 12 = 5
""")

_table("act_sku_eco", """
SELECT DISTINCT 'ACT' || CAST(p_partkey % 5 AS STRING) AS activity_id,
       'S' || CAST(p_partkey % 20 AS STRING) AS sku_code,
       CAST(CASE WHEN p_partkey % 2 = 0 THEN 20 ELSE 600 END AS INT) AS ispcs
FROM {part}
UNION ALL
SELECT 'ACT3', 'S3', CAST(600 AS INT) FROM {region} WHERE r_regionkey = 0
""")

_table("live_mechanism_list", """
SELECT activity_id, outlet_id AS outlet_code, CAST(acctbal * 100000 AS DECIMAL(18,2)) AS rpp_capai
FROM {so_outlets} WHERE sk % 7 <> 0
""")

_table("outlet_basepack_target_master", """
SELECT activity_id, outlet_id, cluster, CAST(sk % 3 AS STRING) AS status_id,
       CAST(6 AS INT) AS total_basepack, CAST(2 + sk % 4 AS INT) AS target,
       CAST(300 AS DECIMAL(18,0)) AS point_min, CAST(1500 AS DECIMAL(18,0)) AS point_max,
       DATE '1999-07-01' AS periode_start, DATE '1999-09-30' AS periode_end
FROM {so_outlets}
UNION ALL
SELECT activity_id, outlet_id, cluster, CAST(sk % 3 AS STRING), CAST(6 AS INT), CAST(2 + sk % 4 AS INT),
       CAST(300 AS DECIMAL(18,0)), CAST(1500 AS DECIMAL(18,0)), DATE '1999-07-01', DATE '1999-09-30'
FROM {so_outlets} WHERE sk % 19 = 4
""")

_table("outlet_basepack_target_detail", """
SELECT d.activity_id, d.outlet_id, d.dist_code, d.basepack AS basepack_title,
       CASE WHEN d.sk % 7 = 0 AND d.basepack = 'BP1' THEN 'N' ELSE 'Y' END AS status,
       CASE WHEN d.sk % 11 = 0 THEN '3' ELSE '1' END AS status_id,
       CAST(60 + d.sk % 3 * 40 AS INT) AS target,
       DATE '1999-07-01' AS periode_start, DATE '1999-09-30' AS periode_end
FROM (SELECT DISTINCT o.activity_id, o.outlet_id, o.dist_code, o.sk, b.basepack
      FROM {so_lines} l
      JOIN {master_products_basepack_new} b ON l.item_code = b.sku_code
      JOIN {so_outlets} o ON l.outlet_id = o.outlet_id) d
UNION ALL
SELECT o.activity_id, o.outlet_id, o.dist_code, 'BP2', 'Y', '1', CAST(60 + o.sk % 3 * 40 AS INT),
       DATE '1999-07-01', DATE '1999-09-30'
FROM {so_outlets} o WHERE o.sk % 23 = 6
""")

_table("target_growth", """
SELECT activity_id, outlet_id AS Outlet_id, outlet_name, dist_code AS Dist_Code, cluster AS Cluster,
       'Target Growth Q3' AS Bar_Title_Target,
       CAST((800 + sk % 10 * 100) * 1000000 AS DECIMAL(18,2)) AS Target_toko,
       CAST(300 AS DECIMAL(18,0)) AS POINT_didapat,
       CASE WHEN sk % 25 = 7 THEN NULL ELSE CAST(1500 AS DECIMAL(18,0)) END AS POINT_max,
       DATE '1999-07-01' AS periode_start, DATE '1999-09-30' AS periode_end
FROM {so_outlets}
UNION ALL
SELECT activity_id, outlet_id, outlet_name, dist_code, cluster, 'Target Growth Q4',
       CAST((800 + sk % 10 * 100) * 1000000 AS DECIMAL(18,2)),
       CAST(300 AS DECIMAL(18,0)), CAST(1500 AS DECIMAL(18,0)),
       DATE '1999-10-01', DATE '1999-12-31'
FROM {so_outlets} WHERE sk % 10 = 3
""")

# master data keyed by outlet; KODE TOKO / KODE DIS are spelled KODE_TOKO / KODE_DIS
_table("temp_master_data_uli", """
SELECT region AS REGION, area AS AREA, outlet_id AS KODE_TOKO,
       CASE WHEN sk % 17 = 0 THEN NULL WHEN sk % 13 = 0 THEN '99999999' ELSE dist_code END AS KODE_DIS,
       CASE WHEN sk % 10 = 4 THEN 'FREEZE' ELSE 'ACTIVE' END AS Remark_freeze
FROM {so_outlets}
UNION ALL
SELECT region, area, outlet_id, dist_code, 'MOVED' FROM {so_outlets} WHERE sk % 15 = 0
""")

_table("summary_outlet", """
SELECT region AS REGION, area AS AREA, dist_code AS KODE_DISTRIBUTOR, outlet_id AS KODE_OUTLET
FROM {so_outlets} WHERE sk % 9 <> 0
""")

_table("outlet_monthly_mapping", """
SELECT outlet_id AS outlet_code, dist_code AS dt_code_latest FROM {so_outlets}
UNION ALL
SELECT outlet_id, 'DX' || CAST(sk AS STRING) FROM {so_outlets} WHERE sk % 23 = 0
""")

_table("user_info", """
SELECT CAST(sk AS STRING) AS user_id, outlet_id, outlet_name AS store_name,
       'user' || CAST(sk AS STRING) || '@mail.test  ' AS user_email,
       '0812' || lpad(CAST(sk AS STRING), 7, '0') || ' ' AS no_hp,
       TIMESTAMP '2020-01-01 08:30:00' AS date_created
FROM {so_outlets}
UNION ALL
SELECT 'U2-' || CAST(sk AS STRING), outlet_id, outlet_name, CAST(NULL AS STRING), CAST(NULL AS STRING),
       TIMESTAMP '2021-06-01 00:00:00'
FROM {so_outlets} WHERE sk % 31 = 5
""")

_table("master_peserta", """
SELECT outlet_id AS KODE_OUTLET, CASE WHEN sk % 2 = 0 THEN 'RETAIL' ELSE 'GROSIR' END AS jenis
FROM {so_outlets}
UNION ALL
SELECT outlet_id, 'RETAIL' FROM {so_outlets} WHERE sk % 29 = 3
""")

_table("alamat_pengiriman", """
SELECT CAST(sk * 2 AS INT) AS id, outlet_id, 'Penerima ' || CAST(sk AS STRING) AS nama_penerima,
       'Jalan Lama ' || CAST(sk AS STRING) AS nama_jalan, CAST(sk % 90 + 1 AS STRING) AS no_rumah,
       'Kel ' || CAST(sk % 13 AS STRING) AS kelurahan, 'Kec ' || CAST(sk % 7 AS STRING) AS kecamatan,
       region AS provinsi, area AS kota, lpad(CAST(sk % 99999 AS STRING), 5, '0') AS kode_pos,
       'lok ' || CAST(sk AS STRING) AS lokasi, 'old' AS alamat_detail,
       'img/' || CAST(sk AS STRING) AS image_lokasi, 'map/' || CAST(sk AS STRING) AS url
FROM {so_outlets} WHERE sk % 19 <> 0
UNION ALL
SELECT CAST(sk * 2 + 1 AS INT), outlet_id, 'Penerima Baru ' || CAST(sk AS STRING),
       'Jalan Baru ' || CAST(sk AS STRING), CAST(sk % 70 + 2 AS STRING),
       'Kel ' || CAST(sk % 11 AS STRING), 'Kec ' || CAST(sk % 5 AS STRING),
       region, area, lpad(CAST(sk % 88888 AS STRING), 5, '0'),
       'lok ' || CAST(sk AS STRING), 'new', 'img/' || CAST(sk AS STRING), 'map/' || CAST(sk AS STRING)
FROM {so_outlets} WHERE sk % 19 <> 0
""")

# redemptions = events; channel event_id % 4: 0 catalogue/OVO, 1 cashback, 2 PPOB, 3 e-wallet
# every event belongs to an outlet: users beyond the outlets are dealt over all of them
_table("so_events", """
SELECT event_id, ts, value,
       CASE WHEN user_id IN (SELECT s_suppkey FROM {supplier}) THEN user_id
            ELSE (SELECT MIN(s_suppkey) FROM {supplier}) + user_id % (SELECT COUNT(*) FROM {supplier}) END AS user_id
FROM {events}
""")

_table("point_redeem", """
SELECT 'RD' || CAST(event_id AS STRING) AS redeem_no, ts AS redeem_date,
       CAST(user_id AS STRING) AS user_id,
       CASE WHEN event_id % 45 >= 40 THEN 'X' ELSE 'G' END || CAST(1 + event_id % (SELECT MAX(p_partkey) FROM {part}) AS STRING) AS gift_code,
       CAST(FLOOR(value) AS DECIMAL(18,4)) AS point_redeem,
       CAST(CAST(FLOOR(value) AS DECIMAL(18,4)) * 4000 AS DECIMAL(22,4)) AS amount,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'Failed'
            ELSE 'DIPROSES' END AS status_delivery,
       CAST(1995 + event_id % 7 AS INT) AS point_year,
       event_id
FROM {so_events}
""")

_table("point_redeem_detail", """
SELECT p.redeem_no, o.outlet_id, '<type>' AS redeem_type
FROM {point_redeem} p JOIN {so_outlets} o ON p.user_id = CAST(o.sk AS STRING)
WHERE p.event_id % 4 = 0
UNION ALL
SELECT p.redeem_no, o.outlet_id, '<type>'
FROM {point_redeem} p JOIN {so_outlets} o ON p.user_id = CAST(o.sk AS STRING)
WHERE p.event_id % 4 = 0 AND p.event_id % 29 = 0
""".replace("<type>", STANDIN_REDEEM_TYPE))

_table("point_redeem_detail_cashback", """
SELECT p.redeem_no, o.outlet_id
FROM {point_redeem} p JOIN {so_outlets} o ON p.user_id = CAST(o.sk AS STRING)
WHERE p.event_id % 4 = 1
""")

_table("ppob_transaction_master", """
SELECT p.redeem_no, o.outlet_id
FROM {point_redeem} p JOIN {so_outlets} o ON p.user_id = CAST(o.sk AS STRING)
WHERE p.event_id % 4 = 2
""")

_table("ewallet_transaction_master", """
SELECT p.redeem_no, o.outlet_id
FROM {point_redeem} p JOIN {so_outlets} o ON p.user_id = CAST(o.sk AS STRING)
WHERE p.event_id % 4 = 3
""")

_table("redeem_item", """
SELECT 'G' || CAST(p_partkey AS STRING) AS redeem_code,
       CASE p_partkey % 5 WHEN 0 THEN '08' WHEN 1 THEN '04' WHEN 2 THEN '12' WHEN 3 THEN '01' END AS type_code,
       CASE WHEN p_partkey % 2 = 0 THEN 'V03' ELSE 'V01' END AS vendor_code,
       p_name || '  ' AS gift_name,
       CASE WHEN p_partkey % 60 = 39 THEN NULL
            WHEN p_partkey % 7 = 6 THEN CAST(100000 AS DECIMAL(18,4))
            ELSE CAST(50 + p_partkey % 60 * 25 AS DECIMAL(18,4)) END AS point
FROM {part}
UNION ALL
SELECT 'G' || CAST(p_partkey AS STRING), '01', 'V01', p_name, CAST(50 + p_partkey % 60 * 25 AS DECIMAL(18,4))
FROM {part} WHERE p_partkey % 37 = 13
""")

_table("new_point_balance", """
SELECT outlet_id, CAST(acctbal AS DECIMAL(18,4)) AS remain_point FROM {so_outlets} WHERE sk % 3 <> 0
""")

_table("log_validasi_redeem", """
SELECT CAST(user_id AS STRING) AS user_id, CASE WHEN event_id % 45 >= 40 THEN 'X' ELSE 'G' END || CAST(1 + event_id % (SELECT MAX(p_partkey) FROM {part}) AS STRING) AS redeem_code,
       ts AS created_date
FROM {so_events}
""")

# redemption requests: one per outlet (some unknown outlets), a second one for some
_table("requests", """
SELECT CASE WHEN o.sk % 25 = 3 THEN 'X' || o.outlet_id ELSE o.outlet_id END AS outlet_id,
       'G' || CAST(CASE WHEN o.sk % 45 IN (0, 11, 22, 34) THEN -1 ELSE 1 + o.sk * 131 % (SELECT MAX(p_partkey) FROM {part}) END AS STRING) AS giftcode,
       CAST(1 + o.sk % 3 AS INT) AS qty,
       CAST(CASE WHEN o.sk % 9 = 2 THEN 2030 ELSE 1995 + o.sk % 7 END AS INT) AS year,
       'RQ' || CAST(o.sk AS STRING) AS redeemno,
       CASE WHEN o.sk % 4 = 0 AND e.last_ts IS NOT NULL THEN e.last_ts + INTERVAL '1' MINUTE
            ELSE TIMESTAMP '2024-02-01 09:00:00' END AS request_ts
FROM {so_outlets} o
LEFT JOIN (SELECT user_id, MAX(ts) AS last_ts FROM {so_events} GROUP BY user_id) e ON o.sk = e.user_id
UNION ALL
SELECT o.outlet_id, 'G' || CAST(1 + (o.sk * 77 + 7) % (SELECT MAX(p_partkey) FROM {part}) AS STRING), CAST(1 AS INT),
       CAST(1995 + o.sk % 7 AS INT), 'RQ' || CAST(o.sk AS STRING) || '-2',
       TIMESTAMP '2024-02-01 09:05:00'
FROM {so_outlets} o WHERE o.sk % 10 = 7
UNION ALL
SELECT o.outlet_id, 'G' || CAST(1 + (o.sk * 53 + n.n * 35) % (SELECT MAX(p_partkey) FROM {part}) AS STRING), CAST(1 + (o.sk + n.n) % 3 AS INT),
       CAST(1995 + o.sk % 7 AS INT), 'RM' || CAST(o.sk AS STRING) || '-' || CAST(n.n AS STRING),
       TIMESTAMP '2024-02-01 09:30:00' + CAST(FLOOR(n.n / 2) AS INT) * INTERVAL '25' MINUTE
FROM {so_outlets} o JOIN (SELECT r_regionkey + 5 * k AS n FROM {region}, (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) z) n
  ON n.n < 4 + o.sk % 11
WHERE o.sk % 3 = 1
UNION ALL
SELECT o.outlet_id, 'G' || CAST(1 + (o.sk * 53) % (SELECT MAX(p_partkey) FROM {part}) AS STRING), CAST(1 + o.sk % 3 AS INT),
       CAST(1995 + o.sk % 7 AS INT), 'RM' || CAST(o.sk AS STRING) || CASE WHEN o.sk % 2 = 0 THEN '-0' ELSE '-1' END,
       TIMESTAMP '2024-02-01 09:30:00'
FROM {so_outlets} o WHERE o.sk % 12 IN (4, 7)
""")

# tables a user of the library supplies (everything but the so_* helpers)
STANDIN_TABLES = tuple(n for n in _SQL if not n.startswith("so_"))
# columns of the invoice lines and nothing else
LINE_TABLES = ("invoice_detail_activity", "invoice_detail")

# ---------------------------------------------------------------------------
# parameters that fit the stand-in dates (orders span 1995-2001, events 2024-01)
# ---------------------------------------------------------------------------
STANDIN_YEAR = 1999
STANDIN_QUARTER = "Q3"
STANDIN_FROM = dt.date(1999, 1, 1)
STANDIN_LEDGER_YEARS = tuple(range(1995, 2002))
STANDIN_AS_OF = dt.datetime(2024, 2, 1, 9, 0, 0)
STANDIN_VIEW_AS_OF = dt.datetime(1999, 8, 2, 9, 0, 0)   # a day with invoices ('Hari ini')

_REF = re.compile(r"\{(\w+)\}")


def sql_text(name: str) -> str:
    return _SQL[name]


def dependencies(name: str) -> list[str]:
    return sorted(set(_REF.findall(_SQL[name])))


def closure(names: Iterable[str]) -> list[str]:
    """Stand-in tables needed by ``names``, dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in order:
            return
        for d in dependencies(n):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def cte_prefix(names: Iterable[str]) -> str:
    """``WITH a AS (...), b AS (...)`` for DuckDB (base tables are views there)."""
    parts = []
    for n in closure(names):
        body = _REF.sub(lambda m: m.group(1), _SQL[n])
        parts.append(f"{n} AS (\n{body}\n)")
    return "WITH " + ",\n".join(parts) + "\n"
