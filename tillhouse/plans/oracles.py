"""SQL each registered query is checked against, written over the given tables by themselves.

Shared parts are named common table expressions; `_sql` puts the ones a query needs in front of it.
"""

from __future__ import annotations

import re

from tillhouse.functions.contracts import PRODUCT_FACT, SERVICE_FACT

MONEY = "decimal(18,6)"


def _total(expression: str) -> str:
    return f"CAST(sum(CAST({expression} AS {MONEY})) AS DOUBLE)"


def _label(code: str, labels: dict[str, str], otherwise: str = "''") -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"CASE CAST({code} AS VARCHAR) {whens} ELSE {otherwise} END"


def _gender(c): return _label(c, {"1": "Male", "2": "Female"})
def _age(c, other="''"): return _label(c, {"2": "Student", "3": "Middle", "5": "Foreigner"}, other)
def _nation(c): return _label(c, {"0": "Vietnamese", "1": "Asian", "2": "US_UK", "3": "Other"})
def _pay(c): return _label(c, {"0": "cash", "1": "card", "2": "voucher", "4": "e-wallet"}, "'unknown'")


def _daypart(h):
    return (f"CASE WHEN {h} BETWEEN 6 AND 10 THEN '1 Morning (06-10)' WHEN {h} BETWEEN 11 AND 13 THEN '2 Lunch (11-13)' "
            f"WHEN {h} BETWEEN 14 AND 16 THEN '3 Afternoon (14-16)' WHEN {h} BETWEEN 17 AND 21 THEN '4 Evening (17-21)' "
            f"ELSE '5 Night (22-05)' END")


_line_order = ("l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
               "l_linestatus, l_shipdate")
TIMES = ("created", "canceled", "driver_booked", "picked", "completed", "store_delivered", "partial_completed")
_times = [f"delivery_{t}_time" for t in TIMES]

CTES: dict[str, str] = {}

CTES["o"] = """SELECT *, o_orderkey AS k, CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS pay, o_orderkey % 4 = 0 AS is_delivery,
    CASE WHEN o_orderkey % 16 = 0 THEN 'SAVYU-' || o_orderkey WHEN o_orderkey % 8 = 0 THEN 'DO-' || o_orderkey END AS delivery_no
    FROM orders"""
CTES["oc"] = """SELECT * FROM o LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"""
CTES["billed"] = "SELECT * FROM oc WHERE NOT (is_delivery AND o_orderstatus = 'O')"
CTES["ln"] = f"""SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_line_order}) AS rn,
    count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""
CTES["lr"] = f"""SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_line_order}) AS rn,
    count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    WHERE l_returnflag = 'R'"""


def _tender(sign, codes):
    return f"{sign}coalesce(CASE WHEN pay IN ({codes}) THEN o_totalprice END, 0)"


def _lines(src, lines, join, is_return):
    sign = "-" if is_return else ""
    t = "o_orderdate + INTERVAL 3 DAY + INTERVAL 7 HOUR" if is_return else "o_orderdate + INTERVAL 7 HOUR"
    null = "CAST(NULL AS {})".format
    own = lambda text: null("VARCHAR") if is_return else text
    win = "l_discount >= 0.05"
    return f"""SELECT '{'R' if is_return else 'T'}' || k AS transaction_id, CAST({t} AS DATE) AS report_date,
    {t} AS sale_bill_time, {t} AS transaction_time, {t} + INTERVAL 1 HOUR AS posting_time,
    {own("'s' || (o_custkey % 50)")} AS staff_id, {own("'Staff ' || (o_custkey % 50)")} AS staff_name,
    CAST(pay AS BIGINT) AS payment_method_id, {own('delivery_no')} AS order_no, CAST(c_nationkey AS VARCHAR) AS store_id,
    n_name AS store_name, 'Type' || (n_regionkey % 2) AS store_type,
    {"'SUP' || (k % 9)" if is_return else null('VARCHAR')} AS supplier_id,
    {"'Supplier ' || (k % 9)" if is_return else null('VARCHAR')} AS supplier_name,
    {null('BIGINT')} AS payment_supplier_id, {null('VARCHAR')} AS payment_supplier_name, {null('TIMESTAMP')} AS synced_sap_time,
    {_tender(sign, '0')} AS cash, {_tender(sign, '2')} AS voucher, {_tender(sign, '1')} AS receivable_amount,
    {_tender(sign, '3, 4')} AS cash_at_bank,
    {_tender(sign, '0')} + {_tender(sign, '1')} + {_tender(sign, '3, 4')} AS bill_amount, {_tender(sign, '2')} AS voucher_amount,
    {"''" if is_return else "CASE k % 3 WHEN 2 THEN 'V' || (k % 7) || '|W' || (k % 5) ELSE '' END"} AS voucher_code_arr,
    {"'T' || k" if is_return else "'Store'"} AS refund_transaction_id, 'completed' AS delivery_status,
    {"''" if is_return else _gender('c_custkey % 3')} AS customer_gender,
    {"''" if is_return else _age('c_custkey % 6')} AS customer_age_range,
    {"''" if is_return else _nation('c_nationkey % 5')} AS customer_nationality,
    '{'Refund' if is_return else 'Sale Transaction'}' AS transaction_type,
    {"'Store'" if is_return else "CASE WHEN delivery_no LIKE 'SAVYU%' THEN 'Savyu' ELSE 'Store' END"} AS channel_name,
    {_pay('pay')} AS payment_method_name, coalesce(n, 1) AS number_of_line_item, coalesce(rn, 1) AS row_num_transaction_id,
    CAST(l_partkey AS VARCHAR) AS product_id, p_name AS product_name, CASE WHEN l_partkey IS NOT NULL THEN 'EA' END AS product_uom,
    CAST(p_size AS BIGINT) AS product_uom_size, l_quantity AS quantity, l_extendedprice AS total_amount,
    l_extendedprice * (1 - l_tax) AS total_amount_no_tax, CAST(substr(p_brand, 7) AS BIGINT) AS product_group_id,
    p_brand AS product_group_name, p_partkey % 12 AS product_sub_category_id, p_type || '/' || (p_partkey % 12) AS product_sub_category_name,
    CAST(length(p_type) AS BIGINT) AS product_category_id, p_type AS product_category_name, p_partkey % 4 AS product_uom_id,
    p_retailprice AS product_price, 'RBT' || (p_size % 3) AS retail_business_type,
    'V' || CAST(round(l_tax * 100) AS INT) AS output_vat_code,
    CASE WHEN {win} THEN l_extendedprice * (1 - l_discount) ELSE l_extendedprice END AS final_amount,
    CASE WHEN {win} THEN l_extendedprice * (1 - l_discount) * (1 - l_tax) ELSE l_extendedprice * (1 - l_tax) END AS final_amount_no_tax
    FROM {src} {join} {lines} ON l_orderkey = k"""


CTES["sale_line"] = (_lines("billed", "ln", "LEFT JOIN", False) + "\nUNION ALL\n" + _lines("billed", "lr", "JOIN", True))

CTES["promos"] = """SELECT k, 'PR' || (k % 7) AS code, 'Promo ' || (k % 7) AS name, 5.25 AS discount, k % 4 AS kind,
    CASE WHEN k % 2 = 0 THEN 'VC' || (k % 13) END AS voucher, CASE WHEN k % 5 = 0 THEN '95010032,1' ELSE '1,2' END AS products
    FROM billed WHERE k % 3 <> 0
    UNION ALL SELECT k, 'PR' || (k % 5), CASE WHEN k % 4 <> 1 THEN 'Promo ' || (k % 5) END, 2.5, 0,
    CASE WHEN k % 6 = 4 THEN 'VD' || (k % 3) END, NULL FROM billed WHERE k % 3 <> 0"""
_voucher = "voucher IS NOT NULL AND (kind = 0 OR coalesce(contains(products, '95010032'), false))"


def _set(value, rule):
    return f"array_to_string(list_sort(list(DISTINCT {value}) FILTER (WHERE {rule} AND {value} IS NOT NULL)), '|')"


CTES["promotion"] = f"""SELECT 'T' || k AS transaction_id, {_set('code', 'name IS NOT NULL')} AS promotion_id_arr,
    {_set('name', 'name IS NOT NULL')} AS promotion_name_arr,
    CAST(sum(CAST(discount AS {MONEY})) FILTER (WHERE {_voucher}) AS DOUBLE) AS total_voucher_amount,
    CASE WHEN count(*) FILTER (WHERE {_voucher}) > 0 THEN coalesce({_set('name', _voucher)}, '') END AS voucher_name_arr,
    CAST(NULL AS VARCHAR) AS promotion_partner_store
    FROM promos GROUP BY k HAVING count(*) FILTER (WHERE name IS NOT NULL) > 0 OR count(*) FILTER (WHERE {_voucher}) > 0"""

CTES["users"] = """SELECT c_custkey AS user_id, '09' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS customer_phone,
    c_name AS user_name, CASE WHEN c_custkey % 4 <> 0 THEN 'C' || c_custkey ELSE '' END AS customer_code FROM customer"""
_status = "CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN 5 WHEN 'click' THEN 6 WHEN 'view' THEN 7 WHEN 'purchase' THEN 8 END"
CTES["status_times"] = f"""SELECT user_id AS order_id, max(ts) FILTER (WHERE {_status} = 1) AS delivery_created_time,
    max(ts) FILTER (WHERE {_status} = 5) AS delivery_canceled_time, max(ts) FILTER (WHERE {_status} = 6) AS delivery_driver_booked_time,
    max(ts) FILTER (WHERE {_status} = 7) AS delivery_picked_time, max(ts) FILTER (WHERE {_status} = 8) AS delivery_completed_time,
    CAST(NULL AS TIMESTAMP) AS delivery_store_delivered_time, CAST(NULL AS TIMESTAMP) AS delivery_partial_completed_time
    FROM events GROUP BY user_id"""
CTES["delivery_orders"] = """SELECT k + shift AS order_id, 'T' || k AS transaction_id,
    coalesce(CASE WHEN k % 12 <> 0 THEN o_custkey END, 0) AS user_id,
    CASE k % 5 WHEN 0 THEN 'GrabFood' WHEN 1 THEN '' END AS external_source, o_orderdate + to_hours(k % 24) AS dom_created_at,
    'P' || k AS short_order_id, CAST(c_nationkey % 6 AS VARCHAR) AS partner_store_id, 'X' || k AS external_order_id,
    'note ' || (k % 9) AS delivery_note, delivery_no AS order_no,
    CAST(CASE o_orderstatus WHEN 'F' THEN 8 WHEN 'P' THEN 7 ELSE 5 END AS BIGINT) AS status, o_totalprice AS total_price_amount,
    CAST(pay AS BIGINT) AS payment_method, CASE WHEN o_orderstatus = 'O' THEN 'reason ' || (k % 3) ELSE '' END AS canceled_reason
    FROM oc JOIN (VALUES (0), (1000000000)) AS s(shift) ON shift = 0 OR k % 40 = 0 WHERE is_delivery"""
CTES["partner"] = """SELECT CAST(n_nationkey AS VARCHAR) AS partner_store_id, r_name AS partner_store FROM nation
    LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 2) ON r_regionkey = n_nationkey % 3 WHERE n_nationkey < 6"""
CTES["delivery"] = """SELECT d.*, delivery_created_time, delivery_canceled_time, delivery_driver_booked_time, delivery_picked_time,
    least(delivery_canceled_time, delivery_completed_time) AS delivery_completed_time, delivery_store_delivered_time,
    delivery_partial_completed_time, customer_phone, user_name, customer_code, partner_store,
    CASE WHEN external_source <> '' THEN external_source ELSE '7Now' END AS channel_name, d.user_id AS customer_id
    FROM delivery_orders d LEFT JOIN status_times s ON s.order_id = d.order_id
    LEFT JOIN users u ON u.user_id = d.user_id AND d.user_id <> 0 LEFT JOIN partner p ON p.partner_store_id = d.partner_store_id"""
CTES["txn"] = """SELECT 'T' || k AS transaction_id, o_custkey + 1 AS customer_id, customer_phone, user_name, customer_code,
    CAST(1 + k % 5 AS INT) AS rating, 'comment ' || (k % 11) AS comment, o_orderdate AS dom_created_at
    FROM o LEFT JOIN users ON user_id = o_custkey + 1 WHERE k % 2 = 0"""
CTES["points"] = """SELECT 'T' || k AS transaction_id, o_custkey + 2 AS customer_id, customer_phone, user_name, customer_code,
    CASE WHEN k % 15 = 0 OR k % 9 = 0 THEN NULL WHEN k % 2 = 0 THEN 'CASHIER' ELSE 'APP' END AS capture_method,
    o_orderdate + INTERVAL 1 DAY AS dom_created_at FROM o LEFT JOIN users ON user_id = o_custkey + 2 WHERE k % 3 = 0"""
CTES["products"] = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, 1 AS status, 1 AS is_base_unit, 'EA' AS product_uom,
    p_name AS product_name, CAST(p_size AS BIGINT) AS product_uom_size, p_partkey % 4 AS product_uom_id,
    CAST(substr(p_brand, 7) AS BIGINT) AS product_group_id, p_brand AS product_group_name,
    CAST(length(p_type) AS BIGINT) AS product_category_id, p_type AS product_category_name,
    p_partkey % 12 AS product_sub_category_id, p_type || '/' || (p_partkey % 12) AS product_sub_category_name,
    'RBT' || (p_size % 3) AS retail_business_type FROM part WHERE p_partkey % 17 <> 0"""
CTES["brands"] = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_brand AS product_brand_name,
    'Maker ' || (p_size % 5) AS product_manufacturer_name FROM part"""
CTES["prices"] = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(a.area AS INT) AS sale_area_id,
    make_timestamp(y.year, 1, 1, 0, 0, 0) AS purchase_price_effective_date,
    make_timestamp(y.year + 1, 1, 1, 0, 0, 0) AS next_purchase_price_effective_date,
    p_retailprice * 0.7::DOUBLE * (1 + 0.01::DOUBLE * (y.year - 1995)) * 1.1::DOUBLE AS purchase_price_with_tax,
    p_retailprice * 0.7::DOUBLE * (1 + 0.01::DOUBLE * (y.year - 1995)) AS purchase_price_without_tax
    FROM part, range(0, 5) a(area), range(1995, 2002) y(year)
    WHERE p_partkey % 10 <> 0 AND NOT (p_partkey % 7 = 0 AND y.year >= 2000)"""
CTES["snaps"] = """SELECT CAST(n_nationkey AS VARCHAR) AS store_id, n_name AS store_name, k,
    CASE WHEN NOT (n_nationkey = 7 AND k = 1) THEN CAST((n_nationkey + k) // 10 AS INT) END AS tier,
    CAST(CASE WHEN n_nationkey = 11 AND k >= 2 THEN (n_regionkey + 1) % 5 ELSE n_regionkey END AS INT) AS sale_area_id, day
    FROM nation, (VALUES (0, TIMESTAMP '1996-01-01'), (1, TIMESTAMP '1997-01-01'), (2, TIMESTAMP '1998-07-01'),
                         (3, TIMESTAMP '2000-01-01')) s(k, day)
    WHERE NOT (n_nationkey = 3 AND k = 3) AND NOT (n_nationkey = 5 AND k < 1)"""
CTES["marked"] = """SELECT *, CASE WHEN lag(k) OVER w = k - 1 AND lag(store_name) OVER w = store_name
        AND lag(tier) OVER w IS NOT DISTINCT FROM tier AND lag(sale_area_id) OVER w = sale_area_id THEN 0 ELSE 1 END AS opens
    FROM snaps WINDOW w AS (PARTITION BY store_id ORDER BY k)"""
CTES["islands"] = "SELECT *, sum(opens) OVER (PARTITION BY store_id ORDER BY k) AS island FROM marked"
CTES["stores"] = """SELECT store_id, any_value(store_name) AS store_name, any_value(tier) AS tier, any_value(sale_area_id) AS sale_area_id,
    CASE WHEN min(k) = 0 THEN TIMESTAMP '1970-01-01' ELSE min(day) END AS valid_from,
    CASE max(k) WHEN 3 THEN TIMESTAMP '9999-12-31' WHEN 0 THEN TIMESTAMP '1997-01-01' WHEN 1 THEN TIMESTAMP '1998-07-01'
        ELSE TIMESTAMP '2000-01-01' END AS valid_to, max(k) = 3 AS is_current FROM islands GROUP BY store_id, island"""

# identity: every source of a bill or line side by side, then by priority
def _from(prefix, names):
    return ", ".join(f"{prefix}.{n} AS {prefix}_{n}" for n in names)


_who = ["customer_id", "customer_phone", "user_name", "customer_code", "dom_created_at"]
_deliv = _who + ["external_order_id", "delivery_note", "short_order_id", "order_id", "channel_name", "partner_store", *_times]


def _first(name, *prefixes):
    return f"coalesce({', '.join(f'{p}_{name}' for p in prefixes)}) AS {name}"


def _gather(base):
    return f"""SELECT b.*, promotion_id_arr, promotion_name_arr, total_voucher_amount, voucher_name_arr,
    {_from('txn', _who + ['rating', 'comment'])}, {_from('pph', _who + ['capture_method'])}, {_from('dtx', _deliv)}, {_from('dno', _deliv)},
    pph.transaction_id IS NOT NULL AS has_points
    FROM {base} b LEFT JOIN promotion p ON p.transaction_id = b.transaction_id
    LEFT JOIN txn ON txn.transaction_id = b.transaction_id LEFT JOIN points pph ON pph.transaction_id = b.transaction_id
    LEFT JOIN delivery dtx ON dtx.transaction_id = b.transaction_id LEFT JOIN delivery dno ON dno.order_no = b.order_no"""


_deliv_first = ("dtx", "dno", "pph", "txn")
_identity = f"""CASE WHEN report_date > DATE '1998-01-01' THEN coalesce(pph_customer_id, txn_customer_id, dtx_customer_id, dno_customer_id)
        ELSE coalesce(dtx_customer_id, dno_customer_id, pph_customer_id, txn_customer_id) END AS customer_id,
    {', '.join(_first(n, *_deliv_first) for n in ('customer_phone', 'user_name', 'customer_code', 'dom_created_at'))},
    {', '.join(_first(n, 'dtx', 'dno') for n in ('external_order_id', 'delivery_note', 'short_order_id', 'order_id', 'partner_store'))},
    {', '.join(_first(t, 'dno', 'dtx') for t in _times)},
    coalesce(dtx_channel_name, dno_channel_name, channel_name) AS channel_name"""
_replaced = "channel_name"
CTES["heads"] = f"""SELECT 'T' || k AS transaction_id, CAST(o_orderdate + INTERVAL 7 HOUR AS DATE) AS report_date, delivery_no AS order_no,
    CASE WHEN delivery_no LIKE 'SAVYU%' THEN 'Savyu' ELSE 'Store' END AS channel_name,
    {_tender('', '0')} + {_tender('', '1')} + {_tender('', '3, 4')} AS bill_amount FROM billed"""
CTES["heads_gathered"] = _gather("heads")
CTES["heads_resolved"] = f"SELECT * EXCLUDE ({_replaced}), {_identity} FROM heads_gathered"
CTES["gathered"] = _gather("sale_line")
CTES["resolved"] = f"""SELECT * EXCLUDE ({_replaced}), {_identity}, txn_rating AS rating, txn_comment AS comment,
    pph_capture_method AS capture_method, CASE WHEN has_points THEN 1 ELSE 0 END AS is_passive_capture FROM gathered"""
CTES["placed"] = """SELECT r.*, s.sale_area_id, product_brand_name, product_manufacturer_name FROM resolved r
    LEFT JOIN stores s ON s.store_id = r.store_id AND s.valid_from <= r.transaction_time AND r.transaction_time < s.valid_to
    LEFT JOIN brands b ON b.product_id = r.product_id"""
CTES["cart"] = """SELECT 'T' || l_orderkey AS transaction_id, CAST(l_partkey AS VARCHAR) AS product_id, min(l_linenumber % 2) AS put_in_cart_order
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_orderkey % 4 = 0 AND l_orderkey % 5 <> 0 AND o_orderstatus = 'F'
    GROUP BY ALL"""
CTES["completed"] = """SELECT p.*, d.purchase_price_with_tax, d.purchase_price_without_tax, coalesce(c.put_in_cart_order, 0) AS put_in_cart_order
    FROM placed p LEFT JOIN prices d ON d.product_id = p.product_id AND d.sale_area_id = p.sale_area_id
    LEFT JOIN cart c ON c.transaction_id = p.transaction_id AND c.product_id = p.product_id
    WHERE d.product_id IS NULL OR (d.purchase_price_effective_date <= p.transaction_time
                                   AND p.transaction_time < d.next_purchase_price_effective_date)"""
CTES["canceled"] = f"""SELECT d.*, CAST(d.dom_created_at AS DATE) AS report_date, d.dom_created_at AS transaction_time,
    l.product_id, product_name, product_uom, product_uom_size, product_uom_id, product_group_id, product_group_name,
    product_category_id, product_category_name, product_sub_category_id, product_sub_category_name, retail_business_type,
    {_pay('d.payment_method')} AS payment_method_name,
    row_number() OVER (PARTITION BY d.order_id ORDER BY l.product_id NULLS FIRST) AS row_num_transaction_id,
    count(*) OVER (PARTITION BY d.order_id) AS number_of_line_item
    FROM delivery d LEFT JOIN (SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS product_id FROM lineitem) l ON l.l_orderkey = d.order_id
    LEFT JOIN products p ON p.product_id = l.product_id
    WHERE d.status IN (5, 13) AND NOT EXISTS (SELECT 1 FROM heads h WHERE h.transaction_id = d.transaction_id)
    AND NOT EXISTS (SELECT 1 FROM heads h WHERE h.order_no = d.order_no)"""

_sql_type = {"str": "VARCHAR", "int": "BIGINT", "float": "DOUBLE", "date": "TIMESTAMP", "day": "DATE", "bool": "BOOLEAN"}


def _shape(tokens: list[tuple[str, str]], given: dict[str, str], doubles: set[str]) -> str:
    def one(name, token):
        source = given.get(name, name)
        source = f"trunc({source})" if token == "int" and name in doubles else source
        return f"CAST({source} AS {_sql_type[token]}) AS {name}"
    return ", ".join(one(n, t) for n, t in tokens)


# The contract's names and order; in the compared output a day is a date and a list is joined text.
_fact = [(name, "day" if name == "report_date" else "str" if token == "list" else token) for name, token in PRODUCT_FACT.items()]
_nothing = {"problem_label_by_llm": "NULL", "feedback_at": "TIMESTAMP '1971-01-01'", "transaction_7now_source": "''"}
_total_of = {n: "total_price_amount" for n in ("final_amount", "final_amount_no_tax", "total_amount", "total_amount_no_tax", "bill_amount")}
_absent = {n: "NULL" for n in (
    "product_price", "product_brand_name", "product_manufacturer_name", "store_id", "store_name", "store_type", "supplier_id",
    "supplier_name", "quantity", "sale_bill_time", "posting_time", "staff_id", "staff_name", "payment_supplier_id",
    "payment_supplier_name", "is_passive_capture", "voucher_amount", "rating", "comment", "purchase_price_without_tax",
    "purchase_price_with_tax", "total_voucher_amount", "capture_method", "customer_gender", "customer_age_range",
    "customer_nationality", "synced_sap_time", "output_vat_code")}
CTES["fact"] = (
    f"SELECT {_shape(_fact, {**_nothing, 'order_cancel_reason': chr(39) * 2}, {'quantity'})} FROM completed UNION ALL "
    f"SELECT {_shape(_fact, {**_nothing, **_absent, **_total_of, 'order_cancel_reason': 'canceled_reason', 'payment_method_id': 'payment_method', 'delivery_status': repr('canceled'), 'transaction_type': repr('Sale Transaction'), 'refund_transaction_id': repr(''), 'put_in_cart_order': '0', 'promotion_id_arr': repr(''), 'promotion_name_arr': repr(''), 'voucher_code_arr': repr(''), 'voucher_name_arr': repr('')}, set())} FROM canceled")

CTES["mart"] = f"""SELECT report_date, CAST(year(report_date) AS INT) AS year, strftime(report_date, '%Y-%m') AS month_key,
    CAST(date_trunc('week', report_date) AS DATE) AS week_start, strftime(report_date, '%a') AS day_name,
    CASE WHEN isodow(report_date) >= 6 THEN 1 ELSE 0 END AS is_weekend, CAST(hour(transaction_time) AS INT) AS txn_hour,
    {_daypart('hour(transaction_time)')} AS daypart,
    CASE WHEN upper(channel_name) LIKE '%SAVYU%' THEN 'Savyu' WHEN upper(channel_name) LIKE '%7NOW%' THEN '7NOW'
         WHEN channel_name <> '' THEN channel_name ELSE 'Store' END AS channel,
    store_id, store_name, store_type, transaction_id, product_id, quantity, final_amount_no_tax AS revenue_net,
    final_amount AS revenue_gross, customer_code, CASE WHEN customer_code <> '' THEN 1 ELSE 0 END AS is_identified_customer, customer_id,
    nullif(customer_gender, '') AS customer_gender, nullif(customer_age_range, '') AS customer_age_range,
    nullif(customer_nationality, '') AS customer_nationality, rating, purchase_price_without_tax * quantity AS cogs
    FROM fact WHERE delivery_status = 'completed' AND transaction_type = 'Sale Transaction'
    AND store_id NOT IN ('3', '7') AND store_id NOT LIKE '2%'"""
CTES["dim"] = """SELECT product_id, product_name, product_category_name AS product_category, product_group_name AS product_group,
    product_sub_category_name AS product_sub_category, retail_business_type, product_brand_name AS brand,
    product_manufacturer_name AS manufacturer FROM products LEFT JOIN brands USING (product_id)"""


def _calendar(source, day):
    return f"""SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INT) AS year, strftime(d, '%Y-%m') AS month_key, strftime(d, '%b %Y') AS month,
    CAST(date_trunc('week', d) AS DATE) AS week_start, strftime(d, '%a') AS day_name, CAST(isodow(d) AS INT) AS weekday_no,
    isodow(d) >= 6 AS is_weekend, CASE WHEN isodow(d) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type
    FROM (SELECT unnest(generate_series(min({day})::TIMESTAMP, max({day})::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM {source})"""


# services
_svc = "CASE WHEN l_linestatus = 'F' THEN 'Pay Bill' WHEN l_partkey % 2 = 0 THEN 'Top Up' ELSE 'Pay Card' END"
_bill = "l_linestatus = 'F'"
CTES["service"] = f"""SELECT 'S' || k || '-' || replace({_svc}, ' ', '') AS transaction_id, o_orderdate + to_hours(k % 24) AS transaction_time,
    o_orderdate + to_hours(k % 24 + 1) AS posting_time, CAST(c_nationkey AS VARCHAR) AS store_id, n_name AS store_name,
    'Type' || (n_regionkey % 2) AS store_type, k % 3 AS movement_type, CAST(k % 2 AS INT) AS has_invoice,
    {_age('c_custkey % 6', 'CAST(c_custkey % 6 AS VARCHAR)')} AS customer_age_range, {_nation('c_nationkey % 5')} AS customer_nationality,
    {_gender('c_custkey % 3')} AS customer_gender, k % 4 AS edc_type, o_totalprice AS cash, {_svc} AS service_name,
    o_totalprice * 0.9::DOUBLE AS amount_before_vat, o_totalprice * 0.1::DOUBLE AS amount_vat, o_totalprice AS total_amount_without_promotion,
    's' || (o_custkey % 50) AS staff_id, 'Staff ' || (o_custkey % 50) AS staff_name, 'pos' || (k % 7) AS pos_id,
    CAST(pay AS BIGINT) AS payment_method, o_totalprice AS payment_method_value, o_orderdate AS transaction_record_start_time,
    o_orderdate AS transaction_record_end_time, CAST(NULL AS DOUBLE) AS promotion_total_amount,
    CAST(NULL AS DOUBLE) AS total_product_promotion_amount_without_tax, CAST(NULL AS DOUBLE) AS total_voucher_promotion_amount_without_tax,
    CAST(NULL AS DOUBLE) AS total_bill_promotion_amount_without_tax, k % 10 AS service_fee, k % 5 AS customer_service_fee,
    k % 2 = 0 AS skip_validate_over_50_percent, o_totalprice AS receivable_amount, k % 5 = 0 AS pre_paid,
    CASE WHEN k % 9 <> 0 THEN 'done' END AS synced_sap_status, CASE WHEN k % 9 <> 0 THEN o_orderdate END AS synced_sap_time,
    'SO-' || k AS order_no, CASE WHEN {_bill} THEN 'svc' || (k % 4) END AS service_id, 'prov' || (k % 3) AS provider_id,
    CASE WHEN {_bill} THEN CAST(c_custkey AS VARCHAR) END AS customer_id, 'type' || (k % 2) AS order_type,
    CAST(CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS INT) AS skip_validate_over_50_percent_by_int,
    CAST(o_orderdate + to_hours(k % 24) AS DATE) AS report_date, CAST(l_partkey AS VARCHAR) AS product_code,
    'Service ' || (l_partkey % 20) AS product_name, CAST(l_partkey % 4 AS VARCHAR) AS product_uom_id,
    CAST(l_suppkey AS VARCHAR) AS supplier_code, 'Supplier ' || l_suppkey AS supplier_name, CAST(trunc(l_quantity) AS BIGINT) AS quantity,
    CASE WHEN NOT {_bill} THEN l_extendedprice * 0.7::DOUBLE END AS purchase_price_with_tax,
    CASE WHEN NOT {_bill} THEN l_extendedprice * 0.63::DOUBLE END AS purchase_price_without_tax, l_extendedprice AS total_amount,
    'RBT' || (l_partkey % 3) AS retail_business_type, l_discount * 100 AS commission_on_vnd, l_extendedprice * l_discount AS total_commission
    FROM lineitem JOIN oc ON l_orderkey = k"""
_svc_tokens = [(name, "day" if name == "report_date" else token) for name, token in SERVICE_FACT.items()]
CTES["service_fact"] = f"SELECT {_shape(_svc_tokens, {}, {n for n, t in _svc_tokens if t == 'int'})} FROM service"
_svc_mart = ("report_date, service_name, provider_id, order_type, store_id, store_name, staff_id, payment_method, transaction_id, "
             "product_code, product_name, quantity, total_amount, amount_before_vat, amount_vat, total_commission, commission_on_vnd, "
             "purchase_price_with_tax, purchase_price_without_tax")

# live
CTES["sent"] = """SELECT *, event_id AS e, value + again AS price, epoch_us(ts) // 1000 + again * 60000 AS ms
    FROM events JOIN (VALUES (0), (1)) a(again) ON again = 0 OR event_id % 50 = 0
    WHERE event_type = 'purchase' AND event_id % 90 <> 0"""
CTES["messages"] = """SELECT 'E' || e AS transaction_id, CAST(e % 40 AS VARCHAR) AS product_id,
    CAST(make_timestamp(ms * 1000) + INTERVAL 7 HOUR AS DATE) AS report_date, make_timestamp(ms * 1000) + INTERVAL 7 HOUR AS transaction_time,
    make_timestamp(ms * 1000) + INTERVAL 7 HOUR AS sale_bill_time, make_timestamp((ms + 1000) * 1000) + INTERVAL 7 HOUR AS posting_time,
    CAST(user_id % 20 AS VARCHAR) AS store_id, 'Store ' || (user_id % 20) AS store_name, 's' || (e % 30) AS staff_id,
    'Staff ' || (e % 30) AS staff_name, e % 5 AS payment_method_id, 'Item ' || (e % 40) AS product_name, 'EA' AS product_uom,
    CASE WHEN e % 70 <> 0 THEN e % 4 END AS product_uom_id, e % 10 AS product_group_id, 'Group ' || (e % 10) AS product_group_name,
    e % 20 AS product_sub_category_id, 'Sub ' || (e % 20) AS product_sub_category_name, e % 5 AS product_category_id,
    'Category ' || (e % 5) AS product_category_name, 'RBT' || (e % 3) AS retail_business_type, 'SUP' || (e % 6) AS supplier_id,
    'Supplier ' || (e % 6) AS supplier_name, CAST(1 AS BIGINT) AS product_uom_size, 1 + e % 3 AS quantity, price AS product_price,
    price AS total_amount, price * 0.9::DOUBLE AS total_amount_no_tax, price AS final_amount, price * 0.9::DOUBLE AS final_amount_no_tax,
    price * 0.7::DOUBLE AS purchase_price_with_tax, price * 0.63::DOUBLE AS purchase_price_without_tax,
    CASE e % 3 WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE '' END AS customer_gender, 'Sale Transaction' AS transaction_type,
    'completed' AS delivery_status FROM sent"""
CTES["live"] = """SELECT * FROM messages QUALIFY row_number() OVER (PARTITION BY transaction_id, product_id, product_uom_id
    ORDER BY transaction_time DESC) = 1"""
CTES["serving"] = """SELECT *, CASE WHEN report_date <= (SELECT max(report_date) FROM live WHERE report_date <= DATE '2024-01-20')
    THEN 'eod' ELSE 'rlt' END AS source FROM live"""
CTES["recent"] = "SELECT * FROM serving WHERE report_date >= DATE '2024-01-17'"


def _sql(body: str) -> str:
    """Put the named parts the body rests on in front of it, in dependency order."""
    ordered: list[str] = []

    def require(text: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"\b(FROM|JOIN|,)\s*\(?{name}\b", text):
                require(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    require(body)
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered)
    return f"WITH {parts}\n{body}" if parts else body


_q: dict[str, str] = {}
_q["schema_conform"] = """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS c_acctbal,
    TRY_CAST(c_mktsegment AS BIGINT) AS c_mktsegment, c_nationkey <> 0 AS c_nationkey, c_name, CAST(NULL AS DOUBLE) AS missing_amount,
    '' AS missing_list, CAST(NULL AS VARCHAR) AS missing_text FROM customer"""
_q["void_cast"] = "SELECT c_custkey, CAST(NULL AS VARCHAR) AS note FROM customer"
_q["json_roundtrip"] = """SELECT 'T' || k AS transaction_id, CAST(l_partkey AS VARCHAR) AS product_id, l_quantity AS quantity,
    l_extendedprice AS total_amount, l_extendedprice * (1 - l_discount) AS promotion_amount, l_discount >= 0.05 AS win,
    CAST(substr(p_brand, 7) AS BIGINT) AS product_group_id FROM billed LEFT JOIN ln ON l_orderkey = k"""
_q["explode_outer"] = """SELECT 'T' || k AS transaction_id, count(*) AS line_rows, count(l_partkey) AS items
    FROM billed LEFT JOIN lineitem ON l_orderkey = k GROUP BY k"""
_q["business_day"] = """SELECT event_id, t AS local_ts, CAST(t AS DATE) AS report_date, strftime(t, '%Y-%m') AS month_key,
    CAST(date_trunc('week', t) AS DATE) AS week_start, strftime(t, '%a') AS day_name, CAST(isodow(t) AS INT) AS weekday_no,
    isodow(t) >= 6 AS is_weekend FROM (SELECT event_id, ts + INTERVAL 7 HOUR AS t FROM events)"""
_q["daypart"] = f"""SELECT event_id, CAST(h AS INT) AS hour, {_daypart('h')} AS daypart
    FROM (SELECT event_id, hour(ts + INTERVAL 7 HOUR) AS h FROM events)"""
_q["channel_decode"] = """SELECT k AS o_orderkey, CASE WHEN lower(delivery_no) LIKE 'savyu%' THEN 'Savyu' ELSE 'Store' END AS bill_channel,
    CASE WHEN k % 3 = 0 THEN 'GrabFood' WHEN k % 7 <> 0 THEN '7Now' ELSE 'Unknown' END AS delivery_channel,
    CASE WHEN k % 11 = 0 THEN '7NOW' ELSE CASE k % 5 WHEN 0 THEN 'Savyu' WHEN 1 THEN '7NOW' WHEN 2 THEN 'GrabFood' ELSE 'Store' END END
    AS report_channel FROM o"""
_q["payment_decode"] = f"SELECT o_orderkey, pay AS pay_code, {_pay('pay')} AS payment_method_name FROM o"
_q["demographics"] = f"""SELECT c_custkey, {_gender('c_custkey % 3')} AS customer_gender, {_age('c_custkey % 6')} AS customer_age_range,
    {_nation('c_nationkey % 5')} AS customer_nationality, {_gender('c_custkey % 3')} AS customer_gender_kept,
    {_age('c_custkey % 6', 'CAST(c_custkey % 6 AS VARCHAR)')} AS customer_age_range_kept,
    {_nation('c_nationkey % 5')} AS customer_nationality_kept FROM customer"""
_q["voucher_split"] = """SELECT 'T' || k AS transaction_id, CAST(CASE WHEN k % 3 = 2 THEN 2 ELSE 1 END AS INT) AS codes,
    CASE WHEN k % 3 = 2 THEN 'V' || (k % 7) ELSE '' END AS first_code,
    CASE WHEN k % 3 = 2 THEN 'V' || (k % 7) || '|W' || (k % 5) ELSE '' END AS code_list FROM billed"""
_window = "o_orderdate >= TIMESTAMP '{}' AND o_orderdate < TIMESTAMP '{}'"
_cover = _window.format("1996-02-28 17:00:00", "1996-04-01 17:00:00")
_q["windowed_scan"] = f"""SELECT o_orderkey, o_orderdate, 'business' AS scan FROM orders WHERE
    {_window.format('1996-02-29 17:00:00', '1996-03-31 17:00:00')}
    UNION ALL SELECT o_orderkey, o_orderdate, 'cover' FROM orders WHERE {_cover}"""
_q["parent_windowed_scan"] = f"""SELECT l_orderkey AS o_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND {_cover})"""
_q["sale_line"] = "SELECT * FROM sale_line"
_q["promotion_agg"] = "SELECT * FROM promotion"
_q["pivot_status_times"] = "SELECT * FROM status_times"
_q["delivery"] = "SELECT * FROM delivery"
_q["transaction_enrich"] = "SELECT * FROM txn"
_q["point_history"] = "SELECT * FROM points"
_q["dedup_latest"] = """SELECT l.user_id, l.event_type, ts, event_id, value, kinds FROM
    (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1) l
    JOIN (SELECT user_id, count(DISTINCT event_type) AS kinds FROM events GROUP BY user_id) k ON k.user_id = l.user_id"""
_q["dim_product"] = "SELECT * FROM products"
_q["dim_store"] = """SELECT CAST(n_nationkey AS VARCHAR) AS store_id, n_name AS store_name, 'Type' || (n_regionkey % 2) AS store_type,
    CASE WHEN n_nationkey <> 11 THEN 'T' || (n_nationkey % 3) END AS tier_store,
    CAST(CASE WHEN n_nationkey <> 11 THEN n_regionkey END AS INT) AS sale_area_id FROM nation"""
_q["dim_brand"] = "SELECT * FROM brands"
_q["dim_payment"] = """SELECT DISTINCT CAST(pay AS BIGINT) AS payment_method_id, 'Pay supplier ' || pay AS payment_supplier_name FROM o"""
_q["dim_customer"] = "SELECT user_id AS customer_id, customer_phone, user_name, customer_code FROM users"
_q["dim_partner_store"] = "SELECT * FROM partner"
_q["dim_purchase_price"] = "SELECT * FROM prices"
_q["dim_date"] = _calendar("orders", "o_orderdate")
_q["range_join_effective"] = """SELECT f.*, purchase_price_effective_date, next_purchase_price_effective_date, purchase_price_with_tax,
    purchase_price_without_tax FROM
    (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS product_id, CAST(n_regionkey AS INT) AS sale_area_id,
     o_orderdate + INTERVAL 7 HOUR AS sold_at, l_quantity FROM lineitem JOIN oc ON l_orderkey = k) f
    LEFT JOIN prices d ON d.product_id = f.product_id AND d.sale_area_id = f.sale_area_id
    WHERE purchase_price_effective_date IS NULL OR (purchase_price_effective_date <= sold_at AND sold_at < next_purchase_price_effective_date)"""
_q["range_join_outside_span"] = _q["range_join_effective"]
_q["as_of_join"] = """SELECT f.*, store_name, tier, sale_area_id FROM
    (SELECT o_orderkey, CAST(c_nationkey AS VARCHAR) AS store_id, o_orderdate + INTERVAL 7 HOUR AS sold_at FROM oc) f
    LEFT JOIN stores s ON s.store_id = f.store_id AND valid_from <= sold_at AND sold_at < valid_to"""
_q["as_of_outside_span"] = _q["as_of_join"]
_q["identity_coalesce"] = f"""SELECT transaction_id, report_date, customer_id, customer_phone, user_name, customer_code, dom_created_at,
    external_order_id, delivery_note, short_order_id, order_id, {', '.join(_times)}, channel_name, partner_store FROM heads_resolved"""
_q["scd2_initial"] = """SELECT CAST(n_nationkey AS VARCHAR) AS store_id, n_name AS store_name, 'Type' || (n_regionkey % 2) AS store_type,
    TIMESTAMP '1970-01-01' AS valid_from, TIMESTAMP '9999-12-31' AS valid_to, true AS is_current FROM nation"""
_q["scd2_apply"] = _q["scd2_from_snapshots"] = "SELECT * FROM stores"
_q["scd2_current"] = "SELECT store_id, store_name, tier, sale_area_id FROM snaps WHERE k = 3"
_q["fact_merge"] = """SELECT transaction_id, row_num_transaction_id, product_id, order_no, store_id, sale_area_id, customer_id, channel_name,
    rating, capture_method, is_passive_capture, final_amount, purchase_price_without_tax, promotion_id_arr, voucher_name_arr,
    total_voucher_amount, put_in_cart_order FROM completed"""
_q["put_in_cart"] = "SELECT * FROM cart"
_q["canceled_orders"] = """SELECT order_id, transaction_id, order_no, product_id, product_name, product_group_name, report_date, transaction_time,
    total_price_amount AS final_amount, total_price_amount AS bill_amount, payment_method_name, canceled_reason AS order_cancel_reason,
    channel_name, row_num_transaction_id, number_of_line_item, customer_id FROM canceled"""
CTES["product_snaps"] = """SELECT p.* REPLACE (product_group_name || CASE WHEN k >= 1 AND CAST(product_id AS BIGINT) % 5 = 1 THEN ' new' ELSE '' END
        || CASE WHEN k >= 2 AND CAST(product_id AS BIGINT) % 10 = 1 THEN ' newer' ELSE '' END AS product_group_name), k, day
    FROM products p CROSS JOIN (VALUES (0, DATE '1996-01-01'), (1, DATE '1997-07-01'), (2, DATE '1999-01-01')) s(k, day)
    WHERE NOT (k = 0 AND CAST(product_id AS BIGINT) % 13 = 0) AND NOT (k = 2 AND CAST(product_id AS BIGINT) % 19 = 0)"""
CTES["product_starts"] = """SELECT * FROM (SELECT *, lag(product_group_name) OVER (PARTITION BY product_id ORDER BY k) AS earlier FROM product_snaps)
    WHERE earlier IS DISTINCT FROM product_group_name"""
CTES["product_versions"] = """SELECT * EXCLUDE (k, day, earlier), CASE WHEN k = 1 OR (k = 0 AND valid_to > TIMESTAMP '1997-07-01') THEN product_uom_size % 7 END AS shelf,
        valid_to = TIMESTAMP '9999-12-31' AS is_current
    FROM (SELECT *, CASE WHEN k = 0 THEN TIMESTAMP '1970-01-01' ELSE CAST(day AS TIMESTAMP) END AS valid_from,
        CAST(coalesce(lead(day) OVER (PARTITION BY product_id ORDER BY k), CASE WHEN CAST(product_id AS BIGINT) % 19 = 0 THEN DATE '1999-01-01' END,
            DATE '9999-12-31') AS TIMESTAMP) AS valid_to FROM product_starts)"""
_q["product_history"] = """SELECT product_id, product_name, product_group_name, product_category_name, shelf, valid_from, valid_to, is_current
    FROM product_versions"""
CTES["canceled_versions"] = CTES["canceled"].replace("LEFT JOIN products p ON p.product_id = l.product_id", """LEFT JOIN product_versions p
    ON p.product_id = l.product_id AND p.valid_from <= d.dom_created_at AND d.dom_created_at < p.valid_to""")
_q["canceled_history"] = """SELECT order_id, transaction_id, product_id, product_name, product_group_name, report_date,
    total_price_amount AS final_amount, row_num_transaction_id, number_of_line_item FROM canceled_versions"""
_q["landed_documents"] = """SELECT * FROM (
    SELECT transaction_id, day AS document_day, store_id, items, cash, NULL AS broken FROM landed_bills WHERE transaction_id NOT LIKE '%7'
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, '{"_id": "' || transaction_id FROM landed_bills WHERE transaction_id LIKE '%7')"""
CTES["landed_bills"] = """SELECT 'T' || k AS transaction_id, CAST(o_orderdate AS DATE) AS day, CAST(c_nationkey AS VARCHAR) AS store_id,
        CAST((SELECT count(*) FROM lineitem WHERE l_orderkey = k) AS INT) AS items, CASE WHEN pay = 0 THEN o_totalprice END AS cash FROM billed
    UNION ALL SELECT 'R' || k, CAST(o_orderdate AS DATE) + 3, CAST(c_nationkey AS VARCHAR),
        CAST((SELECT count(*) FROM lineitem WHERE l_orderkey = k AND l_returnflag = 'R') AS INT), CASE WHEN pay = 0 THEN o_totalprice END FROM billed
    WHERE k IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""
_q["fact_product"] = "SELECT * FROM fact"
_q["service_line"] = "SELECT * FROM service"
_q["fact_service"] = "SELECT * FROM service_fact"
_q["daily_run_fact"] = "SELECT *, 'eod_product' AS created_by FROM fact"
_q["gated_publish"] = "SELECT *, 'eod_service' AS created_by FROM service_fact"
_q["gated_publish_mart"] = f"""SELECT report_date, service_name, count(*) AS lines, {_total('total_amount')} AS revenue
    FROM service_fact GROUP BY ALL"""
_service_years = "(SELECT count(DISTINCT year(CAST(o_orderdate AS DATE))) AS years FROM orders)"
_q["published_runs"] = f"""SELECT 'eod_service' AS pipeline, step, status, runs FROM {_service_years}, LATERAL (VALUES
    ('gold', 'Succeeded', years + 1), ('gate', 'Succeeded', years), ('gate', 'Failed', 1), ('mart', 'Succeeded', years + 1)) v(step, status, runs)"""
_q["published_failures"] = f"""SELECT 'eod_service' AS pipeline, '1997-01-01' AS run_date, 'gate' AS step, 'Failed' AS status,
    'held back: 1997-05: service_name in known set (' || count(*) || ')' AS error FROM service_fact WHERE strftime(report_date, '%Y-%m') = '1997-05'"""
_daily = f"""SELECT CAST(o_orderdate AS DATE) AS report_date, count(*) AS orders, {_total('o_totalprice')} AS amount FROM orders GROUP BY 1"""
_q["idempotent_rerun"] = f"SELECT report_date, strftime(report_date, '%Y-%m') AS month_key, orders, amount FROM ({_daily})"
_q["backfill_equals_daily"] = f"""SELECT report_date, count(DISTINCT transaction_id) AS bills, count(DISTINCT customer_id) AS customers,
    {_total('bill_amount')} AS amount FROM heads_resolved GROUP BY report_date"""
_log = """(SELECT 'eod_' || (k % 3) AS pipeline, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS run_date,
    CASE WHEN k % 9 < 3 THEN 'ingest' WHEN k % 9 < 6 THEN 'silver' ELSE 'gold' END AS step,
    CASE WHEN o_orderstatus = 'P' THEN 'Failed' WHEN k % 50 = 0 THEN 'Cancelled' ELSE 'Succeeded' END AS status,
    o_orderdate + to_hours(k % 24) AS started_at, CAST(k % 600 AS DOUBLE) AS duration_s FROM o)"""
_q["run_log_summary"] = f"""SELECT pipeline, step, status, count(*) AS runs, sum(duration_s) AS total_s, max(started_at) AS last_started
    FROM {_log} GROUP BY ALL"""
_q["failed_runs"] = f"""SELECT pipeline, run_date, step, status, started_at FROM {_log}
    WHERE started_at >= TIMESTAMP '1998-03-13 22:00:00' AND status IN ('Failed', 'Cancelled')"""
_q["baseline_diff"] = f"""WITH d AS ({_daily}),
    b AS (SELECT report_date, amount + CASE day(report_date) WHEN 15 THEN 25.0 WHEN 10 THEN 5.0 ELSE 0.0 END AS amount,
          orders + CASE day(report_date) WHEN 7 THEN 11 ELSE 0 END AS orders FROM d WHERE day(report_date) <> 20),
    a AS (SELECT * FROM d WHERE day(report_date) <> 28)
    SELECT coalesce(a.report_date, b.report_date) AS report_date, a.amount AS actual_amount, a.orders AS actual_orders,
    b.amount AS baseline_amount, b.orders AS baseline_orders FROM a FULL JOIN b ON a.report_date = b.report_date
    WHERE a.report_date IS NULL OR b.report_date IS NULL OR abs(a.amount - b.amount) > 10 OR abs(a.orders - b.orders) > 10"""


def _checks(fact, grain, rules):
    per_day = ", ".join([f"count(*) FILTER (WHERE {rule}) AS c{i}" for i, rule in enumerate(rules.values())])
    rows = " UNION ALL ".join([
        "SELECT report_date, 'row_count > 0' AS check_name, total > 0 AS passed, total AS counted FROM t",
        "SELECT report_date, 'grain unique', total - grains = 0, total - grains FROM t",
        *[f"SELECT report_date, '{name}', c{i} = 0, c{i} FROM t" for i, name in enumerate(rules)]])
    return f"""SELECT * FROM (WITH t AS (SELECT report_date, count(*) AS total, count(DISTINCT {grain}) AS grains, {per_day}
    FROM {fact} GROUP BY report_date) {rows})"""


_q["dq_product"] = _checks("fact", "row(transaction_id, product_id, row_num_transaction_id)", {
    "no null transaction_id": "transaction_id IS NULL", "no null product_id": "product_id IS NULL",
    "no null report_date": "report_date IS NULL",
    "completed final_amount not null": "delivery_status = 'completed' AND final_amount IS NULL"})
_q["dq_service"] = _checks("service_fact", "row(transaction_id, product_code)", {
    "no null transaction_id": "transaction_id IS NULL", "no null product_code": "product_code IS NULL",
    "no null report_date": "report_date IS NULL", "no null total_amount": "total_amount IS NULL",
    "service_name in known set": "service_name NOT IN ('Pay Bill', 'Pay Card', 'Top Up')"})

_q["mart_sales"] = "SELECT * FROM mart"
_units = "CAST(sum(quantity) AS BIGINT) AS units"
_rev = _total("revenue_net")
_q["mart_sales_daily"] = f"""SELECT report_date, year, month_key, week_start, is_weekend, channel, baskets, stores, units,
    CAST(round(net, 0) AS DOUBLE) AS revenue_net, CAST(round(gross, 0) AS DOUBLE) AS revenue_gross,
    round(CAST(net AS DOUBLE) / nullif(baskets, 0), 0) AS basket_size FROM
    (SELECT report_date, year, month_key, week_start, is_weekend, channel, count(DISTINCT transaction_id) AS baskets,
     count(DISTINCT store_id) AS stores, {_units}, sum(CAST(revenue_net AS {MONEY})) AS net, sum(CAST(revenue_gross AS {MONEY})) AS gross
     FROM mart GROUP BY ALL)"""
CTES["changed_mart"] = """SELECT * REPLACE (CASE WHEN report_date IN (DATE '1996-03-01', DATE '1998-07-04') THEN revenue_net * 2
    ELSE revenue_net END AS revenue_net) FROM mart"""
_q["mart_refresh"] = _q["mart_sales_daily"].replace("FROM mart ", "FROM changed_mart ")
_q["mart_dim_product"] = "SELECT * FROM dim"
_q["mart_dim_date"] = _calendar("mart", "report_date")
_q["service_mart"] = f"SELECT {_svc_mart} FROM service_fact"

_measures = {
    "revenue": _rev, "units": "CAST(sum(quantity) AS BIGINT)", "total_cogs": _total("cogs"), "baskets": "count(DISTINCT transaction_id)",
    "store_days": "count(DISTINCT row(report_date, store_id))",
    "identified_baskets": "count(DISTINCT CASE WHEN is_identified_customer = 1 THEN transaction_id END)", "avg_rating": "avg(rating)",
}
_ratios = {"basket_size": ("revenue", "baskets"), "apsd": ("revenue", "store_days"), "units_per_basket": ("units", "baskets"),
           "customer_penetration": ("identified_baskets", "baskets"), "identified_rate": ("identified_baskets", "baskets"),
           "margin_pct": ("gross_margin", "revenue")}
_margin = "CASE WHEN revenue IS NOT NULL OR total_cogs IS NOT NULL THEN coalesce(revenue, 0) - coalesce(total_cogs, 0) END"


def _sales(names, by=(), source="mart", where="true"):
    inner = ", ".join([*by, *[f"{m} AS {n}" for n, m in _measures.items()]])
    margin = f"(SELECT *, {_margin} AS gross_margin FROM (SELECT {inner} FROM {source} WHERE {where}{' GROUP BY ' + ', '.join(by) if by else ''}))"
    pick = [f"CAST({_ratios[n][0]} AS DOUBLE) / nullif({_ratios[n][1]}, 0) AS {n}" if n in _ratios else n for n in names]
    return f"SELECT {', '.join([*by, *pick])} FROM {margin}"


_q["metric_base"] = _sales(["revenue", "units", "total_cogs", "baskets"], ["month_key", "channel"])
_q["metric_ratios"] = _sales(["basket_size", "apsd", "units_per_basket"], ["month_key"])
_q["metric_store_days"] = _sales(["store_days"], ["channel"])
_q["metric_identified"] = _sales(["customer_penetration", "identified_baskets", "identified_rate"], ["month_key"])
_q["metric_margin"] = _sales(["gross_margin", "margin_pct"], ["store_id"])
_q["metric_customers"] = """SELECT channel, count(*) AS unique_customers, count(*) FILTER (WHERE n >= 2) AS repeat_customers,
    CAST(count(*) FILTER (WHERE n >= 2) AS DOUBLE) / count(*) AS repeat_rate FROM
    (SELECT channel, customer_id, count(DISTINCT transaction_id) AS n FROM mart WHERE customer_id > 0 GROUP BY ALL) GROUP BY channel"""
_q["metric_rating"] = _sales(["avg_rating"], ["channel"])
_q["metric_channel_share"] = f"""SELECT month_key, channel, revenue, revenue / nullif(whole, 0) AS share FROM
    (SELECT *, CAST(sum(CAST(revenue AS decimal(28,6))) OVER (PARTITION BY month_key) AS DOUBLE) AS whole FROM
     (SELECT month_key, channel, {_rev} AS revenue FROM mart GROUP BY ALL))"""


def _shifted(axis, name, step, by, base, change):
    keys = "".join(f"{b}, " for b in by)
    total = lambda c: f"CAST(sum(CAST({c} AS decimal(28,6))) AS DOUBLE)"
    diff = f"(coalesce(revenue, 0) - coalesce({base}, 0)) / nullif({base}, 0)"
    day = f"(SELECT report_date, {keys}{_rev} AS revenue FROM mart GROUP BY ALL)"
    return f"""SELECT *, {diff} AS {change} FROM (SELECT {keys}{axis.format('d')} AS {name}, {total('n')} AS revenue, {total('p')} AS {base} FROM
    (SELECT {keys}report_date AS d, revenue AS n, CAST(NULL AS DOUBLE) AS p FROM {day}
     UNION ALL SELECT {keys}CAST(report_date + {step} AS DATE), NULL, revenue FROM {day}) WHERE d <= (SELECT max(report_date) FROM mart) GROUP BY ALL)"""


_week = "CAST(date_trunc('week', {}) AS DATE)"
_q["metric_wow"] = f"""SELECT w.*, baskets, basket_size FROM ({_shifted(_week, 'week_start', 'INTERVAL 7 DAY', (), 'revenue_lw', 'wow_pct')}) w
    LEFT JOIN ({_sales(['baskets', 'basket_size'], ['week_start'])}) b ON b.week_start = w.week_start"""
_q["dash_weeks"] = f"""SELECT * FROM ({_q['metric_wow']}) WHERE week_start IN (DATE '1996-03-04', DATE '1997-12-29', DATE '1998-07-06')"""
_q["dash_weekday"] = _sales(["revenue", "baskets"], ["weekday_no", "day_name"], "(SELECT *, CAST(isodow(report_date) AS INT) AS weekday_no FROM mart)")
_q["metric_mom"] = _shifted("strftime({}, '%Y-%m')", "month_key", "INTERVAL 1 MONTH", ("channel",), "revenue_pm", "mom_pct")
_q["metric_7d_avg"] = f"""SELECT date, CAST(sum(CAST(revenue AS decimal(28,6))) AS DOUBLE) / 7.0::DOUBLE AS revenue_avg_day FROM
    (SELECT CAST(report_date + to_days(CAST(i AS INT)) AS DATE) AS date, revenue FROM
     (SELECT report_date, {_rev} AS revenue FROM mart GROUP BY ALL), range(0, 7) r(i))
    WHERE date <= (SELECT max(report_date) FROM mart) GROUP BY date"""


def _service(names, by):
    inner = {"total_revenue": "CAST(sum(total_amount) AS BIGINT)", "commission_income": "CAST(sum(total_commission) AS BIGINT)",
             "product_cost": "CAST(sum(purchase_price_with_tax) AS BIGINT)",
             "cost_service_margin": "CAST(sum(total_amount - purchase_price_with_tax) FILTER (WHERE purchase_price_with_tax > 0) AS BIGINT)",
             "transaction_count": "count(DISTINCT transaction_id)"}
    margin = """CASE WHEN commission_income IS NOT NULL OR cost_service_margin IS NOT NULL
        THEN coalesce(commission_income, 0) + coalesce(cost_service_margin, 0) END"""
    outer = {"margin_pct": "CAST(gross_margin AS DOUBLE) / nullif(total_revenue, 0) AS margin_pct",
             "aov": "CAST(total_revenue AS DOUBLE) / nullif(transaction_count, 0) AS aov"}
    return f"""SELECT {', '.join(by)}, {', '.join(outer.get(n, n) for n in names)} FROM (SELECT *, {margin} AS gross_margin FROM
    (SELECT {', '.join(by)}, {', '.join(f'{m} AS {n}' for n, m in inner.items())} FROM service_fact GROUP BY {', '.join(by)}))"""


_q["metric_service"] = _service(["total_revenue", "commission_income", "product_cost", "cost_service_margin", "gross_margin", "margin_pct",
                                 "transaction_count", "aov"], ["service_name"])


def _live(names, by, source="recent"):
    m = {"revenue": _total("total_amount"), "net_revenue": _total("final_amount"), "units": "CAST(sum(quantity) AS BIGINT)",
         "transactions": "count(DISTINCT transaction_id)", "lines": "count(*)",
         "aov": f"{_total('total_amount')} / nullif(count(DISTINCT transaction_id), 0)",
         "realtime_revenue": f"CAST(sum(CAST(total_amount AS {MONEY})) FILTER (WHERE source = 'rlt') AS DOUBLE)",
         "batch_revenue": f"CAST(sum(CAST(total_amount AS {MONEY})) FILTER (WHERE source = 'eod') AS DOUBLE)"}
    return f"SELECT {', '.join(by)}, {', '.join(f'{m[n]} AS {n}' for n in names)} FROM {source} GROUP BY ALL"


_q["metric_realtime"] = _live(["revenue", "net_revenue", "units", "transactions", "lines", "aov", "realtime_revenue", "batch_revenue"],
                              ["report_date"])
_q["daily_series"] = _sales(["revenue", "baskets", "units"], ["report_date"]).replace(
    "SELECT report_date,", "SELECT CASE WHEN isodow(report_date) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type, report_date,", 1)
_q["top_products"] = f"""SELECT t.*, product_name FROM ({_sales(['revenue', 'units'], ['product_id'])}
    ORDER BY revenue DESC NULLS LAST, product_id LIMIT 10) t LEFT JOIN dim d ON d.product_id = t.product_id"""
_q["dash_overview"] = _sales(["revenue", "baskets", "units", "basket_size", "apsd", "units_per_basket", "customer_penetration"])
_q["dash_daypart"] = _sales(["revenue", "baskets"], ["daypart"])
_q["dash_store"] = _sales(["revenue", "baskets", "basket_size", "units", "units_per_basket", "apsd"], ["store_id", "store_name"],
                          where="report_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND channel IN ('Store', '7NOW')")
_q["dash_store_channel"] = _sales(["revenue"], ["store_id", "store_name", "channel"])
_q["dash_product"] = f"""SELECT t.*, product_name, product_category, brand FROM
    ({_sales(['units', 'revenue', 'baskets', 'gross_margin', 'margin_pct'], ['product_id'])}) t LEFT JOIN dim d ON d.product_id = t.product_id"""
_star = "(SELECT m.*, product_category, product_group FROM mart m LEFT JOIN dim d ON d.product_id = m.product_id)"
_cells = ", ".join(f"""CAST(sum(CAST(revenue_net AS {MONEY})) FILTER (WHERE channel = '{c}') AS DOUBLE) AS "{c}_revenue",
    CAST(sum(quantity) FILTER (WHERE channel = '{c}') AS BIGINT) AS "{c}_units" """ for c in ("Store", "7NOW", "Savyu", "GrabFood"))
_q["dash_matrix"] = f"""SELECT product_category, {_cells}, {_rev} AS total_revenue, CAST(sum(quantity) AS BIGINT) AS total_units,
    CAST(grouping(product_category) AS INT) AS is_total FROM {_star} GROUP BY ROLLUP (product_category)"""
_q["dash_category"] = _sales(["revenue", "units", "gross_margin"], ["product_category", "product_group"], _star)
_q["dash_customer"] = _sales(["baskets", "revenue"], ["customer_gender", "customer_age_range"])
_q["dash_identified"] = _sales(["identified_baskets", "baskets", "identified_rate"], ["report_date"])
_q["dash_service"] = _service(["total_revenue", "transaction_count"], ["service_name", "provider_id"])
_q["dash_service_store"] = _service(["total_revenue", "gross_margin", "transaction_count", "aov"], ["store_id", "store_name"])
_q["dash_realtime"] = _live(["revenue", "transactions", "aov"], ["store_id", "store_name"])
_q["dash_realtime_category"] = _live(["revenue", "units", "lines"], ["product_category_name"])
_q["dash_realtime_hour"] = _live(["revenue", "transactions"], ["hour"], "(SELECT *, date_trunc('hour', transaction_time) AS hour FROM recent)")
_q["stream_conform"] = "SELECT * FROM messages"
_q["bad_documents"] = """SELECT transaction_id, cash, voucher, receivable_amount, 0::DOUBLE AS cash_at_bank, cash + receivable_amount AS bill_amount
    FROM (SELECT 'T' || k AS transaction_id, CASE WHEN pay = 0 AND c_custkey % 3 <> 1 THEN o_totalprice ELSE 0 END AS cash,
        coalesce(CASE WHEN pay = 2 THEN o_totalprice END, 0) AS voucher, coalesce(CASE WHEN pay = 1 THEN o_totalprice END, 0) AS receivable_amount
        FROM billed)"""
_q["stream_upsert"] = "SELECT * FROM live"
CTES["moved_batch"] = """SELECT transaction_id, product_id, store_id, CAST(report_date AS DATE) + 8220 AS report_date, quantity, final_amount
    FROM fact WHERE delivery_status = 'completed'
        AND CAST(report_date AS DATE) + 8220 <= DATE '2024-01-20' - CAST(CAST(store_id AS INT) % 5 AS INT)"""
_q["stream_retention"] = "SELECT * FROM live WHERE transaction_time >= TIMESTAMP '2024-01-28'"
_q["frontier_union"] = """SELECT *, 'eod' AS source FROM moved_batch UNION ALL
    SELECT transaction_id, product_id, store_id, report_date, quantity, final_amount, 'rlt'
    FROM live LEFT JOIN (SELECT store_id AS s, max(report_date) AS d FROM moved_batch GROUP BY 1) ON store_id = s
    WHERE d IS NULL OR report_date > d"""
_q["stream_dedup"] = "SELECT * FROM messages WHERE transaction_time IS NOT NULL"
_q["stream_hourly"] = f"""SELECT * FROM (SELECT date_trunc('hour', transaction_time) AS hour, store_id, count(*) AS lines,
        CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(CAST(final_amount AS {MONEY})) AS DOUBLE) AS revenue FROM messages GROUP BY 1, 2)
    WHERE hour + INTERVAL 1 HOUR <= (SELECT max(transaction_time) - INTERVAL 1 HOUR FROM messages)"""
_q["stream_restart"] = _q["stream_upsert"]
# what arrived later is the corrected message; within one arrival the later event time wins
_q["stream_correction"] = """SELECT * EXCLUDE (p) REPLACE (
        CASE WHEN CAST(substr(transaction_id, 2) AS BIGINT) % 3 = 0 THEN report_date - 1 ELSE report_date END AS report_date,
        CASE WHEN CAST(substr(transaction_id, 2) AS BIGINT) % 3 = 0 THEN transaction_time - INTERVAL 1 DAY ELSE transaction_time END AS transaction_time,
        CASE WHEN CAST(substr(transaction_id, 2) AS BIGINT) % 3 = 0 THEN sale_bill_time - INTERVAL 1 DAY ELSE sale_bill_time END AS sale_bill_time,
        CASE WHEN CAST(substr(transaction_id, 2) AS BIGINT) % 3 = 0 THEN posting_time - INTERVAL 1 DAY ELSE posting_time END AS posting_time,
        p AS product_price, p AS total_amount, p AS final_amount, p * 0.9::DOUBLE AS total_amount_no_tax,
        p * 0.9::DOUBLE AS final_amount_no_tax, p * 0.7::DOUBLE AS purchase_price_with_tax, p * 0.63::DOUBLE AS purchase_price_without_tax)
    FROM (SELECT l.*, CASE WHEN e.event_id % 3 = 0 THEN (e.value + 10) + (CASE WHEN e.event_id % 50 = 0 THEN 1 ELSE 0 END)
        ELSE l.total_amount END AS p FROM live l JOIN events e ON l.transaction_id = 'E' || e.event_id)"""
_q["retention_filter"] = """SELECT transaction_id, product_id, product_uom_id, report_date, transaction_time, total_amount FROM live
    WHERE transaction_time >= TIMESTAMP '2024-01-28'"""
_q["lambda_union"] = "SELECT * FROM serving"
_q["mart_realtime"] = """SELECT transaction_id, product_id, report_date, transaction_time, source, store_id, store_name, staff_id,
    payment_method_id, product_name, product_group_name, product_category_name, retail_business_type, quantity, product_price,
    total_amount, total_amount_no_tax, final_amount, customer_gender FROM serving WHERE report_date >= DATE '2024-01-24'"""

ORACLES: dict[str, str] = {name: _sql(body) for name, body in _q.items()}
