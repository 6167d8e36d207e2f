"""SQL that gives the result each registered query must have."""

from __future__ import annotations

# --- shared relations ------------------------------------------------------

PARTS = """strftime({c}, '%Y-%m-%d') AS report_date, CAST(year({c}) AS INTEGER) AS year,
    CAST(month({c}) AS INTEGER) AS month, CAST(day({c}) AS INTEGER) AS day"""

HEADER = f"""header AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ref_id, n_name AS branch_name,
    'INV-' || o_orderkey AS ref_no, CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(CASE o_orderstatus WHEN 'P' THEN 4 WHEN 'F' THEN 3 ELSE 1 END AS BIGINT) AS payment_status,
    o_totalprice AS total_amount, o_orderdate AS ref_date, {PARTS.format(c="o_orderdate")}
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

DETAIL = """detail AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS ref_id,
    concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS ref_detail_id,
    CAST(l_partkey AS VARCHAR) AS item_id, 'item ' || l_partkey AS item_name,
    CAST(trunc(l_quantity) AS BIGINT) AS quantity, l_extendedprice AS amount,
    l_extendedprice * l_discount AS allocation_amount,
    CASE WHEN l_linestatus = 'F' THEN CAST(0.5 AS DOUBLE) END AS allocation_delivery_promotion_amount,
    CASE WHEN l_returnflag <> 'R' THEN l_extendedprice * l_tax END AS tax_amount,
    l_shipdate AS ref_date
  FROM lineitem)"""

# An invoice line's worth before and with tax; sold lines are those of invoices that are not cancelled.
LINE_WORTH = """worth AS (
  SELECT *, amount - coalesce(allocation_amount, 0) - coalesce(allocation_delivery_promotion_amount, 0) AS before_tax,
    coalesce(tax_amount, 0) AS tax FROM {lines})"""

SOLD_COLUMNS = """invoice.ref_id AS order_id, invoice.ref_no AS invoice_code, invoice.branch_name, invoice.customer_id,
    invoice.ref_date, CAST(invoice.ref_date AS DATE) AS report_date, strftime(invoice.ref_date, '%H') AS report_hour,
    invoice.year, invoice.month, invoice.day, worth.item_id, worth.item_name, worth.quantity,
    worth.before_tax AS net_revenue_pre_tax, worth.tax AS tax_amount, worth.before_tax + worth.tax AS net_revenue_inclusive"""

SOLD = "SELECT " + SOLD_COLUMNS + " FROM {invoices} AS invoice JOIN worth USING (ref_id) WHERE invoice.payment_status <> 4"

SALES = LINE_WORTH.format(lines="detail") + ", sales AS (" + SOLD.format(invoices="header") + ")"

REVENUE = """SELECT report_date, branch_name, year, month, count(*) AS total_orders,
    round(sum(taken), 2) AS total_revenue, round(sum(taken) / count(*), 6) AS aov
  FROM (SELECT report_date, branch_name, year, month, ref_id, sum(total_amount) AS taken
        FROM {source} WHERE total_amount > 0 GROUP BY ALL)
  GROUP BY report_date, branch_name, year, month"""

LATER_HEADER = f"""later AS (
  SELECT ref_id, 'NEW ' || branch_name AS branch_name, ref_no, customer_id, payment_status,
    total_amount + 1 AS total_amount, ref_date + INTERVAL 1 DAY AS ref_date,
    {PARTS.format(c="(ref_date + INTERVAL 1 DAY)")} FROM header)"""

LATER_DETAIL = """later_detail AS (
  SELECT * FROM (
    SELECT ref_id, ref_detail_id, item_id, item_name, quantity + 1 AS quantity, amount, allocation_amount,
      allocation_delivery_promotion_amount, tax_amount, ref_date + INTERVAL 1 DAY AS ref_date,
      row_number() OVER (PARTITION BY ref_id, ref_detail_id ORDER BY ref_date DESC NULLS LAST,
        item_id DESC NULLS LAST, item_name DESC NULLS LAST, quantity DESC NULLS LAST, amount DESC NULLS LAST,
        allocation_amount DESC NULLS LAST, allocation_delivery_promotion_amount DESC NULLS LAST,
        tax_amount DESC NULLS LAST) AS rn
    FROM detail) WHERE rn = 1)"""

LINE_ID = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)"
ISO = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f')"

# Landed event orders: what each spelling means.
EVENT_UTC = """CASE event_type WHEN 'click' THEN date_trunc('day', ts) WHEN 'error' THEN NULL ELSE ts END"""
EVENT = f"""event AS (
  SELECT *, CAST({EVENT_UTC} AS TIMESTAMP) + INTERVAL 7 HOUR AS local_ts,
    CASE WHEN event_type IN ('signup', 'purchase') THEN value ELSE 0 END AS amount,
    CAST(CASE event_type WHEN 'signup' THEN user_id WHEN 'purchase' THEN user_id WHEN 'view' THEN -user_id
         WHEN 'click' THEN 1000 ELSE 0 END AS BIGINT) AS kind,
    CASE event_type WHEN 'signup' THEN 'SIGNUP' WHEN 'purchase' THEN '  purchase ' WHEN 'view' THEN 'view'
         WHEN 'click' THEN 'click' END AS branch_id,
    CASE WHEN value >= 5 THEN 'Store ' || event_type END AS own_name
  FROM events)"""
MAPPED = """CASE event_type WHEN 'signup' THEN 'Online' WHEN 'purchase' THEN 'Counter' WHEN 'view' THEN ''
    ELSE coalesce(own_name, branch_id) END"""
EVENT_PARTS = """coalesce(strftime(local_ts, '%Y-%m-%d'), '1970-01-01') AS report_date,
    CAST(coalesce(year(local_ts), 0) AS INTEGER) AS year, CAST(coalesce(month(local_ts), 0) AS INTEGER) AS month,
    CAST(coalesce(day(local_ts), 0) AS INTEGER) AS day"""

EVENT_TABLE = """rows AS (
  SELECT CAST(event_id AS VARCHAR) AS ref_id, event_type AS branch_name, value AS total_amount,
    CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
  FROM events)"""

FLAWED = """flawed AS (
  SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
              WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN ''
              ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
    CASE WHEN o_orderpriority = '2-HIGH' THEN -o_totalprice ELSE o_totalprice END AS total_amount,
    CASE WHEN o_orderstatus <> 'O' THEN CAST(o_custkey AS VARCHAR) END AS customer_id
  FROM orders)"""

FLAWED_SALES = f"""flawed AS (
  SELECT CASE WHEN d.quantity <> 9 THEN d.item_id END AS item_id, h.ref_id AS order_id,
    CAST(h.ref_date AS DATE) AS report_date,
    (CASE WHEN d.quantity <> 7 THEN d.amount END
      - coalesce(CASE WHEN d.quantity = 11 THEN d.amount * 2 ELSE d.allocation_amount END, 0)
      - coalesce(d.allocation_delivery_promotion_amount, 0)) + coalesce(d.tax_amount, 0) AS net_revenue_inclusive
  FROM detail d JOIN header h ON d.ref_id = h.ref_id WHERE h.payment_status <> 4)"""

INCREMENT = """WITH {header}, {detail}, {sales},
  old AS (SELECT order_id, item_id, report_date, quantity, net_revenue_pre_tax FROM sales
          WHERE report_date < DATE '1998-01-01'),
  fresh AS (SELECT order_id, item_id, report_date, quantity + 1000 AS quantity, net_revenue_pre_tax FROM sales
            WHERE report_date >= DATE '1997-07-01' AND {since})
  SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM fresh WHERE fresh.order_id = old.order_id)
  UNION ALL SELECT * FROM fresh"""


LOCAL_DAY = """strftime(o_orderdate + INTERVAL 7 HOUR, '%Y-%m-%d') AS "DateFormat", """ + PARTS.format(
    c="(o_orderdate + INTERVAL 7 HOUR)"
)


def NO_TEXT(names: str) -> str:
    """Columns that do not land, as nulls."""
    return ", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n in names.split())


def ZERO(kind: str, names: str) -> str:
    """Numbers that do not land, as zeros."""
    return ", ".join(f"CAST(0 AS {kind}) AS {n}" for n in names.split())


ORDER_LINE = (
    f"""SELECT {LINE_ID} AS order_detail_id, CAST(o_orderkey AS VARCHAR) AS order_id,
            CAST(l_partkey AS VARCHAR) AS item_id, CAST(trunc(l_quantity) AS BIGINT) AS quantity,
            l_extendedprice AS amount, CAST(0 AS DOUBLE) AS price, {{branch}} AS branch_id,
            {NO_TEXT("item_name unit_name")}, o_orderdate + INTERVAL 7 HOUR AS order_date, {LOCAL_DAY}
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)

PAYMENT_COLUMNS = f"""'PAY-' || o_orderkey AS invoice_payment_id, CAST(o_orderkey AS VARCHAR) AS ref_id,
            o_orderpriority AS payment_name, o_totalprice AS amount, CAST(1 AS BIGINT) AS payment_type,
            o_orderdate + INTERVAL 7 HOUR AS ref_date, {LOCAL_DAY}, {NO_TEXT("card_name card_no")}"""
PAYMENT = f"SELECT {PAYMENT_COLUMNS}, {NO_TEXT('branch_id branch_name')} FROM orders"
PAYMENT_OF_STORE = (
    f"SELECT {PAYMENT_COLUMNS}, o_orderpriority AS branch_id, 'Store ' || o_orderpriority AS branch_name FROM orders"
)

STORED_ROWS = """SELECT table_name, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d') AS report_date, count(*){times} AS n_rows
          FROM (SELECT unnest(['order_header', 'order_detail', 'invoice_header', 'invoice_detail', 'invoice_payment'])
                AS table_name, ts FROM events) GROUP BY 1, 2"""

MARTS = """WITH event AS (
            SELECT strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d') AS report_date, event_id, event_type, value, ts,
              CASE event_type WHEN 'signup' THEN 'Online' WHEN 'purchase' THEN 'Counter' WHEN 'view' THEN ''
                ELSE event_type END AS branch_name FROM events WHERE {landed}),
          revenue AS (
            SELECT report_date, branch_name, count(DISTINCT event_id) AS total_orders,
              round(sum(value), 2) AS total_revenue, round(sum(value) / count(DISTINCT event_id), 6) AS aov
            FROM event WHERE value > 0 GROUP BY report_date, branch_name),
          lines AS (
            SELECT report_date, branch_name, count(*) AS n_lines, round(sum(value + 0.5), 2) AS sold
            FROM event WHERE event_type <> 'error' GROUP BY report_date, branch_name)
          SELECT report_date, branch_name, total_orders, total_revenue, aov, n_lines, sold
          FROM revenue LEFT JOIN lines USING (report_date, branch_name)"""


HISTORY = """WITH snapshot AS (
            SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN p_partkey % 5 <> 0 THEN p_name END AS product_name,
              p_retailprice + CAST(floor(day / 4) AS BIGINT) * (p_partkey % 3) AS price, n,
              DATE '2024-01-01' + CAST(day - 1 AS INTEGER) AS day, DATE '2024-01-01' + CAST(later - 1 AS INTEGER) AS later
            FROM part, (SELECT day, row_number() OVER (ORDER BY day) AS n, lead(day) OVER (ORDER BY day) AS later
                        FROM (SELECT unnest([1, 2, 3, 5, 6, 7, 8, 10, 11]) AS day))
            WHERE (p_partkey + day) % 7 <> 0),
          island AS (
            SELECT *, n - row_number() OVER (PARTITION BY product_id, product_name, price ORDER BY n) AS start FROM snapshot)
          SELECT product_id, product_name, price, min(day) AS valid_from,
            CASE WHEN max(n) < 9 THEN max(later) END AS valid_until
          FROM island GROUP BY product_id, product_name, price, start"""


def _check(name: str, level: str, count: str) -> str:
    return (
        f"'{name}' AS check_name, '{level}' AS level, CAST({count} AS BIGINT) AS violations, {count} = 0 AS passed"
    )


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


ORACLE: dict[str, str] = {
    # --- marts
    "revenue_daily": _with(HEADER) + REVENUE.format(source="header"),
    "sales_lines": _with(HEADER, DETAIL, SALES) + "SELECT * FROM sales",
    "revenue_daily_dedupe": _with(HEADER, LATER_HEADER) + REVENUE.format(source="later"),
    "revenue_daily_copies": _with(HEADER, "twice AS (SELECT * FROM header UNION ALL SELECT * FROM header)")
    + REVENUE.format(source="twice"),
    "sales_lines_dedupe": _with(HEADER, DETAIL, LATER_HEADER, LATER_DETAIL, LINE_WORTH.format(lines="later_detail"))
    + SOLD.format(invoices="later"),
    "sales_lines_bucketed": _with(HEADER, DETAIL, LATER_HEADER, LATER_DETAIL, LINE_WORTH.format(lines="later_detail"))
    + SOLD.format(invoices="later"),
    "hourly_bucket": "SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%H') AS report_hour FROM events",
    # --- staging
    "dedup_order_header": """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
            CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS order_date,
            CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE o_totalprice + 1 END AS total_amount,
            CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS order_status,
            CAST(1 AS INTEGER) AS row_num FROM orders""",
    "dedup_order_detail": """SELECT * FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY order_detail_id ORDER BY order_date DESC NULLS LAST,
              order_id DESC, item_id DESC, quantity DESC, amount DESC) AS INTEGER) AS row_num
          FROM (SELECT concat_ws('-', l_orderkey, l_linenumber) AS order_detail_id,
                  CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS item_id,
                  CAST(trunc(l_quantity) AS BIGINT) AS quantity, l_extendedprice AS amount,
                  l_shipdate AS order_date FROM lineitem)) WHERE row_num = 1""",
    "dedup_invoice_header": _with(HEADER, LATER_HEADER)
    + "SELECT ref_id, branch_name, total_amount, ref_date, report_date FROM later",
    "dedup_invoice_detail": _with(DETAIL, LATER_DETAIL)
    + "SELECT ref_id, ref_detail_id, item_id, quantity, amount, ref_date FROM later_detail",
    "latest_master": """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
            p_retailprice + 21 AS price, '2024-01-21' AS report_date FROM part""",
    "hash_pii": """SELECT c_custkey, upper(md5(c_name)) AS by_column, upper(md5(c_name)) AS by_sql,
            CASE WHEN c_acctbal > 0 THEN upper(md5('Nguyễn ' || c_name)) END AS of_null FROM customer""",
    "mask_pii": """SELECT c_custkey, upper(md5(c_name)) AS c_name, upper(md5(c_mktsegment)) AS c_mktsegment
            FROM customer""",
    "stg_customer": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_mktsegment AS customer_code,
            upper(md5(c_name)) AS customer_name_hashed,
            CASE WHEN c_acctbal >= 0 THEN upper(md5('+84' || c_custkey)) END AS customer_tel_hashed,
            'Đường ' || c_nationkey AS address, '2024-02-01' AS report_date FROM customer""",
    "stg_product": """SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_size AS VARCHAR) AS product_code,
            p_name AS product_name, p_brand AS unit_name, p_retailprice AS price, p_type AS category_name,
            p_size > 25 AS is_active, '2024-02-01' AS report_date, NOT (p_size > 25) AS active_fixed FROM part""",
    "stg_passthrough": PAYMENT,
    "staging_views": f"""SELECT upper(md5(c_name)) AS customer_name_hashed, count(DISTINCT o_orderkey) AS n_orders,
            count(DISTINCT o_orderkey) AS n_invoices, count(DISTINCT o_orderkey) AS n_payments,
            count(DISTINCT {LINE_ID}) FILTER (l_orderkey IS NOT NULL) AS n_order_lines,
            count(DISTINCT {LINE_ID}) FILTER (l_orderkey IS NOT NULL) AS n_invoice_lines, count(DISTINCT p_partkey) AS n_products
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
          LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey
          GROUP BY c_name""",
    # --- standardizing
    "branch_enrich": _with(EVENT)
    + f"""SELECT CAST(event_id AS VARCHAR) AS "Id", {MAPPED} AS "BranchName",
            coalesce(own_name, branch_id) AS "UnmappedName" FROM event""",
    "business_date": _with(EVENT)
    + """SELECT CAST(event_id AS VARCHAR) AS "Id", strftime(local_ts, '%Y-%m-%d') AS "DateFormat" FROM event""",
    "rename_project": _with(EVENT)
    + """SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
            CASE event_type WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
              WHEN 'purchase' THEN strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+07:00'
              WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') WHEN 'click' THEN strftime(ts, '%Y-%m-%d')
              ELSE strftime(ts, '%d/%m/%Y') END AS order_date,
            CASE event_type WHEN 'signup' THEN CAST(value AS VARCHAR) WHEN 'purchase' THEN ' ' || value || ' '
              WHEN 'view' THEN 'abc' WHEN 'error' THEN 'nan' END AS total_amount,
            CASE event_type WHEN 'signup' THEN CAST(user_id AS VARCHAR) WHEN 'purchase' THEN user_id || '.7'
              WHEN 'view' THEN '-' || user_id || '.7' WHEN 'click' THEN '1e3' ELSE 'inf' END AS order_type,
            branch_id AS brand_id, own_name AS branch_name, CAST(NULL AS VARCHAR) AS customer_tel,
            CAST(NULL AS VARCHAR) AS customer_name, CAST(NULL AS VARCHAR) AS order_status,
            CAST(NULL AS VARCHAR) AS shipping_address, CAST(NULL AS VARCHAR) AS employee_id FROM event""",
    "rename_passthrough": "SELECT * FROM orders",
    "cast_numeric": _with(EVENT)
    + """SELECT CAST(event_id AS VARCHAR) AS "Id", amount AS total_amount, kind AS order_type FROM event""",
    "cast_timestamp": _with(EVENT)
    + """SELECT CAST(event_id AS VARCHAR) AS "Id", local_ts AS order_date FROM event""",
    "cast_string": """SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_size AS VARCHAR) AS product_code,
            p_name AS product_name, p_size > 25 AS inactive, CAST(NULL AS VARCHAR) AS category_id FROM part""",
    "partition_master": """SELECT CAST(p_partkey AS VARCHAR) AS product_id, '2024-02-01' AS report_date,
            CAST(2024 AS INTEGER) AS year, CAST(2 AS INTEGER) AS month, CAST(1 AS INTEGER) AS day FROM part""",
    "partition_trans": _with(EVENT) + f"SELECT CAST(event_id AS VARCHAR) AS order_id, {EVENT_PARTS} FROM event",
    "partition_fallback": f"""SELECT CAST(event_id AS VARCHAR) AS ref_id, {PARTS.format(c="(ts + INTERVAL 7 HOUR)")} FROM events
          UNION ALL SELECT 'x' || event_id, '2024-02-01', 2024, 2, 1 FROM events""",
    "transform_order_header": _with(EVENT)
    + f"""SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id, local_ts AS order_date,
            amount AS total_amount, kind AS order_type, branch_id AS brand_id, {MAPPED} AS branch_name,
            CAST(NULL AS VARCHAR) AS customer_tel, CAST(NULL AS VARCHAR) AS customer_name,
            CAST(NULL AS VARCHAR) AS order_status, CAST(NULL AS VARCHAR) AS shipping_address,
            CAST(NULL AS VARCHAR) AS employee_id, strftime(local_ts, '%Y-%m-%d') AS "DateFormat", {EVENT_PARTS}
          FROM event""",
    "transform_invoice_header": f"""SELECT CAST(o_orderkey AS VARCHAR) AS ref_id, CAST(o_custkey AS VARCHAR) AS customer_id,
            o_orderpriority AS branch_id, 'Store ' || o_orderpriority AS branch_name,
            CAST(CASE WHEN o_orderstatus = 'P' THEN 4 ELSE 1 END AS BIGINT) AS payment_status,
            o_totalprice AS total_amount, o_orderdate + INTERVAL 7 HOUR AS ref_date, {LOCAL_DAY},
            {NO_TEXT("employee_id customer_tel employee_name ref_no promotion_name cancel_reason customer_name description")},
            {ZERO("DOUBLE", "tip_amount card_amount sale_amount delivery_amount cash_amount voucher_amount discount_amount "
                            "promotion_amount service_amount total_item_amount promotion_items_amount vat_amount")},
            {ZERO("BIGINT", "used_point add_point number_of_people ref_type total_item order_type")} FROM orders""",
    "transform_order_detail": ORDER_LINE.format(branch="o_orderpriority"),
    "transform_invoice_detail": f"""SELECT {LINE_ID} AS ref_detail_id, CAST(o_orderkey AS VARCHAR) AS ref_id,
            CAST(l_partkey AS VARCHAR) AS item_id, CAST(trunc(l_quantity) AS BIGINT) AS quantity, l_extendedprice AS amount,
            o_orderpriority AS branch_id, 'Store ' || o_orderpriority AS branch_name, CAST(o_custkey AS VARCHAR) AS customer_id,
            o_orderdate + INTERVAL 7 HOUR AS ref_date, {LOCAL_DAY},
            {NO_TEXT("item_name promotion_name order_detail_id item_code unit_name")},
            {ZERO("DOUBLE", "tax_amount promotion_amount pre_tax_amount sainvoice_promotion_amount allocation_amount unit_price "
                            "allocation_delivery_promotion_amount")},
            {ZERO("BIGINT", "ref_detail_type promotion_type")}
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "transform_invoice_payment": PAYMENT_OF_STORE,
    # --- nested documents
    "nest_children": """SELECT CAST(o_orderkey AS VARCHAR) AS "RefId", count(l_orderkey) AS n_details,
            CAST(1 AS BIGINT) AS n_payments, coalesce(sum(l_quantity), 0) AS sum_quantity
          FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
    "nest_children_split": f"""SELECT CAST(o_orderkey AS VARCHAR) AS "OrderId", {LINE_ID} AS line_id,
            CAST(l_partkey AS VARCHAR) AS "ItemId", l_quantity AS "Quantity"
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL FROM orders""",
    "nest_land_roundtrip": """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(1 AS BIGINT) AS n_headers,
            count(l_orderkey) AS n_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
    "flatten_orders": f"""SELECT {LINE_ID} AS "Id", CAST(l_partkey AS VARCHAR) AS "ItemId", l_quantity AS "Quantity",
            l_extendedprice AS "Amount", o_orderstatus AS "BranchName", CAST(o_orderkey AS VARCHAR) AS "OrderId",
            {ISO} AS "OrderDate", o_orderpriority AS "BranchId"
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "flatten_invoice_details": f"""SELECT {LINE_ID} AS "RefDetailId", CAST(l_partkey AS VARCHAR) AS "ItemID",
            l_quantity AS "Quantity", l_extendedprice AS "Amount", CAST(o_orderkey AS VARCHAR) AS "RefID",
            {ISO} AS "RefDate", o_orderpriority AS "BranchId", 'Store ' || o_orderpriority AS "BranchName",
            CAST(o_custkey AS VARCHAR) AS "CustomerId"
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "flatten_invoice_payments": f"""SELECT 'PAY-' || o_orderkey AS "SAInvoicePaymentID", o_totalprice AS "Amount",
            o_orderpriority AS "PaymentName", CAST(1 AS INTEGER) AS "PaymentType", CAST(o_orderkey AS VARCHAR) AS "RefID",
            {ISO} AS "RefDate", o_orderpriority AS "BranchId", 'Store ' || o_orderpriority AS "BranchName",
            CAST(o_custkey AS VARCHAR) AS "CustomerId" FROM orders""",
    "normalize_payload": f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, {LINE_ID} AS line_id,
            CAST(l_partkey AS VARCHAR) AS item_id, CAST(trunc(l_quantity) AS BIGINT) AS quantity
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('O', 'F')""",
    "read_nested_json": ORDER_LINE.format(branch="o_orderpriority"),
    "read_json_arrays": ORDER_LINE.format(branch="o_orderpriority"),
    "master_snapshot": """SELECT 'product' AS table_name, CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
            CAST(p_size AS VARCHAR) AS code, p_retailprice AS price, p_size > 25 AS inactive,
            '2024-02-01' AS report_date FROM part
          UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment, NULL, NULL, '2024-02-01'
          FROM customer""",
    "missing_day_empty": "SELECT count(*) AS n_landed, CAST(0 AS BIGINT) AS n_missing FROM events",
    "empty_input": "SELECT CAST(0 AS INTEGER) AS n_written, count(*) AS n_orders FROM orders",
    # --- extract
    "cutoff_filter": """SELECT event_id FROM events WHERE event_type IN ('click', 'error')
            OR (event_type = 'signup' AND ts < TIMESTAMP '2024-01-16')
            OR (event_type IN ('purchase', 'view') AND ts + INTERVAL 1 DAY < TIMESTAMP '2024-01-16')""",
    "branch_scope": """SELECT CAST(event_id AS VARCHAR) AS "Id", 'one' AS scope FROM events WHERE event_type = 'click'
          UNION ALL SELECT CAST(event_id AS VARCHAR), 'all' FROM events""",
    "accepted_pages": "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment <> 'MACHINERY'",
    "extract_orders": f"""SELECT CAST(o_orderkey AS VARCHAR) AS "OrderId", {LINE_ID} AS line_id,
            CAST(l_partkey AS VARCHAR) AS "ItemId", {ISO} AS "OrderDate", o_orderpriority AS "BranchId"
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('O', 'F')
            AND o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '1999-01-01'""",
    "extract_invoices": """SELECT CAST(o_orderkey AS VARCHAR) AS "RefId", o_orderpriority AS "BranchId",
            CAST(count(l_orderkey) AS INTEGER) AS n_details,
            CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS INTEGER) AS n_payments
          FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND o_orderstatus <> 'P'
          WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY o_orderkey, o_orderpriority, o_orderstatus""",
    # --- incremental
    "incremental_lookback": _with(HEADER)
    + "SELECT ref_id, ref_date, total_amount FROM header WHERE ref_date >= TIMESTAMP '1998-07-29'",
    "high_water_mark": _with(HEADER)
    + """SELECT ref_id, report_date, total_amount FROM header WHERE report_date >=
            (SELECT max(report_date) FROM header WHERE ref_date < TIMESTAMP '1998-01-01')""",
    "high_water_empty_target": _with(HEADER) + "SELECT branch_name, count(*) AS n_rows FROM header GROUP BY branch_name",
    "merge_upsert": _with(HEADER, DETAIL, SALES)
    + """, source AS (SELECT order_id, item_id, max(report_date) AS report_date, CAST(sum(quantity) + 1000 AS BIGINT) AS quantity
            FROM sales WHERE report_date >= DATE '1997-07-01' GROUP BY order_id, item_id)
          SELECT order_id, item_id, report_date, quantity FROM sales t WHERE report_date < DATE '1998-01-01'
            AND NOT EXISTS (SELECT 1 FROM source s WHERE s.order_id = t.order_id AND s.item_id = t.item_id)
          UNION ALL SELECT order_id, item_id, report_date, quantity FROM source""",
    "merge_replace": _with(HEADER, DETAIL, SALES)
    + """, source AS (SELECT order_id, item_id, report_date, quantity + 1000 AS quantity
            FROM sales WHERE report_date >= DATE '1997-07-01')
          SELECT order_id, item_id, report_date, quantity FROM sales t WHERE report_date < DATE '1998-01-01'
            AND NOT EXISTS (SELECT 1 FROM source s WHERE s.order_id = t.order_id)
          UNION ALL SELECT * FROM source""",
    "duplicate_merge_keys": _with(HEADER, DETAIL, SALES)
    + "SELECT order_id, item_id, count(*) AS n_rows FROM sales GROUP BY order_id, item_id HAVING count(*) > 1",
    "sales_incremental": INCREMENT.format(
        header=HEADER, detail=DETAIL, sales=SALES, since="report_date >= (SELECT max(report_date) FROM old)"
    ),
    "sales_repair": INCREMENT.format(header=HEADER, detail=DETAIL, sales=SALES, since="true"),
    "gap_days": """SELECT CAST(day AS DATE) AS gap_day, 'orders' AS table_name
          FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY)) AS day FROM orders)
          WHERE CAST(day AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
          UNION ALL SELECT CAST(day AS DATE), 'events'
          FROM (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-02-05', INTERVAL 1 DAY)) AS day)
          WHERE CAST(day AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)""",
    # --- quality
    "dq_count_match": _with(FLAWED)
    + f"""SELECT {_check("row_count:order_header", "error", "count_if(total_amount < 0)")} FROM flawed
          UNION ALL SELECT {_check("row_count:invoice_header", "error", "count_if(false)")} FROM flawed""",
    "dq_pk_null_empty": _with(FLAWED)
    + f"""SELECT {_check("key_present:order_id", "error", "count_if(order_id IS NULL OR order_id = '')")} FROM flawed
          UNION ALL SELECT {_check("key_present:ref_detail_id", "error", "count_if(l_orderkey IS NULL)")} FROM lineitem""",
    "dq_negative_amount": _with(FLAWED)
    + f"SELECT {_check('not_negative:total_amount', 'warn', 'count_if(total_amount < 0)')} FROM flawed",
    "dq_not_null": _with(HEADER, DETAIL, FLAWED_SALES)
    + " UNION ALL ".join(
        f"SELECT {_check(f'not_null:{c}', 'error', f'count_if({c} IS NULL)')} FROM flawed"
        for c in ("order_id", "item_id", "report_date", "net_revenue_inclusive")
    ),
    "dq_future_date": "SELECT "
    + _check("not_future:order_date", "error", "count_if(o_orderdate > TIMESTAMP '1998-01-01')")
    + " FROM orders",
    "dq_negative_revenue": _with(HEADER, DETAIL, FLAWED_SALES)
    + f"SELECT {_check('not_negative:net_revenue_inclusive', 'error', 'count_if(net_revenue_inclusive < 0)')} FROM flawed",
    "dq_summary": _with(FLAWED)
    + """SELECT 'flawed' AS batch, count_if(order_id IS NULL OR order_id = '') = 0 AS verdict FROM flawed
          UNION ALL SELECT 'warned', true""",
    "dq_gate": _with(FLAWED)
    + """SELECT 'key_present:order_id' AS check_name, 'error' AS level,
            CAST(count_if(order_id IS NULL OR order_id = '') AS BIGINT) AS violations FROM flawed
          UNION ALL SELECT 'not_negative:total_amount', 'warn', CAST(count_if(total_amount < 0) AS BIGINT) FROM flawed""",
    "profile_nonnull": _with(FLAWED)
    + """SELECT count(*) AS n_rows, count(order_id) AS order_id_nonnull, count(customer_id) AS customer_id_nonnull,
            count(total_amount) AS total_amount_nonnull FROM flawed""",
    # --- sinks
    "sink_append_evolve": _with(EVENT_TABLE)
    + """SELECT *, CAST(NULL AS VARCHAR) AS channel FROM rows
          UNION ALL SELECT *, upper(branch_name) FROM rows""",
    "sink_partition_overwrite": _with(EVENT_TABLE)
    + """SELECT ref_id, branch_name, CASE WHEN day BETWEEN 10 AND 12 THEN total_amount + 1000 ELSE total_amount END
            AS total_amount, year, month, day FROM rows
          WHERE NOT (day BETWEEN 10 AND 12) OR branch_name = 'purchase'""",
    "sink_flat": _with(EVENT_TABLE)
    + "SELECT ref_id, branch_name, total_amount + 1000 AS total_amount, year, month, day FROM rows",
    "sink_multi_table": STORED_ROWS.format(times=""),
    "sink_full_refresh": _with(HEADER)
    + """SELECT branch_name, year, month, CAST(count(DISTINCT ref_id) AS BIGINT) AS total_orders,
            round(sum(total_amount), 2) AS total_revenue FROM header
          WHERE total_amount > 0 AND branch_name <> 'NATION_0' GROUP BY branch_name, year, month""",
    "sink_merge": _with(HEADER, DETAIL, SALES)
    + """, source AS (SELECT order_id, item_id, CAST(report_date + INTERVAL 1 MONTH AS DATE) AS report_date, quantity
            FROM sales WHERE report_date >= DATE '1997-07-01'),
          merged AS (SELECT order_id, item_id, report_date, quantity FROM sales t WHERE report_date < DATE '1998-01-01'
              AND NOT EXISTS (SELECT 1 FROM source s WHERE s.order_id = t.order_id)
            UNION ALL SELECT * FROM source)
          SELECT *, CAST(year(report_date) AS INTEGER) AS year, CAST(month(report_date) AS INTEGER) AS month FROM merged""",
    "merge_interrupted": _with(HEADER, DETAIL, SALES)
    + """, source AS (SELECT order_id, item_id, report_date, quantity + 1000 AS quantity
            FROM sales WHERE report_date >= DATE '1997-07-01'),
          base AS (SELECT order_id, item_id, report_date, quantity FROM sales WHERE report_date < DATE '1998-01-01')
          SELECT *, 'before' AS read FROM base
          UNION ALL SELECT *, 'after' FROM base t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.order_id = t.order_id)
          UNION ALL SELECT *, 'after' FROM source""",
    # --- streaming and jobs
    "stream_ingest": f"""SELECT 'L' || event_id AS order_detail_id, CAST(event_id AS VARCHAR) AS order_id,
            CAST(user_id AS VARCHAR) AS item_id, CAST(2 AS BIGINT) AS quantity, value AS amount, CAST(0 AS DOUBLE) AS price,
            event_type AS branch_id, event_type AS brand_id, CAST(user_id AS VARCHAR) AS customer_id, value AS total_amount,
            {NO_TEXT("item_name unit_name")}, ts + INTERVAL 7 HOUR AS order_date,
            strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d') AS "DateFormat", {PARTS.format(c="(ts + INTERVAL 7 HOUR)")} FROM events""",
    "stream_archive_all_tables": STORED_ROWS.format(times=""),
    "stream_then_batch": STORED_ROWS.format(times=" * 2"),
    "daily_build": MARTS.format(landed="true"),
    "first_day_without_invoices": MARTS.format(landed="ts >= TIMESTAMP '2024-01-02'"),
    "interrupted_build": MARTS.format(landed="true"),
    "backfill_range": MARTS.format(landed="ts < TIMESTAMP '2024-01-25'"),
    "revenue_incremental": f"""SELECT report_date, branch_name, CAST(left(report_date, 4) AS INTEGER) AS year,
            CAST(substring(report_date, 6, 2) AS INTEGER) AS month, total_orders, total_revenue, aov
          FROM ({MARTS.format(landed="true")})""",
    "corrected_invoice_fewer_lines": _with(HEADER, DETAIL, LINE_WORTH.format(lines="detail"))
    + """SELECT strftime(ref_date + INTERVAL 1 DAY, '%Y-%m-%d') AS report_date, branch_name, count(*) AS n_lines,
            round(sum(before_tax + tax), 4) AS sold, round(sum(before_tax + tax), 4) AS total_revenue
          FROM header JOIN (SELECT ref_id, before_tax, tax FROM worth
                            WHERE CAST(split_part(ref_detail_id, '-', -1) AS INTEGER) % 2 = 1) USING (ref_id)
          WHERE payment_status <> 4 GROUP BY 1, 2""",
    # --- loads, history
    "load_dies_between_tables": MARTS.format(landed="ts < TIMESTAMP '2024-01-21'"),
    "load_repeated": STORED_ROWS.format(times=""),
    "stream_relanded": STORED_ROWS.format(times=""),
    "backfill_changed_days": MARTS.format(landed="ts < TIMESTAMP '2024-01-25'"),
    "two_writers": _with(HEADER, DETAIL, SALES)
    + """, source AS (SELECT order_id, item_id, report_date, quantity + 1000 AS quantity
            FROM sales WHERE report_date >= DATE '1997-07-01')
          SELECT * FROM (SELECT order_id, item_id, report_date, quantity FROM sales WHERE report_date < DATE '1998-01-01') t
          WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.order_id = t.order_id)
          UNION ALL SELECT * FROM source""",
    "corrected_to_earlier_day": _with(HEADER)
    + """SELECT ref_id, ref_date - INTERVAL 3 DAY AS ref_date, strftime(ref_date - INTERVAL 3 DAY, '%Y-%m-%d') AS report_date,
            total_amount + 1 AS total_amount FROM header""",
    "revenue_by_deltas": """WITH event AS (
            SELECT strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d') AS report_date,
              CASE event_type WHEN 'signup' THEN 'Online' WHEN 'purchase' THEN 'Counter' WHEN 'view' THEN '' ELSE event_type END AS branch_name,
              CASE WHEN ts < TIMESTAMP '2024-01-06' OR ts >= TIMESTAMP '2024-01-26' THEN value
                   WHEN event_type = 'purchase' THEN -value ELSE value + 1 END AS taken
            FROM events WHERE event_type <> 'click' OR ts >= TIMESTAMP '2024-01-06')
          SELECT report_date, branch_name, CAST(left(report_date, 4) AS INTEGER) AS year,
            CAST(substring(report_date, 6, 2) AS INTEGER) AS month, count(*) AS total_orders,
            round(sum(taken), 2) AS total_revenue, round(sum(taken) / count(*), 6) AS aov
          FROM event WHERE taken > 0 GROUP BY report_date, branch_name""",
    "master_history": HISTORY,
    "master_history_extended": HISTORY,
    "sales_asof_product": """WITH line AS (
            SELECT *, least(23, (year(l_shipdate) - 1995) * 4 + quarter(l_shipdate) - 1) AS q FROM lineitem)
          SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS ref_detail_id, CAST(l_partkey AS VARCHAR) AS item_id,
            l_shipdate AS ref_date, CAST(trunc(l_quantity) AS BIGINT) AS quantity,
            p_retailprice + CAST(floor(q / (1 + p_partkey % 4)) AS BIGINT) AS price
          FROM line LEFT JOIN part ON p_partkey = l_partkey AND q >= 0 AND (p_partkey + q) % 9 <> 0""",
    "gap_stretches": """WITH branch AS (
            SELECT branch_name, CAST(DATE '2023-12-26' + CAST(length(branch_name) AS INTEGER) AS DATE) AS opened
            FROM (SELECT DISTINCT event_type AS branch_name FROM events UNION ALL SELECT 'closed')),
          missing AS (
            SELECT branch_name, day FROM (
              SELECT branch_name, CAST(unnest(generate_series(opened, DATE '2024-02-03', INTERVAL 1 DAY)) AS DATE) AS day FROM branch) c
            WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = c.branch_name AND CAST(e.ts AS DATE) = c.day
              AND (day(e.ts) + length(e.event_type)) % 6 < 2)),
          island AS (
            SELECT *, day - CAST(row_number() OVER (PARTITION BY branch_name ORDER BY day) AS INTEGER) AS start FROM missing)
          SELECT branch_name, min(day) AS first_day, max(day) AS last_day, count(*) AS n_days FROM island GROUP BY branch_name, start""",
    "dq_quarantine": _with(HEADER, DETAIL, FLAWED_SALES)
    + """SELECT order_id, item_id, report_date, failed, failed <> '' AS held FROM (
            SELECT *, concat_ws(',', CASE WHEN order_id IS NULL THEN 'not_null:order_id' END,
              CASE WHEN item_id IS NULL THEN 'not_null:item_id' END, CASE WHEN report_date IS NULL THEN 'not_null:report_date' END,
              CASE WHEN net_revenue_inclusive IS NULL THEN 'not_null:net_revenue_inclusive' END,
              CASE WHEN net_revenue_inclusive < 0 THEN 'not_negative:net_revenue_inclusive' END) AS failed FROM flawed)""",
}
