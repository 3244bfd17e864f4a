"""The expected result of every query as SQL on the given tables, without JSON, XML or streams."""

from __future__ import annotations

from orderflow import schemas as S

# ------------------------------------------------------------------ what the wire derivation says

_LINES = """
lines AS (
  SELECT l_orderkey AS k, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag,
    l_linestatus, l_shipdate, CAST(l_quantity AS INTEGER) AS sold_qty,
    CASE WHEN l_orderkey % 61 = 0 AND l_linenumber = 1 THEN 0
         ELSE CAST(l_quantity AS INTEGER) END AS qty,
    ROW_NUMBER() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag,
        l_linestatus, l_shipdate) - 1 AS idx,
    COUNT(*) OVER (PARTITION BY l_orderkey) AS n
  FROM lineitem),
sums AS (
  SELECT k, COUNT(*) AS n, SUM(sold_qty * CAST(l_extendedprice AS DECIMAL(18,2))) AS total,
    SUM(qty) AS qty, COUNT(*) FILTER (WHERE l_returnflag = 'A') AS altered
  FROM lines GROUP BY k)
"""

_ORDER_TYPE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'RETAIL' WHEN '2-HIGH' THEN 'TAILORED'
      WHEN '3-MEDIUM' THEN 'CUSTOM' WHEN '4-NOT SPECIFIED' THEN 'RENTAL' WHEN '5-LOW' THEN 'ECOM' END"""
_EVENT_TYPE = """CASE o_orderstatus WHEN 'O' THEN 'ORDER_CREATED' WHEN 'F' THEN 'ORDER_UPDATED'
      WHEN 'P' THEN 'ORDER_CANCELLED' END"""
_STORE = "LPAD(CAST(o_custkey % 50 AS VARCHAR), 4, '0')"

_ORDERS = (
    _LINES
    + f""",
line_problems AS (
  SELECT k, STRING_AGG(problem, '; ' ORDER BY idx, rule) AS problems FROM (
    SELECT k, idx, 1 AS rule, 'order.lines[' || idx || '].quantity must be >= 1' AS problem
    FROM lines WHERE qty < 1
    UNION ALL
    SELECT k, idx, 2, 'order.lines[' || idx ||
      '].alteration block is required when fulfillmentType == ALTERATION'
    FROM lines WHERE l_returnflag = 'A' AND l_partkey % 53 = 0) p
  GROUP BY k),
sent AS (
  SELECT o.o_orderkey AS k, o_custkey, o_orderdate,
    o_orderdate + TO_MINUTES(CAST(o.o_orderkey % 1440 AS INTEGER)) AS moment,
    o_orderdate + TO_MINUTES(CAST(o.o_orderkey % 1440 AS INTEGER))
      + TO_SECONDS(CAST(o.o_orderkey % 90 AS INTEGER)) AS published,
    CASE WHEN o.o_orderkey % 37 = 0 THEN 'ORDER_PLACED' ELSE {_EVENT_TYPE} END AS event_type,
    {_ORDER_TYPE} AS order_type,
    CASE WHEN o.o_orderkey % 41 <> 0 THEN {_STORE} END AS store_id,
    CASE WHEN o.o_orderkey % 43 = 0 THEN -5.0 ELSE CAST(COALESCE(s.total, 0) AS DOUBLE) END AS total,
    COALESCE(s.n, 0) AS n, COALESCE(s.qty, 0) AS qty, COALESCE(s.altered, 0) AS altered,
    p.problems
  FROM orders o LEFT JOIN sums s ON s.k = o.o_orderkey LEFT JOIN line_problems p ON p.k = o.o_orderkey),
reasons AS (
  SELECT *,
    CASE WHEN k % 47 = 0 THEN 'JSON parse error: malformed document'
         WHEN k % 73 = 0 THEN 'empty payload'
         WHEN k % 79 = 0 THEN 'JSON parse error: not a number in a numeric field' END AS parse_error,
    CONCAT_WS('; ',
      CASE WHEN k % 37 = 0 THEN
        'eventType ''ORDER_PLACED'' not in [ORDER_CANCELLED, ORDER_CREATED, ORDER_UPDATED]' END,
      CASE WHEN k % 59 = 0 THEN 'eventTime must be an RFC-3339 timestamp, got '''
        || STRFTIME(moment, '%Y-%m-%dT%H:%M:%S') || '''' END,
      CASE WHEN k % 67 = 0 THEN
        'source ''FAX'' not in [LEGACY_SOAP_ADAPTER, ORDER_INTAKE_API, REPLAY, TIBCO_EMS_BRIDGE]' END,
      CASE WHEN store_id IS NULL THEN 'order.storeId is required' END,
      CASE WHEN total < 0 THEN 'order.totalAmount must be >= 0, got -5.0' END,
      CASE WHEN k % 71 = 0 THEN 'order.promisedDate must be an ISO date (yyyy-MM-dd)' END,
      CASE WHEN event_type = 'ORDER_CREATED' AND n = 0 THEN
        'order.lines must not be empty for ORDER_CREATED' END,
      problems) AS problems_text
  FROM sent),
judged AS (
  SELECT *,
    CASE WHEN parse_error IS NOT NULL THEN 'PARSE' WHEN problems_text <> '' THEN 'VALIDATE' END AS stage,
    CASE WHEN parse_error IS NOT NULL THEN parse_error
         WHEN LENGTH(problems_text) > 1000 THEN SUBSTR(problems_text, 1, 1000) || '...'
         WHEN problems_text <> '' THEN problems_text END AS reason
  FROM reasons)
"""
)

_STORES = """
places AS (
  SELECT DISTINCT c_custkey % 50 AS s FROM customer),
stores AS (
  SELECT LPAD(CAST(s AS VARCHAR), 4, '0') AS store_id, n_name AS store_name,
    CASE WHEN s % 11 <> 0 THEN r_name END AS region,
    CASE WHEN s % 11 <> 0 AND s % 7 <> 0 THEN 'Etc/UTC' END AS timezone
  FROM places JOIN nation ON n_nationkey = s % 25 JOIN region ON r_regionkey = n_regionkey
  WHERE s % 10 NOT IN (4, 9))
"""

_INVENTORY = (
    _LINES
    + f""",
line_problems AS (
  SELECT k, STRING_AGG(problem, '; ' ORDER BY idx, rule) AS problems FROM (
    SELECT k, idx, 1 AS rule, 'lines[' || idx || '].sku is required' AS problem
    FROM lines WHERE l_partkey % 89 = 0
    UNION ALL
    SELECT k, idx, 2, 'lines[' || idx || '].status ''LOST'' not in [BACKORDERED, RELEASED, RESERVED]'
    FROM lines WHERE l_suppkey % 97 = 0) p
  GROUP BY k),
places_of AS (
  SELECT k, STRING_AGG('L-' || l_suppkey, ',' ORDER BY idx) AS locations, SUM(sold_qty) AS sold
  FROM lines GROUP BY k),
judged AS (
  SELECT o_orderkey AS k,
    o_orderdate + TO_MINUTES(CAST(o_orderkey % 1440 AS INTEGER)) AS moment,
    {_STORE} AS store_id, COALESCE(s.n, 0) AS n, pl.sold, pl.locations,
    CASE o_orderstatus WHEN 'O' THEN 'INVENTORY_RESERVED' WHEN 'F' THEN 'INVENTORY_RELEASED'
      WHEN 'P' THEN 'INVENTORY_BACKORDERED' END AS event_type,
    CASE WHEN o_orderkey % 47 = 0 THEN 'JSON parse error: malformed document'
      ELSE NULLIF(CONCAT_WS('; ',
        CASE WHEN o_orderkey % 31 = 0 THEN 'eventId is required' END,
        CASE WHEN o_orderkey % 37 = 0 THEN 'eventType ''INVENTORY_LOST'' not in '
          || '[INVENTORY_BACKORDERED, INVENTORY_RELEASED, INVENTORY_RESERVED]' END,
        CASE WHEN o_orderkey % 29 = 0 THEN 'orderId is required' END,
        CASE WHEN COALESCE(s.n, 0) = 0 THEN 'lines must not be empty' END,
        p.problems), '') END AS whole_reason
  FROM orders LEFT JOIN sums s ON s.k = o_orderkey LEFT JOIN line_problems p ON p.k = o_orderkey
    LEFT JOIN places_of pl ON pl.k = o_orderkey),
staged AS (
  SELECT *,
    CASE WHEN k % 47 = 0 THEN 'PARSE' WHEN whole_reason IS NOT NULL THEN 'VALIDATE' END AS stage,
    CASE WHEN LENGTH(whole_reason) > 1000 THEN SUBSTR(whole_reason, 1, 1000) || '...'
      ELSE whole_reason END AS reason
  FROM judged)
"""
)

_SHIPMENTS = """
shipped AS (
  SELECT *, CONCAT_WS('-', 's', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS message_id,
    l_shipdate + TO_SECONDS(CAST(l_partkey % 3600 AS INTEGER)) AS published,
    NULLIF(CONCAT_WS('; ',
      CASE WHEN l_partkey % 101 = 0 THEN 'trackingNumber is required' END,
      CASE WHEN l_suppkey % 17 = 0 THEN 'carrier is required' END,
      CASE WHEN l_partkey % 103 = 0 THEN 'status ''LOST'' not in '
        || '[DELIVERED, EXCEPTION, IN_TRANSIT, LABEL_CREATED, OUT_FOR_DELIVERY]' END,
      CASE WHEN l_partkey % 19 = 0 THEN 'statusTime must be an RFC-3339 timestamp' END), '') AS reason
  FROM lineitem),
accepted AS (
  SELECT 'shp-' || l_orderkey || '-' || l_linenumber AS event_id,
    CASE WHEN l_linestatus = 'O' THEN 'SHIPMENT_CREATED' ELSE 'SHIPMENT_UPDATED' END AS event_type,
    l_shipdate + TO_MILLISECONDS(250) AS event_time, message_id, published,
    'ORD-' || l_orderkey AS order_id, '1Z' || l_partkey AS tracking_number,
    CASE WHEN l_suppkey % 2 = 0 THEN 'UPS' ELSE 'FEDEX' END AS carrier,
    CASE l_returnflag WHEN 'A' THEN 'DELIVERED' WHEN 'N' THEN 'IN_TRANSIT' WHEN 'R' THEN 'EXCEPTION' END AS status,
    CASE WHEN l_partkey % 2 = 0 THEN l_shipdate + TO_MILLISECONDS(250) END AS status_time,
    'Dock ' || l_suppkey AS location
  FROM shipped WHERE reason IS NULL)
"""

_DEAD = (
    _ORDERS
    + ", inventory AS (WITH "
    + _INVENTORY
    + " SELECT * FROM staged), "
    + _SHIPMENTS
    + """,
dead AS (
  SELECT 'orders-v1' AS original_topic, stage, reason, 'm-' || k AS message_id, event_type AS attribute,
    '{"eventType":"' || event_type || '"' || COALESCE(',"storeId":"' || store_id || '"', '') || '}' AS attributes_json,
    published AS failed_at
  FROM judged WHERE stage IS NOT NULL
  UNION ALL
  SELECT 'inventory-v1', stage, reason, 'i-' || k, event_type, '{"eventType":"' || event_type || '"}', moment
  FROM inventory WHERE stage IS NOT NULL
  UNION ALL
  SELECT 'shipments-v1', 'VALIDATE', reason, message_id, l_returnflag, '{"carrier":"' || l_returnflag || '"}', published
  FROM shipped WHERE reason IS NOT NULL)
"""
)

_ARRIVED = """
arrived AS (
  SELECT LPAD(CAST(user_id % 20 AS VARCHAR), 4, '0') AS store_id, event_id, value,
    event_id % 3 AS alterations, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS rentals,
    ts, EPOCH_MS(ts) AS at_ms, (EPOCH_MS(ts) // 3600000 + 1) * 3600000 AS end_ms,
    (event_id + CASE WHEN event_id % 7 = 0 THEN (event_id % 11) * 40 ELSE 0 END) // 200 AS batch
  FROM events)
"""


_PANES = (
    _ARRIVED
    + """,
halves AS (
  SELECT store_id, end_ms, 'EARLY' AS pane_timing, COUNT(*) - 1 AS pane_index, FALSE AS is_last, COUNT(*) AS orders,
    SUM(CAST(value AS DECIMAL(18,2))) AS revenue, SUM(alterations) AS alterations, SUM(rentals) AS rentals
  FROM arrived WHERE MINUTE(ts) < 30 GROUP BY 1, 2
  UNION ALL
  SELECT store_id, end_ms, 'ON_TIME', COUNT(*), TRUE, COUNT(*), SUM(CAST(value AS DECIMAL(18,2))),
    SUM(alterations), SUM(rentals)
  FROM arrived GROUP BY 1, 2),
panes AS (
  SELECT store_id, MAKE_TIMESTAMP((end_ms - 3600000) * 1000) AS window_start,
    MAKE_TIMESTAMP(end_ms * 1000) AS window_end, pane_timing,
    CAST(pane_index AS BIGINT) AS pane_index, is_last, CAST(orders AS BIGINT) AS orders,
    CAST(revenue AS DOUBLE) AS revenue, CAST(alterations AS BIGINT) AS alteration_lines,
    CAST(rentals AS BIGINT) AS rental_orders
  FROM halves)
"""
)
_PANE_COLUMNS = """store_id, STRFTIME(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
  STRFTIME(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, pane_timing, pane_index, is_last,
  orders, revenue, alteration_lines, rental_orders"""

_LEGACY = (
    _LINES
    + f""",
extract AS (
  SELECT o_orderkey AS k, o_orderkey // 100 AS file, o_custkey, o_orderdate,
    {_ORDER_TYPE} AS order_type, {_STORE} AS store, COALESCE(s.n, 0) AS n,
    COALESCE(s.total, 0) AS total, o_orderkey % 17 = 0 AND COALESCE(s.n, 0) >= 2 AS shortened
  FROM orders LEFT JOIN sums s ON s.k = o_orderkey
  WHERE o_orderstatus = 'O' AND o_orderkey % 11 <> 0),
filed AS (
  SELECT *, 'extract-' || LPAD(CAST(file AS VARCHAR), 8, '0') || '.xml' AS source_file,
    ROW_NUMBER() OVER (PARTITION BY file ORDER BY k) - CASE WHEN file % 23 = 13 THEN 0 ELSE 1 END AS position,
    CASE WHEN shortened THEN n - 1 ELSE n END AS kept
  FROM extract),
contents AS (
  SELECT *, CASE WHEN k % 29 = 0 THEN '' ELSE 'ORD-' || k END AS order_nbr,
    CASE WHEN k % 13 = 0 THEN total + 10 WHEN shortened THEN total END AS explicit_total
  FROM filed
  WHERE file % 23 NOT IN (7, 8, 9, 10, 11)
    OR (file % 23 = 9 AND NOT EXISTS (
      SELECT 1 FROM filed f JOIN lines l ON l.k = f.k AND l.idx < f.kept WHERE f.file = filed.file))),
legacy AS (
  SELECT * REPLACE (CAST(order_nbr AS VARCHAR) AS order_nbr), 'C-' || o_custkey AS cust,
    COALESCE(explicit_total, total) AS effective FROM contents
  UNION ALL BY NAME
  SELECT DISTINCT source_file, file, 0 AS position, 0 AS kept, 0 AS effective FROM contents WHERE file % 23 = 13)
"""
)

_LANDED = (
    _LINES
    + f""",
versions AS (
  SELECT o_orderkey AS k, 0 AS copy FROM orders UNION ALL
  SELECT o_orderkey, 1 FROM orders WHERE o_orderkey % 23 = 0),
landed AS (
  SELECT v.k, 'ORD-' || v.k AS order_id,
    CASE WHEN v.k % 31 <> 0 THEN {_EVENT_TYPE} END AS event_type,
    CASE WHEN v.k % 7 <> 0 THEN STRFTIME(o_orderdate + TO_MINUTES(CAST(v.k % 1440 AS INTEGER))
      - TO_SECONDS(v.copy), '%Y-%m-%dT%H:%M:%S') || 'Z' END AS event_time,
    {_STORE} AS store_id, CAST(COALESCE(s.total, 0) - v.copy AS DOUBLE) AS total_amount,
    COALESCE(s.n, 0) AS n, s.n AS listed
  FROM versions v JOIN orders ON o_orderkey = v.k LEFT JOIN sums s ON s.k = v.k
  WHERE v.k % 19 <> 0 AND v.k % 97 <> 0),
latest AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
      ORDER BY event_time DESC NULLS LAST, total_amount DESC, n DESC, store_id DESC) AS rn
    FROM landed WHERE (event_type IS NULL OR event_type = 'ORDER_CREATED') AND k % 101 <> 0) r
  WHERE rn = 1)
"""
)

_RECONCILED = (
    _LANDED
    + ", old AS (WITH "
    + _LEGACY
    + """ SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_nbr ORDER BY source_file, position) AS rn
        FROM legacy WHERE order_nbr <> '') x WHERE rn = 1),
sides AS (
  SELECT COALESCE(l.order_nbr, e.order_id) AS order_id, l.order_nbr IS NOT NULL AS in_legacy,
    e.order_id IS NOT NULL AS in_events, CAST(l.effective AS DOUBLE) AS legacy_total,
    e.total_amount AS pubsub_total,
    CAST(l.effective - CAST(e.total_amount AS DECIMAL(18,2)) AS DOUBLE) AS amount_diff,
    CAST(l.kept AS BIGINT) AS legacy_line_count, CAST(e.n AS BIGINT) AS pubsub_line_count,
    l.store AS legacy_store, e.store_id AS pubsub_store, l.source_file
  FROM old l FULL OUTER JOIN latest e ON e.order_id = l.order_nbr),
results AS (
  SELECT *, CASE WHEN NOT in_events THEN 'MISSING_IN_PUBSUB' WHEN NOT in_legacy THEN 'MISSING_IN_LEGACY'
    WHEN ABS(amount_diff) > 0.01 THEN 'AMOUNT_MISMATCH'
    WHEN legacy_line_count <> pubsub_line_count THEN 'LINE_COUNT_MISMATCH' ELSE 'MATCH' END AS classification
  FROM sides)
"""
)

_TIME_TEXTS = """
shapes AS (
  SELECT event_id, event_id % 17 AS shape, STRFTIME(ts, '%Y-%m-%d') AS day,
    STRFTIME(ts, '%H:%M:%S') AS clock, STRFTIME(ts, '%H:%M') AS minute, ts
  FROM events)
"""


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(part.strip() for part in parts) + " "


ORACLES: dict[str, str] = {
    "order_csv_lines": f"""
      SELECT {_STORE} AS store_id, CASE WHEN o_orderkey % 67 = 0 THEN 9000000000000000000 ELSE CAST(FLOOR(o_totalprice * 100 + 0.5) AS BIGINT) END AS cents FROM orders
      WHERE o_orderkey % 43 <> 0 AND (o_orderkey % 53 <> 0 OR o_orderkey % 67 = 0) AND o_orderkey % 59 <> 0 AND o_orderkey % 61 <> 0""",
    "revenue_per_store": f"""
      SELECT store_id, (cents // 100) || '.' || LPAD(CAST(cents % 100 AS VARCHAR), 2, '0') AS revenue FROM (
        SELECT {_STORE} AS store_id, SUM(CASE WHEN o_orderkey % 67 = 0 THEN 9000000000000000000 ELSE CAST(FLOOR(o_totalprice * 100 + 0.5) AS BIGINT) END) AS cents
        FROM orders
        WHERE o_orderkey % 43 <> 0 AND (o_orderkey % 53 <> 0 OR o_orderkey % 67 = 0) AND o_orderkey % 59 <> 0 AND o_orderkey % 61 <> 0
        GROUP BY 1) t""",
    "parse_orders": _with(_ORDERS)
    + """SELECT 'm-' || k AS message_id, parse_error,
        CASE WHEN parse_error IS NULL THEN 'evt-' || k END AS event_id,
        CASE WHEN parse_error IS NULL THEN total END AS total_amount,
        CASE WHEN parse_error IS NULL AND n > 0 THEN n END AS lines FROM judged""",
    "validate_orders": _with(_ORDERS) + "SELECT 'm-' || k AS message_id, stage, reason FROM judged",
    "validate_inventory": _with(_INVENTORY) + "SELECT 'i-' || k AS message_id, stage, reason FROM staged",
    "validate_shipments": _with(_SHIPMENTS)
    + "SELECT message_id, CASE WHEN reason IS NOT NULL THEN 'VALIDATE' END AS stage, reason FROM shipped",
    "split_valid": _with(_ORDERS)
    + "SELECT COALESCE(stage, 'VALID') AS outcome, COUNT(*) AS messages FROM judged GROUP BY 1",
    "store_reference": _with(_STORES) + "SELECT * FROM stores",
    "enrich_with_store": _with(_ORDERS, _STORES)
    + """SELECT 'm-' || k AS message_id, store_id, store_name, region, timezone
      FROM judged LEFT JOIN stores USING (store_id) WHERE stage IS NULL""",
    "order_events": _with(_ORDERS, _STORES)
    + """SELECT 'evt-' || k AS event_id, event_type, STRFTIME(moment, '%Y-%m-%d %H:%M:%S') AS event_time,
        '1' AS schema_version, CASE WHEN k % 3 = 0 THEN 'REPLAY' ELSE 'ORDER_INTAKE_API' END AS source,
        'corr-' || k AS correlation_id, CAST(NULL AS VARCHAR) AS legacy_message_id, 'm-' || k AS message_id,
        STRFTIME(published, '%Y-%m-%d %H:%M:%S') AS publish_time, 'ORD-' || k AS order_id, order_type,
        CASE WHEN k % 2 = 0 THEN 'STORE' ELSE 'WEB' END AS channel, store_id, store_name, region,
        'C-' || o_custkey AS customer_id, STRFTIME(moment, '%Y-%m-%d %H:%M:%S') AS ordered_at,
        STRFTIME(o_orderdate + TO_DAYS(7), '%Y-%m-%d') AS promised_date, 'USD' AS currency,
        total AS total_amount, n AS line_count, altered AS alteration_line_count,
        order_type = 'RENTAL' AS is_rental, CAST(qty AS BIGINT) AS line_quantity,
        CASE WHEN order_type = 'RENTAL' THEN '{"eventId":"WED-' || k || '","eventDate":"2026-10-18"}' END AS rental_json,
        CASE WHEN order_type = 'ECOM' THEN '{"name":"Customer ' || o_custkey || '","country":"US"}' END AS ship_to_json
      FROM judged LEFT JOIN stores USING (store_id) WHERE stage IS NULL AND k % 83 <> 0""",
    "order_lines": _with(_ORDERS, _STORES)
    + """SELECT 'evt-' || k AS event_id, event_type, STRFTIME(moment, '%Y-%m-%d %H:%M:%S') AS event_time,
        'ORD-' || k AS order_id, order_type, CASE WHEN k % 2 = 0 THEN 'STORE' ELSE 'WEB' END AS channel,
        store_id, region, CAST(l_linenumber AS BIGINT) AS line_number, 'SKU-' || l_partkey AS sku,
        CAST(l.qty AS BIGINT) AS quantity, l_extendedprice AS unit_price, l.qty * l_extendedprice AS line_amount,
        CASE l_returnflag WHEN 'A' THEN 'ALTERATION' WHEN 'R' THEN 'SHIP_TO_HOME' WHEN 'N' THEN 'STORE_PICKUP' END
          AS fulfillment_type,
        CASE WHEN l_returnflag = 'A' THEN 'HEM' END AS alteration_type,
        CASE WHEN l_returnflag = 'A' THEN l_linenumber + CAST(30.5 AS DOUBLE) END AS alteration_measurement_inches,
        CASE WHEN l_returnflag = 'A' THEN 'TS-' || l_suppkey END AS tailor_shop_id
      FROM judged JOIN lines l USING (k) LEFT JOIN stores USING (store_id)
      WHERE stage IS NULL AND k % 83 <> 0""",
    "inventory_events": _with(_INVENTORY)
    + """SELECT 'inv-' || k AS event_id, event_type, STRFTIME(moment, '%Y-%m-%d %H:%M:%S') AS event_time,
        'i-' || k AS message_id, STRFTIME(moment, '%Y-%m-%d %H:%M:%S') AS publish_time, 'ORD-' || k AS order_id,
        store_id, n AS line_count, CAST(sold AS BIGINT) AS line_quantity, locations
      FROM staged WHERE stage IS NULL""",
    "shipment_events": _with(_SHIPMENTS)
    + """SELECT event_id, event_type, STRFTIME(event_time, '%Y-%m-%d %H:%M:%S.%g') AS event_time, message_id,
        STRFTIME(published, '%Y-%m-%d %H:%M:%S') AS publish_time, order_id, tracking_number, carrier, status,
        STRFTIME(status_time, '%Y-%m-%d %H:%M:%S.%g') AS status_time, location FROM accepted""",
    "dead_letter_rows": _with(_DEAD)
    + """SELECT original_topic, stage, reason, message_id, attributes_json,
        STRFTIME(failed_at, '%Y-%m-%d %H:%M:%S') AS failed_at FROM dead""",
    "dlq_messages": _with(_DEAD)
    + """SELECT SUBSTR(reason, 1, 900) AS dlq_reason, stage AS dlq_stage, original_topic,
        message_id AS original_message_id, STRFTIME(failed_at, '%Y-%m-%dT%H:%M:%S') || 'Z' AS dlq_failed_at,
        attribute AS kept_attribute FROM dead""",
    "dead_letter_counts": _with(_DEAD) + """SELECT stage, reason, COUNT(*) AS "count" FROM dead GROUP BY 1, 2""",
    "dead_letter_top_reasons": _with(_DEAD)
    + """SELECT original_topic, stage, SUBSTR(reason, 1, 80) AS reason, COUNT(*) AS c FROM dead
      WHERE failed_at > TIMESTAMP '2001-07-19 12:00:00' GROUP BY 1, 2, 3 ORDER BY c DESC""",
    "rejected_rows": _with(_ORDERS)
    + """SELECT 'bigquery:order_events' AS original_topic, 'BIGQUERY_WRITE' AS stage,
        'column event_time is no timestamp: ''' || event_time || '''' AS reason, event_id, event_time,
        'order_events' AS table_name, CAST(NULL AS VARCHAR) AS message_id FROM (
        SELECT 'evt-' || k AS event_id, '+1' || STRFTIME(moment, '%Y-%m-%dT%H:%M:%S') || 'Z' AS event_time
        FROM judged WHERE stage IS NULL AND k % 83 = 0) r""",
    "rejected_table_rows": "WITH orders_in AS (WITH " + _ORDERS
    + """ SELECT 'order_lines' AS t, 'evt-' || k AS row_key, '+1' || STRFTIME(moment, '%Y-%m-%dT%H:%M:%S') || 'Z' AS late
        FROM judged JOIN lines l USING (k) WHERE stage IS NULL AND k % 83 = 0),
      inventory_in AS (WITH """ + _INVENTORY
    + """ SELECT 'inventory_events' AS t, 'inv-' || k AS row_key, '+1' || STRFTIME(moment, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS late
        FROM staged WHERE stage IS NULL AND k % 83 = 0),
      shipments_in AS (WITH """ + _SHIPMENTS
    + """ SELECT 'shipment_events' AS t, 'shp-' || l_orderkey || '-' || l_linenumber AS row_key,
          '+1' || STRFTIME(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '.250Z' AS late
        FROM shipped WHERE reason IS NULL AND l_partkey % 83 = 0),
      panes_in AS (WITH """ + _PANES
    + """ SELECT 'store_order_metrics' AS t, STRFTIME(window_start, '%Y-%m-%dT%H:%M:%SZ') AS row_key, CAST(NULL AS VARCHAR) AS late
        FROM panes WHERE store_id = '0007')
      SELECT 'bigquery:' || t AS original_topic, 'BIGQUERY_WRITE' AS stage, row_key,
        CASE WHEN late IS NULL THEN 'missing required column store_id'
          ELSE 'column event_time is no timestamp: ' || CHR(39) || late || CHR(39) END AS reason
      FROM (SELECT * FROM orders_in UNION ALL SELECT * FROM inventory_in UNION ALL SELECT * FROM shipments_in
        UNION ALL SELECT * FROM panes_in) u""",
    "store_metrics": _with(_ORDERS)
    + """SELECT store_id, STRFTIME(d, '%Y-%m-%d %H:%M:%S') AS window_start,
        STRFTIME(d + TO_DAYS(1), '%Y-%m-%d %H:%M:%S') AS window_end, orders, revenue, alteration_lines, rental_orders
      FROM (SELECT store_id, DATE_TRUNC('day', published) + TO_SECONDS(0) AS d, COUNT(*) AS orders,
          CAST(SUM(CAST(total AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
          CAST(SUM(altered) AS BIGINT) AS alteration_lines,
          COUNT(*) FILTER (WHERE order_type = 'RENTAL') AS rental_orders
        FROM judged WHERE stage IS NULL AND event_type = 'ORDER_CREATED' GROUP BY 1, 2) t""",
    "store_metrics_minutes": _with(_ORDERS)
    + """SELECT store_id, STRFTIME(d, '%Y-%m-%d %H:%M:%S') AS window_start,
        STRFTIME(d + TO_MINUTES(1), '%Y-%m-%d %H:%M:%S') AS window_end, orders, revenue, alteration_lines, rental_orders
      FROM (SELECT store_id, DATE_TRUNC('minute', published) AS d, COUNT(*) AS orders,
          CAST(SUM(CAST(total AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
          CAST(SUM(altered) AS BIGINT) AS alteration_lines,
          COUNT(*) FILTER (WHERE order_type = 'RENTAL') AS rental_orders
        FROM judged WHERE stage IS NULL AND event_type = 'ORDER_CREATED' GROUP BY 1, 2) t""",
    "metric_panes": _with(_PANES) + f"SELECT {_PANE_COLUMNS} FROM panes",
    "latest_panes": _with(_PANES)
    + f"""SELECT {_PANE_COLUMNS} FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY store_id, window_start ORDER BY pane_index DESC) AS rn
        FROM panes WHERE window_start >= TIMESTAMP '2024-01-20 00:00:00') t WHERE rn = 1""",
    "recent_metrics": _with(_PANES)
    + """SELECT store_id, STRFTIME(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, pane_timing, orders, revenue
      FROM (SELECT * FROM panes ORDER BY panes.window_start DESC, pane_index DESC, store_id LIMIT 20) t""",
    "legacy_files": _with(_LEGACY)
    + """SELECT f.source_file, c.n IS NULL AND f.file % 23 <> 11 AS failed,
        CASE WHEN c.n IS NOT NULL THEN c.n WHEN f.file % 23 = 11 THEN 0 END AS orders
      FROM (SELECT DISTINCT source_file, file FROM filed) f
      LEFT JOIN (SELECT source_file, COUNT(*) AS n FROM legacy GROUP BY 1) c USING (source_file)""",
    "legacy_orders": _with(_LEGACY)
    + """SELECT source_file, position, order_nbr, order_type, store AS store_nbr, cust AS cust_nbr,
        STRFTIME(o_orderdate, '%d/%m/%Y') AS order_date, CAST(explicit_total AS DOUBLE) AS total_amount,
        kept AS line_count, COALESCE(t.line_texts, '') AS line_texts
      FROM legacy LEFT JOIN (
        SELECT k, STRING_AGG(CONCAT_WS('/', 'SKU-' || l_partkey, CAST(sold_qty AS VARCHAR),
            CASE WHEN l_suppkey % 2 = 0 THEN CASE l_returnflag WHEN 'A' THEN 'ALTERATION'
              WHEN 'R' THEN 'SHIP_TO_HOME' WHEN 'N' THEN 'STORE_PICKUP' END END), ';' ORDER BY idx) AS line_texts
        FROM lines WHERE NOT (k % 17 = 0 AND n >= 2 AND idx = n - 1) GROUP BY k) t USING (k)""",
    "legacy_rows": _with(_LEGACY)
    + """SELECT '1998-01-05' AS extract_date, source_file AS extract_file, order_nbr, order_type,
        store AS store_nbr, cust AS cust_nbr, STRFTIME(o_orderdate, '%d/%m/%Y') AS order_date,
        CAST(effective AS DOUBLE) AS total_amount, kept AS line_count FROM legacy WHERE order_nbr IS NOT NULL""",
    "landed_jsonl": _with(_LANDED)
    + """SELECT order_id, event_type, event_time, store_id,
        CASE WHEN k % 101 = 0 THEN CAST(0 AS DOUBLE) ELSE total_amount END AS total_amount, CASE WHEN k % 3 <> 0 THEN CAST(n AS VARCHAR) END AS line_count, listed AS lines FROM landed""",
    "unreadable_events": _with(_LANDED)
    + f"""SELECT '{S.REJECTED_TOPIC_PREFIX}order_events' AS original_topic, '{S.STAGE_PARSE}' AS stage,
        'total or line count is no number, order ' || order_id AS reason, 'n/a' AS total
      FROM landed WHERE (event_type IS NULL OR event_type = 'ORDER_CREATED') AND k % 101 = 0""",
    "landed_day": _with(_ORDERS)
    + """SELECT 'ORD-' || k AS order_id, store_id, event_type,
        STRFTIME(moment, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS event_time, total AS total_amount, n AS line_count
      FROM judged WHERE stage IS NULL AND k % 83 <> 0 AND event_type = 'ORDER_CREATED'
        AND moment >= TIMESTAMP '1998-01-05' AND moment < TIMESTAMP '1998-01-06'""",
    "summarize_events": _with(_LANDED)
    + """SELECT order_id, total_amount AS pubsub_total, n AS pubsub_line_count, store_id AS pubsub_store FROM latest""",
    "reconcile_orders": _with(_RECONCILED)
    + """SELECT '1998-01-05' AS run_date, order_id, classification, legacy_total, pubsub_total, amount_diff,
        legacy_line_count, pubsub_line_count, legacy_store, pubsub_store,
        CASE classification
          WHEN 'MISSING_IN_PUBSUB' THEN 'order present in legacy OMS extract ' || source_file
            || ' but no ORDER_CREATED event in BigQuery'
          WHEN 'MISSING_IN_LEGACY' THEN 'ORDER_CREATED event in BigQuery but order absent from legacy OMS extract'
          WHEN 'AMOUNT_MISMATCH' THEN PRINTF('legacy total %.2f vs pubsub total %.2f (tolerance %.2f)',
            legacy_total, pubsub_total, CAST(0.01 AS DOUBLE))
          WHEN 'LINE_COUNT_MISMATCH' THEN 'legacy lines ' || legacy_line_count || ' vs pubsub lines ' || pubsub_line_count
          END AS detail
      FROM results""",
    "reconciliation_rows": _with(_RECONCILED)
    + """SELECT '1998-01-05' AS run_date, 'run-2' AS run_id, '1998-01-06 02:00:00' AS checked_at, order_id, classification, legacy_total, pubsub_total, amount_diff,
        legacy_line_count, pubsub_line_count, legacy_store, pubsub_store,
        CASE classification
          WHEN 'MISSING_IN_PUBSUB' THEN 'order present in legacy OMS extract ' || source_file
            || ' but no ORDER_CREATED event in BigQuery'
          WHEN 'MISSING_IN_LEGACY' THEN 'ORDER_CREATED event in BigQuery but order absent from legacy OMS extract'
          WHEN 'AMOUNT_MISMATCH' THEN PRINTF('legacy total %.2f vs pubsub total %.2f (tolerance %.2f)',
            legacy_total, pubsub_total, CAST(0.01 AS DOUBLE))
          WHEN 'LINE_COUNT_MISMATCH' THEN 'legacy lines ' || legacy_line_count || ' vs pubsub lines ' || pubsub_line_count
          END AS detail
      FROM results""",
    "scorecard_report": _with(_RECONCILED)
    + """SELECT '1998-01-05' AS run_date, classification, COUNT(*) AS "count" FROM results GROUP BY 2""",
    "order_event_days": _with(_ORDERS)
    + """SELECT 'ORD-' || k AS order_id, store_id, event_type,
        STRFTIME(moment, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS event_time, total AS total_amount, n AS line_count
      FROM judged WHERE stage IS NULL AND k % 83 <> 0 AND event_type = 'ORDER_CREATED'""",
    "scorecard": _with(_RECONCILED)
    + """SELECT '1998-01-05' AS run_date, classification, COUNT(*) AS "count" FROM results GROUP BY 2""",
    "daily_scorecard": _with(_RECONCILED)
    + """SELECT '1998-01-05' AS run_date, classification, COUNT(*) AS orders FROM results GROUP BY 2""",
    "dedupe_events": _with(_SHIPMENTS)
    + """SELECT event_id, message_id, STRFTIME(published, '%Y-%m-%d %H:%M:%S') AS publish_time FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY published, message_id) AS rn FROM accepted) t
      WHERE rn = 1""",
    "latency": _with(_SHIPMENTS)
    + """SELECT event_type, COUNT(*) AS events,
        AVG((EPOCH_US(published) - EPOCH_US(event_time)) / 1e6) AS avg_publish_seconds,
        MAX((EPOCH_US(published) - EPOCH_US(event_time)) / 1e6) AS max_publish_seconds,
        CAST(90.0 AS DOUBLE) AS avg_ingest_seconds, CAST(90.0 AS DOUBLE) AS max_ingest_seconds
      FROM accepted GROUP BY 1""",
    "table_days": _with(_PANES)
    + """SELECT STRFTIME(window_start, '%Y-%m-%d') AS window_date, COUNT(*) AS panes,
        COUNT(DISTINCT store_id) AS stores, CAST(SUM(orders) AS BIGINT) AS orders FROM panes GROUP BY 1""",
    "table_jsonl": _with(_ORDERS)
    + """SELECT 'ORD-' || k AS order_id, store_id AS pubsub_store,
        CASE WHEN k % 83 = 0 THEN '+1' ELSE '' END || STRFTIME(moment, '%Y-%m-%dT%H:%M:%S') || 'Z' AS event_time,
        total AS pubsub_total, n AS pubsub_line_count
      FROM judged WHERE stage IS NULL AND event_type = 'ORDER_CREATED'""",
    "kafka_messages": """
      SELECT 'orders-v1-' || (event_id % 8) || '-' || event_id AS message_id,
        STRFTIME(ts, '%Y-%m-%d %H:%M:%S') AS publish_time, event_type, CAST(user_id AS VARCHAR) AS store_id,
        props AS payload FROM events""",
    "time_checks": _with(_TIME_TEXTS)
    + """SELECT event_id,
        COALESCE(shape IN (0, 1, 2, 10, 16) OR (shape = 6 AND MONTH(ts) IN (1, 3, 5, 7, 8, 10, 12)), FALSE) AS is_rfc3339,
        COALESCE(shape IN (5, 15) OR (shape = 14 AND MONTH(ts) IN (1, 3, 5, 7, 8, 10, 12)), FALSE) AS is_iso_date,
        shape = 12 AS is_blank,
        CASE WHEN shape IN (0, 1, 3, 4, 10) THEN STRFTIME(ts, '%Y-%m-%d %H:%M:%S')
          WHEN shape IN (5, 13) THEN STRFTIME(ts, '%Y-%m-%d') || ' 00:00:00'
          WHEN shape = 15 THEN '2024-02-29 00:00:00'
          WHEN shape = 14 AND MONTH(ts) IN (1, 3, 5, 7, 8, 10, 12) THEN STRFTIME(ts, '%Y-%m-31 00:00:00')
          WHEN shape = 2 THEN STRFTIME(DATE_TRUNC('minute', ts) - TO_MINUTES(330), '%Y-%m-%d %H:%M:%S')
          WHEN shape = 16 THEN STRFTIME(DATE_TRUNC('second', ts) - TO_HOURS(2), '%Y-%m-%d %H:%M:%S')
          WHEN shape = 6 AND MONTH(ts) IN (1, 3, 5, 7, 8, 10, 12) THEN
            STRFTIME(DATE_TRUNC('month', ts) + TO_DAYS(30) + (DATE_TRUNC('second', ts) - DATE_TRUNC('day', ts))
              + TO_HOURS(18), '%Y-%m-%d %H:%M:%S') END AS as_time
      FROM shapes""",
    "instant_texts": """
      SELECT event_id, STRFTIME(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS millis,
        STRFTIME(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS whole FROM events""",
    "lenient_numbers": """
      SELECT event_id, CASE event_id % 5 WHEN 0 THEN value WHEN 4 THEN -value ELSE 0 END AS as_double,
        CAST(CASE event_id % 5 WHEN 0 THEN TRUNC(value) WHEN 4 THEN -TRUNC(value) ELSE 0 END AS BIGINT) AS as_long,
        CASE WHEN cents IS NOT NULL THEN CASE WHEN cents < 0 THEN '-' ELSE '' END || (ABS(cents) // 100) || '.'
          || LPAD(CAST(ABS(cents) % 100 AS VARCHAR), 2, '0') END AS money,
        event_id % 5 = 3 AS is_not_number
      FROM (SELECT *, CASE event_id % 5 WHEN 0 THEN CAST(FLOOR(value * 100 + 0.5) AS BIGINT)
          WHEN 4 THEN CAST(FLOOR(-value * 100 + 0.5) AS BIGINT) END AS cents FROM events) e""",
    "cut_texts": """
      SELECT doc_id, MD5(CASE WHEN LENGTH(text) > 1000 THEN SUBSTR(text, 1, 1000) || '...' ELSE text END) AS shortened,
        MD5(SUBSTR(text, 1, 900)) AS capped, NOT REGEXP_MATCHES(text, '\\S') AS is_blank FROM documents""",
}
