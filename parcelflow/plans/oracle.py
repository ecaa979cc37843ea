"""The registered queries as plain SQL over the given tables.

Independent of the Spark code: the tables are joined flat, no nested envelope is
ever built. The shared prefix gives the envelopes of each order (``hdr``, one
row unless the order is longer than an envelope), its items in both generations
(``items``, ``items1``), the orders (``ord``) and the stock tables.
"""

from __future__ import annotations

from parcelflow.plans.catalog import BOUND, LOOKUP_PACKAGE, PARTITIONS, PROCESSED_AT, WITHIN
from parcelflow.sources import landing
from parcelflow.sources.landing import STOCK_TIME


def _hashed(prefix: str, *keys: str) -> str:
    """SQL of a row id: every key with its length before it."""
    texts = (f"CAST({k} AS VARCHAR)" for k in keys)
    return f"'{prefix}' || sha256(" + " || ".join(f"length({t}) || ':' || {t}" for t in texts) + ")"


def _share(shares: int) -> str:
    if shares == 1:
        return "CAST(0 AS BIGINT)"
    return f"""CAST('0x' || substr(md5(concat_ws('|', l_linenumber, l_partkey, l_suppkey,
        CAST(l_shipdate AS DATE), CAST(l_quantity AS BIGINT),
        CAST(floor(l_extendedprice * 100) AS BIGINT), CAST(floor(l_discount * 100) AS BIGINT),
        CAST(floor(l_tax * 100) AS BIGINT))), 1, 8) AS BIGINT) % {shares}"""


def _earlier(items: str, place: str) -> str:
    """Items written before: those of every second order under an older event, with mixed
    statuses; one product in five has left the range."""
    number, product = "CAST(substr(order_id, 5) AS BIGINT)", "CAST(substr(product_id, 5) AS BIGINT)"
    return f"""SELECT * REPLACE ({_hashed("inv-", "'old-' || event_id", "order_id", *place.split(","))} AS inventory_id,
    CASE {number} % 3 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'PROCESSING' ELSE 'INTERRUPTED' END AS status,
    CASE WHEN {product} % 5 = 0 THEN 'ret-' || {product} ELSE product_id END AS product_id)
  FROM {items} WHERE {number} % 2 = 0"""


def _prefix(shares: int) -> str:
    return f"""
WITH shares AS (
  SELECT l.*, {_share(shares)} AS part_nr FROM lineitem l
), li AS (
  SELECT l_orderkey, part_nr, CAST(l_quantity AS BIGINT) AS q, l_extendedprice,
    p_partkey, p_name, p_size,
    'ev-' || l_orderkey || CASE WHEN part_nr > 0 THEN '-' || part_nr ELSE '' END AS event_id,
    'ord-' || l_orderkey AS order_id,
    row_number() OVER (PARTITION BY l_orderkey, part_nr
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity) - 1
      AS item_pos
  FROM shares JOIN part ON p_partkey = l_partkey
), items AS (
  SELECT {_hashed("inv-", "event_id", "order_id", "item_pos", "i - 1")} AS inventory_id,
    item_pos, i - 1 AS package_pos, event_id, order_id, 'prd-' || p_partkey AS product_id, p_name AS product_name,
    l_extendedprice AS order_price, 'pkg-' || p_partkey AS package_id,
    CAST(i AS INTEGER) AS subpackage_id, CAST(q * i AS BIGINT) AS items_quantity,
    q * i * (p_size * CAST(0.5 AS DOUBLE)) AS items_weight,
    q * i * (p_size * CAST(0.25 AS DOUBLE)) AS items_volume,
    o_orderdate AS order_timestamp, 'PENDING' AS status,
    q AS order_quantity, i AS package_quantity, p_size, o_orderstatus
  FROM li JOIN orders ON o_orderkey = l_orderkey,
    LATERAL (SELECT unnest(range(1, p_size % 3 + 2)) AS i)
), items1 AS (
  SELECT {_hashed("inv-", "event_id", "order_id", "item_pos")} AS inventory_id,
    item_pos, event_id, order_id, 'prd-' || p_partkey AS product_id, p_name AS product_name, q AS quantity,
    l_extendedprice AS price, p_size * CAST(0.5 AS DOUBLE) AS weight,
    o_orderdate AS order_timestamp, 'PENDING' AS status
  FROM li JOIN orders ON o_orderkey = l_orderkey
), earlier AS (
  {_earlier("items", "item_pos,package_pos")}
), earlier1 AS (
  {_earlier("items1", "item_pos")}
), tot AS (
  SELECT event_id, sum(items_weight) AS w, sum(items_volume) AS v FROM items GROUP BY event_id
), cnt AS (
  SELECT event_id, count(*) AS n FROM li GROUP BY event_id
), hdr AS (
  SELECT 'ev-' || o_orderkey || CASE WHEN part_nr > 0 THEN '-' || part_nr ELSE '' END AS event_id,
    'ord-' || o_orderkey AS order_id, part_nr, o.*
  FROM (SELECT o_orderkey AS k, CAST(0 AS BIGINT) AS part_nr FROM orders
        UNION SELECT l_orderkey, part_nr FROM shares) JOIN orders o ON o_orderkey = k
), evt AS (
  SELECT event_id, 'ORDER_CREATED' AS event_type, o_orderdate AS event_timestamp, order_id FROM hdr
), ord AS (
  SELECT hdr.event_id, order_id, 'cus-' || o_custkey AS customer_id,
    coalesce(w, CAST(0 AS DOUBLE)) AS total_weight, coalesce(v, CAST(0 AS DOUBLE)) AS total_volume,
    CASE WHEN part_nr = 0 THEN o_totalprice ELSE 0 END AS total_price, o_orderdate AS order_timestamp,
    CASE o_orderstatus WHEN 'O' THEN 'RECEIVED' WHEN 'P' THEN 'PENDING' ELSE 'PROCESSING' END
      AS status,
    c_nationkey * CAST(1.5 AS DOUBLE) AS lat, c_nationkey * CAST(-2.25 AS DOUBLE) AS lon
  FROM hdr LEFT JOIN tot ON tot.event_id = hdr.event_id LEFT JOIN customer ON c_custkey = o_custkey
), pkg AS (
  SELECT 'pkg-' || p_partkey AS package_id, CAST(i AS INTEGER) AS subpackage_id,
    CAST(p_size * 30 AS BIGINT) AS stock_quantity
  FROM part, LATERAL (SELECT unnest(range(1, p_size % 3 + 2)) AS i)
), prd AS (
  SELECT 'prd-' || p_partkey AS product_id, CAST(p_size * 30 AS BIGINT) AS quantity,
    p_size % 2 = 0 AS availability, TIMESTAMP '{STOCK_TIME}' AS updated_at
  FROM part WHERE p_partkey % 7 <> 0
), demand AS (
  SELECT package_id, subpackage_id, CAST(sum(items_quantity) AS BIGINT) AS items_quantity
  FROM items GROUP BY package_id, subpackage_id
), outcome AS (
  SELECT inventory_id, order_id, i.product_id, p.product_id IS NOT NULL AS in_stock,
    CASE WHEN p.quantity >= i.quantity THEN p.quantity - i.quantity ELSE p.quantity END
      AS quantity_updated,
    coalesce(p.quantity >= i.quantity, FALSE) AS availability_updated,
    CASE WHEN p.quantity >= i.quantity THEN 'PROCESSING' ELSE 'INTERRUPTED' END AS status_updated
  FROM items1 i LEFT JOIN prd p ON p.product_id = i.product_id
), clicks AS (
  SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'
), purchases AS (
  SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'
), pairs AS (
  SELECT l.event_id AS click_id, l.user_id, l.ts AS clicked_at,
    r.event_id AS purchase_id, r.ts AS purchased_at
  FROM clicks l LEFT JOIN purchases r ON l.user_id = r.user_id
    AND l.ts BETWEEN r.ts - INTERVAL {WITHIN.seconds} SECOND AND r.ts + INTERVAL {WITHIN.seconds} SECOND
)
"""

_ORDER = """order_id, customer_id, total_weight, total_volume, total_price, order_timestamp,
  status, lat, lon"""
_ITEM = """inventory_id, order_id, product_id, product_name, order_price, package_id, subpackage_id,
  items_quantity, items_weight, items_volume, order_timestamp, status"""
_ITEM1 = """inventory_id, order_id, product_id, product_name, quantity, price, weight,
  order_timestamp, status"""
_SOLD = "product_id IN (SELECT product_id FROM items1)"
_RECEIVED_ORDER = "CASE WHEN status = 'RECEIVED' THEN 'PROCESSING' ELSE status END"

_EVENTS = "SELECT event_id, event_type, event_timestamp, order_id FROM evt"
_ORDERS = f"SELECT {_ORDER} FROM ord"
_ITEMS = f"SELECT {_ITEM} FROM items"
_STOCK = """SELECT package_id, subpackage_id,
  CASE WHEN stock_quantity >= items_quantity THEN stock_quantity - items_quantity
       ELSE stock_quantity END AS stock_quantity
FROM pkg LEFT JOIN demand USING (package_id, subpackage_id)"""
_SHORTAGE = """SELECT package_id, subpackage_id, stock_quantity, items_quantity
FROM pkg JOIN demand USING (package_id, subpackage_id) WHERE stock_quantity < items_quantity"""
_EARLIER = f"SELECT {_ITEM} FROM earlier"
_ITEMS_DONE = f"""SELECT * REPLACE ('PROCESSING' AS status) FROM ({_ITEMS}) UNION ALL {_EARLIER}"""
_STORED1 = f"(SELECT {_ITEM1} FROM items1 UNION ALL SELECT {_ITEM1} FROM earlier1)"
_BY_PRODUCT = f"""SELECT * REPLACE (
    CASE WHEN {_SOLD} THEN 'PROCESSING' ELSE status END AS status,
    CASE WHEN {_SOLD} THEN TIMESTAMP '{PROCESSED_AT}' ELSE order_timestamp END AS order_timestamp)
  FROM {_STORED1}"""
_ORDERS_DONE = f"SELECT * REPLACE ({_RECEIVED_ORDER} AS status) FROM ({_ORDERS})"


def _status_events(tag: str) -> str:
    quoted = f"'{tag}'"
    return f"""SELECT {_hashed("ev-", "order_id", "'INVENTORY_UPDATED'", quoted, "nr")}
    AS event_id, 'INVENTORY_UPDATED' AS event_type,
  TIMESTAMP '{PROCESSED_AT}' AS event_timestamp, order_id
FROM (SELECT order_id, row_number() OVER (PARTITION BY order_id) - 1 AS nr
      FROM ord WHERE status = 'RECEIVED')"""


_REVIEW = """SELECT i.order_id, total_weight AS order_total_weight, product_id, product_name,
  order_price, package_id, subpackage_id, p_size * CAST(0.5 AS DOUBLE) AS package_weight,
  p_size * CAST(0.25 AS DOUBLE) AS package_volume, order_quantity,
  CAST(package_quantity AS BIGINT) AS package_quantity, i.order_timestamp, ord.status
FROM items i JOIN ord ON ord.event_id = i.event_id"""

_UP_TO = f"{_EVENTS} WHERE event_timestamp <= TIMESTAMP '{BOUND}'"
_PROCESSED1 = f"(SELECT * FROM ({_BY_PRODUCT}) WHERE status = 'PROCESSING')"
_OUTCOME = """SELECT * EXCLUDE (in_stock) REPLACE (CAST(quantity_updated AS DOUBLE) AS quantity_updated)
  FROM outcome"""
_DEMAND = """SELECT package_id, subpackage_id, CAST(sum(items_quantity) AS BIGINT) AS items_quantity
  FROM (SELECT * FROM items UNION ALL SELECT * FROM earlier) {0} GROUP BY ALL"""

_NUMBER = "CAST(substr(order_id, 5) AS BIGINT)"


def _feed(rows: str, change: str) -> str:
    """Rows before and after, the latter with ``change``; ``feed_version`` comes with the rows."""
    return f"""SELECT *, 'update_preimage' AS change_type FROM ({rows})
  UNION ALL SELECT * REPLACE ({change}), 'update_postimage' FROM ({rows})"""


def _demand_of(part: int) -> str:
    return f"""SELECT package_id, subpackage_id, CAST(sum(items_quantity) AS BIGINT) AS d{part}
    FROM items WHERE {_NUMBER} % 2 = {part} GROUP BY ALL"""


_STOCK_FEED = f"""SELECT package_id, subpackage_id, s.q AS stock_quantity, change_type, feed_version
FROM (SELECT *, CASE WHEN stock_quantity >= d0 THEN stock_quantity - d0 ELSE stock_quantity END AS left0
      FROM pkg LEFT JOIN ({_demand_of(0)}) USING (package_id, subpackage_id)
        LEFT JOIN ({_demand_of(1)}) USING (package_id, subpackage_id)),
  LATERAL (SELECT unnest([stock_quantity, left0]) AS q, unnest(['update_preimage', 'update_postimage']) AS change_type,
      CAST(0 AS BIGINT) AS feed_version WHERE stock_quantity >= d0 AND d0 <> 0
    UNION ALL SELECT unnest([left0, left0 - d1]), unnest(['update_preimage', 'update_postimage']), 1
      WHERE left0 >= d1 AND d1 <> 0) s"""

_BODIES = {
    "ingest_json": """SELECT e.event_id, event_type, event_timestamp, order_id, customer_id,
        CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS order_date, CAST(coalesce(n, 0) AS INTEGER) AS n_items,
        'txn-' || substr(order_id, 5) AS transaction_id
      FROM evt e JOIN (SELECT event_id, customer_id FROM ord) USING (event_id)
        LEFT JOIN cnt USING (event_id)""",
    "decode_envelope": _ORDERS,
    "decode_base64": _ITEMS,
    "decode_rejected": "SELECT text FROM documents",
    "events_project": _EVENTS,
    "orders_flatten": _ORDERS,
    "orders_flatten_v1": f"SELECT * EXCLUDE (total_volume) FROM ({_ORDERS})",
    "orders_flatten_v1_date": f"""SELECT * EXCLUDE (total_volume, order_timestamp),
        CAST(CAST(order_timestamp AS DATE) AS VARCHAR) AS order_date FROM ({_ORDERS})""",
    "items_explode": _ITEMS,
    "items_explode_v1": f"SELECT {_ITEM1} FROM items1",
    "items_measures": """SELECT product_id, CAST(sum(items_quantity) AS BIGINT) AS items_quantity,
        sum(items_weight) AS items_weight, sum(items_volume) AS items_volume
      FROM items GROUP BY product_id""",
    "deterministic_ids": "SELECT inventory_id, order_id, package_id, subpackage_id FROM items",
    "item_review_all": _REVIEW,
    "item_review_lookup": f"{_REVIEW} WHERE package_id = '{LOOKUP_PACKAGE}'",
    "item_review_order": f"""{_REVIEW} WHERE package_id = '{LOOKUP_PACKAGE}' AND i.order_id =
        (SELECT 'ord-' || min(l_orderkey) FROM lineitem WHERE 'pkg-' || l_partkey = '{LOOKUP_PACKAGE}')""",
    "item_review_indexed": f"""{_REVIEW} WHERE i.order_id =
        (SELECT 'ord-' || min(l_orderkey) FROM lineitem WHERE 'pkg-' || l_partkey = '{LOOKUP_PACKAGE}')""",
    "batch_append": _EVENTS,
    "batch_overwrite": f"{_EVENTS} JOIN hdr USING (event_id) WHERE o_orderstatus <> 'P'".replace(
        "order_id FROM", "evt.order_id FROM"
    ),
    "delete_all": f"{_EVENTS} JOIN hdr USING (event_id) WHERE o_orderstatus = 'P'".replace(
        "order_id FROM", "evt.order_id FROM"
    ),
    "filter_pending": f"{_ORDERS} WHERE status = 'PENDING'",
    "filter_received": f"{_ORDERS} WHERE status = 'RECEIVED'",
    "filter_upto": _UP_TO,
    "count_unprocessed": "SELECT count(*) AS n FROM ord WHERE status <> 'PROCESSING'",
    "package_demand": _DEMAND.format("WHERE status = 'PENDING'"),
    "package_demand_all": _DEMAND.format(""),
    "threshold_totals": f"""SELECT sum(weight) AS total_weight,
        CAST(sum(quantity) AS BIGINT) AS total_quantity FROM {_PROCESSED1}""",
    "threshold_by_order": f"""SELECT order_id, sum(weight) AS total_weight,
        CAST(sum(quantity) AS BIGINT) AS total_quantity FROM {_PROCESSED1} GROUP BY order_id""",
    "total_order_weight": "SELECT sum(total_weight) AS total_weight FROM ord",
    "max_timestamp": "SELECT max(event_timestamp) AS max_timestamp FROM evt",
    "distinct_packages": """SELECT count(*) AS n
      FROM (SELECT DISTINCT package_id, subpackage_id FROM items)""",
    "distinct_status": "SELECT DISTINCT status FROM ord",
    "orders_to_process": "SELECT DISTINCT order_id FROM earlier WHERE status = 'PENDING'",
    "latest_events": f"{_EVENTS} ORDER BY event_timestamp DESC, event_id",
    "topk_items": f"{_ITEMS} ORDER BY order_timestamp DESC, inventory_id LIMIT 25",
    "stock_rank": "SELECT * FROM pkg ORDER BY stock_quantity, package_id, subpackage_id",
    "stock_rank_desc": "SELECT * FROM pkg ORDER BY stock_quantity DESC, package_id, subpackage_id",
    "stock_outcome": _OUTCOME,
    # Null fields are left out of the messages.
    "outcome_message": """SELECT inventory_id AS "partitionKey", CASE WHEN in_stock
        THEN CAST(to_json({'inventory_id': inventory_id, 'order_id': order_id,
          'product_id': product_id, 'quantity_updated': quantity_updated,
          'availability_updated': availability_updated, 'status_updated': status_updated}) AS VARCHAR)
        ELSE CAST(to_json({'inventory_id': inventory_id, 'order_id': order_id,
          'product_id': product_id, 'availability_updated': availability_updated,
          'status_updated': status_updated}) AS VARCHAR) END AS data FROM outcome""",
    "message_payload": """SELECT inventory_id AS "partitionKey", inventory_id, order_id,
        i.product_id, product_name, i.quantity AS order_quantity, price, weight, order_timestamp,
        status, CAST(p.quantity AS DOUBLE) AS stock_quantity,
        CAST(availability AS VARCHAR) AS availability
      FROM items1 i LEFT JOIN prd p ON p.product_id = i.product_id""",
    "join_using": f"""SELECT {_ITEM1}, stock_quantity, availability, updated_at
      FROM items1 JOIN (SELECT * RENAME (quantity AS stock_quantity) FROM prd) USING (product_id)""",
    "interval_join": "SELECT * FROM pairs",
    "stock_decrement": _STOCK,
    "stock_shortage": _SHORTAGE,
    "product_decrement": """SELECT product_id,
        CAST(prd.quantity - coalesce(d.quantity, 0) AS BIGINT) AS quantity, availability, updated_at
      FROM prd LEFT JOIN (SELECT product_id, sum(quantity) AS quantity FROM items1
                          GROUP BY product_id) d USING (product_id)""",
    "items_to_processing": _ITEMS_DONE,
    "items_to_processing_restamped": f"""SELECT * REPLACE ('PROCESSING' AS status,
        TIMESTAMP '{PROCESSED_AT}' AS order_timestamp) FROM ({_ITEMS}) UNION ALL {_EARLIER}""",
    "orders_to_processing": _ORDERS_DONE,
    "orders_to_processing_v1": f"""SELECT * EXCLUDE (total_volume, busy) REPLACE (
        CASE WHEN busy THEN 'PROCESSING' ELSE status END AS status,
        CASE WHEN busy THEN TIMESTAMP '{PROCESSED_AT}' ELSE order_timestamp END AS order_timestamp)
      FROM ({_ORDERS}) JOIN (SELECT DISTINCT order_id, order_id IN (SELECT order_id FROM items1)
        AS busy FROM ord) USING (order_id)""",
    "items_by_product": _BY_PRODUCT,
    "merge_case": f"""SELECT ord.order_id, 2 * coalesce(cnt.n, 0) AS items,
        CASE WHEN packed.n IS NULL THEN status
             WHEN packed.n > 2 * coalesce(cnt.n, 0) THEN 'PROCESSING' ELSE 'CANCELLED' END AS status,
        CASE WHEN packed.n IS NULL THEN order_timestamp
             ELSE TIMESTAMP '{PROCESSED_AT}' + INTERVAL 5 MINUTE END AS order_date
      FROM ord LEFT JOIN cnt ON cnt.event_id = ord.event_id
        LEFT JOIN (SELECT order_id, count(*) AS n FROM items GROUP BY order_id) packed
          ON packed.order_id = ord.order_id""",
    "status_change_rows": """SELECT order_id, inventory_id, 'PENDING' AS old_status,
        'PROCESSING' AS new_status FROM items""",
    "events_from_status": _status_events(""),
    "stream_ingest": _ORDERS,
    "stream_table_read": _UP_TO,
    "stream_append_events": _EVENTS,
    "stream_append_orders": _ORDERS,
    "stream_named_table": _EVENTS,
    "stream_resume": _EVENTS,
    "stream_status_changes": """SELECT order_id, status AS old_status, 'PROCESSING' AS new_status
      FROM ord WHERE status = 'RECEIVED'""",
    "stream_status_events": f"""SELECT {_hashed(
        "ev-", "order_id", "'INVENTORY_UPDATED'", "epoch_us(order_timestamp)")} AS event_id, 'INVENTORY_UPDATED' AS event_type,
        TIMESTAMP '{PROCESSED_AT}' AS event_timestamp, order_id
      FROM ord WHERE status = 'PROCESSING'""",
    "stream_append_items": _ITEMS,
    "stream_messages": """SELECT inventory_id AS "partitionKey", CAST(to_json({
        'inventory_id': inventory_id, 'order_id': order_id, 'items_quantity': items_quantity
        }) AS VARCHAR) AS data FROM items""",
    "stream_stock_decrement": _STOCK,
    "stream_items_to_processing": _ITEMS_DONE,
    "stream_orders_to_processing": _ORDERS_DONE,
    # Open clicks: no purchase yet, and the watermark (the later-running of the
    # two streams less its lateness) has not passed the interval.
    "stream_interval_join": f"""SELECT * FROM pairs
      WHERE purchase_id IS NOT NULL OR clicked_at + INTERVAL {WITHIN.seconds} SECOND < (
        SELECT least((SELECT max(ts) FROM clicks) - INTERVAL 60 SECOND,
                     (SELECT max(ts) FROM purchases) - INTERVAL 150 SECOND))""",
    "stream_inner_join": f"{_OUTCOME} WHERE in_stock",
    "flow_events": f"({_EVENTS}) UNION ALL ({_status_events('orders-0')})",
    "flow_orders": _ORDERS_DONE,
    "flow_items": f"SELECT * REPLACE ('PROCESSING' AS status) FROM ({_ITEMS})",
    "flow_stock": _STOCK,
    "flow_shortage": _SHORTAGE,
    "stream_dedup": _EVENTS,
    "flow_items_once": f"SELECT * REPLACE ('PROCESSING' AS status) FROM ({_ITEMS})",
    "stream_demand": """SELECT CAST(date_trunc('day', order_timestamp) AS TIMESTAMP) AS since, package_id, subpackage_id,
        CAST(sum(items_quantity) AS BIGINT) AS items_quantity FROM items GROUP BY ALL""",
    "stream_status_transitions": f"""SELECT DISTINCT order_id, status AS old_status, 'PROCESSING' AS new_status,
        TIMESTAMP '{PROCESSED_AT}' AS changed_at FROM ord WHERE status = 'RECEIVED'""",
    "stream_stock_rank": "SELECT * FROM demand ORDER BY items_quantity DESC, package_id, subpackage_id",
    "stream_from_latest": f"{_EVENTS} JOIN hdr USING (event_id) WHERE o_orderstatus = 'P'".replace(
        "order_id FROM", "evt.order_id FROM"
    ),
    "change_feed_items": _feed(f"SELECT {_ITEM}, {_NUMBER} % 2 AS feed_version FROM items", "'PROCESSING' AS status"),
    "change_feed_orders": _feed(
        f"SELECT {_ORDER}, {_NUMBER} % 2 AS feed_version FROM ord WHERE status = 'RECEIVED'", "'PROCESSING' AS status"
    ),
    "change_feed_stock": _STOCK_FEED,
    "routed_messages": f"""SELECT *, row_number() OVER (PARTITION BY partition
          ORDER BY order_timestamp, "partitionKey", inventory_id) - 1 AS position
      FROM (SELECT order_id AS "partitionKey", inventory_id, order_timestamp, items_quantity,
        CAST(CAST('0x' || substr(md5(order_id), 1, 8) AS BIGINT) % {PARTITIONS} AS INTEGER) AS partition FROM items)""",
    # Numbers of a variant have no negative zero.
    "decode_mixed": f"""SELECT * REPLACE (lon + CAST(0 AS DOUBLE) AS lon), 2 AS generation FROM ({_ORDERS})
      UNION ALL SELECT * REPLACE (NULL AS total_volume, lon + CAST(0 AS DOUBLE) AS lon), 1 FROM ({_ORDERS})""",
    "decode_mixed_items": f"SELECT {_ITEM1} FROM items1",
    "decode_mixed_rejected": "SELECT text FROM documents",
    "pipeline_events": _EVENTS,
    "pipeline_items": f"SELECT * REPLACE ('PROCESSING' AS status) FROM ({_ITEMS})",
}


def all_sql() -> dict[str, str]:
    prefix = _prefix(landing.SHARES)
    return {name: prefix + body for name, body in _BODIES.items()}
