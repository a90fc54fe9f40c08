"""Independent DuckDB answers for every registered query.

Each statement starts from the base tables (``events``, ``lineitem``, ...)
and applies the derivation rules of FIXTURES.md §3 directly, so it shares no
code path with the Spark route (messages → JSON envelope → Connect Decimal →
Bronze → decode → vault).
"""

from __future__ import annotations

# Fixed values shared with the Spark side: hash null token and separator.
NULL = "'^^NULL^^'"


def _bk(expr: str) -> str:
    return f"coalesce(upper(trim(CAST({expr} AS VARCHAR))), {NULL})"


def _ad(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), {NULL})"


SHOP_CTES = f"""
pe AS (
  SELECT event_id, user_id, value, op, copy,
         (event_id + 1) * 10 + copy * 5 AS lsn,
         epoch_us(ts) // 1000 AS source_ts_ms,
         event_id * 4 + copy * 2 AS "offset",
         CAST(floor(value / 50) AS BIGINT) * 5000 + copy * 100 + 850 AS cents,
         op <> 'd' AND event_id % 61 = 0 OR event_id % 71 = 0 OR event_id % 73 = 0 OR event_id % 79 = 0 AS bad, ts
  FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op
        FROM events WHERE event_type <> 'purchase'), (SELECT unnest([0, 1]) AS copy)
  WHERE copy = 0 OR (op = 'u' AND event_id % 7 = 0)
),
products AS (
  SELECT sha256({_bk('user_id')}) AS hk_product,
         CAST(user_id AS INTEGER) AS product_id,
         CASE WHEN op <> 'd' THEN 'product ' || CAST(user_id AS VARCHAR) END AS name,
         CASE WHEN op <> 'd' THEN (['Garden', 'Office', 'Workshop'])[CAST(user_id % 3 AS INTEGER) + 1] END AS category,
         CASE WHEN op <> 'd' THEN CAST(cents / 100.0 AS DECIMAL(10,2)) END AS unit_price,
         CASE WHEN op <> 'd' THEN CAST(CAST(floor(value) AS BIGINT) % 5 AS INTEGER) END AS stock_quantity,
         op = 'd' AS dv_is_deleted,
         op, lsn, source_ts_ms, "offset",
         make_timestamp(source_ts_ms * 1000) AS load_dts,
         'shop.products' AS record_source
  FROM pe WHERE NOT bad
),
oe AS (
  SELECT event_id, user_id, ts, epoch_us(ts) // 1000 AS ms FROM events WHERE event_type = 'purchase'
),
order_steps AS (
  SELECT oe.*, 0 AS step, 'c' AS op, 'placed' AS status FROM oe
  UNION ALL SELECT oe.*, 1, 'u', 'paid' FROM oe WHERE event_id % 2 = 0
  UNION ALL SELECT oe.*, 2, 'd', NULL FROM oe WHERE event_id % 10 = 3
),
orders AS (
  SELECT sha256({_bk('event_id')}) AS hk_order,
         CAST(event_id AS INTEGER) AS order_id,
         sha256({_bk("CASE WHEN op <> 'd' THEN 'Customer ' || CAST(user_id % 40 AS VARCHAR) END")}) AS hk_customer,
         CASE WHEN op <> 'd' THEN 'Customer ' || CAST(user_id % 40 AS VARCHAR) END AS customer_name,
         sha256({_bk("CASE WHEN op <> 'd' THEN user_id END")}) AS hk_product,
         CASE WHEN op <> 'd' THEN CAST(user_id AS INTEGER) END AS product_id,
         CASE WHEN op <> 'd' THEN CAST(event_id % 5 + 1 AS INTEGER) END AS quantity,
         status AS order_status,
         CASE WHEN op <> 'd' THEN ts END AS ordered_at,
         op = 'd' AS dv_is_deleted,
         op,
         (event_id + 1) * 10 + step AS lsn,
         ms + step * 60000 AS source_ts_ms,
         event_id * 4 + step AS "offset",
         make_timestamp((ms + step * 60000) * 1000) AS load_dts,
         'shop.orders' AS record_source
  FROM order_steps WHERE NOT (step = 1 AND event_id % 66 = 0 OR event_id % 71 = 0 OR event_id % 73 = 0 OR event_id % 79 = 0)
),
product_keys AS (
  SELECT hk_product, product_id, lsn, source_ts_ms, "offset", load_dts, record_source FROM products
  UNION ALL
  SELECT hk_product, product_id, lsn, source_ts_ms, "offset", load_dts, record_source FROM orders WHERE product_id IS NOT NULL
),
hub_product AS (
  SELECT hk_product, product_id, load_dts, record_source FROM (
    SELECT *, row_number() OVER (PARTITION BY hk_product ORDER BY lsn NULLS FIRST, source_ts_ms NULLS FIRST, "offset" NULLS FIRST, record_source) AS rn
    FROM product_keys) WHERE rn = 1
),
hub_customer AS (
  SELECT hk_customer, customer_name, load_dts, record_source FROM (
    SELECT *, row_number() OVER (PARTITION BY hk_customer ORDER BY lsn NULLS FIRST, source_ts_ms NULLS FIRST, "offset" NULLS FIRST, record_source) AS rn
    FROM orders WHERE customer_name IS NOT NULL) WHERE rn = 1
),
hub_order AS (
  SELECT hk_order, order_id, load_dts, record_source FROM (
    SELECT *, row_number() OVER (PARTITION BY hk_order ORDER BY lsn NULLS FIRST, source_ts_ms NULLS FIRST, "offset" NULLS FIRST, record_source) AS rn
    FROM orders) WHERE rn = 1
),
link_order AS (
  SELECT sha256(concat_ws('||', {_bk('order_id')}, {_bk('customer_name')}, {_bk('product_id')})) AS hk_link_order,
         hk_order, hk_customer, hk_product, load_dts, record_source FROM (
    SELECT *, row_number() OVER (PARTITION BY hk_order ORDER BY lsn NULLS FIRST, source_ts_ms NULLS FIRST, "offset" NULLS FIRST, record_source) AS rn
    FROM orders WHERE customer_name IS NOT NULL AND product_id IS NOT NULL) WHERE rn = 1
),
sat_product_all AS (
  SELECT *, lag(hashdiff) OVER (PARTITION BY hk_product ORDER BY lsn NULLS FIRST, source_ts_ms NULLS FIRST, "offset" NULLS FIRST, record_source, hashdiff) AS prev
  FROM (SELECT *, sha256(concat_ws('||', {_ad('name')}, {_ad('category')}, {_ad('unit_price')}, {_ad('stock_quantity')}, {_ad('dv_is_deleted')})) AS hashdiff FROM products)
),
sat_product_changes AS (SELECT * FROM sat_product_all WHERE prev IS NULL OR prev <> hashdiff),
sat_order_all AS (
  SELECT *, lag(hashdiff) OVER (PARTITION BY hk_order ORDER BY lsn NULLS FIRST, source_ts_ms NULLS FIRST, "offset" NULLS FIRST, record_source, hashdiff) AS prev
  FROM (SELECT *, sha256(concat_ws('||', {_ad('quantity')}, {_ad('order_status')}, {_ad('ordered_at')}, {_ad('dv_is_deleted')})) AS hashdiff FROM orders)
),
sat_order_changes AS (SELECT * FROM sat_order_all WHERE prev IS NULL OR prev <> hashdiff)
"""

# Of the product versions at or before the order time the newest counts;
# equal times are settled by {ties}, the largest winning.
ORDER_VALUE = """
SELECT order_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(CAST(quantity * unit_price * 4000 AS DECIMAL(18,2)) AS DOUBLE) AS order_value_khr
FROM (
  SELECT h.order_id, o.quantity, sp.unit_price,
         row_number() OVER (PARTITION BY o.hk_order, o.lsn, o."offset" ORDER BY sp.load_dts DESC, {ties}) AS rn
  FROM {orders} o
  JOIN hub_order h ON o.hk_order = h.hk_order
  JOIN link_order l ON o.hk_order = l.hk_order
  JOIN sat_product_changes sp ON l.hk_product = sp.hk_product AND sp.load_dts <= o.ordered_at
  WHERE NOT o.dv_is_deleted
) WHERE rn = 1
"""
LOG_TIES = 'sp.lsn DESC NULLS LAST, sp.source_ts_ms DESC, sp."offset" DESC'
PUBLISHED_TIES = "sp.hashdiff DESC"

LATEST_ORDER = """
latest_order AS (
  SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY hk_order ORDER BY lsn DESC NULLS LAST, source_ts_ms DESC NULLS LAST, "offset" DESC NULLS LAST) AS rn
    FROM sat_order_changes) WHERE rn = 1
)
"""


def shop(select: str, extra_ctes: str = "") -> str:
    ctes = SHOP_CTES + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{select}"


def oracle_sql() -> dict[str, str]:
    return {**shop_oracles(), **price_oracles()}


# The messages as the fixture writes them, texts included. A decimal is the
# base64 of the fewest bytes that hold it with its sign.
MESSAGES = r"""
hexed AS (
  SELECT *, CASE WHEN length(h) % 2 = 1 THEN '0' || h WHEN h >= '8' THEN '00' || h ELSE h END AS even
  FROM (SELECT *, printf('%X', cents) AS h FROM pe)
),
product_json AS (
  SELECT *, CASE WHEN event_id % 61 = 0 THEN '!bad!' WHEN event_id % 59 = 0 THEN to_base64(unhex(lpad(even, 40, '0')))
                 ELSE to_base64(unhex(even)) END AS price,
    CASE WHEN event_id % 53 = 0 THEN '"' || user_id || '"' ELSE user_id::VARCHAR END AS pid
  FROM hexed
),
bodies AS (
  SELECT 'products' AS source_table, event_id, user_id AS key_id, 'product_id' AS key_name, op, lsn, event_id // 2 AS tx_id, source_ts_ms, "offset",
    CASE WHEN op = 'd' THEN '"before":{"product_id":' || pid || '}'
         ELSE '"after":{"product_id":' || pid || ',"name":"product ' || user_id || '","category":"'
           || (['Garden', 'Office', 'Workshop'])[CAST(user_id % 3 AS INTEGER) + 1] || '","unit_price":"' || price
           || '","stock_quantity":' || CAST(floor(value) AS BIGINT) % 5
           || ',"updated_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"}' END AS body
  FROM product_json
  UNION ALL
  SELECT 'orders', event_id, event_id, 'order_id', op, (event_id + 1) * 10 + step, event_id // 2, ms + step * 60000, event_id * 4 + step,
    CASE WHEN op = 'd' THEN '"before":{"order_id":' || event_id || '}'
         ELSE '"after":{"order_id":' || event_id || ',"customer_name":"Customer ' || user_id % 40 || '","product_id":' || user_id
           || ',"quantity":' || CASE WHEN step = 1 AND event_id % 66 = 0 THEN '"many"' ELSE (event_id % 5 + 1)::VARCHAR END
           || ',"order_status":"' || status || '","ordered_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"}' END
  FROM order_steps
),
live AS (
  SELECT *, '{"payload":' || payload || '}' AS whole, event_id % 71 = 0 AS cut FROM (
    SELECT *, event_id % 73 = 0 AS no_lsn, event_id % 79 = 0 AS no_time,
      '{' || body || ',"source":{"lsn":' || CASE WHEN event_id % 73 = 0 THEN '"x9"' ELSE lsn::VARCHAR END || ',"txId":' || tx_id
      || ',"ts_ms":' || CASE WHEN event_id % 79 = 0 THEN '"zz"' ELSE source_ts_ms::VARCHAR END || '},"op":"' || op
      || '","ts_ms":' || source_ts_ms || '}' AS payload, source_ts_ms AS ms FROM bodies)
),
lifted AS (
  SELECT source_table, key_name, key_id, body, "offset", ms, cut, no_lsn, no_time, CASE WHEN cut THEN whole[1:40] ELSE whole END AS event,
    CASE WHEN NOT cut THEN payload END AS payload, CASE WHEN NOT cut THEN op END AS op, CASE WHEN NOT cut THEN tx_id END AS tx_id,
    CASE WHEN NOT cut AND NOT no_lsn THEN lsn END AS lsn, CASE WHEN NOT cut AND NOT no_time THEN source_ts_ms END AS source_ts_ms
  FROM live
),
messages AS (
  SELECT source_table, 'shop.public.' || source_table AS topic, '{"payload":{"' || key_name || '":' || key_id || '}}' AS kafka_key,
    op, lsn, tx_id, source_ts_ms, "offset", ms, sha256(event) AS event, sha256(payload) AS payload
  FROM lifted
  UNION ALL
  SELECT source_table, 'shop.public.' || source_table, '{"payload":{"' || key_name || '":' || key_id || '}}',
    NULL, NULL, NULL, NULL, "offset" + 1, ms, NULL, NULL
  FROM live WHERE op = 'd'
)
"""

PRODUCT_CHANGE_COLS = (
    "hk_product, product_id, name, category, CAST(unit_price AS DOUBLE) AS unit_price, stock_quantity, dv_is_deleted, "
    'lsn, source_ts_ms, "offset", load_dts, record_source'
)
ORDER_CHANGE_COLS = (
    "hk_order, hk_customer, hk_product, order_id, customer_name, product_id, quantity, order_status, "
    'ordered_at, dv_is_deleted, lsn, source_ts_ms, "offset", load_dts, record_source'
)


def shop_oracles() -> dict[str, str]:
    return {
        "change_rejects": shop(
            """SELECT * FROM (
                 SELECT 'shop.' || source_table AS record_source, op, lsn, source_ts_ms, "offset", sha256(coalesce(payload, event)) AS payload,
                   CASE WHEN cut THEN 'event: not a change envelope' ELSE concat_ws('; ',
                     CASE WHEN body LIKE '%"!bad!"%' THEN 'unit_price: not a valid decimal(10,2)' END,
                     CASE WHEN body LIKE '%"quantity":"many"%' THEN 'quantity: not a valid int' END,
                     CASE WHEN no_lsn THEN 'lsn: not a valid bigint' END, CASE WHEN no_time THEN 'ts_ms: not a valid bigint' END) END
                     AS reject_reasons
                 FROM lifted) WHERE reject_reasons <> ''""",
            MESSAGES,
        ),
        "changes_products": shop(f"SELECT {PRODUCT_CHANGE_COLS} FROM products"),
        "changes_orders": shop(f"SELECT {ORDER_CHANGE_COLS} FROM orders"),
        "bronze_change_stream": shop(
            """SELECT kafka_key, source_table, op, lsn, tx_id, source_ts_ms, topic, 0 AS partition, "offset",
                      make_timestamp(ms * 1000) AS event_timestamp, event, payload
               FROM messages""",
            MESSAGES,
        ),
        "log_counts": shop(
            """SELECT source_table, op, CAST(count(*) AS BIGINT) AS events, CAST(count(DISTINCT tx_id) AS BIGINT) AS transactions
               FROM messages GROUP BY source_table, op""",
            MESSAGES,
        ),
        "op_profile": shop(
            "SELECT source_table, op, CAST(count(*) AS BIGINT) AS events FROM messages GROUP BY source_table, op",
            MESSAGES,
        ),
        "op_transactions": shop(
            """SELECT op, CAST(count(*) AS BIGINT) AS events, CAST(count(DISTINCT tx_id) AS BIGINT) AS transactions
               FROM messages WHERE source_table = 'products' GROUP BY op""",
            MESSAGES,
        ),
        "op_by_source": shop(
            "SELECT source_table, op, CAST(count(*) AS BIGINT) AS events FROM messages GROUP BY 1, 2",
            MESSAGES,
        ),
        "version_counts": shop(
            "SELECT hk_product, CAST(count(*) AS BIGINT) AS versions FROM sat_product_changes GROUP BY 1"
        ),
        "vault_inventory": shop(
            """SELECT 'hub_product' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM hub_product
               UNION ALL SELECT 'hub_customer', count(*) FROM hub_customer
               UNION ALL SELECT 'hub_order', count(*) FROM hub_order
               UNION ALL SELECT 'link_order', count(*) FROM link_order
               UNION ALL SELECT 'sat_product', count(*) FROM sat_product_changes
               UNION ALL SELECT 'sat_order', count(*) FROM sat_order_changes"""
        ),
        "order_value_versions": shop(ORDER_VALUE.format(orders="sat_order_changes", ties=LOG_TIES)),
        "published_vault_order_value": shop(ORDER_VALUE.format(orders="sat_order_changes", ties=PUBLISHED_TIES)),
        "order_value_live": shop(ORDER_VALUE.format(orders="latest_order", ties=LOG_TIES), LATEST_ORDER),
        "hub_product": shop("SELECT * FROM hub_product"),
        "hub_customer": shop("SELECT * FROM hub_customer"),
        "hub_order": shop("SELECT * FROM hub_order"),
        "link_order": shop("SELECT * FROM link_order"),
        "sat_product": shop(
            "SELECT hk_product, load_dts, hashdiff, name, category, CAST(unit_price AS DOUBLE) AS unit_price, "
            "stock_quantity, dv_is_deleted, record_source FROM sat_product_changes"
        ),
        "sat_order": shop(
            "SELECT hk_order, load_dts, hashdiff, quantity, order_status, ordered_at, dv_is_deleted, record_source FROM sat_order_changes"
        ),
    }


PRICE_CTES = r"""
li AS (
  SELECT l.l_orderkey, l.l_suppkey, l.l_partkey, l.l_linenumber, l.l_extendedprice, l.l_returnflag,
         l.l_linestatus, l.l_shipdate, s.s_name, n.n_name, r.r_name, p.p_name, p.p_type, p.p_size
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
text0 AS (
  SELECT l_orderkey,
    CASE WHEN l_orderkey % 97 = 0 THEN 'bad-date' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
    r_name AS admin1, n_name AS admin2, s_name AS market,
    CAST(l_suppkey AS VARCHAR) AS market_id,
    CAST(l_suppkey % 180 - 90 AS VARCHAR) AS latitude,
    CAST(l_suppkey % 360 - 180 AS VARCHAR) AS longitude,
    CASE WHEN p_size = 1 THEN 'non-food' ELSE p_type END AS category,
    p_name AS commodity,
    CAST(l_partkey AS VARCHAR) AS commodity_id,
    (['KG', 'L', '5 L', '730 ML', '140 ML', '10 pcs', 'Day'])[l_linenumber % 7 + 1] AS unit,
    CASE l_returnflag WHEN 'A' THEN 'actual' WHEN 'N' THEN 'aggregate' WHEN 'R' THEN 'actual,aggregate' END AS priceflag,
    CASE l_linestatus WHEN 'F' THEN 'Wholesale' WHEN 'O' THEN 'Retail' END AS pricetype,
    'KHR' AS currency,
    CASE WHEN l_orderkey % 89 = 0 THEN 'n/a' ELSE CAST(l_extendedprice AS VARCHAR) END AS price,
    CAST(l_extendedprice / 4000 AS VARCHAR) AS usdprice
  FROM li
),
text_rows AS (
  SELECT date, admin1, admin2, market, market_id, latitude, longitude, category, commodity, commodity_id, unit, priceflag, pricetype, currency, price, usdprice
  FROM text0
  UNION ALL
  SELECT ' ' || date || ' ' AS date,
         ' ' || admin1 || ' ' AS admin1,
         ' ' || admin2 || ' ' AS admin2,
         ' ' || market || ' ' AS market,
         ' ' || market_id || ' ' AS market_id,
         ' ' || latitude || ' ' AS latitude,
         ' ' || longitude || ' ' AS longitude,
         ' ' || category || ' ' AS category,
         ' ' || commodity || ' ' AS commodity,
         ' ' || commodity_id || ' ' AS commodity_id,
         ' ' || unit || ' ' AS unit,
         ' ' || priceflag || ' ' AS priceflag,
         ' ' || pricetype || ' ' AS pricetype,
         ' ' || currency || ' ' AS currency,
         ' ' || price || ' ' AS price,
         ' ' || usdprice || ' ' AS usdprice
  FROM text0 WHERE l_orderkey % 50 = 0
),
renamed AS (
  SELECT date AS price_date, trim(admin1) AS province, trim(admin2) AS district, trim(market) AS market,
         market_id, latitude, longitude, trim(category) AS category, trim(commodity) AS commodity, commodity_id,
         trim(unit) AS unit, trim(priceflag) AS priceflag, trim(pricetype) AS pricetype, trim(currency) AS currency,
         price, usdprice AS usd_price, 'wfp' AS source
  FROM text_rows
),
cast_rows AS (
  SELECT *,
    CASE WHEN regexp_full_match(trim(price_date), '\d{4}-\d{2}-\d{2}') THEN TRY_CAST(trim(price_date) AS DATE) END AS c_price_date,
    TRY_CAST(trim(market_id) AS INTEGER) AS c_market_id,
    TRY_CAST(trim(commodity_id) AS INTEGER) AS c_commodity_id,
    TRY_CAST(trim(latitude) AS DOUBLE) AS c_latitude,
    TRY_CAST(trim(longitude) AS DOUBLE) AS c_longitude,
    TRY_CAST(trim(price) AS DOUBLE) AS c_price,
    TRY_CAST(trim(usd_price) AS DOUBLE) AS c_usd_price
  FROM renamed
),
classified AS (
  SELECT *, concat_ws('; ',
    CASE WHEN price_date IS NOT NULL AND c_price_date IS NULL THEN 'price_date: failed cast to date' END,
    CASE WHEN market_id IS NOT NULL AND c_market_id IS NULL THEN 'market_id: failed cast to int' END,
    CASE WHEN commodity_id IS NOT NULL AND c_commodity_id IS NULL THEN 'commodity_id: failed cast to int' END,
    CASE WHEN latitude IS NOT NULL AND c_latitude IS NULL THEN 'latitude: failed cast to double' END,
    CASE WHEN longitude IS NOT NULL AND c_longitude IS NULL THEN 'longitude: failed cast to double' END,
    CASE WHEN price IS NOT NULL AND c_price IS NULL THEN 'price: failed cast to double' END,
    CASE WHEN usd_price IS NOT NULL AND c_usd_price IS NULL THEN 'usd_price: failed cast to double' END
  ) AS reject_reasons
  FROM cast_rows
),
good AS (
  SELECT c_price_date AS price_date, province, district, market, c_market_id AS market_id,
         c_latitude AS latitude, c_longitude AS longitude, category, commodity, c_commodity_id AS commodity_id,
         unit, priceflag, pricetype, currency, c_price AS price, c_usd_price AS usd_price, source
  FROM classified WHERE reject_reasons = ''
),
standard AS (
  SELECT *,
    list_contains(string_split(priceflag, ','), 'actual') AS is_actual,
    list_contains(string_split(priceflag, ','), 'aggregate') AS is_aggregate,
    CASE unit WHEN 'KG' THEN 1.0 WHEN 'L' THEN 1.0 WHEN '5 L' THEN 5.0 WHEN '730 ML' THEN 0.73
              WHEN '140 ML' THEN 0.14 WHEN '10 pcs' THEN 10.0 WHEN 'Day' THEN 1.0 END::DOUBLE AS unit_qty,
    CASE unit WHEN 'KG' THEN 'KG' WHEN 'L' THEN 'L' WHEN '5 L' THEN 'L' WHEN '730 ML' THEN 'L'
              WHEN '140 ML' THEN 'L' WHEN '10 pcs' THEN 'pcs' WHEN 'Day' THEN 'Day' END AS unit_base,
    category <> 'non-food' AS is_food
  FROM good
),
derived AS (
  SELECT *,
    CAST(round(CAST(CAST(price / unit_qty AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS price_per_base_unit,
    CAST(round(CAST(CAST(usd_price / unit_qty AS VARCHAR) AS DECIMAL(38,18)), 4) AS DOUBLE) AS usd_price_per_base_unit
  FROM standard
),
silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY price_date, market_id, commodity_id, pricetype, unit, priceflag
      ORDER BY price NULLS FIRST, usd_price NULLS FIRST, province NULLS FIRST, district NULLS FIRST,
               market NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST, category NULLS FIRST,
               commodity NULLS FIRST, currency NULLS FIRST) AS rn
    FROM derived) WHERE rn = 1
)
"""

SILVER_SELECT = """
SELECT price_date, province, district, market, market_id, latitude, longitude, category, commodity,
       commodity_id, unit, unit_qty, unit_base, currency, price, price_per_base_unit, usd_price,
       usd_price_per_base_unit, pricetype, priceflag, is_actual, is_aggregate, is_food, source
FROM silver
"""

BRONZE_SELECT = r"""
SELECT CASE WHEN regexp_full_match(date, '\d{4}-\d{2}-\d{2}') THEN TRY_CAST(date AS DATE) END AS price_date,
       admin1, admin2, market, TRY_CAST(trim(market_id) AS INTEGER) AS market_id,
       TRY_CAST(trim(latitude) AS DOUBLE) AS latitude, TRY_CAST(trim(longitude) AS DOUBLE) AS longitude,
       category, commodity, TRY_CAST(trim(commodity_id) AS INTEGER) AS commodity_id, unit, priceflag,
       pricetype, currency, TRY_CAST(trim(price) AS DOUBLE) AS price, TRY_CAST(trim(usdprice) AS DOUBLE) AS usd_price,
       'wfp' AS source
FROM text_rows
"""


_LINE = "date, admin1, admin2, market, market_id, latitude, longitude, category, commodity, commodity_id, unit, priceflag, pricetype, currency, price, usdprice"

LANDING_REJECTS = f"""
SELECT 'short' AS file, concat_ws(',', date, admin1, admin2, market, market_id) AS line, 'row: not 16 fields' AS reject_reasons
FROM text_rows WHERE CAST(trim(commodity_id) AS INTEGER) % 31 = 0
UNION ALL SELECT 'long', concat_ws(',', {_LINE}, 'more'), 'row: not 16 fields'
FROM text_rows WHERE CAST(trim(commodity_id) AS INTEGER) % 37 = 0 AND trim(priceflag) <> 'actual,aggregate'
UNION ALL SELECT 'renamed', concat_ws(',', {_LINE}), 'header: lacks usdprice'
FROM text_rows WHERE CAST(trim(commodity_id) AS INTEGER) % 41 = 0 AND trim(priceflag) <> 'actual,aggregate'
"""


def prices(select: str) -> str:
    return f"WITH {PRICE_CTES}\n{select}"


def price_oracles() -> dict[str, str]:
    return {
        "bronze_prices": prices(BRONZE_SELECT),
        "landing_rejects": prices(LANDING_REJECTS),
        "bronze_profile": prices(
            f"""SELECT source, CAST(count(*) AS BIGINT) AS rows,
                       CAST(count(*) FILTER (WHERE price_date IS NULL) AS BIGINT) AS unparseable_dates,
                       min(price_date) AS first_date, max(price_date) AS last_date
                FROM ({BRONZE_SELECT}) GROUP BY source"""
        ),
        "load_span": prices(f"SELECT source, CAST(count(*) AS BIGINT) AS rows, true AS in_order FROM ({BRONZE_SELECT}) GROUP BY source"),
        "silver_prices": prices(SILVER_SELECT),
        "published_silver": prices(f"SELECT *, CAST(year(price_date) AS INTEGER) AS price_date_year FROM ({SILVER_SELECT})"),
        "price_window": prices(
            """SELECT price_date, pricetype, CAST(count(*) AS BIGINT) AS rows, max(price) AS highest FROM silver
               WHERE price_date BETWEEN DATE '1995-11-20' AND DATE '1996-02-10' GROUP BY ALL"""
        ),
        "price_rejects": prices(
            """SELECT price_date, province, district, market, market_id, latitude, longitude, category,
                      commodity, commodity_id, unit, priceflag, pricetype, currency, price, usd_price, source,
                      reject_reasons
               FROM classified WHERE reject_reasons <> ''"""
        ),
        "dedup_audit": prices(
            """SELECT CAST(count(*) AS BIGINT) AS bronze_rows,
                      CAST(count(*) FILTER (WHERE reject_reasons <> '') AS BIGINT) AS rows_quarantined,
                      CAST(count(*) FILTER (WHERE reject_reasons = '') AS BIGINT) AS rows_before_dedup,
                      CAST((SELECT count(*) FROM silver) AS BIGINT) AS silver_rows,
                      CAST(count(*) FILTER (WHERE reject_reasons = '') - (SELECT count(*) FROM silver) AS BIGINT) AS duplicates_removed
               FROM classified"""
        ),
        "unmapped_units": prices(
            "SELECT DISTINCT unit FROM good WHERE unit NOT IN ('KG', 'L', '5 L', '10 pcs', 'Day')"
        ),
        "flag_profile": prices(
            "SELECT priceflag, is_actual, is_aggregate, CAST(count(*) AS BIGINT) AS rows FROM silver GROUP BY 1, 2, 3"
        ),
        "food_profile": prices("SELECT is_food, CAST(count(*) AS BIGINT) AS rows FROM silver GROUP BY 1"),
        "price_lookup_top5": prices(
            """SELECT price_date, unit, price, price_per_base_unit FROM silver
               WHERE commodity_id = 96 AND pricetype = 'Retail'
               ORDER BY price_date DESC, market_id, unit, priceflag LIMIT 5"""
        ),
    }
