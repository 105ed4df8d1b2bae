"""The same results as plain SQL, for the engine that checks them."""

from __future__ import annotations

_TRADES = """
SELECT printf('tx_%09d', l_orderkey * 10 + l_linenumber) AS transaction_id,
       l_shipdate + to_seconds(34200 + (l_partkey * 37 + l_suppkey) % 23401) AS ts,
       concat('S', lpad(CAST(l_suppkey % 20 AS VARCHAR), 2, '0')) AS stock_symbol,
       CASE WHEN l_orderkey % 100 = 1 THEN NULL
            WHEN l_orderkey % 100 = 2 THEN CAST('NaN' AS DOUBLE)
            ELSE l_extendedprice END AS price,
       CASE WHEN l_orderkey % 100 = 3 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS quantity,
       CASE WHEN l_orderkey % 100 = 4 THEN NULL
            WHEN l_orderkey % 100 = 5 THEN '"NaN"'
            WHEN l_linestatus = 'O' THEN 'buy' ELSE 'sell' END AS order_type,
       CASE WHEN l_orderkey % 100 = 6 THEN NULL
            WHEN l_orderkey % 100 = 7 THEN '"NaN"'
            WHEN l_suppkey % 20 < 10 THEN 'NASDAQ' ELSE 'NYSE' END AS exchange
FROM lineitem"""

_PARTS = """CAST(year(ts) AS INTEGER) AS ts_year, CAST(month(ts) AS INTEGER) AS ts_month,
       CAST(day(ts) AS INTEGER) AS ts_day"""

_CLEAN = """price IS NOT NULL AND NOT isnan(price) AND quantity IS NOT NULL
  AND order_type IS NOT NULL AND order_type <> '"NaN"'
  AND exchange IS NOT NULL AND exchange <> '"NaN"'"""

_RANK = """row_number() OVER (PARTITION BY transaction_id ORDER BY ts DESC NULLS LAST,
       stock_symbol NULLS LAST, price NULLS LAST, quantity NULLS LAST, order_type NULLS LAST,
       exchange NULLS LAST)"""

_COLUMNS = """transaction_id, ts, stock_symbol, price, quantity, order_type, exchange,
       ts_year, ts_month, ts_day"""

_WITH = f"""WITH trades AS ({_TRADES}),
bronze AS (SELECT *, {_PARTS} FROM trades),
cleaned AS (SELECT * FROM bronze WHERE {_CLEAN}),
silver AS (SELECT {_COLUMNS} FROM (SELECT *, {_RANK} AS rn FROM cleaned) WHERE rn = 1)"""



def _dated(day: str) -> str:
    """The same, with trades on other days."""
    return _WITH.replace("l_shipdate + to_seconds", f"{day} + to_seconds")


_DAY_NUMBER = "CAST(epoch(l_shipdate) // 86400 AS INTEGER)"
_WITH_FOLDED = _dated(f"TIMESTAMP '1998-06-11' + to_days({_DAY_NUMBER} % 40)")
# The date in UTC, whatever the zone of the engine that checks.
_TODAY = "CAST(CAST(make_timestamp(epoch_us(get_current_timestamp())) AS DATE) AS TIMESTAMP)"
_WITH_TODAY = _dated(f"{_TODAY} + to_days({_DAY_NUMBER} % 3 - 1)")

_NAN_FLAG = """CASE WHEN isnan({0}) THEN NULL ELSE {0} END AS {0},
       coalesce(isnan({0}), false) AS {0}_nan"""

_BRONZE_OUT = f"""SELECT transaction_id, ts, stock_symbol, {_NAN_FLAG.format('price')}, quantity,
       order_type, exchange, ts_year, ts_month, ts_day FROM bronze"""

_KEYS = {
    "market": "",
    "stock": "stock_symbol, exchange, ",
    "order_type": "order_type, ",
    "exchange": "exchange, ",
}
_VOLUME = "CAST(sum(quantity) AS BIGINT) AS total_volume"
_VALUE = "round(sum(CAST(price AS DOUBLE) * quantity), 2) AS total_value"
_MEASURES = {
    "market": f"{_VOLUME}, {_VALUE}",
    "stock": f"{_VOLUME}, {_VALUE}, count(transaction_id) AS transaction_count",
    "order_type": f"count(transaction_id) AS order_count, {_VOLUME}",
    "exchange": f"{_VOLUME}, {_VALUE}, count(transaction_id) AS transaction_count",
}


def _summary(name: str, source: str) -> str:
    keys = _KEYS[name]
    return f"""SELECT CAST(ts AS DATE) AS report_date, {keys}{_MEASURES[name]},
       ts_year AS year, ts_month AS month
FROM {source} GROUP BY {keys}ts_year, ts_month, CAST(ts AS DATE)"""


def _gold(name: str) -> str:
    return f"{_WITH}\n{_summary(name, 'silver')}"


def _gold_bronze(name: str) -> str:
    inner = _summary(name, "bronze")
    if "total_value" not in inner:
        return f"{_WITH}\n{inner}"
    return f"""{_WITH}
SELECT * REPLACE (CASE WHEN isnan(total_value) THEN NULL ELSE total_value END AS total_value),
       coalesce(isnan(total_value), false) AS total_value_nan
FROM ({inner})"""


def _upsert(target: str, updates: str) -> str:
    def batch(condition: str) -> str:
        return f"""SELECT {_COLUMNS} FROM (SELECT *, {_RANK} AS rn FROM cleaned
  WHERE ts {condition} TIMESTAMP '1998-07-01') WHERE rn = 1"""

    return f"""{_WITH}, target AS ({batch(target)}), updates AS ({batch(updates)})
SELECT * FROM target t WHERE NOT EXISTS
  (SELECT 1 FROM updates u WHERE u.transaction_id = t.transaction_id)
UNION ALL SELECT * FROM updates"""


def _table_count(name: str, rows: str, parts: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count,
       count(DISTINCT ({parts})) AS partition_count FROM ({rows})"""


_DAY_PARTS, _MONTH_PARTS = "ts_year, ts_month, ts_day", "year, month"
_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
_EVENT_PARTS = f"SELECT event_id, ts, user_id, event_type, value, props, {_PARTS} FROM events"
_SESSION_GRID = """SELECT trade_date, CAST(i AS INTEGER) AS minute_index,
       CAST(trade_date AS TIMESTAMP) + INTERVAL 570 MINUTE + to_minutes(i) AS minute
FROM (SELECT DISTINCT CAST(ts AS DATE) AS trade_date FROM events), range(391) AS r(i)"""
_NEAREST = """SELECT event_id, ts, date_trunc('minute', ts)
       + CASE WHEN date_part('microsecond', ts) > 30000000 THEN INTERVAL 1 MINUTE
              ELSE INTERVAL 0 MINUTE END AS minute,
       date_trunc('day', ts) + INTERVAL 570 MINUTE AS opens,
       date_trunc('day', ts) + INTERVAL 960 MINUTE AS closes
FROM events"""

ORACLES: dict[str, str] = {
    "tx_bronze": f"{_WITH}\n{_BRONZE_OUT}",
    "day_slice": f"{_WITH}\n{_BRONZE_OUT} WHERE ts_year = 1998 AND ts_month = 5 AND ts_day = 5",
    "today_slice": f"{_WITH_TODAY}\n{_BRONZE_OUT} WHERE CAST(ts AS DATE) = CAST({_TODAY} AS DATE)",
    "dq_clean": f"{_WITH}\nSELECT {_COLUMNS} FROM cleaned",
    "dq_stage_counts": f"""{_WITH}
SELECT (SELECT count(*) FROM bronze) AS rows_read, (SELECT count(*) FROM cleaned) AS rows_clean,
       (SELECT count(*) FROM silver) AS rows_deduplicated""",
    "dedup_latest": f"{_WITH}\nSELECT * FROM silver",
    "silver_upsert": _upsert("<", ">="),
    "silver_upsert_reversed": _upsert(">=", "<"),
    "silver_table_upsert": _upsert("<", ">="),
    "gold_market": _gold("market"),
    "gold_stock": _gold("stock"),
    "gold_order_type": _gold("order_type"),
    "gold_exchange": _gold("exchange"),
    "gold_market_bronze": _gold_bronze("market"),
    "gold_stock_bronze": _gold_bronze("stock"),
    "gold_order_type_bronze": _gold_bronze("order_type"),
    "gold_exchange_bronze": _gold_bronze("exchange"),
    "gold_append_twice": f"""{_WITH}, summary AS ({_summary('market', 'silver')})
SELECT * FROM summary UNION ALL SELECT * FROM summary""",
    "gold_replace_day": _gold("market"),
    "ddl_tables": _WITH
    + "\n"
    + "\nUNION ALL ".join(
        [
            _table_count("transactions", "SELECT * FROM bronze", _DAY_PARTS),
            _table_count("transactions_cleaned", "SELECT * FROM silver", _DAY_PARTS),
            *(
                _table_count(f"daily_{name}_summary", _summary(name, "silver"), _MONTH_PARTS)
                for name in _KEYS
            ),
        ]
    ),
    "json_decode_explode": _EVENTS,
    "stream_append": _EVENT_PARTS,
    "stream_restart": _EVENT_PARTS,
    "stream_table": _EVENT_PARTS,
    "stream_service": _EVENT_PARTS,
    "stream_compact": _EVENT_PARTS,
    "envelope_pages": """SELECT n // 100 AS page, CAST(n % 100 AS INTEGER) AS place,
       event_id, ts, user_id, event_type, value, props
FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS n FROM events)""",
    "page_slice": """SELECT event_id, ts, user_id, event_type, value, props,
       CASE WHEN 400 >= (SELECT count(*) FROM events) THEN 'complete' ELSE 'success' END AS status
FROM events ORDER BY ts, event_id LIMIT 100 OFFSET 300""",
    "page_listing": """SELECT n // 100 * 100 AS page_offset, count(*) AS page_rows,
       CASE WHEN n // 100 * 100 + 100 >= (SELECT count(*) FROM events)
            THEN 'complete' ELSE 'success' END AS status
FROM (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS n FROM events)
GROUP BY n // 100""",
    "csv_roundtrip": """SELECT event_id, ts, user_id, event_type,
       value, props FROM events""",
    "wire_missing_values": f"""WITH trades AS ({_TRADES})
SELECT transaction_id, ts, stock_symbol,
       CASE WHEN isnan(price) THEN NULL ELSE price END AS price,
       (price IS NULL OR isnan(price)) AS price_nan, quantity,
       coalesce(order_type, '"NaN"') AS order_type, coalesce(exchange, '"NaN"') AS exchange,
       {_PARTS} FROM trades""",
    "minute_grid": _SESSION_GRID,
    "nearest_minute": f"""SELECT event_id, minute,
       least(greatest(minute, opens), closes) AS session_minute,
       CAST(date_diff('minute', opens, least(greatest(minute, opens), closes)) AS INTEGER)
         AS minute_index
FROM ({_NEAREST})""",
    "minute_lookup": f"""WITH grid AS ({_SESSION_GRID}), ranked AS (
  SELECT event_id, ts, trade_date, minute_index, minute,
         row_number() OVER (PARTITION BY event_id
           ORDER BY abs(epoch_us(minute) - epoch_us(ts)), minute) AS rn
  FROM events JOIN grid ON trade_date = CAST(ts AS DATE))
SELECT event_id, ts, trade_date, minute_index, minute FROM ranked WHERE rn = 1""",
    "dim_enrich": """SELECT s_nationkey, s_suppkey, s_name, s_acctbal, n_name, n_regionkey
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "symbol_lookup": f"""{_WITH}, symbols AS (
  SELECT concat('S', lpad(CAST(s_suppkey % 20 AS VARCHAR), 2, '0')) AS symbol,
         max(CASE WHEN s_suppkey % 20 < 10 THEN 'NASDAQ' ELSE 'NYSE' END) AS home_exchange,
         max(s_acctbal) AS base_price
  FROM supplier GROUP BY 1)
SELECT stock_symbol, transaction_id, ts, price, quantity, home_exchange, base_price
FROM cleaned LEFT JOIN symbols ON stock_symbol = symbol""",
    "daily_run": _gold("stock"),
    "daily_run_tables": f"{_WITH_FOLDED}\n{_summary('stock', 'silver')}",
    "late_days": f"{_WITH_FOLDED}\nSELECT * FROM silver",
    "empty_day": f"""{_WITH_FOLDED}, days AS (
  SELECT * FROM (VALUES (DATE '1997-01-01'), (DATE '1998-06-20')) AS d(day))
SELECT day, (SELECT count(*) FROM bronze WHERE CAST(ts AS DATE) = day) AS rows_read,
       (SELECT count(*) FROM cleaned WHERE CAST(ts AS DATE) = day) AS rows_clean,
       (SELECT count(DISTINCT transaction_id) FROM cleaned WHERE CAST(ts AS DATE) = day) AS rows_deduplicated,
       (SELECT count(DISTINCT transaction_id) FROM cleaned WHERE CAST(ts AS DATE) = day) AS silver_rows
FROM days""",
}
