"""The catalogue's queries as SQL over ``events``, without the way through JSON.

The statements compute every table from the event columns directly and share no code
with the operators.
"""

# One row per event with the facts that the feed puts into its line. A blank or truncated
# line and one without a type have no event type; k numbers the defects of the feed.
_FEED = """
facts AS (
  SELECT event_id, user_id, event_type AS kind, CAST(value AS DECIMAL(18,8)) AS amount,
         epoch_us(ts) // 1000 AS ms, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events
),
feed AS (
  SELECT *,
         CASE WHEN k IN (0, 1, 12) THEN NULL
              WHEN kind = 'signup' THEN 'ACCOUNT_UPDATE'
              WHEN kind = 'error' THEN 'MARGIN_CALL'
              ELSE 'ORDER_TRADE_UPDATE' END AS event_type,
         CASE WHEN k IN (0, 1, 2) THEN NULL
              WHEN k = 11 THEN make_timestamp(CAST(floor(
                (CAST(ms AS DOUBLE) + 0.25) / 1000 * 1000000) AS BIGINT))
              ELSE make_timestamp(ms * 1000) END AS bronze_time,
         CASE WHEN k IN (2, 3, 11) THEN NULL
              ELSE CAST(make_timestamp(ms * 1000) AS DATE) END AS silver_date,
         make_timestamp((ms + 1) * 1000) AS event_received_time,
         1 AS schema_version
  FROM facts
)"""

_SIDE = "CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END"
_STATUS = (
    "CASE event_id % 3 WHEN 0 THEN 'NEW' WHEN 1 THEN 'PARTIALLY_FILLED' ELSE 'FILLED' END"
)
_TYPE = "CASE WHEN kind = 'purchase' THEN 'MARKET' ELSE 'LIMIT' END"
_FILLED = "CASE WHEN event_id % 3 = 0 THEN '0' ELSE '1.5' END"
# The texts (quoted) and other values (plain) of a line's order, in the line's order.
_ORDER_JSON = {
    "s": ("quoted", "CASE WHEN k <> 4 THEN 'PAIR' || (user_id % 4) END"),
    "c": ("quoted", "'client-' || event_id"),
    "S": ("quoted", _SIDE),
    "o": ("quoted", _TYPE),
    "f": ("quoted", "CASE WHEN kind = 'view' THEN 'IOC' ELSE 'GTC' END"),
    "q": (
        "quoted",
        "CASE k WHEN 5 THEN '12345678901234567890.5' WHEN 6 THEN '' "
        "WHEN 7 THEN amount::VARCHAR || '567' ELSE amount::VARCHAR END",
    ),
    "p": ("quoted", "CASE WHEN kind = 'purchase' THEN '0' ELSE amount::VARCHAR END"),
    "ap": ("quoted", "amount::VARCHAR"),
    "sp": ("quoted", "'0'"),
    "x": ("quoted", "CASE WHEN event_id % 3 = 0 THEN 'NEW' ELSE 'TRADE' END"),
    "X": ("quoted", _STATUS),
    "i": ("plain", "event_id + 1000000"),
    "l": ("quoted", _FILLED),
    "z": ("quoted", _FILLED),
    "L": ("quoted", "CASE WHEN event_id % 3 = 0 THEN '0' ELSE amount::VARCHAR END"),
    "n": ("quoted", "(amount * CAST(0.0005 AS DECIMAL(5,4)))::VARCHAR"),
    "N": ("quoted", "'USDT'"),
    "T": ("plain", "ms + 5"),
    "t": ("plain", "event_id"),
    "b": ("quoted", "CASE WHEN event_id % 2 = 0 THEN amount::VARCHAR ELSE '0' END"),
    "a": ("quoted", "CASE WHEN event_id % 2 = 0 THEN '0' ELSE amount::VARCHAR END"),
    "m": ("plain", "kind = 'click'"),
    "R": ("plain", "event_id % 2 = 1"),
    "wt": ("quoted", "'CONTRACT_PRICE'"),
    "ot": ("quoted", _TYPE),
    "ps": ("quoted", "'BOTH'"),
    "cp": ("plain", "false"),
    "rp": (
        "quoted",
        "CASE WHEN k = 10 THEN '0' WHEN k <> 9 THEN CAST(amount - 50 AS DECIMAL(18,8))::VARCHAR END",
    ),
    "pP": ("plain", "event_id % 5 = 0"),
    "si": ("plain", "0"),
    "ss": ("plain", "0"),
    "V": ("quoted", "'EXPIRE_MAKER'"),
    "pm": ("quoted", "'NONE'"),
    "gtd": ("plain", "CASE WHEN kind = 'purchase' THEN 0 ELSE ms + 86400000 END"),
    "er": ("quoted", "'0'"),
}


def _object(fields: dict[str, tuple[str, str]]) -> str:
    """A JSON object without its NULL fields."""
    parts = [
        f"'\"{key}\":' || " + (f"'\"' || ({sql}) || '\"'" if kind == "quoted" else f"({sql})::VARCHAR")
        for key, (kind, sql) in fields.items()
    ]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def _amount(more: str) -> tuple[str, str]:
    return "quoted", f"CAST(amount + {more} AS DECIMAL(18,8))::VARCHAR"


_BALANCE_JSON = _object(
    {
        "a": ("quoted", "'ASSET' || z"),
        "wb": _amount("1000 + z"),
        "cw": _amount("900 + z"),
        "bc": _amount("z - 50"),
    }
)
_POSITION_JSON = _object(
    {
        "s": ("quoted", "CASE WHEN k <> 4 THEN 'PAIR' || ((user_id + z) % 4) END"),
        "pa": _amount("0"),
        "ep": _amount("z"),
        "cr": _amount("-100"),
        "up": _amount("z - 250"),
        "mt": ("quoted", "'cross'"),
        "ps": ("quoted", "CASE WHEN z = 0 THEN 'BOTH' ELSE 'LONG' END"),
    }
)
_ACCOUNT_JSON = _object(
    {
        "m": ("quoted", "CASE WHEN user_id % 2 = 0 THEN 'ORDER' ELSE 'FUNDING_FEE' END"),
        "B": (
            "plain",
            f"'[' || array_to_string([{_BALANCE_JSON} FOR z IN range(user_id % 3)], ',') || ']'",
        ),
        "P": (
            "plain",
            f"'[' || array_to_string([{_POSITION_JSON} FOR z IN range(event_id % 3)], ',') || ']'",
        ),
    }
)
_LINES = f""",
lines AS (
  SELECT *, CASE WHEN k = 0 THEN '' ELSE
    CASE WHEN k = 12 THEN '{{' ELSE '{{"e":"' || CASE kind WHEN 'signup' THEN 'ACCOUNT_UPDATE'
      WHEN 'error' THEN 'MARGIN_CALL' ELSE 'ORDER_TRADE_UPDATE' END || '",' END
    || '"T":' || CASE k WHEN 2 THEN '"abc"' WHEN 3 THEN '"' || ms || '"'
      WHEN 11 THEN ms || '.25' ELSE ms::VARCHAR END
    || ',"E":' || (ms + 1)
    || CASE WHEN k = 8 THEN '' WHEN kind = 'signup' THEN ',"a":' || {_ACCOUNT_JSON}
      ELSE ',"o":' || {_object(_ORDER_JSON)} END
    || CASE WHEN k = 1 THEN '' ELSE '}}' END END AS line
  FROM feed
)"""

_ORDER_BODY = {
    "symbol": "CASE WHEN k <> 4 THEN 'PAIR' || (user_id % 4) END",
    "client_order_id": "'client-' || event_id",
    "side": "CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END",
    "order_type": "CASE WHEN kind = 'purchase' THEN 'MARKET' ELSE 'LIMIT' END",
    "time_in_force": "CASE WHEN kind = 'view' THEN 'IOC' ELSE 'GTC' END",
    "original_quantity": "CASE WHEN k = 7 THEN CAST(amount + 0.00000001 AS DECIMAL(18,8)) "
    "WHEN k NOT IN (5, 6) THEN amount END",
    "price": "CASE WHEN kind = 'purchase' THEN CAST(0 AS DECIMAL(18,8)) ELSE amount END",
    "avg_price": "amount",
    "stop_price": "CAST(0 AS DECIMAL(18,8))",
    "execution_type": "CASE WHEN event_id % 3 = 0 THEN 'NEW' ELSE 'TRADE' END",
    "order_status": "CASE event_id % 3 WHEN 0 THEN 'NEW' WHEN 1 THEN 'PARTIALLY_FILLED' "
    "ELSE 'FILLED' END",
    "order_id": "event_id + 1000000",
    "last_fill_qty": "CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1.5 END AS DECIMAL(18,8))",
    "cum_fill_qty": "CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1.5 END AS DECIMAL(18,8))",
    "last_fill_price": "CASE WHEN event_id % 3 = 0 THEN CAST(0 AS DECIMAL(18,8)) ELSE amount END",
    "commission": "CAST(amount * 0.0005 AS DECIMAL(18,8))",
    "commission_asset": "'USDT'",
    "trade_time": "make_timestamp((ms + 5) * 1000)",
    "trade_id": "event_id",
    "bid_notional": "CASE WHEN event_id % 2 = 0 THEN amount ELSE CAST(0 AS DECIMAL(18,8)) END",
    "ask_notional": "CASE WHEN event_id % 2 = 1 THEN amount ELSE CAST(0 AS DECIMAL(18,8)) END",
    "is_maker": "kind = 'click'",
    "is_reduce_only": "event_id % 2 = 1",
    "working_type": "'CONTRACT_PRICE'",
    "original_order_type": "CASE WHEN kind = 'purchase' THEN 'MARKET' ELSE 'LIMIT' END",
    "position_side": "'BOTH'",
    "close_position": "false",
    "realized_pnl": "CASE WHEN k = 10 THEN CAST(0 AS DECIMAL(18,8)) "
    "WHEN k <> 9 THEN CAST(amount - 50 AS DECIMAL(18,8)) END",
    "price_protect": "event_id % 5 = 0",
    "stp_mode": "'EXPIRE_MAKER'",
    "price_match_mode": "'NONE'",
    "good_till_date": "CASE WHEN kind = 'purchase' THEN 0 ELSE ms + 86400000 END",
    "event_reason": "'0'",
}
_BALANCE = {
    "asset": "'ASSET' || b",
    "wallet_balance": "CAST(amount + 1000 + b AS DECIMAL(18,8))",
    "cross_wallet_balance": "CAST(amount + 900 + b AS DECIMAL(18,8))",
    "balance_change": "CAST(amount - 50 + b AS DECIMAL(18,8))",
}
_POSITION = {
    "symbol": "CASE WHEN k <> 4 THEN 'PAIR' || ((user_id + p) % 4) END",
    "position_amount": "amount",
    "entry_price": "CAST(amount + p AS DECIMAL(18,8))",
    "realized_pnl": "CAST(amount - 100 AS DECIMAL(18,8))",
    "unrealized_pnl": "CAST(amount - 250 + p AS DECIMAL(18,8))",
    "position_side": "CASE WHEN p = 0 THEN 'BOTH' ELSE 'LONG' END",
}


def _when(condition: str, columns: dict[str, str]) -> str:
    return ",\n".join(
        f"CASE WHEN {condition} THEN {sql} END AS {name}" for name, sql in columns.items()
    )


_ENVELOPE = "event_type, silver_date AS event_time, event_received_time"
_REASON = {"event_reason": "CASE WHEN user_id % 2 = 0 THEN 'ORDER' ELSE 'FUNDING_FEE' END"}

_ORDERS = f""",
orders_silver AS (
  SELECT {_ENVELOPE}, {_when("k <> 8", _ORDER_BODY)}, schema_version
  FROM feed WHERE event_type = 'ORDER_TRADE_UPDATE'
)"""
# b and p number an event's balances and positions; an event without any has a NULL.
_ACCOUNT = f""",
account_events AS (
  SELECT *, CASE WHEN k = 8 OR user_id % 3 = 0 THEN [NULL::BIGINT]
                 ELSE range(0, user_id % 3) END AS bs,
            CASE WHEN k = 8 OR event_id % 3 = 0 THEN [NULL::BIGINT]
                 ELSE range(0, event_id % 3) END AS ps
  FROM feed WHERE event_type = 'ACCOUNT_UPDATE'
),
balances AS (SELECT *, unnest(bs) AS b FROM account_events),
positions AS (SELECT *, unnest(ps) AS p FROM account_events),
pairs AS (SELECT *, unnest(ps) AS p FROM balances),
account_silver AS (
  SELECT {_ENVELOPE}, {_when("k <> 8", _REASON)}, {_when("b IS NOT NULL", _BALANCE)},
         {_when("p IS NOT NULL", _POSITION)}, schema_version
  FROM pairs
)"""
_ORDER_CLEAN = (
    "(symbol IS NOT NULL AND side IS NOT NULL AND order_type IS NOT NULL "
    "AND event_time IS NOT NULL)"
)
_ACCOUNT_CLEAN = (
    "(symbol IS NOT NULL AND position_side IS NOT NULL AND entry_price IS NOT NULL "
    "AND event_time IS NOT NULL)"
)
_TRADES = f""",
trades AS (
  SELECT order_id, symbol, side, original_quantity, avg_price AS price, realized_pnl,
         trade_time, order_status
  FROM orders_silver
  WHERE {_ORDER_CLEAN} AND side = 'SELL' AND order_status = 'FILLED'
)"""


def _average(condition: str) -> str:
    """The mean as a decimal of 12 digits, in integers: DuckDB divides decimals as doubles.

    The quotient is rounded half up to 18 digits, then to 12, as decimal averages are.
    """
    count = f"count(*) FILTER (WHERE {condition})"
    total = f"CAST(sum(realized_pnl) FILTER (WHERE {condition}) * 100000000 AS HUGEINT)"
    quotient = f"((2 * abs({total}) * 10000000000 + {count}) // (2 * {count}))"
    rounded = f"CAST(sign({total}) * (({quotient} + 500000) // 1000000) AS DECIMAL(22,0))"
    return (
        f"CASE WHEN {count} > 0 THEN CAST({rounded} * CAST(0.000000000001 AS DECIMAL(13,12)) "
        "AS DECIMAL(22,12)) END"
    )


_DAILY = f""",
daily AS (
  SELECT CAST(trade_time AS DATE) AS day,
         CAST(sum(realized_pnl) AS DECIMAL(28,8)) AS total_pnl,
         count(*) AS trades_count,
         count(*) FILTER (WHERE realized_pnl > 0) / count(*) AS win_rate,
         {_average("realized_pnl > 0")} AS avg_win,
         {_average("realized_pnl < 0")} AS avg_loss
  FROM trades GROUP BY 1
)"""

# One ordered window over the curve and one per day: what the bounded groups of the operator
# must add up to.
_PEAKS = """
, curve AS (
  SELECT event_received_time AS moment, CAST(
           sum(amount + 1000 + b) + (SELECT coalesce(sum(amount - 250 + p), 0)
             FROM unnest(any_value(ps)) AS t(p) WHERE p IS NOT NULL) AS DOUBLE) AS equity
  FROM balances WHERE b IS NOT NULL GROUP BY event_id, event_received_time, amount
)"""
_FALLS = """,
peaks AS (
  SELECT CAST(moment AS DATE) AS day, equity,
         max(equity) OVER (PARTITION BY CAST(moment AS DATE) ORDER BY moment, equity
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak,
         max(equity) OVER (ORDER BY moment, equity
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS highest
  FROM curve
),
drawdowns AS (
  SELECT day, max(CASE WHEN peak > 0 THEN 1 - greatest(equity, 0) / peak END) AS max_drawdown,
         max(CASE WHEN highest > 0 THEN 1 - greatest(equity, 0) / highest END) AS running_drawdown
  FROM peaks GROUP BY day
)"""
# The last known amount of every asset and position at every instant, on the full grid of both.
_CARRIED = """
, changes AS (
  SELECT event_received_time AS moment, 'asset' || b AS name, amount + 1000 + b AS known
  FROM balances WHERE b IS NOT NULL UNION ALL
  SELECT event_received_time,
         coalesce(CASE WHEN k <> 4 THEN 'PAIR' || ((user_id + p) % 4) END, '') ||
           CASE WHEN p = 0 THEN '/BOTH' ELSE '/LONG' END,
         amount - 250 + p
  FROM positions WHERE p IS NOT NULL
),
once AS (SELECT moment, name, max(known) AS known FROM changes GROUP BY ALL),
grid AS (
  SELECT moment, name FROM (SELECT DISTINCT moment FROM once)
  CROSS JOIN (SELECT DISTINCT name FROM once)
),
filled AS (
  SELECT moment, last_value(known IGNORE NULLS) OVER (PARTITION BY name ORDER BY moment
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known
  FROM grid LEFT JOIN once USING (moment, name)
),
carried AS (
  SELECT moment, CAST(sum(known) AS DECIMAL(28,8)) AS equity FROM filled GROUP BY moment
)"""
_SHARPE = """
, moments AS (
  SELECT CAST(trade_time AS DATE) AS day, avg(realized_pnl) AS mean,
         stddev_samp(CAST(realized_pnl AS DOUBLE)) AS deviation
  FROM trades GROUP BY 1
),
sharpes AS (
  SELECT day, CASE WHEN deviation > 0 THEN round(mean / deviation, 9) END AS sharpe FROM moments
)"""


def _bronze(body: str) -> str:
    return f"WITH {_FEED}\n{body}"


def _orders(body: str) -> str:
    return f"WITH {_FEED}{_ORDERS}\n{body}"


def _account(body: str) -> str:
    return f"WITH {_FEED}{_ACCOUNT}\n{body}"


def _silver(body: str) -> str:
    return f"WITH {_FEED}{_ORDERS}{_ACCOUNT}\n{body}"


def _trades(body: str) -> str:
    return f"WITH {_FEED}{_ORDERS}{_TRADES}\n{body}"


def _daily(body: str) -> str:
    return f"WITH {_FEED}{_ORDERS}{_TRADES}{_DAILY}\n{body}"


def _parts(feed: str, table: str, clean: str) -> str:
    return (
        f"SELECT '{feed}' AS feed, count(*) AS row_count, "
        f"count(*) FILTER (WHERE {clean}) AS clean, "
        f"count(*) FILTER (WHERE NOT {clean}) AS quarantine, "
        f"0::BIGINT AS \"both\", 0::BIGINT AS neither FROM {table}"
    )


_SILVER_BY_DATE = _silver(
    f"SELECT 'orders' AS feed, event_time, count(*) AS row_count FROM orders_silver "
    f"WHERE {_ORDER_CLEAN} GROUP BY event_time UNION ALL "
    f"SELECT 'account', event_time, count(*) FROM account_silver "
    f"WHERE {_ACCOUNT_CLEAN} GROUP BY event_time"
)
_BY_TYPE = _bronze("SELECT event_type, count(*) AS events FROM feed GROUP BY event_type")
_ALL_TRADES = _trades("SELECT * FROM trades")
_ALL_DAYS = _daily("SELECT * FROM daily")

_RISK = (
    f"WITH {_FEED}{_ORDERS}{_TRADES}{_ACCOUNT}{_PEAKS}{_FALLS}{_SHARPE}\n"
    "SELECT day, max_drawdown, running_drawdown, sharpe FROM drawdowns FULL JOIN "
    "(SELECT * FROM sharpes WHERE day IS NOT NULL) USING (day)"
)
_VERDICTS = _silver(
    f"SELECT 'orders' AS feed, CASE WHEN {_ORDER_CLEAN} THEN 'clean' ELSE 'quarantine' END "
    "AS verdict, count(*) AS row_count FROM orders_silver GROUP BY 1, 2 UNION ALL "
    f"SELECT 'account', CASE WHEN {_ACCOUNT_CLEAN} THEN 'clean' ELSE 'quarantine' END, "
    "count(*) FROM account_silver GROUP BY 1, 2"
)

ORACLES: dict[str, str] = {
    "raw_line_count": _bronze(
        "SELECT count(*) AS lines, count(*) FILTER (WHERE k = 0) AS blank_lines FROM feed"
    ),
    "bronze_envelope": _bronze(
        "SELECT bronze_time AS event_time, event_type, CAST(bronze_time AS DATE) AS event_date "
        "FROM feed"
    ),
    "bronze_roundtrip_by_partition": _bronze(
        "SELECT event_type, CAST(bronze_time AS DATE) AS event_date, count(*) AS events "
        "FROM feed GROUP BY 1, 2"
    ),
    "route_by_event_type": _BY_TYPE,
    "unrouted_by_type": _bronze(
        "SELECT event_type, count(*) AS events FROM feed WHERE event_type IS NULL "
        "OR event_type NOT IN ('ORDER_TRADE_UPDATE', 'ACCOUNT_UPDATE') GROUP BY event_type"
    ),
    "silver_orders": _orders("SELECT * FROM orders_silver"),
    "silver_account": _account("SELECT * FROM account_silver"),
    "clean_orders": _orders(f"SELECT * FROM orders_silver WHERE {_ORDER_CLEAN}"),
    "clean_account": _account(f"SELECT * FROM account_silver WHERE {_ACCOUNT_CLEAN}"),
    "quarantine_orders": _orders(f"SELECT * FROM orders_silver WHERE NOT {_ORDER_CLEAN}"),
    "quarantine_account": _account(f"SELECT * FROM account_silver WHERE NOT {_ACCOUNT_CLEAN}"),
    "split_is_partition": _silver(
        _parts("orders", "orders_silver", _ORDER_CLEAN)
        + " UNION ALL "
        + _parts("account", "account_silver", _ACCOUNT_CLEAN)
    ),
    "verdict_by_feed": _VERDICTS,
    "account_balances_exploded": _account(
        f"SELECT {_ENVELOPE}, {_when('k <> 8', _REASON)}, {_when('b IS NOT NULL', _BALANCE)}, "
        "schema_version FROM balances"
    ),
    "account_positions_exploded": _account(
        f"SELECT {_ENVELOPE}, {_when('k <> 8', _REASON)}, {_when('p IS NOT NULL', _POSITION)}, "
        "schema_version FROM positions"
    ),
    "account_cross_explode": _account(
        "SELECT event_received_time, count(*) AS row_count, count(asset) AS with_balance, "
        "count(entry_price) AS with_position FROM account_silver GROUP BY event_received_time"
    ),
    "decimal_parse": _orders("SELECT order_id, original_quantity, commission FROM orders_silver"),
    "silver_schema_version": _orders(
        "SELECT schema_version, count(*) AS row_count FROM orders_silver GROUP BY schema_version"
    ),
    "silver_roundtrip_by_date": _SILVER_BY_DATE,
    "quarantine_by_feed": _silver(
        "SELECT 'orders' AS feed, event_type, count(*) AS row_count FROM orders_silver "
        f"WHERE NOT {_ORDER_CLEAN} GROUP BY event_type UNION ALL "
        "SELECT 'account', event_type, count(*) FROM account_silver "
        f"WHERE NOT {_ACCOUNT_CLEAN} GROUP BY event_type"
    ),
    "gold_trades": _ALL_TRADES,
    "daily_metrics": _ALL_DAYS,
    "gold_roundtrip": _ALL_TRADES,
    "gold_trades_of_orders": _trades(
        "SELECT * FROM trades WHERE order_id IN (SELECT order_id FROM trades "
        "ORDER BY realized_pnl DESC NULLS LAST, order_id LIMIT 10)"
    ),
    "end_to_end": _ALL_DAYS,
    "gold_sql_daily": _daily(
        "SELECT day, total_pnl, trades_count, win_rate FROM daily WHERE total_pnl > 0"
    ),
    "gold_sql_symbols": _trades(
        "SELECT symbol, count(*) AS trades_count, "
        "CAST(sum(realized_pnl) AS DECIMAL(28,8)) AS total_pnl FROM trades GROUP BY symbol"
    ),
    "daily_max_drawdown": _account(
        f"{_PEAKS}{_FALLS}\nSELECT * FROM drawdowns",
    ),
    "carried_equity": _account(f"{_CARRIED}\nSELECT moment AS at, equity FROM carried"),
    "carried_drawdown": _account(
        f"{_CARRIED},\ncurve AS (SELECT moment, CAST(equity AS DOUBLE) AS equity FROM carried)"
        f"{_FALLS}\nSELECT * FROM drawdowns"
    ),
    "daily_sharpe": _trades(f"{_SHARPE}\nSELECT * FROM sharpes"),
    "gold_sql_risk": _RISK,
    "batch_two_loads": _ALL_DAYS,
    "batch_three_loads_metrics": _ALL_DAYS,
    "batch_three_loads_risk": _RISK,
    "batch_merged_parts": _VERDICTS,
    "batch_late_trades": _trades(
        # A load's trades are late if their day is over by a day at the newest of earlier loads.
        ", loads AS (SELECT (order_id - 1000000) % 4 AS k, trade_time, CAST(trade_time AS DATE) "
        "AS day FROM trades),\n"
        "newest AS (SELECT l.k, max(e.trade_time) AS at FROM "
        "(SELECT DISTINCT k FROM loads) l JOIN loads e ON e.k < l.k GROUP BY l.k)\n"
        "SELECT day, count(*) AS trades_count, "
        "count(*) FILTER (WHERE n.at >= day + INTERVAL 2 DAY) AS late_trades "
        "FROM loads LEFT JOIN newest n USING (k) GROUP BY day HAVING day + INTERVAL 2 DAY <= "
        "(SELECT max(trade_time) FROM trades)"
    ),
    # Loads come in the order 2, 0, 3, 1; a load is judged by those before it.
    "batch_windows_and_late": _trades(
        ", loads AS (SELECT CASE (order_id - 1000000) % 4 WHEN 2 THEN 0 WHEN 0 THEN 1 "
        "WHEN 3 THEN 2 ELSE 3 END AS k, trade_time, realized_pnl, "
        "CAST(trade_time AS DATE) AS day FROM trades),\n"
        "newest AS (SELECT l.k, max(e.trade_time) AS at FROM "
        "(SELECT DISTINCT k FROM loads) l JOIN loads e ON e.k < l.k GROUP BY l.k),\n"
        "judged AS (SELECT day, realized_pnl, coalesce(n.at >= day + INTERVAL 2 DAY, false) "
        "AS is_late FROM loads LEFT JOIN newest n USING (k))\n"
        "SELECT day, count(*) FILTER (WHERE NOT is_late) AS in_window, "
        "CAST(sum(realized_pnl) FILTER (WHERE NOT is_late) AS DECIMAL(28,8)) AS window_pnl, "
        "nullif(count(*) FILTER (WHERE is_late), 0) AS late, "
        "CAST(sum(realized_pnl) FILTER (WHERE is_late) AS DECIMAL(28,8)) AS late_pnl "
        "FROM judged GROUP BY day HAVING in_window > 0"
    ),
    "batch_redelivered": _ALL_DAYS,
    "stream_redelivered": f"WITH {_FEED}{_LINES}\nSELECT DISTINCT md5(line) AS digest FROM lines",
    "raw_json_digests": f"WITH {_FEED}{_LINES}\n"
    "SELECT 'bronze' AS \"table\", md5(line) AS digest, count(*) AS lines FROM lines GROUP BY 2 "
    "UNION ALL SELECT 'orders', md5(line), count(*) FROM lines "
    "WHERE event_type = 'ORDER_TRADE_UPDATE' AND k NOT IN (4, 8) AND silver_date IS NOT NULL "
    "GROUP BY 2",
    "silver_elements": _account(
        f"SELECT 'balances' AS element, count(*) AS row_count, "
        f"CAST(sum({_BALANCE['balance_change']}) AS DECIMAL(28,8)) AS total "
        f"FROM balances WHERE b IS NOT NULL UNION ALL "
        f"SELECT 'positions', count(*), "
        f"CAST(sum({_POSITION['realized_pnl']}) AS DECIMAL(28,8)) "
        f"FROM positions WHERE p IS NOT NULL"
    ),
    "stream_landing_count": "SELECT count(*) AS lines FROM events",
    "stream_bronze_count": _BY_TYPE,
    "stream_silver_split": _SILVER_BY_DATE,
    "stream_gold": _ALL_TRADES,
    "stream_daily_metrics": _ALL_DAYS,
    "stream_settled_days": _daily(
        "SELECT * FROM daily WHERE day + INTERVAL 1 DAY <= "
        "(SELECT max(trade_time) FROM trades) - INTERVAL 1 DAY"
    ),
}
