"""Payload fields and table contracts.

Payload keys of one struct may differ only by case (``e``/``E``, ``s``/``S``), which
Spark's default name resolution cannot tell apart. Each field therefore carries a JSON
key and a column name: payloads are parsed by key and renamed by position, so no plan
ever resolves a colliding name and the session may keep ``spark.sql.caseSensitive=false``.
"""

from pyspark.sql import types as T

TEXT = T.StringType()
WHOLE = T.LongType()
SMALL = T.IntegerType()
FLAG = T.BooleanType()
MONEY = T.DecimalType(18, 8)

# Event types routed to silver.
ORDER_EVENT = "ORDER_TRADE_UPDATE"
ACCOUNT_EVENT = "ACCOUNT_UPDATE"

# JSON key, column name and type of each payload field, in payload order.
ENVELOPE = (
    ("e", "event_type", TEXT),
    ("T", "event_time", WHOLE),
    ("E", "event_received_time", WHOLE),
)
ORDER_BODY = (
    ("s", "symbol", TEXT),
    ("c", "client_order_id", TEXT),
    ("S", "side", TEXT),
    ("o", "order_type", TEXT),
    ("f", "time_in_force", TEXT),
    ("q", "original_quantity", MONEY),
    ("p", "price", MONEY),
    ("ap", "avg_price", MONEY),
    ("sp", "stop_price", MONEY),
    ("x", "execution_type", TEXT),
    ("X", "order_status", TEXT),
    ("i", "order_id", WHOLE),
    ("l", "last_fill_qty", MONEY),
    ("z", "cum_fill_qty", MONEY),
    ("L", "last_fill_price", MONEY),
    ("n", "commission", MONEY),
    ("N", "commission_asset", TEXT),
    ("T", "trade_time", WHOLE),
    ("t", "trade_id", WHOLE),
    ("b", "bid_notional", MONEY),
    ("a", "ask_notional", MONEY),
    ("m", "is_maker", FLAG),
    ("R", "is_reduce_only", FLAG),
    ("wt", "working_type", TEXT),
    ("ot", "original_order_type", TEXT),
    ("ps", "position_side", TEXT),
    ("cp", "close_position", FLAG),
    ("rp", "realized_pnl", MONEY),
    ("pP", "price_protect", FLAG),
    ("si", "si", SMALL),
    ("ss", "ss", SMALL),
    ("V", "stp_mode", TEXT),
    ("pm", "price_match_mode", TEXT),
    ("gtd", "good_till_date", WHOLE),
    ("er", "event_reason", TEXT),
)
BALANCE = (
    ("a", "asset", TEXT),
    ("wb", "wallet_balance", MONEY),
    ("cw", "cross_wallet_balance", MONEY),
    ("bc", "balance_change", MONEY),
)
POSITION = (
    ("s", "symbol", TEXT),
    ("pa", "position_amount", MONEY),
    ("ep", "entry_price", MONEY),
    ("cr", "realized_pnl", MONEY),
    ("up", "unrealized_pnl", MONEY),
    ("ps", "position_side", TEXT),
)
ACCOUNT_BODY = (
    ("m", "event_reason", TEXT),
    ("B", "balances", [BALANCE]),
    ("P", "positions", [POSITION]),
)
ORDER_PAYLOAD = (*ENVELOPE, ("o", "body", ORDER_BODY))
ACCOUNT_PAYLOAD = (*ENVELOPE, ("a", "body", ACCOUNT_BODY))

# Order body fields that are parsed but not part of the silver table.
UNPROJECTED = ("si", "ss")

# Columns a row needs to be clean.
ORDER_REQUIRED = ("symbol", "side", "order_type", "event_time")
ACCOUNT_REQUIRED = ("symbol", "position_side", "entry_price", "event_time")


def _typed(kind, name_at: int) -> T.DataType:
    if isinstance(kind, list):
        return T.ArrayType(_typed(kind[0], name_at))
    if isinstance(kind, tuple):
        return T.StructType([T.StructField(f[name_at], _typed(f[2], name_at)) for f in kind])
    return kind


def by_key(payload: tuple) -> T.StructType:
    """The payload's type with JSON keys as field names."""
    return _typed(payload, 0)


def by_name(payload: tuple) -> T.StructType:
    """The same type, position by position, with column names as field names."""
    return _typed(payload, 1)


def names(fields: tuple) -> list[str]:
    return [name for _, name, _ in fields if name not in UNPROJECTED]


def narrowed(payload: tuple, only: tuple[str, ...]) -> tuple:
    """The payload with the named columns of its body alone."""
    *envelope, (key, name, body) = payload
    if unknown := set(only) - set(names(body)):
        raise ValueError(f"no columns of the payload: {sorted(unknown)}")
    return (*envelope, (key, name, tuple(field for field in body if field[1] in only)))


def _columns(fields: tuple, **replaced: T.DataType) -> list[T.StructField]:
    return [
        T.StructField(name, replaced.get(name, kind))
        for _, name, kind in fields
        if name not in UNPROJECTED
    ]


_TIMES = {
    "event_time": T.DateType(),
    "event_received_time": T.TimestampType(),
    "trade_time": T.TimestampType(),
}
_INGEST = [T.StructField("ingest_time", T.TimestampType()), T.StructField("raw_json", TEXT)]
_LINEAGE = [
    T.StructField("processing_time", T.TimestampType()),
    T.StructField("schema_version", SMALL),
]

LANDING = T.StructType([T.StructField("value", TEXT)])

# The last two columns are the partition columns.
BRONZE = T.StructType(
    [
        T.StructField("raw_json", TEXT),
        T.StructField("ingest_time", T.TimestampType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("event_type", TEXT),
        T.StructField("event_date", T.DateType()),
    ]
)
# What tells lines of bronze apart.
LINE_DIGESTS = T.StructType(
    [T.StructField("digest", T.BinaryType()), T.StructField("event_date", T.DateType())]
)
SILVER_ORDERS = T.StructType(
    _columns(ENVELOPE, **_TIMES) + _columns(ORDER_BODY, **_TIMES) + _INGEST + _LINEAGE
)
SILVER_ACCOUNT = T.StructType(
    _columns(ENVELOPE, **_TIMES)
    + _columns(ACCOUNT_BODY[:1])
    + _columns(BALANCE)
    + _columns(POSITION)
    + _INGEST
    + _LINEAGE
)
# Parsed account updates, arrays kept, and the tables of their elements.
ACCOUNT_EVENTS = T.StructType(_INGEST + by_name(ACCOUNT_PAYLOAD).fields)
BALANCES = T.StructType(
    _columns(ENVELOPE, **_TIMES)
    + _columns(ACCOUNT_BODY[:1])
    + _columns(BALANCE)
    + _INGEST[:1]
    + _LINEAGE
)
POSITIONS = T.StructType(
    _columns(ENVELOPE, **_TIMES)
    + _columns(ACCOUNT_BODY[:1])
    + _columns(POSITION)
    + _INGEST[:1]
    + _LINEAGE
)
_SUM = T.DecimalType(28, 8)
_COUNT = T.DecimalType(38, 0)
# Sums of one load's trades by day.
TRADE_DAYS = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("trades", WHOLE),
        T.StructField("known", WHOLE),
        T.StructField("total", _SUM),
        T.StructField("wins", WHOLE),
        T.StructField("win_total", _SUM),
        T.StructField("losses", WHOLE),
        T.StructField("loss_total", _SUM),
        T.StructField("newest", T.TimestampType()),
        T.StructField("late", WHOLE),
        T.StructField("high_sum", _COUNT),
        T.StructField("high_squares", _COUNT),
        T.StructField("high_lows", _COUNT),
        T.StructField("low_squares", _COUNT),
    ]
)
# The equity curve of one load, by instant and summed up by minute.
EQUITY_INSTANTS = T.StructType(
    [
        T.StructField("minute", T.TimestampType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("day", T.DateType()),
    ]
)
EQUITY_MINUTES = T.StructType(
    [
        T.StructField("minute", T.TimestampType()),
        T.StructField("fall", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
    ]
)

# The gold tables that dashboards query.
GOLD_TRADES = T.StructType(
    [
        T.StructField("order_id", WHOLE),
        T.StructField("symbol", TEXT),
        T.StructField("side", TEXT),
        T.StructField("original_quantity", MONEY),
        T.StructField("price", MONEY),
        T.StructField("realized_pnl", MONEY),
        T.StructField("trade_time", T.TimestampType()),
        T.StructField("order_status", TEXT),
    ]
)
#: Columns in whose order files of trades are kept.
TRADE_ORDER = ("trade_time", "symbol")
TRADE_BLOOMS = ("order_id",)
GOLD_DAILY_METRICS = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("total_pnl", T.DecimalType(28, 8)),
        T.StructField("trades_count", WHOLE),
        T.StructField("win_rate", T.DoubleType()),
        T.StructField("avg_win", T.DecimalType(22, 12)),
        T.StructField("avg_loss", T.DecimalType(22, 12)),
    ]
)
GOLD_DAILY_RISK = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("max_drawdown", T.DoubleType()),
        T.StructField("running_drawdown", T.DoubleType()),
        T.StructField("sharpe", T.DoubleType()),
    ]
)
