"""The ``events`` test table as a feed of trading-account JSON lines.

Every event becomes one line. The event's own columns decide the payload, and the number
``k`` in its properties decides which defect the line has, if any, so that malformed
input occurs throughout the data:

====  ==========================================================
k     defect
====  ==========================================================
0     blank line
1     truncated JSON
2     event time is no number
3     event time is a number in quotes
4     no symbol
5     quantity too wide for its type
6     empty quantity
7     quantity with more fraction digits than its type
8     no body
9     no realized PnL
10    realized PnL of zero
11    event time has a fraction
12    no event type
====  ==========================================================
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import ACCOUNT_EVENT, ORDER_EVENT


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def feed_lines(events: DataFrame) -> DataFrame:
    """One JSON line per event, in a column ``value``."""
    facts = events.select(
        "event_id",
        "user_id",
        "event_type",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("millis"),
        F.col("value").cast("decimal(18,8)").alias("amount"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    kind = (
        F.when(F.col("event_type") == "signup", ACCOUNT_EVENT)
        .when(F.col("event_type") == "error", "MARGIN_CALL")
        .otherwise(ORDER_EVENT)
    )
    millis, k = F.col("millis"), F.col("k")
    time = (
        F.when(k == 2, '"abc"')
        .when(k == 3, F.concat(F.lit('"'), millis, F.lit('"')))
        .when(k == 11, F.concat(millis, F.lit(".25")))
        .otherwise(millis.cast("string"))
    )
    body = (
        F.when(k == 8, "")
        .when(F.col("event_type") == "signup", F.concat(F.lit(',"a":'), _account_body()))
        .otherwise(F.concat(F.lit(',"o":'), _order_body()))
    )
    line = F.concat(
        F.when(k == 12, "{").otherwise(F.concat(F.lit('{"e":"'), kind, F.lit('",'))),
        F.lit('"T":'),
        time,
        F.lit(',"E":'),
        millis + 1,
        body,
        F.when(k == 1, "").otherwise("}"),
    )
    return facts.select(F.when(k == 0, "").otherwise(line).alias("value"))


def _text(amount: Column) -> Column:
    return amount.cast("decimal(18,8)").cast("string")


def _order_body() -> Column:
    user, event, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")
    millis, amount, k = F.col("millis"), F.col("amount"), F.col("k")
    side = F.when(event % 2 == 0, "BUY").otherwise("SELL")
    status = (
        F.when(event % 3 == 0, "NEW").when(event % 3 == 1, "PARTIALLY_FILLED").otherwise("FILLED")
    )
    order_type = F.when(kind == "purchase", "MARKET").otherwise("LIMIT")
    limited = kind != "purchase"
    filled = F.when(status == "NEW", "0").otherwise("1.5")
    fields = {
        "s": F.when(k != 4, F.concat(F.lit("PAIR"), user % 4)),
        "c": F.concat(F.lit("client-"), event),
        "S": side,
        "o": order_type,
        "f": F.when(kind == "view", "IOC").otherwise("GTC"),
        "q": F.when(k == 5, "12345678901234567890.5")
        .when(k == 6, "")
        .when(k == 7, F.concat(_text(amount), F.lit("567")))
        .otherwise(_text(amount)),
        "p": F.when(limited, _text(amount)).otherwise("0"),
        "ap": _text(amount),
        "sp": F.lit("0"),
        "x": F.when(status == "NEW", "NEW").otherwise("TRADE"),
        "X": status,
        "i": event + 1000000,
        "l": filled,
        "z": filled,
        "L": F.when(status == "NEW", "0").otherwise(_text(amount)),
        "n": (amount * F.lit("0.0005").cast("decimal(5,4)")).cast("string"),
        "N": F.lit("USDT"),
        "T": millis + 5,
        "t": event,
        "b": F.when(side == "BUY", _text(amount)).otherwise("0"),
        "a": F.when(side == "SELL", _text(amount)).otherwise("0"),
        "m": kind == "click",
        "R": side == "SELL",
        "wt": F.lit("CONTRACT_PRICE"),
        "ot": order_type,
        "ps": F.lit("BOTH"),
        "cp": F.lit(False),
        "rp": F.when(k == 10, "0").when(k != 9, _text(amount - 50)),
        "pP": event % 5 == 0,
        "si": F.lit(0),
        "ss": F.lit(0),
        "V": F.lit("EXPIRE_MAKER"),
        "pm": F.lit("NONE"),
        "gtd": F.when(limited, millis + 86400000).otherwise(0),
        "er": F.lit("0"),
    }
    return _json(fields)


def _account_body() -> Column:
    user, event = F.col("user_id"), F.col("event_id")
    amount, k = F.col("amount"), F.col("k")
    balances = _times(
        user % 3,
        lambda at: _struct(
            {
                "a": F.concat(F.lit("ASSET"), at),
                "wb": _text(amount + 1000 + at),
                "cw": _text(amount + 900 + at),
                "bc": _text(amount - 50 + at),
            }
        ),
    )
    positions = _times(
        event % 3,
        lambda at: _struct(
            {
                "s": F.when(k != 4, F.concat(F.lit("PAIR"), (user + at) % 4)),
                "pa": _text(amount),
                "ep": _text(amount + at),
                "cr": _text(amount - 100),
                "up": _text(amount - 250 + at),
                "mt": F.lit("cross"),
                "ps": F.when(at == 0, "BOTH").otherwise("LONG"),
            }
        ),
    )
    reason = F.when(user % 2 == 0, "ORDER").otherwise("FUNDING_FEE")
    return _json({"m": reason, "B": balances, "P": positions})


def _times(count: Column, element) -> Column:
    """An array of zero to two elements made from their positions."""
    positions = F.slice(F.sequence(F.lit(0), F.lit(1)), F.lit(1), count.cast("int"))
    return F.transform(positions, element)


def _struct(fields: dict[str, Column]) -> Column:
    return F.struct(*[column.alias(name) for name, column in fields.items()])


def _json(fields: dict[str, Column]) -> Column:
    return F.to_json(_struct(fields))
