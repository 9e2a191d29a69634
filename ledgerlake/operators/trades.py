"""Silver orders to gold trades."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.orders import silver_orders
from ledgerlake.operators.quality import clean_rows
from ledgerlake.schemas import ORDER_REQUIRED

#: Columns of an update's body that decide whether it is a trade, or are part of one.
TRADE_FIELDS = (
    "symbol",
    "side",
    "order_type",
    "original_quantity",
    "avg_price",
    "order_status",
    "order_id",
    "trade_time",
    "realized_pnl",
)


def closed_trades(orders: DataFrame) -> DataFrame:
    """Completely filled sells, at their average price."""
    return orders.where((F.col("side") == "SELL") & (F.col("order_status") == "FILLED")).select(
        "order_id",
        "symbol",
        "side",
        "original_quantity",
        F.col("avg_price").alias("price"),
        "realized_pnl",
        "trade_time",
        "order_status",
    )


def trades_of_bronze(bronze: DataFrame) -> DataFrame:
    """Trades straight from bronze, for questions that silver is not there to answer yet.

    Nine fields of a line's body are converted, not all 35.
    """
    return closed_trades(clean_rows(silver_orders(bronze, only=TRADE_FIELDS), ORDER_REQUIRED))


def trades_of_orders(trades: DataFrame, order_ids: list[int]) -> DataFrame:
    """The trades of some orders.

    Gold trades have bloom filters on ``order_id``, so that row groups without any of them are
    skipped. A few ids reach the scan as they are; of more, the least and the greatest.
    """
    return trades.where(F.col("order_id").isin(order_ids))
