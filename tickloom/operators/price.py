"""Returns, gaps and intraday range of each bar."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.functions.labels import compared
from tickloom.functions.numeric import pct_change, ratio
from tickloom.functions.series import BY_SYMBOL, Series, add_columns

INPUT = ["SYMBOL", "DATE", "OPEN_PRICE", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE"]
# The columns of the table, in the order of its contract.
OUTPUT = [
    "SYMBOL",
    "DATE",
    "PREV_CLOSE_PRICE",
    "DAILY_RETURN_PCT",
    "GAP_AMOUNT",
    "GAP_DIRECTION",
    "DAILY_DIRECTION",
    "INTRADAY_RANGE_AMT",
    "INTRADAY_RANGE_PCT",
    "20_DAY_AVG_INTRADAY_RANGE_PCT",
]
REACH = 20


def add_price_metrics(bars: DataFrame, series: Series = BY_SYMBOL) -> DataFrame:
    ranged = add_columns(
        bars,
        {
            "INTRADAY_RANGE_AMT": "HIGH_PRICE - LOW_PRICE",
            "INTRADAY_RANGE_PCT": f"{ratio('HIGH_PRICE - LOW_PRICE', 'CLOSE_PRICE')} * 100",
        },
    )
    framed = add_columns(
        ranged,
        {
            "PREV_CLOSE_PRICE": series.before("CLOSE_PRICE"),
            "20_DAY_AVG_INTRADAY_RANGE_PCT": series.mean("INTRADAY_RANGE_PCT", 20),
        },
    )
    return add_columns(
        framed,
        {
            "DAILY_RETURN_PCT": pct_change("CLOSE_PRICE", "PREV_CLOSE_PRICE"),
            "GAP_AMOUNT": "OPEN_PRICE - PREV_CLOSE_PRICE",
            "GAP_DIRECTION": compared("OPEN_PRICE", "PREV_CLOSE_PRICE", "UP", "DOWN", "NO_GAP"),
            "DAILY_DIRECTION": compared("CLOSE_PRICE", "PREV_CLOSE_PRICE", "UP", "DOWN", "FLAT"),
        },
    )
