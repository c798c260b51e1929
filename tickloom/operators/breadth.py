"""Market-wide share of rising, outperforming and strengthening symbols per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.series import BY_SYMBOL, Series, add_columns

# The columns of the table, in the order of its contract.
OUTPUT = [
    "DATE",
    "TOTAL_STOCKS",
    "PCT_STOCKS_UP",
    "PCT_STOCKS_DOWN",
    "PCT_STOCKS_OUTPERFORMING",
    "PCT_RS_STRENGTHENING",
    "AVG_MARKET_VOLATILITY",
    "BREADTH_REGIME",
]

# Lowest share of rising symbols for each regime.
REGIMES = [("STRONG_BULL", 0.70), ("BULL", 0.50), ("NEUTRAL", 0.40), ("BEAR", 0.25)]
LOWEST_REGIME = "STRONG_BEAR"


def add_first_of_day(bars: DataFrame, series: Series = BY_SYMBOL) -> DataFrame:
    """Mark the first bar of each symbol and day.

    Summed per day this is the exact number of distinct symbols. It rides on
    the window the price metrics already need, where a distinct count would
    shuffle every bar once more.
    """
    return add_columns(bars, {"FIRST_OF_DAY": f"NOT (DATE <=> {series.before('DATE')})"})


# Per day, by name: what is counted or summed of its bars. Sums of these over any division of the bars are those of all.
_COUNTS = {
    "TOTAL_STOCKS": "count_if(FIRST_OF_DAY)",
    "BARS": "count(*)",
    "BARS_UP": "count_if(DAILY_DIRECTION = 'UP')",
    "BARS_DOWN": "count_if(DAILY_DIRECTION = 'DOWN')",
    "BARS_OUTPERFORMING": "count_if(RELATIVE_STRENGTH_DIRECTION = 'OUTPERFORM')",
    "BARS_STRENGTHENING": "count_if(RS_TREND = 'STRENGTHENING')",
    "BARS_VOLATILE": "count(ROLLING_VOLATILITY_20D)",
    "VOLATILITY": "sum(ROLLING_VOLATILITY_20D)",
}


def daily_counts(bars: DataFrame) -> DataFrame:
    """One row per day from bars with price, risk and strength columns side by side: all that breadth needs of them.

    Counts of bars that were divided by symbol can be stored apart; ``breadth_of_counts`` adds them up.
    """
    full = bars.filter("SYMBOL IS NOT NULL AND DATE IS NOT NULL")
    return full.groupBy("DATE").agg(*[F.expr(f"{sql} AS {name}") for name, sql in _COUNTS.items()])


def breadth_of_counts(counts: DataFrame) -> DataFrame:
    """The table from the ``daily_counts`` of all bars, however they were divided."""
    added = counts.groupBy("DATE").agg(*[F.expr(f"sum({name}) AS {name}") for name in _COUNTS])
    return _shares(added)


def _shares(daily: DataFrame) -> DataFrame:
    shares = {
        "PCT_STOCKS_UP": "BARS_UP / BARS",
        "PCT_STOCKS_DOWN": "BARS_DOWN / BARS",
        "PCT_STOCKS_OUTPERFORMING": "BARS_OUTPERFORMING / BARS",
        "PCT_RS_STRENGTHENING": "BARS_STRENGTHENING / BARS",
        "AVG_MARKET_VOLATILITY": "VOLATILITY / nullif(BARS_VOLATILE, 0)",
    }
    bands = " ".join(f"WHEN PCT_STOCKS_UP >= {floor}D THEN '{name}'" for name, floor in REGIMES)
    regime = {"BREADTH_REGIME": f"CASE {bands} ELSE '{LOWEST_REGIME}' END"}
    return add_columns(add_columns(daily, shares), regime).select(*OUTPUT)


def market_breadth(bars: DataFrame) -> DataFrame:
    """One row per day from bars with price, risk and strength columns side by side."""
    return _shares(daily_counts(bars))
