"""Rolling return, volatility and drawdown over the trailing 20 bars."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.functions.numeric import growth, ratio
from tickloom.functions.series import BY_SYMBOL, Series, add_columns

# The columns of the table, in the order of its contract.
OUTPUT = [
    "SYMBOL",
    "DATE",
    "ROLLING_VOLATILITY_20D",
    "MAX_DRAWDOWN_LOOKBACK",
    "ROLLING_RETURN_20D",
    "RISK_ADJUSTED_RETURN_20D",
]
# Two 20-row frames are stacked, so one value looks back 40 rows.
REACH = 40


PRICED_BAR = "SYMBOL IS NOT NULL AND DATE IS NOT NULL AND CLOSE_PRICE IS NOT NULL"


def add_risk_metrics(bars: DataFrame, series: Series = BY_SYMBOL) -> DataFrame:
    """Needs DAILY_RETURN_PCT, and bars for which ``PRICED_BAR`` holds.

    Volatility is the root mean square of (return - own trailing mean): each
    bar in the frame is measured against the mean of the 20 bars before *it*,
    so this is not a standard deviation of the frame. Drawdown likewise takes
    the lowest of 20 values, each measured against its own trailing high.
    """
    levels = add_columns(
        bars,
        {
            "CLOSE_PRICE_20D": series.before("CLOSE_PRICE", 20),
            "AVG_RETURN_20D": series.mean("DAILY_RETURN_PCT", 20),
            "ROLLING_MAX_CLOSE_20D": series.highest("CLOSE_PRICE", 20),
        },
    )
    surprise = "(DAILY_RETURN_PCT - AVG_RETURN_20D)"
    measured = add_columns(
        levels,
        {
            "SQUARED_SURPRISE": f"{surprise} * {surprise}",
            "DRAWDOWN_TODAY": growth("CLOSE_PRICE", "ROLLING_MAX_CLOSE_20D"),
            "ROLLING_RETURN_20D": growth("CLOSE_PRICE", "CLOSE_PRICE_20D"),
        },
    )
    nested = add_columns(
        measured,
        {
            "VARIANCE_20D": series.mean("SQUARED_SURPRISE", 20),
            "MAX_DRAWDOWN_LOOKBACK": series.lowest("DRAWDOWN_TODAY", 20),
        },
    )
    rooted = add_columns(nested, {"ROLLING_VOLATILITY_20D": "sqrt(VARIANCE_20D)"})
    adjusted = ratio("ROLLING_RETURN_20D", "ROLLING_VOLATILITY_20D")
    return add_columns(
        rooted, {"RISK_ADJUSTED_RETURN_20D": f"CASE WHEN ROLLING_VOLATILITY_20D > 0 THEN {adjusted} END"}
    ).drop("SQUARED_SURPRISE")
