"""Change and usual level of trading volume."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.functions.labels import compared
from tickloom.functions.numeric import pct_change
from tickloom.functions.series import BY_SYMBOL, Series, add_columns

INPUT = ["SYMBOL", "DATE", "VOLUME"]
# The columns of the table, in the order of its contract.
OUTPUT = [
    "SYMBOL",
    "DATE",
    "PREV_VOLUME",
    "VOLUME_CHANGE_PCT",
    "VOLUME_DIRECTION",
    "5_DAY_AVG_VOLUME",
    "20_DAY_AVG_VOLUME",
]
REACH = 20


def add_volume_metrics(bars: DataFrame, series: Series = BY_SYMBOL) -> DataFrame:
    framed = add_columns(
        bars,
        {
            "PREV_VOLUME": series.before("VOLUME"),
            "5_DAY_AVG_VOLUME": series.mean("VOLUME", 5),
            "20_DAY_AVG_VOLUME": series.mean("VOLUME", 20),
        },
    )
    return add_columns(
        framed,
        {
            "VOLUME_CHANGE_PCT": pct_change("VOLUME", "PREV_VOLUME"),
            "VOLUME_DIRECTION": compared("VOLUME", "PREV_VOLUME", "UP", "DOWN", "FLAT"),
        },
    )
