"""Moving averages, their slopes and the volatility regime."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.functions.labels import SPIKE_FACTOR
from tickloom.functions.numeric import ratio
from tickloom.functions.series import BY_SYMBOL, Series, add_columns

# The columns of the table, in the order of its contract.
OUTPUT = [
    "SYMBOL",
    "DATE",
    "30_DAYS_AVG_SMA",
    "100_DAYS_AVG_SMA",
    "6_MONTHS_AVG_SMA",
    "5_DAY_TREND_SLOPE",
    "10_DAY_TREND_SLOPE",
    "30_DAY_TREND_SLOPE",
    "VOLATILITY_REGIME_FLAG",
]
CALM_FACTOR = "0.7D"
REACH = 180

# The long frames as consecutive blocks: (rows of the block, rows back to it).
_LAST_100 = [(30, 0), (30, 30), (30, 60), (10, 90)]
_LAST_180 = [(30, back) for back in range(0, 180, 30)]


def _mean_of_blocks(series: Series, blocks: list[tuple[int, int]]) -> str:
    """Mean over several blocks from their sums and counts.

    A moving frame adds up all its rows again for every bar. Reading back the
    sums of earlier blocks leaves 40 rows to add per bar in place of 310.
    """

    def added(name: str) -> str:
        parts = [series.before(f"{name}_{rows}", back) if back else f"{name}_{rows}" for rows, back in blocks]
        return " + ".join(f"coalesce({part}, 0)" for part in parts)

    return ratio(added("TOTAL"), added("KNOWN"))


def add_regime(bars: DataFrame, series: Series = BY_SYMBOL) -> DataFrame:
    """Needs the intraday range columns of the price metrics."""
    blocks = {}
    for rows in (30, 10):
        blocks[f"TOTAL_{rows}"] = series.total("CLOSE_PRICE", rows)
        blocks[f"KNOWN_{rows}"] = series.known("CLOSE_PRICE", rows)
    summed = add_columns(add_columns(bars, blocks), {"30_DAYS_AVG_SMA": ratio("TOTAL_30", "KNOWN_30")})
    slopes = {
        f"{rows}_DAY_TREND_SLOPE": f"(`30_DAYS_AVG_SMA` - {series.before('`30_DAYS_AVG_SMA`', rows)}) / {rows}"
        for rows in (5, 10, 30)
    }
    span, usual = "INTRADAY_RANGE_PCT", "`20_DAY_AVG_INTRADAY_RANGE_PCT`"
    # Bars without a full key keep their averages but have no regime.
    rated = f"SYMBOL IS NOT NULL AND DATE IS NOT NULL AND {span} <> 0 AND {usual} <> 0"
    flag = (
        f"CASE WHEN {rated} THEN CASE WHEN {span} > {SPIKE_FACTOR} * {usual} THEN 'HIGH' "
        f"WHEN {span} < {CALM_FACTOR} * {usual} THEN 'LOW' ELSE 'NORMAL' END END"
    )
    return add_columns(
        summed,
        {
            "100_DAYS_AVG_SMA": _mean_of_blocks(series, _LAST_100),
            "6_MONTHS_AVG_SMA": _mean_of_blocks(series, _LAST_180),
            **slopes,
            "VOLATILITY_REGIME_FLAG": flag,
        },
    ).drop(*blocks)
