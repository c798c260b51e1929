"""Twenty-bar return of each symbol against a benchmark symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.labels import compared, signed
from tickloom.functions.numeric import growth
from tickloom.functions.series import BY_SYMBOL, Series, add_columns

# The columns of the table, in the order of its contract.
OUTPUT = [
    "SYMBOL",
    "DATE",
    "INDEX_RETURN_20D",
    "ROLLING_RETURN_20D",
    "RELATIVE_STRENGTH_20D",
    "RELATIVE_STRENGTH_DIRECTION",
    "RS_TREND",
]
BENCHMARK = "SPY"
INDEX_REACH = 20
REACH = 1


def benchmark_bars(bars: DataFrame, symbol: str = BENCHMARK) -> DataFrame:
    chosen = bars.select("SYMBOL", "DATE", "CLOSE_PRICE").filter(F.col("SYMBOL") == symbol)
    return chosen.filter("DATE IS NOT NULL AND CLOSE_PRICE IS NOT NULL")


def add_index_return(bars: DataFrame, series: Series = BY_SYMBOL) -> DataFrame:
    lagged = add_columns(bars, {"INDEX_CLOSE_20D_AGO": series.before("CLOSE_PRICE", 20)})
    return add_columns(lagged, {"INDEX_RETURN_20D": growth("CLOSE_PRICE", "INDEX_CLOSE_20D_AGO")})


def index_by_day(returns: DataFrame) -> DataFrame:
    """One row per day, so the size is bounded by the calendar and not by the data.

    A DATE can hold 3.65 million days at most, a few thousand in practice. Two
    benchmark bars on one day break the unique key and raise.
    """
    daily = returns.groupBy("DATE").agg(F.expr("max(INDEX_RETURN_20D) AS value"), F.expr("count(*) AS bars"))
    repeated = "raise_error(concat('more than one benchmark bar on ', cast(DATE AS string)))"
    return daily.selectExpr("DATE", f"if(bars = 1, value, cast({repeated} AS double)) AS INDEX_RETURN_20D")


def add_relative_strength(bars: DataFrame, index: DataFrame, series: Series = BY_SYMBOL) -> DataFrame:
    """Needs ROLLING_RETURN_20D. ``index`` must come from ``index_by_day``: it is broadcast."""
    joined = bars.join(F.broadcast(index), "DATE", "left")
    measured = add_columns(joined, {"RELATIVE_STRENGTH_20D": "ROLLING_RETURN_20D - INDEX_RETURN_20D"})
    lagged = add_columns(measured, {"PREV_RS_20D": series.before("RELATIVE_STRENGTH_20D")})
    # A known strength yesterday and none today counts as STABLE.
    trend = compared("RELATIVE_STRENGTH_20D", "PREV_RS_20D", "STRENGTHENING", "WEAKENING", "STABLE")
    return add_columns(
        lagged,
        {
            "RELATIVE_STRENGTH_DIRECTION": signed("RELATIVE_STRENGTH_20D", "OUTPERFORM", "UNDERPERFORM", "NEUTRAL"),
            "RS_TREND": f"CASE WHEN PREV_RS_20D IS NOT NULL THEN {trend} END",
        },
    )


def latest_complete(strength: DataFrame) -> DataFrame:
    """The newest row of each symbol in which every strength column is known."""
    measures = [c for c in OUTPUT if c not in ("SYMBOL", "DATE")]
    known = strength.select(*OUTPUT).dropna(subset=measures)
    newest = F.expr(f"max_by(struct(DATE, {', '.join(measures)}), DATE) AS newest")
    return known.groupBy("SYMBOL").agg(newest).select("SYMBOL", "newest.*")
