"""What each column means, and its attachment to tables as column comments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# The names must match the tables; the texts follow the code.
COLUMNS = {
    # Identity
    "SYMBOL": "Ticker of the traded company or index.",
    "DATE": "Trading day of the bar.",
    # Market data
    "OPEN_PRICE": "First price of the day.",
    "HIGH_PRICE": "Highest price of the day.",
    "LOW_PRICE": "Lowest price of the day.",
    "CLOSE_PRICE": "Last price of the day, not adjusted.",
    "CLOSE_ADJUSTED_PRICE": "Last price, adjusted for splits and dividends; no metric reads it.",
    "VOLUME": "Shares traded on the day.",
    "SPLIT_COEFFICIENT": "Split factor effective on the day.",
    # Corporate events
    "DIVIDENDS": "Dividend per share on the day; NULL without one.",
    "QUARTER": "Fiscal quarter of the earnings report.",
    "EPS": "Reported earnings per share.",
    "EPS_ESTIMATE": "Expected earnings per share.",
    "RELEASE_TIME": "When in the day earnings were published, as text.",
    # Price metrics
    "PREV_CLOSE_PRICE": "Close of the bar before.",
    "DAILY_RETURN_PCT": "Change of the close since the bar before, in percent points.",
    "GAP_AMOUNT": "Open minus the close before.",
    "GAP_DIRECTION": "UP, DOWN or NO_GAP; NO_GAP also where the close before is unknown.",
    "DAILY_DIRECTION": "UP, DOWN or FLAT against the close before; FLAT also where it is unknown.",
    "INTRADAY_RANGE_AMT": "High minus low.",
    "INTRADAY_RANGE_PCT": "High minus low, in percent of the close.",
    "20_DAY_AVG_INTRADAY_RANGE_PCT": "Mean of INTRADAY_RANGE_PCT over the 20 bars before.",
    # Volume and liquidity
    "PREV_VOLUME": "Volume of the bar before.",
    "VOLUME_CHANGE_PCT": "Change of volume since the bar before, in percent points.",
    "VOLUME_DIRECTION": "UP, DOWN or FLAT against the volume before; FLAT also where it is unknown.",
    "5_DAY_AVG_VOLUME": "Mean volume over the 5 bars before.",
    "20_DAY_AVG_VOLUME": "Mean volume over the 20 bars before.",
    # Earnings surprise
    "EPS_SURPRISE_AMT": "Reported minus expected earnings per share.",
    "EPS_SURPRISE_PCT": "Surprise in percent of the signed estimate.",
    "SURPRISE_DIRECTION": "POSITIVE, NEGATIVE or NO_SURPRISE by the sign of EPS_SURPRISE_PCT.",
    # Event window
    "PRE_EARNINGS_CLOSE": "Close of the traded bar before.",
    "PRE_EARNINGS_VOLUME": "Volume of the traded bar before.",
    "POST_EARNINGS_OPEN": "Open of the next traded bar.",
    "POST_EARNINGS_CLOSE": "Close of the next traded bar.",
    "POST_EARNINGS_VOLUME": "Volume of the next traded bar.",
    # Event reaction
    "EARNING_DIRECTION": "UP, DOWN or FLAT from the close before to the close after.",
    "EVENT_WINDOW_RETURN_PCT": "Change from the close before to the close after, in percent points.",
    "EARNINGS_DAY_RETURN_PCT": "Change from the close before to this close, in percent points.",
    "NEXT_DAY_RETURN_PCT": "Change from this close to the close after, in percent points.",
    # Volatility around the event
    "VOLATILITY_SPIKE_FLAG": "SPIKE when the intraday range is above 1.5 times its 20-bar mean, else NORMAL.",
    "VOLATILITY_MULTIPLIER": "Intraday range over its 20-bar mean.",
    "EARNINGS_REACTION_STRENGTH": "EVENT_WINDOW_RETURN_PCT over the 20-bar mean intraday range.",
    # Volume around the event
    "VOLUME_SPIKE_FLAG": "SPIKE when volume is above 1.5 times its 20-bar mean, else NORMAL.",
    "VOLUME_CONFIRMATION_FLAG": "CONFIRMED for a move with a volume spike, WEAK without one, else NEUTRAL.",
    # Alignment and drift
    "REACTION_ALIGNMENT_FLAG": "ALIGNED, NEUTRAL or MISALIGNED: surprise against EARNING_DIRECTION.",
    "DRIFT_DIRECTION": "UP, DOWN or FLAT by the sign of NEXT_DAY_RETURN_PCT.",
    "DRIFT_ALIGNMENT_FLAG": "CONTINUATION, REVERSAL or NEUTRAL: drift against EARNING_DIRECTION.",
    # Risk
    "ROLLING_RETURN_20D": "Change of the close over 20 bars, as a fraction.",
    "ROLLING_VOLATILITY_20D": "Root of VARIANCE_20D, in percent points.",
    "MAX_DRAWDOWN_LOOKBACK": "Lowest DRAWDOWN_TODAY of the 20 bars before; can be positive.",
    "RISK_ADJUSTED_RETURN_20D": "ROLLING_RETURN_20D over ROLLING_VOLATILITY_20D where that is positive.",
    # Relative strength
    "INDEX_RETURN_20D": "Change of the benchmark's close over 20 of its bars, as a fraction.",
    "RELATIVE_STRENGTH_20D": "ROLLING_RETURN_20D minus INDEX_RETURN_20D.",
    "RELATIVE_STRENGTH_DIRECTION": "OUTPERFORM, UNDERPERFORM or NEUTRAL by the sign of the strength.",
    "RS_TREND": "STRENGTHENING, WEAKENING or STABLE against the strength of the bar before.",
    # Risk intermediates
    "CLOSE_PRICE_20D": "Close 20 bars before.",
    "AVG_RETURN_20D": "Mean DAILY_RETURN_PCT over the 20 bars before.",
    "VARIANCE_20D": "Mean over the 20 bars before of (return - that bar's AVG_RETURN_20D) squared.",
    "ROLLING_MAX_CLOSE_20D": "Highest close of the 20 bars before.",
    "DRAWDOWN_TODAY": "Close over ROLLING_MAX_CLOSE_20D, minus 1.",
    # Regime
    "30_DAYS_AVG_SMA": "Mean close over the 30 bars before.",
    "100_DAYS_AVG_SMA": "Mean close over the 100 bars before.",
    "6_MONTHS_AVG_SMA": "Mean close over the 180 bars before.",
    "5_DAY_TREND_SLOPE": "Change of the 30-bar mean per bar over 5 bars.",
    "10_DAY_TREND_SLOPE": "Change of the 30-bar mean per bar over 10 bars.",
    "30_DAY_TREND_SLOPE": "Change of the 30-bar mean per bar over 30 bars.",
    "VOLATILITY_REGIME_FLAG": "HIGH, LOW or NORMAL: intraday range against its 20-bar mean.",
    # Breadth
    "TOTAL_STOCKS": "Distinct symbols with a bar on the day.",
    "PCT_STOCKS_UP": "Share of bars with DAILY_DIRECTION UP, 0 to 1.",
    "PCT_STOCKS_DOWN": "Share of bars with DAILY_DIRECTION DOWN, 0 to 1.",
    "PCT_STOCKS_OUTPERFORMING": "Share of bars that outperform the benchmark, 0 to 1.",
    "PCT_RS_STRENGTHENING": "Share of bars with a strengthening trend, 0 to 1.",
    "AVG_MARKET_VOLATILITY": "Mean ROLLING_VOLATILITY_20D of the day, unknown values left out.",
    "BREADTH_REGIME": "STRONG_BULL, BULL, NEUTRAL, BEAR or STRONG_BEAR by PCT_STOCKS_UP.",
}


def with_comments(df: DataFrame) -> DataFrame:
    """Attach each known column's text as its comment; parquet keeps it."""
    return df.select(
        *[F.col(c).alias(c, metadata={"comment": COLUMNS[c]}) if c in COLUMNS else F.col(c) for c in df.columns]
    )


def column_audit(df: DataFrame) -> DataFrame:
    """One row per column: whether the dictionary explains it, and its known values.

    One pass with a map-side count per column; a single row is unpivoted.
    """
    counts = df.selectExpr(*[f"count(`{c}`) AS `{c}`" for c in df.columns])
    long = counts.unpivot([], df.columns, "COLUMN_NAME", "KNOWN_VALUES")
    return long.withColumn("DESCRIBED", F.col("COLUMN_NAME").isin(*COLUMNS))


class Audit:
    """Known values of tables, counted while they are written, and their comments as stored.

    A table of the audit is some columns of what is written, over the rows for which a condition holds.
    """

    def __init__(self, tables: Mapping[str, tuple[list[str], str]]):
        self.tables, self.observation = tables, Observation()

    def counting(self, df: DataFrame) -> DataFrame:
        """``df``, with the counts on the way of whatever action reads it."""
        counts = [
            F.expr(f"count_if(({rows}) AND `{column}` IS NOT NULL) AS `{table}.{column}`")
            for table, (columns, rows) in self.tables.items()
            for column in columns
        ]
        return df.observe(self.observation, *counts)

    def rows(self, stored: DataFrame) -> list[tuple[str, str, int, bool]]:
        """TABLE_NAME, COLUMN_NAME, KNOWN_VALUES and DESCRIBED; ``stored`` is what was written, as its files describe it."""
        known = self.observation.get
        return [
            (table, column, known[f"{table}.{column}"], "comment" in stored.schema[column].metadata)
            for table, (columns, _) in self.tables.items()
            for column in columns
        ]
