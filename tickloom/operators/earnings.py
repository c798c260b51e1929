"""Earnings surprise and the market's reaction around each bar."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.functions.labels import compared, signed, spike
from tickloom.functions.numeric import pct_change, ratio
from tickloom.functions.series import BY_SYMBOL, Series, add_columns

# The columns of the table, in the order of its contract.
OUTPUT = [
    "SYMBOL",
    "DATE",
    "OPEN_PRICE",
    "CLOSE_PRICE",
    "VOLUME",
    "EPS",
    "EPS_ESTIMATE",
    "EPS_SURPRISE_AMT",
    "EPS_SURPRISE_PCT",
    "SURPRISE_DIRECTION",
    "PRE_EARNINGS_CLOSE",
    "PRE_EARNINGS_VOLUME",
    "POST_EARNINGS_OPEN",
    "POST_EARNINGS_CLOSE",
    "POST_EARNINGS_VOLUME",
    "EARNING_DIRECTION",
    "EVENT_WINDOW_RETURN_PCT",
    "EARNINGS_DAY_RETURN_PCT",
    "VOLATILITY_SPIKE_FLAG",
    "VOLATILITY_MULTIPLIER",
    "INTRADAY_RANGE_PCT",
    "20_DAY_AVG_INTRADAY_RANGE_PCT",
    "EARNINGS_REACTION_STRENGTH",
    "NEXT_DAY_RETURN_PCT",
    "VOLUME_CHANGE_PCT",
    "VOLUME_DIRECTION",
    "5_DAY_AVG_VOLUME",
    "20_DAY_AVG_VOLUME",
    "VOLUME_SPIKE_FLAG",
    "VOLUME_CONFIRMATION_FLAG",
    "REACTION_ALIGNMENT_FLAG",
    "DRIFT_DIRECTION",
    "DRIFT_ALIGNMENT_FLAG",
]
REACH = 1


TRADED_BAR = "SYMBOL IS NOT NULL AND DATE IS NOT NULL AND OPEN_PRICE IS NOT NULL AND CLOSE_PRICE IS NOT NULL"

_SPAN, _USUAL = "INTRADAY_RANGE_PCT", "`20_DAY_AVG_INTRADAY_RANGE_PCT`"


def add_eps_surprise(bars: DataFrame) -> DataFrame:
    """The estimate divides with its sign: beating a negative estimate reads NEGATIVE."""
    measured = add_columns(
        bars,
        {"EPS_SURPRISE_AMT": "EPS - EPS_ESTIMATE", "EPS_SURPRISE_PCT": pct_change("EPS", "EPS_ESTIMATE")},
    )
    label = signed("EPS_SURPRISE_PCT", "POSITIVE", "NEGATIVE", "NO_SURPRISE")
    return add_columns(measured, {"SURPRISE_DIRECTION": label})


def add_event_context(bars: DataFrame, series: Series = BY_SYMBOL) -> DataFrame:
    """Neighbouring bars. Needs bars for which ``TRADED_BAR`` holds."""
    return add_columns(
        bars,
        {
            "PRE_EARNINGS_CLOSE": series.before("CLOSE_PRICE"),
            "PRE_EARNINGS_VOLUME": series.before("VOLUME"),
            "POST_EARNINGS_OPEN": series.after("OPEN_PRICE"),
            "POST_EARNINGS_CLOSE": series.after("CLOSE_PRICE"),
            "POST_EARNINGS_VOLUME": series.after("VOLUME"),
        },
    )


def add_event_readings(bars: DataFrame) -> DataFrame:
    """Returns around the bar, and its range and volume against their usual level."""
    before, today, after = "PRE_EARNINGS_CLOSE", "CLOSE_PRICE", "POST_EARNINGS_CLOSE"
    both_sides = f"{before} IS NOT NULL AND {after} IS NOT NULL"
    measured = add_columns(
        bars,
        {
            "EARNING_DIRECTION": f"CASE WHEN {both_sides} THEN {compared(after, before, 'UP', 'DOWN', 'FLAT')} END",
            "EVENT_WINDOW_RETURN_PCT": pct_change(after, before),
            "EARNINGS_DAY_RETURN_PCT": pct_change(today, before),
            "NEXT_DAY_RETURN_PCT": pct_change(after, today),
        },
    )
    return add_columns(
        measured,
        {
            "VOLATILITY_SPIKE_FLAG": spike(_SPAN, _USUAL),
            "VOLATILITY_MULTIPLIER": ratio(_SPAN, _USUAL),
            "EARNINGS_REACTION_STRENGTH": ratio("EVENT_WINDOW_RETURN_PCT", _USUAL),
            "VOLUME_SPIKE_FLAG": spike("VOLUME", "`20_DAY_AVG_VOLUME`"),
            "DRIFT_DIRECTION": signed("NEXT_DAY_RETURN_PCT", "UP", "DOWN", "FLAT"),
        },
    )


def add_event_flags(bars: DataFrame) -> DataFrame:
    """How surprise, volume and the next day's drift agree with the move."""
    surprise, move, drift = "SURPRISE_DIRECTION", "EARNING_DIRECTION", "DRIFT_DIRECTION"
    agrees = f"({surprise}, {move}) IN (('POSITIVE', 'UP'), ('NEGATIVE', 'DOWN'))"
    # A NULL move matches neither branch, so the confirmation ends NEUTRAL and is never NULL.
    moved = f"{move} IN ('UP', 'DOWN') AND VOLUME_DIRECTION IS NOT NULL"
    return add_columns(
        bars,
        {
            "REACTION_ALIGNMENT_FLAG": f"""
                CASE WHEN {surprise} IS NULL OR {move} IS NULL THEN NULL
                     WHEN {agrees} THEN 'ALIGNED'
                     WHEN {surprise} = 'NO_SURPRISE' OR {move} = 'FLAT' THEN 'NEUTRAL'
                     ELSE 'MISALIGNED' END""",
            "VOLUME_CONFIRMATION_FLAG": f"""
                CASE WHEN {moved} AND VOLUME_SPIKE_FLAG = 'SPIKE' THEN 'CONFIRMED'
                     WHEN {moved} AND VOLUME_SPIKE_FLAG = 'NORMAL' THEN 'WEAK'
                     ELSE 'NEUTRAL' END""",
            "DRIFT_ALIGNMENT_FLAG": f"""
                CASE WHEN {move} IS NULL OR {drift} IS NULL THEN NULL
                     WHEN 'FLAT' IN ({move}, {drift}) THEN 'NEUTRAL'
                     WHEN {move} = {drift} THEN 'CONTINUATION'
                     ELSE 'REVERSAL' END""",
        },
    )


def add_earnings_reaction(bars: DataFrame, series: Series = BY_SYMBOL) -> DataFrame:
    """Every earnings column, for every bar and not only for announcement days."""
    return add_event_flags(add_event_readings(add_event_context(add_eps_surprise(bars), series)))
