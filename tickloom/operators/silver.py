"""Typing of the raw text tables and their enrichment into one wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tickloom.functions.numeric import to_day, to_double, to_long

KEY = ["SYMBOL", "DATE"]
SILVER = [
    "SYMBOL",
    "DATE",
    "OPEN_PRICE",
    "HIGH_PRICE",
    "LOW_PRICE",
    "CLOSE_PRICE",
    "CLOSE_ADJUSTED_PRICE",
    "VOLUME",
    "SPLIT_COEFFICIENT",
    "QUARTER",
    "EPS_ESTIMATE",
    "EPS",
    "RELEASE_TIME",
    "DIVIDENDS",
]

# Raw column -> (typed column, cast).
PRICES = {
    "symbol": ("SYMBOL", None),
    "date": ("DATE", to_day),
    "open": ("OPEN_PRICE", to_double),
    "high": ("HIGH_PRICE", to_double),
    "low": ("LOW_PRICE", to_double),
    "close": ("CLOSE_PRICE", to_double),
    "close_adjusted": ("CLOSE_ADJUSTED_PRICE", to_double),
    "volume": ("VOLUME", to_long),
    "split_coefficient": ("SPLIT_COEFFICIENT", to_double),
}
EARNINGS = {
    "symbol": ("SYMBOL", None),
    "date": ("DATE", to_day),
    "qtr": ("QUARTER", None),
    "eps_est": ("EPS_ESTIMATE", to_double),
    "eps": ("EPS", to_double),
    "release_time": ("RELEASE_TIME", None),
}
DIVIDENDS = {
    "symbol": ("SYMBOL", None),
    "date": ("DATE", to_day),
    "dividend": ("DIVIDENDS", to_double),
}


def _typed(raw: DataFrame, rules: dict) -> DataFrame:
    return raw.selectExpr(*[f"{cast(name) if cast else name} AS {target}" for name, (target, cast) in rules.items()])


def type_prices(raw: DataFrame) -> DataFrame:
    return _typed(raw, PRICES)


def type_earnings(raw: DataFrame) -> DataFrame:
    return _typed(raw, EARNINGS)


def type_dividends(raw: DataFrame) -> DataFrame:
    return _typed(raw, DIVIDENDS)


RULES = {"prices": PRICES, "earnings": EARNINGS, "dividends": DIVIDENDS}


def typed_with_losses(raw: DataFrame, name: str, losses: Observation) -> DataFrame:
    """The typed table ``name``; the action that reads it also counts into ``losses``, by typed column, the
    texts that are not blank and that no value can be read from."""
    unread = [
        F.expr(f"count_if(trim({column}) <> '' AND {cast(column)} IS NULL) AS {target}")
        for column, (target, cast) in RULES[name].items()
        if cast
    ]
    return _typed(raw.observe(losses, *unread), RULES[name])


def enrich(prices: DataFrame, earnings: DataFrame, dividends: DataFrame) -> DataFrame:
    """Every price row with the earnings and dividend of its symbol and day, where known.

    The two small tables are put together first, so the prices take part in one
    join only. Adaptive execution can then split a heavy partition of it; it cannot in
    a chain of joins. Rows without a full key match nothing: each goes to a place of its own, so
    that, however many, and however alike, they do not meet in one task.
    """
    # Always 0, in a form that does not fold away: it is part of the key that deals the rows out.
    events = earnings.join(dividends, KEY, "full").withColumn("_SLOT", F.expr("pmod(xxhash64(SYMBOL), 1)"))
    slot = "if(SYMBOL IS NULL OR DATE IS NULL, monotonically_increasing_id() + 1, 0L) AS _SLOT"
    return prices.selectExpr("*", slot).join(events, [*KEY, "_SLOT"], "left").select(*SILVER)
