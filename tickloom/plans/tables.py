"""The seven derived tables, each from silver (or any frame with its columns).

Catalyst cannot know that (SYMBOL, DATE) is unique, so joining one table's
columns back to silver costs a shuffle per side. The tables are instead built
by adding columns to the same frame: stacked windows on SYMBOL share a single
shuffle. ``longest`` is the row count of the longest series where the caller
knows it (or a bound on it); otherwise a job measures it while the table is
being built, so pass it where silver is not stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tickloom.functions.series import BY_SYMBOL, Series, add_columns
from tickloom.operators import breadth, earnings, price, regime, risk, strength, volume
from tickloom.operators.long_series import MAX_ROWS, PART_ROWS, Reach, longest_series, over_chain, over_series


def part_rows(bars: DataFrame, longest: int | None) -> int | None:
    """Length of the parts that series must be cut into, or None to keep them whole."""
    rows = longest_series(bars) if longest is None else longest
    return PART_ROWS if rows > MAX_ROWS else None


# The JVM compiles no method of more bytes of code than this; a fixed value of HotSpot.
LARGEST_COMPILED = 8000
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """For jobs over the wide rows of a ``market_frame``, which must run inside.

    Spark would fuse projections of some ninety columns into one method, too large for the JVM to compile, and
    interpret it for every row. Inside, such projections run unfused, from methods that are compiled. The
    setting is the session's, so queries of other threads see it too; it changes no result.
    """
    before = spark.conf.get(HUGE_METHOD)
    spark.conf.set(HUGE_METHOD, str(min(int(before), LARGEST_COMPILED)))
    try:
        yield
    finally:
        spark.conf.set(HUGE_METHOD, before)


def _priced(silver: DataFrame, parts: int | None) -> DataFrame:
    return over_series(silver, BY_SYMBOL, price.add_price_metrics, price.REACH, part_rows=parts)


def _with_volume(bars: DataFrame, series: Series) -> DataFrame:
    return volume.add_volume_metrics(price.add_price_metrics(bars, series), series)


def _with_first_of_day(bars: DataFrame, series: Series) -> DataFrame:
    return breadth.add_first_of_day(price.add_price_metrics(bars, series), series)


def _with_regime(bars: DataFrame, series: Series) -> DataFrame:
    return regime.add_regime(price.add_price_metrics(bars, series), series)


def price_metrics(silver: DataFrame, longest: int | None = None) -> DataFrame:
    parts = part_rows(silver, longest)
    return _priced(silver.select(*price.INPUT), parts).select(*price.OUTPUT)


def volume_liquidity(silver: DataFrame, longest: int | None = None) -> DataFrame:
    parts = part_rows(silver, longest)
    bars = silver.select(*volume.INPUT)
    added = over_series(bars, BY_SYMBOL, volume.add_volume_metrics, volume.REACH, part_rows=parts)
    return added.select(*volume.OUTPUT)


def earnings_reaction(silver: DataFrame, longest: int | None = None) -> DataFrame:
    """Price and volume columns see every bar; neighbours are taken among traded bars."""
    parts = part_rows(silver, longest)
    bars = silver.select(*price.INPUT, "VOLUME", "EPS", "EPS_ESTIMATE")
    measured = over_series(bars, BY_SYMBOL, _with_volume, volume.REACH, part_rows=parts)
    traded = measured.filter(earnings.TRADED_BAR)
    added = over_series(traded, BY_SYMBOL, earnings.add_earnings_reaction, earnings.REACH, True, parts)
    return added.select(*earnings.OUTPUT)


def risk_frame(silver: DataFrame, longest: int | None = None) -> DataFrame:
    """Risk columns with their intermediates. Returns come from every bar, the rest from priced bars."""
    parts = part_rows(silver, longest)
    priced = _priced(silver.select(*price.INPUT), parts).filter(risk.PRICED_BAR)
    return over_series(priced, BY_SYMBOL, risk.add_risk_metrics, risk.REACH, part_rows=parts)


def risk_metrics(silver: DataFrame, longest: int | None = None) -> DataFrame:
    return risk_frame(silver, longest).select(*risk.OUTPUT)


def index_frame(silver: DataFrame, benchmark: str = strength.BENCHMARK, longest: int | None = None) -> DataFrame:
    """The benchmark's bars with its close 20 bars ago and its return since."""
    bars = strength.benchmark_bars(silver, benchmark)
    parts = part_rows(bars, longest)
    return over_series(bars, BY_SYMBOL, strength.add_index_return, strength.INDEX_REACH, part_rows=parts)


def index_returns(silver: DataFrame, benchmark: str = strength.BENCHMARK, longest: int | None = None) -> DataFrame:
    return strength.index_by_day(index_frame(silver, benchmark, longest))


def strength_frame(
    silver: DataFrame, benchmark: str = strength.BENCHMARK, longest: int | None = None, index: DataFrame | None = None
) -> DataFrame:
    """Risk and strength columns with their intermediates.

    ``index`` takes ready-made index returns, one row per day, in place of the benchmark's
    bars; a repeated day raises.
    """
    rows = longest_series(silver) if longest is None else longest
    parts = part_rows(silver, rows)
    index = strength.index_by_day(index_frame(silver, benchmark, rows) if index is None else index)

    def step(bars: DataFrame, series: Series) -> DataFrame:
        return strength.add_relative_strength(risk.add_risk_metrics(bars, series), index, series)

    priced = _priced(silver.select(*price.INPUT), parts).filter(risk.PRICED_BAR)
    reach = risk.REACH + strength.REACH
    return over_series(priced, BY_SYMBOL, step, reach, part_rows=parts)


def relative_strength(
    silver: DataFrame, benchmark: str = strength.BENCHMARK, longest: int | None = None, index: DataFrame | None = None
) -> DataFrame:
    return strength_frame(silver, benchmark, longest, index).select(*strength.OUTPUT)


def market_regime(silver: DataFrame, longest: int | None = None) -> DataFrame:
    parts = part_rows(silver, longest)
    bars = silver.select(*price.INPUT)
    added = over_series(bars, BY_SYMBOL, _with_regime, regime.REACH, part_rows=parts)
    return added.select(*regime.OUTPUT)


def breadth_frame(
    silver: DataFrame, benchmark: str = strength.BENCHMARK, longest: int | None = None, index: DataFrame | None = None
) -> DataFrame:
    """Price, risk and strength columns side by side for every bar, without a join back.

    Bars with no close count in breadth but take no part in the risk series.
    Splitting the series by HAS_CLOSE keeps both in one frame: the rows are
    already in the right task, so only the order within it changes.
    """
    rows = longest_series(silver) if longest is None else longest
    parts = part_rows(silver, rows)
    index = strength.index_by_day(index_frame(silver, benchmark, rows) if index is None else index)
    bars = silver.select(*price.INPUT)
    priced = over_series(bars, BY_SYMBOL, _with_first_of_day, price.REACH, part_rows=parts)
    keyed = add_columns(priced, {"HAS_CLOSE": "CLOSE_PRICE IS NOT NULL"})
    keyed = keyed.filter("SYMBOL IS NOT NULL AND DATE IS NOT NULL")

    def step(bars: DataFrame, series: Series) -> DataFrame:
        return strength.add_relative_strength(risk.add_risk_metrics(bars, series), index, series)

    reach = risk.REACH + strength.REACH
    added = over_series(keyed, BY_SYMBOL.by("HAS_CLOSE"), step, reach, part_rows=parts)
    measures = {*risk.OUTPUT[2:], *strength.OUTPUT[2:]}
    return added.selectExpr(*[f"if(HAS_CLOSE, {c}, NULL) AS {c}" if c in measures else f"`{c}`" for c in added.columns])


def market_breadth(
    silver: DataFrame, benchmark: str = strength.BENCHMARK, longest: int | None = None, index: DataFrame | None = None
) -> DataFrame:
    return breadth.market_breadth(breadth_frame(silver, benchmark, longest, index))


# How far the chain of all steps looks: the averages and, for the first return of a priced series, one bar more;
# risk and strength among priced bars; the neighbours among traded ones.
REACHES = [
    Reach("true", max(price.REACH, volume.REACH, regime.REACH) + 1),
    Reach(risk.PRICED_BAR, risk.REACH + strength.REACH + 1),
    Reach(earnings.TRADED_BAR, earnings.REACH, earnings.REACH),
]

# The columns of a ``market_frame`` that ``table_of`` reads.
_OUTPUTS = [price.OUTPUT, volume.OUTPUT, earnings.OUTPUT, risk.OUTPUT, strength.OUTPUT, regime.OUTPUT]
FRAME = list(dict.fromkeys([c for output in _OUTPUTS for c in output] + ["FIRST_OF_DAY", "HAS_CLOSE", "HAS_TRADE"]))


def market_frame(
    silver: DataFrame,
    benchmark: str = strength.BENCHMARK,
    longest: int | None = None,
    index: DataFrame | None = None,
    parts: int | None = None,
    bars: int | None = None,
) -> DataFrame:
    """Every column of every derived table side by side, one row per bar, from one shuffle of the bars.

    HAS_CLOSE and HAS_TRADE tell which bars take part in the risk series and in the earnings table.
    All steps stack on one layout by SYMBOL; long series are cut once for the whole chain.
    ``parts`` asks for a cut into parts of about that many rows however short the series are. ``table_of`` takes
    the tables out of the frame. ``bars`` is the number of rows of silver, so that no task gets too many of them, however
    large the table; without it silver keeps the layout it is stored in, as one in buckets should.
    """
    rows = longest_series(silver) if longest is None else longest
    parts = parts or part_rows(silver, rows)
    index = strength.index_by_day(index_frame(silver, benchmark, rows) if index is None else index)

    def step(bars: DataFrame, series: Series) -> DataFrame:
        measured = _with_regime(volume.add_volume_metrics(breadth.add_first_of_day(bars, series), series), series)
        told = add_columns(measured, {"HAS_CLOSE": risk.PRICED_BAR, "HAS_TRADE": earnings.TRADED_BAR})
        priced = series.by("HAS_CLOSE")
        compared = strength.add_relative_strength(risk.add_risk_metrics(told, priced), index, priced)
        return earnings.add_earnings_reaction(compared, series.by("HAS_TRADE"))

    taken = silver.select(*price.INPUT, "VOLUME", "EPS", "EPS_ESTIMATE")
    return over_chain(taken, BY_SYMBOL, step, REACHES, parts, rows, bars)


def breadth_bars(frame: DataFrame) -> DataFrame:
    """What breadth reads of a ``market_frame``: risk and strength only of bars with a close."""
    measures = [*risk.OUTPUT[2:], *strength.OUTPUT[2:]]
    own = ["SYMBOL", "DATE", "FIRST_OF_DAY", "DAILY_DIRECTION"]
    return frame.selectExpr(*own, *[f"if(HAS_CLOSE, {c}, NULL) AS {c}" for c in dict.fromkeys(measures)])


def table_of(frame: DataFrame, name: str) -> DataFrame:
    """One of the seven tables from a ``market_frame``: a choice of its columns and rows."""
    if name == "market_breadth":
        return breadth.market_breadth(breadth_bars(frame))
    output, rows = {
        "price_metrics": (price.OUTPUT, "true"),
        "volume_liquidity": (volume.OUTPUT, "true"),
        "earnings_reaction": (earnings.OUTPUT, "HAS_TRADE"),
        "risk_metrics": (risk.OUTPUT, "HAS_CLOSE"),
        "relative_strength": (strength.OUTPUT, "HAS_CLOSE"),
        "market_regime": (regime.OUTPUT, "true"),
    }[name]
    return frame.filter(rows).select(*output)
