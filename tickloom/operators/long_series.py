"""Guard against a series too long for one task.

All metrics look at a bounded number of neighbouring rows. One task per series
is the cheapest plan while series are short: one shuffle serves every window.
A key that holds a large part of all rows would put them all into one task. So
where the longest series is beyond ``MAX_ROWS``, series are cut into parts of
about ``PART_ROWS`` rows, and each part is given copies of the neighbouring
rows its frames reach. The copies are dropped afterwards, so the result is the
same.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.series import Series, add_columns

MAX_ROWS = 1_000_000
PART_ROWS = 100_000
# Rows that one task should hold of a chain of steps, whose rows grow wide and are sorted several times.
TASK_ROWS = 100_000
# Rows without a full key may be many on one day; they are spread over this many slots.
SLOTS = 256

Step = Callable[[DataFrame, Series], DataFrame]


@dataclass(frozen=True)
class Profile:
    """What the plans need to know about a table's keys, measured on the cluster."""

    rows: int
    longest_series: int
    repeated_keys: int


def profile_keys(bars: DataFrame) -> Profile:
    """Rows of the table and of its longest series, and whether a full (SYMBOL, DATE) key repeats.

    A month of a symbol is one row with one bit per day: a key repeats exactly
    where there are more dated rows than bits. So up to 31 rows combine into one
    before the shuffle, and a hot key costs nothing extra.
    """
    return profile_tables({"": bars})[""]


def _keys_by_series(keyed: DataFrame, *tags: str) -> DataFrame:
    monthly = keyed.groupBy(*tags, "SYMBOL", F.expr("trunc(DATE, 'month') AS MONTH")).agg(
        F.expr("count(*) AS n"),
        F.expr("count(DATE) AS dated"),
        F.expr("bit_or(shiftleft(1, day(DATE) - 1)) AS days"),
    )
    repeated = "if(SYMBOL IS NULL, 0, dated - coalesce(bit_count(days), 0))"
    return monthly.groupBy(*tags, "SYMBOL").agg(F.expr("sum(n) AS n"), F.expr(f"sum({repeated}) AS repeated"))


def profile_tables(frames: Mapping[str, DataFrame]) -> dict[str, Profile]:
    """``profile_keys`` of several tables in one job: their keys are tagged, and combined as one."""
    keys = [df.select(F.lit(name).alias("TABLE_NAME"), "SYMBOL", "DATE") for name, df in frames.items()]
    tagged = reduce(DataFrame.unionByName, keys)
    per_series = _keys_by_series(tagged, "TABLE_NAME")
    totals = [F.expr(sql) for sql in ("sum(n)", "max(n)", "sum(repeated)")]
    found = per_series.groupBy("TABLE_NAME").agg(*totals).collect()
    empty = dict.fromkeys(frames, Profile(0, 0, 0))
    return empty | {r[0]: Profile(*[value or 0 for value in r[1:]]) for r in found}


def require_unique_key(profile: Profile, table: str, bars: DataFrame) -> None:
    """Raise if a key repeats; only then is the number of its copies counted."""
    if profile.repeated_keys:
        keys = bars.filter("SYMBOL IS NOT NULL AND DATE IS NOT NULL").groupBy("SYMBOL", "DATE").count()
        copies = keys.agg(F.max("count")).first()[0]
        raise ValueError(f"{table}: a (SYMBOL, DATE) key occurs {copies} times, it must be unique")


def longest_series(bars: DataFrame) -> int:
    """Rows of the longest series; reads only SYMBOL."""
    return bars.groupBy("SYMBOL").count().agg(F.max("count")).first()[0] or 0


def over_series(
    bars: DataFrame, series: Series, step: Step, reach: int, ahead: bool = False, part_rows: int | None = None
) -> DataFrame:
    """Run ``step`` on whole series, or on parts of about ``part_rows`` rows.

    ``reach`` is the number of earlier rows one value depends on; ``ahead``
    says that it also depends on the next row.
    """
    if part_rows is None:
        return step(bars, series)
    if part_rows < reach:
        raise ValueError(f"parts of {part_rows} rows are shorter than the reach of {reach} rows")
    parts, part_series = _cut(bars, series, reach, ahead, part_rows)
    return step(parts, part_series).filter("NOT _COPY").drop("_BUCKET", "_SLOT", "_PART", "_COPY")


def _cut(bars: DataFrame, series: Series, reach: int, ahead: bool, part_rows: int) -> tuple[DataFrame, Series]:
    # Parts are made of whole buckets: a month of one symbol, or a hash slot of
    # a day among rows without a full key. (_BUCKET, _SLOT) follows the order
    # (DATE, _SLOT). The hash is the same when a lost task runs again: rows
    # without a full key occur in raw bars only, the later series leave them out.
    bucketed = _bucketed(bars)
    place = [*series.keys, "_BUCKET", "_SLOT"]
    sizes = bucketed.groupBy(*place).agg(F.expr("count(*) AS n"))
    in_order = f"OVER (PARTITION BY {', '.join(series.keys)} ORDER BY _BUCKET, _SLOT"
    placed = add_columns(sizes, {"end": f"sum(n) {in_order} ROWS UNBOUNDED PRECEDING)"})
    numbered = add_columns(placed, {"own": f"(end - n) div {part_rows}"})

    # A part starts within ``reach`` rows of the end of a bucket only if its
    # number lies in this range, because the number is its start div part_rows.
    later = f"sequence(end div {part_rows}, (end + {reach - 1}) div {part_rows})"
    serves = f"array(own), filter({later}, p -> p > own)"
    if ahead:
        serves += f", filter(array(lag(own) {in_order})), p -> p < own)"
    members = (
        add_columns(numbered, {"parts": f"concat({serves})"})
        .selectExpr(*place, "own", "explode(parts) AS _PART")
        .selectExpr(*place, "_PART", "_PART <> own AS _COPY")
    )
    # Null-safe, so that rows without a full key find their place too.
    same_place = " AND ".join(f"bar.{name} <=> member.{name}" for name in place)
    joined = bucketed.alias("bar").join(members.alias("member"), F.expr(same_place), "inner")
    return (
        joined.select("bar.*", "member._PART", "member._COPY"),
        replace(series.by("_PART"), order=(*series.order, "_SLOT")),
    )


@dataclass(frozen=True)
class Reach:
    """How far one value of a chain of steps looks, in rows for which ``rows`` holds.

    Steps of a chain may each count other rows: all bars, those with a close, those traded.
    """

    rows: str
    earlier: int
    later: int = 0


def dealt(bars: DataFrame, series: Series, rows: int) -> DataFrame:
    """``bars`` dealt by series to tasks of about ``TASK_ROWS`` rows, if there are ``rows`` of them.

    This is the shuffle that windows on the series need in any case. Left to itself, Spark sizes tasks by the bytes of the
    narrow rows it shuffles, into as few as it has cores, and a task's sorts then grow with the table.
    """
    tasks = max(bars.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return bars.repartition(tasks, *series.keys)


def over_chain(
    bars: DataFrame,
    series: Series,
    step: Step,
    reaches: list[Reach],
    part_rows: int | None = None,
    longest: int = 0,
    rows: int | None = None,
) -> DataFrame:
    """Run a whole chain of ``step`` on whole series, or on parts that are cut once for all of it.

    ``longest`` bounds the rows without a full key on one day; from it comes the number of slots they are spread over.
    ``rows`` is the number of bars, from which comes the number of tasks; None leaves them as they lie, or to Spark.

    Every part gets copies of as many neighbouring months as its furthest reach asks for, each
    counted in its own rows. All windows of the chain then work within a part.
    """
    if part_rows is None:
        return step(bars if rows is None else dealt(bars, series, rows), series)
    parts, part_series = _cut_chain(bars, series, reaches, part_rows, max(SLOTS, -(-longest // part_rows)))
    if rows is not None:
        parts = dealt(parts, part_series, rows)
    return step(parts, part_series).filter("NOT _COPY").drop("_BUCKET", "_SLOT", "_PART", "_COPY")


def _bucketed(bars: DataFrame, slots: int = SLOTS) -> DataFrame:
    every = ", ".join(f"`{name}`" for name in bars.columns)
    return add_columns(
        bars,
        {
            "_BUCKET": "if(SYMBOL IS NULL, DATE, trunc(DATE, 'month'))",
            "_SLOT": f"if(SYMBOL IS NULL OR DATE IS NULL, pmod(xxhash64({every}), {slots}), 0)",
        },
    )


def _cut_chain(
    bars: DataFrame, series: Series, reaches: list[Reach], part_rows: int, slots: int
) -> tuple[DataFrame, Series]:
    bucketed = _bucketed(bars, slots)
    place = [*series.keys, "_BUCKET", "_SLOT"]
    counts = {f"n{i}": f"count_if({reach.rows})" for i, reach in enumerate(reaches)}
    sizes = bucketed.groupBy(*place).agg(F.expr("count(*) AS n"), *[F.expr(f"{sql} AS {name}") for name, sql in counts.items()])

    by = f"PARTITION BY {', '.join(series.keys)} ORDER BY"
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    starts = {name: f"coalesce(sum({name}) OVER ({by} _BUCKET, _SLOT {before}), 0)" for name in ("n", *counts)}
    numbered = add_columns(
        sizes,
        {"nr": f"row_number() OVER ({by} _BUCKET, _SLOT)", **{f"start_{name}": sql for name, sql in starts.items()}},
    )
    # The bucket before the first one that starts within reach holds the rest of the reach. Of later
    # buckets, those up to the first that starts after ``later`` rows behind this one's end.
    needs = {}
    for i, reach in enumerate(reaches):
        near = f"min(nr) OVER ({by} start_n{i} RANGE BETWEEN {max(reach.earlier - 1, 0)} PRECEDING AND CURRENT ROW)"
        needs[f"first_{i}"] = f"greatest(1, {near} - 1)" if reach.earlier else "nr"
        ends = f"max(nr) OVER ({by} end_n{i} RANGE BETWEEN CURRENT ROW AND {max(reach.later - 1, 0)} FOLLOWING)"
        needs[f"last_{i}"] = f"{ends} + 1" if reach.later else "nr"
    ended = add_columns(numbered, {f"end_n{i}": f"start_n{i} + n{i}" for i in range(len(reaches))})
    reached = add_columns(ended, {"own": f"start_n div {part_rows}", **needs})
    low = ", ".join(f"first_{i}" for i in range(len(reaches)))
    high = ", ".join(f"last_{i}" for i in range(len(reaches)))
    ranges = reached.groupBy(*series.keys, "own").agg(
        F.expr(f"min(array_min(array({low}))) AS low"), F.expr(f"max(array_max(array({high}))) AS high")
    )
    served = ranges.selectExpr(*series.keys, "own AS _PART", "explode(sequence(low, high)) AS nr")
    same_number = " AND ".join([*(f"bucket.{k} <=> served.{k}" for k in series.keys), "bucket.nr = served.nr"])
    members = reached.alias("bucket").join(served.alias("served"), F.expr(same_number), "inner")
    members = members.selectExpr(*[f"bucket.{name}" for name in place], "served._PART", "bucket.own <> served._PART AS _COPY")
    same_place = " AND ".join(f"bar.{name} <=> member.{name}" for name in place)
    joined = bucketed.alias("bar").join(members.alias("member"), F.expr(same_place), "inner")
    return (
        joined.select("bar.*", "member._PART", "member._COPY"),
        replace(series.by("_PART"), order=(*series.order, "_SLOT")),
    )
