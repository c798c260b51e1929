"""Casts against Spark's own lenient casts, and the label helpers."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.frames import bars
from tests.test_plans import random_rows
from tickloom.functions.labels import compared, signed, spike
from tickloom.functions.numeric import growth, pct_change, ratio, to_day, to_double, to_long
from tickloom.plans import tables

ODD = ["abc", "", " ", " 7 ", "\t7\n", "123.7", "1e3", "-5.9", "01/05/2020", "2020-1-5", "2020-01-05 10:00:00",
       ".5", "-.5", ".", "+", "-", "+7", "--7", "7.", "1.2.3", "9223372036854775807", "9223372036854775808",
       "-9223372036854775808.9", "NaN", "Infinity", "1_000", "1,000", "0x10", "1 2", None]


def lenient(spark, build):
    """Rows of a frame that is built and run with ANSI mode off."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        return [tuple(r) for r in build().collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def same_as_lenient(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string").coalesce(1)
    ours = [tuple(r) for r in df.selectExpr(to_long("v"), to_double("v"), f"cast({to_day('v')} AS string)").collect()]
    plain = ["cast(v AS bigint)", "cast(v AS double)", "cast(to_date(v) AS string)"]
    theirs = lenient(spark, lambda: df.selectExpr(*plain))
    assert [str(r) for r in ours] == [str(r) for r in theirs]


def test_casts_equal_lenient_casts(spark):
    same_as_lenient(spark, ODD)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789.+-e \t", max_size=12), min_size=30, max_size=60))
def test_casts_equal_lenient_casts_on_any_text(spark, texts):
    same_as_lenient(spark, texts)


def test_values_read_as_expected(spark):
    df = spark.createDataFrame([("123.7",), ("1e3",), (" 7 ",), (".5",)], "v string").coalesce(1)
    assert [r[0] for r in df.selectExpr(to_long("v")).collect()] == [123, None, 7, 0]


@pytest.mark.parametrize(
    "sql,expected",
    [
        (ratio("1D", "0D"), None),
        (ratio("1D", "-0D"), None),
        (ratio("1D", "cast(NULL AS double)"), None),
        (ratio("3L", "2L"), 1.5),
        (pct_change("110D", "100D"), 10.0),
        (pct_change("-0.5D", "-1D"), -50.0),
        (growth("110D", "100D"), 1.1 - 1),
        (compared("2", "1", "a", "b", "c"), "a"),
        (compared("1", "2", "a", "b", "c"), "b"),
        (compared("1", "1", "a", "b", "c"), "c"),
        (compared("1", "cast(NULL AS int)", "a", "b", "c"), "c"),
        (signed("cast(NULL AS double)", "a", "b", "c"), None),
        (signed("0D", "a", "b", "c"), "c"),
        (signed("cast('NaN' AS double)", "a", "b", "c"), "a"),
        (spike("151", "100D"), "SPIKE"),
        (spike("150", "100D"), "NORMAL"),
        (spike("150", "0D"), None),
        (spike("cast(NULL AS int)", "100D"), None),
    ],
)
def test_expression(spark, sql, expected):
    assert spark.range(1).selectExpr(f"{sql} AS v").first()[0] == expected


def test_tables_do_not_depend_on_the_ansi_setting(spark):
    frame = bars(spark, random_rows(days=80)).coalesce(1)
    for build in (tables.earnings_reaction, tables.risk_metrics, tables.market_regime):
        strict = [tuple(r) for r in build(frame, 1).collect()]
        assert sorted(strict, key=str) == sorted(lenient(spark, lambda: build(frame, 1)), key=str)
