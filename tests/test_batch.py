"""The full run from CSV files, the table layout and the dictionary."""

from __future__ import annotations

from pathlib import Path

import pytest

from tests.frames import bar
from tests.test_plans import plan_of, random_rows, same
from tickloom.operators import breadth, earnings, price, regime, risk, strength, volume
from tickloom.operators.long_series import Profile
from tickloom.operators.silver import SILVER
from tickloom.plans import batch, tables
from tickloom.sources.dictionary import COLUMNS, column_audit, with_comments
from tickloom.sources import tables as sources
from tickloom.sources.tables import (
    GOLD_TABLES,
    PATHS,
    read_raw_csv,
    read_table,
    remove,
    scratch_dir,
    table_path,
    write_table,
)


def write_csvs(folder, rows):
    (folder / "bronze").mkdir(parents=True)

    def save(table, header, lines):
        text = "\n".join([header, *[",".join("" if v is None else str(v) for v in line) for line in lines]])
        (folder / PATHS[table]).write_text(text + "\n")

    save("raw_prices", "symbol,date,open,high,low,close,close_adjusted,volume,split_coefficient",
         [(s, d, o, h, low, c, c, v, 1.0) for s, d, o, h, low, c, v, _, _ in rows])
    save("raw_earnings", "symbol,date,qtr,eps_est,eps,release_time",
         [(s, d, "Q1", x, e, "post") for s, d, *_, e, x in rows if e is not None])
    save("raw_dividends", "symbol,date,dividend", [(r[0], r[1], 0.5) for r in rows[::50]])


@pytest.fixture
def base(tmp_path):
    write_csvs(tmp_path, random_rows(days=60))
    return str(tmp_path)


@pytest.mark.parametrize("name", [None, "silver_by_symbol"])
def test_run_all(spark, base, name):
    batch.run_all(spark, base, silver_table=name)
    silver = read_table(spark, base, "silver")
    assert silver.columns == SILVER
    assert silver.count() == len(random_rows(days=60))
    assert silver.filter("DIVIDENDS IS NOT NULL").count() == len(random_rows(days=60)[::50])
    for table in GOLD_TABLES:
        same(read_table(spark, base, table), getattr(tables, table)(silver))


def test_bucketed_silver_needs_no_shuffle(spark, base):
    batch.ingest_bronze(spark, base)
    batch.build_silver(spark, base, "silver_for_plans")
    silver = spark.table("silver_for_plans")
    for build in (tables.price_metrics, tables.earnings_reaction, tables.risk_metrics, tables.market_regime):
        assert "Exchange" not in plan_of(build(silver, longest=1))


def test_silver_is_registered_at_every_size(spark, base, monkeypatch):
    batch.run_all(spark, base, silver_table="silver_twice")
    rows = spark.table("silver_twice").count()
    monkeypatch.setattr(batch, "MAX_ROWS", 10)
    batch.run_all(spark, base, silver_table="silver_twice")
    assert spark.table("silver_twice").count() == rows
    same(tables.price_metrics(spark.table("silver_twice")), read_table(spark, base, "price_metrics"))
    monkeypatch.undo()
    batch.run_all(spark, base, silver_table="silver_twice")
    same(tables.price_metrics(spark.table("silver_twice")), read_table(spark, base, "price_metrics"))


def test_buckets_stay_within_the_limit(spark):
    assert batch.bucket_count(spark, Profile(10**13, 1000, 0)) == 100_000
    assert batch.bucket_count(spark, Profile(10**6, 2_000_000, 0)) is None


def test_failed_write_stops_the_rest(spark, tmp_path):
    bad = spark.range(1).selectExpr("raise_error('no') AS x")
    frames = {str(tmp_path / "a"): bad, str(tmp_path / "b"): spark.range(3)}
    with pytest.raises(Exception, match="no"):
        batch._write_all(spark, frames, writes=1)
    assert not list(tmp_path.iterdir())


def test_csv_with_another_header_raises(spark, tmp_path):
    (tmp_path / "one.csv").write_text("symbol,date,dividend\nA,2020-01-01,9\n")
    (tmp_path / "two.csv").write_text("date,symbol,dividend\n2020-01-03,B,1\n")
    with pytest.raises(Exception, match="header"):
        read_raw_csv(spark, str(tmp_path)).collect()


def test_repeated_key_stops_the_run(spark, tmp_path):
    write_csvs(tmp_path, [bar("A", 0, 1.0), bar("A", 0, 2.0)])
    with pytest.raises(ValueError, match="prices: a .SYMBOL, DATE. key occurs 2 times"):
        batch.run_all(spark, str(tmp_path))


def test_raw_csv_stays_text(spark, base):
    raw = read_raw_csv(spark, table_path(base, "raw_prices"))
    assert {t for _, t in raw.dtypes} == {"string"}
    batch.ingest_bronze(spark, base)
    same(read_table(spark, base, "bronze_prices"), raw)


def test_raw_paths_can_be_given(spark, base, tmp_path):
    other = tmp_path / "elsewhere.csv"
    other.write_text("symbol,date,dividend\nA,2020-01-01,9\n")
    batch.ingest_bronze(spark, base, {"dividends": str(other)})
    assert [tuple(r) for r in read_table(spark, base, "bronze_dividends").collect()] == [("A", "2020-01-01", "9")]


def test_write_replaces_and_honours_file_count(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10).repartition(6), path)
    write_table(spark.range(1000).repartition(6), path, files=1)
    assert spark.read.parquet(path).count() == 1000
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 1


def test_scratch_folders_lie_in_the_shared_folder(spark):
    first, second = scratch_dir(spark), scratch_dir(spark)
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_layout():
    assert len(PATHS) == len(set(PATHS.values())) == 14
    assert table_path("data/", "silver") == "data/silver/financial_market_events_silver"


def test_dictionary_covers_every_table():
    outputs = [SILVER, price.OUTPUT, volume.OUTPUT, earnings.OUTPUT, risk.OUTPUT, strength.OUTPUT, regime.OUTPUT]
    final = {c for columns in [*outputs, breadth.OUTPUT] for c in columns}
    intermediates = {"CLOSE_PRICE_20D", "AVG_RETURN_20D", "VARIANCE_20D", "ROLLING_MAX_CLOSE_20D", "DRAWDOWN_TODAY"}
    assert set(COLUMNS) == final | intermediates
    assert len(COLUMNS) == 74


def test_comments_survive_parquet(spark, tmp_path):
    df = spark.range(1).selectExpr("'A' AS SYMBOL", "1D AS `20_DAY_AVG_VOLUME`", "1 AS other")
    write_table(with_comments(df), str(tmp_path / "t"))
    fields = {f.name: f.metadata for f in spark.read.parquet(str(tmp_path / "t")).schema}
    assert fields["20_DAY_AVG_VOLUME"] == {"comment": COLUMNS["20_DAY_AVG_VOLUME"]}
    assert fields["other"] == {}


def test_column_audit(spark):
    df = spark.sql("SELECT * FROM VALUES ('A', 1), ('B', NULL) AS t(SYMBOL, OTHER)")
    assert sorted(tuple(r) for r in column_audit(df).collect()) == [("OTHER", 1, False), ("SYMBOL", 2, True)]


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(spark.range(5), path)
    with pytest.raises(Exception, match="no more"):
        write_table(spark.range(9).selectExpr("if(id > 7, raise_error('no more'), id) AS id"), path)
    assert spark.read.parquet(path).count() == 5
    write_table(spark.read.parquet(path).union(spark.range(2)), path)
    assert spark.read.parquet(path).count() == 7
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_tables_are_published_together_or_not_at_all(spark, tmp_path, monkeypatch):
    old = {name: str(tmp_path / name) for name in "abc"}
    batch._write_all(spark, {path: spark.range(1) for path in old.values()})
    bad = spark.range(1).selectExpr("raise_error('no') AS id")
    with pytest.raises(Exception, match="no"):
        batch._write_all(spark, {old["a"]: spark.range(2), old["b"]: spark.range(2), old["c"]: bad}, writes=1)
    assert [spark.read.parquet(p).count() for p in old.values()] == [1, 1, 1]

    real = sources.rename

    calls = {"left": 1}

    def once(session, path, to):
        if to == old["b"] and calls["left"]:
            calls["left"] = 0
            raise OSError("no rename")
        real(session, path, to)

    monkeypatch.setattr(sources, "rename", once)
    with pytest.raises(OSError, match="no rename"):
        batch._write_all(spark, {path: spark.range(3) for path in old.values()})
    assert [spark.read.parquet(p).count() for p in old.values()] == [1, 1, 1]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "b", "c"]


def test_unreadable_texts_are_counted_while_silver_is_written(spark, base):
    lines = (Path(base) / PATHS["raw_prices"]).read_text().splitlines()
    lines[1] = "A,not a day,x,2.0,,1.5, ,many,1.0"
    (Path(base) / PATHS["raw_prices"]).write_text("\n".join(lines) + "\n")
    found = batch.run_all(spark, base).losses
    assert found["prices"] == {
        "DATE": 1, "OPEN_PRICE": 1, "HIGH_PRICE": 0, "LOW_PRICE": 0, "CLOSE_PRICE": 0,
        "CLOSE_ADJUSTED_PRICE": 0, "VOLUME": 1, "SPLIT_COEFFICIENT": 0}
    assert set(found["dividends"].values()) == set(found["earnings"].values()) == {0}


def test_build_one_table(spark, base):
    batch.run_all(spark, base)
    for name in ("risk_metrics", "market_breadth"):
        before = read_table(spark, base, name).collect()
        remove(spark, table_path(base, name))
        batch.build_table(spark, base, name)
        same(read_table(spark, base, name), spark.createDataFrame(before, read_table(spark, base, name).schema))


def test_gold_leaves_no_scratch_behind(spark, base):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("*"))
    batch.run_all(spark, base)
    assert set(shared.glob("*")) == before
