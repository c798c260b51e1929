"""Reading and writing of the raw, bronze, silver and gold tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Where each table lives below the base folder.
PATHS = {
    "raw_dividends": "bronze/dividends_latest.csv",
    "raw_earnings": "bronze/earnings_latest.csv",
    "raw_prices": "bronze/stock_prices_latest.csv",
    "bronze_dividends": "bronze/dividends",
    "bronze_earnings": "bronze/earnings",
    "bronze_prices": "bronze/stock_prices",
    "silver": "silver/financial_market_events_silver",
    "price_metrics": "gold/daily_price_metrics_gold",
    "volume_liquidity": "gold/daily_volume_liquidity_metrics_gold",
    "earnings_reaction": "gold/earnings_impact_and_event_driven_market_reaction_gold",
    "market_regime": "gold/market_regime_gold",
    "risk_metrics": "gold/risk_metrics_gold",
    "relative_strength": "gold/relative_strength_gold",
    "market_breadth": "gold/market_breadth",
}
RAW_TABLES = ["prices", "earnings", "dividends"]
GOLD_TABLES = [
    "price_metrics",
    "volume_liquidity",
    "earnings_reaction",
    "risk_metrics",
    "relative_strength",
    "market_regime",
    "market_breadth",
]


def table_path(base_dir: str, table: str) -> str:
    return f"{base_dir.rstrip('/')}/{PATHS[table]}"


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV, or a folder of them, with headers; every column stays text.

    The headers must name the same columns in the same order; a file with
    another header raises when it is read, rather than give columns a wrong name.
    """
    return spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False)


def read_table(spark: SparkSession, base_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(base_dir, table))


def codec(spark: SparkSession) -> str:
    """How tables are compressed: as the session asks, and else smaller than by Spark's own default."""
    return spark.conf.get("spark.sql.parquet.compression.codec", None) or "zstd"


def write_table(df: DataFrame, path: str, files: int | None = None) -> None:
    """Replace the table at ``path`` once all of ``df`` is written; until then, and after a failure, the old one stays.

    ``files`` asks for about that many files. It rebalances the rows before the
    write, so the work above keeps its own parallelism and a heavy partition is
    split, where a coalesce would run all of it in that few tasks.
    """
    replacement = Replacement(df.sparkSession)
    try:
        replacement.write(df, path, files)
        replacement.publish()
    finally:
        replacement.discard()


class Replacement:
    """Tables that are written beside the old ones and then take their places together.

    A new table is written to a folder next to its path, whose name begins with an underscore, so that
    no reader of the parent folder takes it for data. ``publish`` renames folders, old ones aside
    and new ones in; if a rename fails, those already made are undone. ``discard`` removes what is left aside.
    On a store where a rename copies, publishing takes as long as the copies.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.mark = spark, uuid.uuid4().hex
        self.staged: dict[str, str] = {}
        self.aside: list[str] = []

    def _beside(self, path: str, kind: str) -> str:
        parent, _, name = path.rstrip("/").rpartition("/")
        return f"{parent}/_{name}.{kind}-{self.mark}"

    def write(self, df: DataFrame, path: str, files: int | None = None) -> None:
        """Write rows of the new table at ``path``; what is written to one path in several calls adds up."""
        mode = "append" if path in self.staged else "overwrite"
        self.staged[path] = self._beside(path, "new")
        out = df if files is None else df.hint("rebalance", files)
        out.write.mode(mode).option("compression", codec(self.spark)).parquet(self.staged[path])

    def publish(self) -> None:
        done: list[tuple[str, str]] = []
        try:
            for path, staged in self.staged.items():
                old = self._beside(path, "old")
                if exists(self.spark, path):
                    rename(self.spark, path, old)
                    done.append((path, old))
                    self.aside.append(old)
                rename(self.spark, staged, path)
                done.append((staged, path))
        except BaseException:
            for path, now in reversed(done):
                rename(self.spark, now, path)
            self.aside = []
            raise
        self.staged = {}

    def discard(self) -> None:
        for path in [*self.staged.values(), *self.aside]:
            remove(self.spark, path)
        self.staged, self.aside = {}, []


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def rename(spark: SparkSession, path: str, to: str) -> None:
    system, place = _file_system(spark, path)
    if not system.rename(place, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be renamed to {to}")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all in it, if it is there."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def write_by_symbol(df: DataFrame, path: str, table: str, buckets: int | None) -> None:
    """Replace ``table``, stored at ``path``, in buckets by SYMBOL or (None) without.

    With buckets a window on SYMBOL over ``spark.table(table)`` needs no shuffle,
    so one shuffle here serves every derived table. Files and catalog entry
    change together: what is stored below a registered table is written through it.
    """
    spark = df.sparkSession
    rows = df if buckets is None else df.repartition(buckets, "SYMBOL")
    writer = rows.write.mode("overwrite").format("parquet").option("path", path).option("compression", codec(spark))
    if buckets is not None:
        writer = writer.bucketBy(buckets, "SYMBOL").sortBy("SYMBOL", "DATE")
    writer.saveAsTable(table)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """For jobs whose shuffle files nobody reads again: Spark then removes those of a query once it has run.

    Left to itself, it does so when the driver happens to collect its garbage, and until then the shuffles of several steps
    lie side by side. The setting is the session's, so queries of other threads see it too; it changes no result.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tickloom-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="tickloom-")
