"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tickloom.sources.tables import remove, scratch_dir

#: Upper case letters of ASCII only; other letters stay as they are.
ASCII_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back, which cuts its lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one run, in a fresh folder below ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, scratch_dir(spark)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        return stored(df, f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Remove tables that no frame still in use reads."""
        for name in names:
            remove(self.spark, f"{self.root}/{name}")


#: Spark's limit on the rows of an Arrow batch, which the JVM and the worker each hold whole, and what whole texts get.
BATCH_ROWS, SMALL_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside gets Arrow batches of at most ``SMALL_BATCH`` rows; the session's own limit comes back after it."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(int(before), SMALL_BATCH) if int(before) > 0 else SMALL_BATCH))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


#: Row keys of rows that their doc_id does not name lie beyond this, on either side.
FAR = 1 << 62


def with_row_key(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with ``__row``, equal only for rows equal in doc_id and text.

    It is the doc_id where that has one text. Where it has several, that holds for one
    of them, and the others get hashes above ``FAR``. Rows without a doc_id get hashes
    below ``-FAR``, so that they come first, as nulls do.
    """
    text = F.xxhash64("text")
    texts = docs.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id"))
    texts = texts.agg(F.min(text).alias("__first"), F.max(text).alias("__last")).filter("__first <> __last")
    shared = scratch.store(texts.select("__id", "__first"), "shared_ids")
    none = -FAR - 1 - F.shiftrightunsigned(text, 2)
    other = FAR + F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
    key = F.when(F.col("doc_id").isNull(), none).when(F.col("__first") != text, other).otherwise(F.col("doc_id").cast("long"))
    joined = docs.join(shared, F.col("doc_id") == F.col("__id"), "left")
    return joined.withColumn("__row", key).drop("__id", "__first")


#: Bits of a ``sifted`` bitmap for each id, and at most in all (8 MB). With more ids than these serve, more rows are marked.
SIFT_BITS, MOST_SIFT_BITS = 64, 1 << 26


def sifted(rows: DataFrame, key: str, ids: DataFrame, id_count: int) -> DataFrame:
    """``rows`` with ``__maybe``: false where the key is null or surely none of ``ids`` (one column), without a shuffle of ``rows``.

    The ids set a bit each in a bitmap of bounded size, which is broadcast in pieces. What the
    bitmap marks must go through an exact join; only these rows need to be shuffled.
    """
    bits = min(MOST_SIFT_BITS, SIFT_BITS << max(0, id_count - 1).bit_length())
    place = F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(bits)) + 1
    pieces = ids.select(F.bitmap_bucket_number(place).alias("__piece"), F.bitmap_bit_position(place).alias("__bit"))
    pieces = pieces.groupBy("__piece").agg(F.bitmap_construct_agg("__bit").alias("__bits"))
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(bits)) + 1
    placed = rows.withColumns({"__piece": F.bitmap_bucket_number(place), "__bit": F.bitmap_bit_position(place)})
    byte = F.substring("__bits", (F.floor(F.col("__bit") / 8) + 1).cast("int"), F.lit(1))
    found = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("__bit") % 8).cast("int")) == 1
    marked = placed.join(F.broadcast(pieces), "__piece", "left")
    marked = marked.withColumn("__maybe", F.col(key).isNotNull() & F.coalesce(found, F.lit(False)))
    return marked.select(*rows.columns, "__maybe")


def words_of(text: str | None) -> list[bytes]:
    """The runs of characters other than ``[\\x20\\x09-\\x0D]``, as UTF-8."""
    return text.encode().split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """``words_of`` after A-Z is lower-cased (``bytes.lower`` changes ASCII only)."""
    return text.encode().lower().split() if text else []


def map_rows(
    df: DataFrame,
    keep: list[str],
    given: list[str],
    fn: Callable[..., Iterable[tuple]],
    ddl: str,
    sliced: str | None = None,
) -> DataFrame:
    """Columns ``keep`` as they are, then those of ``ddl``: one tuple of ``fn`` per row.

    ``fn`` gets the values of the columns ``given`` of one Arrow batch, as one
    list per column. Kept columns never leave Arrow, so their values and nulls
    are untouched; all others are left behind in the scan. With ``sliced`` it gets no
    whole batch, but ``slices_of`` it by the texts of that column.
    """
    added = T._parse_datatype_string(ddl)
    schema = T.StructType([df.schema[c] for c in keep] + added.fields)
    kinds = [to_arrow_type(f.dataType) for f in added.fields]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, sliced):
            rows = list(fn(*(batch.column(c).to_pylist() for c in given)))
            made = list(zip(*rows, strict=True)) if rows else [() for _ in kinds]
            arrays = [pa.array(column, kind) for column, kind in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *arrays], names)

    return df.select(*dict.fromkeys([*keep, *given])).mapInArrow(run, schema)


def map_batches(
    df: DataFrame,
    given: list[str],
    fn: Callable[[Iterator[list[list]]], Iterable[list]],
    ddl: str,
    sliced: str | None = None,
) -> DataFrame:
    """Rows made of whole partitions: ``fn`` gets an iterator of batches (one list per
    column ``given``), or with ``sliced`` of slices as ``map_rows`` does, and yields lists of columns."""
    schema = T._parse_datatype_string(ddl)
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = ([b.column(c).to_pylist() for c in given] for b in parts_of(batches, sliced))
        for columns in fn(lists):
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return df.select(*given).mapInArrow(run, schema)


#: Bytes of the texts (or of other values) that a worker holds as Python objects at once, besides one longer value.
SLICE_BYTES = 2_000_000


def slices_of(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of rows in order, each of about ``most`` bytes of the texts or binary values in ``column``."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
    group = (np.cumsum(sizes) - sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for start, end in zip(edges, edges[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)
    # What Arrow's allocator keeps for later would stay with a worker that waits for its next task.
    pa.default_memory_pool().release_unused()


def parts_of(batches: Iterator[pa.RecordBatch], sliced: str | None) -> Iterator[pa.RecordBatch]:
    """The batches, or (``sliced``) the ``slices_of`` each by that column."""
    for batch in batches:
        if sliced is None:
            yield batch
        else:
            yield from slices_of(batch, sliced)


def int_lists(values: list[bytes]) -> pa.ListArray:
    """Each value, little-endian 32-bit integers, as a list; no integer becomes a Python object."""
    ends = np.cumsum([0, *map(len, values)]) // 4
    flat = np.frombuffer(b"".join(values), "<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def long_lists(values: list[np.ndarray]) -> pa.ListArray:
    """Each array of 64-bit integers as a list; no integer becomes a Python object."""
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate([np.zeros(0, np.int64), *values])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


class Remembered(dict):
    """Values of words by word, up to about ``most`` bytes in all. Beyond that the older half goes."""

    def __init__(self, most: int, overhead: int = 200):
        super().__init__()
        self.most, self.overhead, self.held = most, overhead, 0

    def make_room(self) -> None:
        """To be called between slices: words in use stay until then."""
        if self.held > self.most:
            for word in list(islice(self, len(self) // 2)):
                del self[word]
            self.held //= 2

    def learn(self, words: list, values: list, sizes: int) -> None:
        """``sizes``: bytes of the words and values together."""
        self.update(zip(words, values, strict=True))
        self.held += sizes + self.overhead * len(words)
