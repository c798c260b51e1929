"""Token ids as ORC files in ascending order of the documents.

The rows of a file are in order of doc_id, and the files follow one another in that order. A
file is a run of stripes, each with integer run-length encoding, a row index (least and
greatest doc_id of every ``INDEX_ROWS`` rows) and Bloom filters on doc_id. Readers take
stripes in parallel, and a read for some doc_ids skips stripes and index groups by metadata.

Columns: doc_id; part, the number of the file's place in the order; at, the ids before the
document within its part; n_tokens; and ids. So a document's place in the whole corpus
needs only the sums of the parts before it, never a pass over the ids.

Rows that repeat a doc_id follow one another in the order of a hash of their texts; equal
rows are interchangeable. Rows without a doc_id come first. A null text is empty, and an
empty text has the end id alone. No key need fit into one file: rows of one doc_id are
dealt on over files.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tickloom.llm.common import Remembered, Scratch, slices_of, table

MODEL = "/opt/tokenizers/word_bpe_49k.json"
#: The id that ends each document.
END = 2
#: Bytes of a stripe before compression, rows of an index group, and share of false hits of a Bloom filter.
STRIPE_BYTES, INDEX_ROWS, FALSE_HITS = 16 << 20, 1_000, 0.01
#: Bytes of runs, and of words, with their ids that a worker remembers, and the longest word that it does.
REMEMBERED, LONGEST = 96 << 20, 256
#: Letters that are one character in every form and whose lower case is another of them, or their own:
#: those of ASCII, Latin-1 and Latin Extended-A, without the dotted capital I.
_LOWER = r"a-z\x{df}-\x{f6}\x{f8}-\x{ff}\x{101}-\x{12f}\x{131}-\x{17f}"
_UPPER = r"A-Z\x{c0}-\x{d6}\x{d8}-\x{de}\x{100}"
#: Marks outside ASCII that are neither letters nor numbers, nor parts of others.
_MARKS = r"\x{a1}\x{ab}\x{bb}\x{bf}\x{2013}\x{2014}\x{2018}-\x{201d}\x{2026}"
#: What a plain text does not hold: other characters, and the start of a special token.
NOT_PLAIN = rf"[^\x09-\x0d\x20-\x7e{_LOWER}{_UPPER}{_MARKS}]|<\|"
#: What the vocabulary merges by itself, in lower case. The endings after an apostrophe.
RUNS = rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LOWER}]+|[0-9]|[^\x09-\x0d\x200-9{_LOWER}]+"

#: Values one after the other, and how many belong to each row.
Lists = tuple[np.ndarray, np.ndarray]
SCHEMA = "doc_id long, part int, at long, n_tokens int, ids array<int>"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: its own if visible, else one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(0x100) if b not in own]
    return [chr(b) if b in own else chr(0x100 + other.index(b)) for b in range(0x100)]


LETTERS = str.maketrans(dict(enumerate(byte_letters())))


class WordEncoder:
    """Ids of texts as 32-bit integers.

    This vocabulary drops white space and merges nothing across it, so that a text's ids are
    those of its words one after the other. In a text of ``PLAIN`` characters normalising is
    lower case alone, and the words fall into ``RUNS`` that the vocabulary's model merges by themselves. So each run,
    and in other texts each word, is encoded once and remembered.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.model = self.tokenizer.model
        self.runs, self.words = Remembered(REMEMBERED), Remembered(REMEMBERED)

    def _of_runs(self, runs: list[bytes]) -> list[bytes]:
        # The letter of a byte of visible ASCII is its own.
        spelt = (r.decode() if r.isascii() else r.decode("latin-1").translate(LETTERS) for r in runs)
        merged = map(self.model.tokenize, spelt)
        return [array("i", [token.id for token in tokens]).tobytes() for tokens in merged]

    def _of_words(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [array("i", x.ids).tobytes() for x in found]

    def _joined(self, split: pa.ListArray, known: Remembered, learn: Callable[[list[bytes]], list[bytes]]) -> Lists:
        """The ids of each list of words, one word after the other."""
        known.make_room()
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        ids = list(map(known.get, distinct))
        new = [w for w, x in zip(distinct, ids, strict=True) if x is None]
        made = dict(zip(new, learn(new), strict=True))
        short = [w for w in new if len(w) <= LONGEST]
        known.learn(short, [made[w] for w in short], sum(len(w) + len(made[w]) for w in short))
        ids = [made[w] if x is None else x for w, x in zip(distinct, ids, strict=True)]

        flat = pa.py_buffer(b"".join(ids))
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        edges = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
        lists = pa.ListArray.from_arrays(edges, pa.Array.from_buffers(pa.int32(), int(size.sum()), [None, flat]))
        taken = lists.take(coded.indices).flatten().to_numpy()
        behind = np.cumsum(size[coded.indices.to_numpy()], dtype=np.int64)
        # A null list is empty, and leaves no words in the flattened array.
        words = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], behind])[np.concatenate([[0], np.cumsum(words)])]
        return taken, np.diff(ends)

    def encode(self, texts: pa.StringArray) -> Lists:
        """The ids of all texts one after the other, and how many each has; null has none."""
        plain = pc.fill_null(pc.invert(pc.match_substring_regex(texts, NOT_PLAIN)), True)
        runs = pc.replace_substring_regex(pc.utf8_lower(texts.filter(plain)), RUNS, r"\0 ")
        words = texts.filter(pc.invert(plain))
        simple, sizes = self._joined(pc.ascii_split_whitespace(runs), self.runs, self._of_runs)
        others, counts = self._joined(pc.ascii_split_whitespace(words), self.words, self._of_words)
        if not len(counts):
            return simple, sizes
        # Back into the order of the texts.
        is_plain = plain.to_numpy(zero_copy_only=False)
        size = np.empty(len(texts), np.int64)
        size[is_plain], size[~is_plain] = sizes, counts
        out, mine = np.empty(size.sum(), np.int32), np.repeat(is_plain, size)
        out[mine], out[~mine] = simple, others
        return out, size


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id and text, dealt and sorted by doc_id; rows of one doc_id may go on in the next partition."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("tie", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("tie")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def write_tokens(docs: DataFrame, path: str, model: str = MODEL, end: int = END) -> None:
    """Encode the texts of ``docs`` and write the files of this format to the folder ``path``.

    The vocabulary file, which the driver reads, bounds what is broadcast.
    """
    with open(model, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": file.read()})
    last = np.int32(end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker keeps the value of a broadcast from task to task, and the encoder with it.
        held = shared.value
        encoder = held.setdefault("encoder", None) or WordEncoder(held["vocabulary"])
        held["encoder"] = encoder
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices_of(batch, "text"):
                flat, sizes = encoder.encode(piece.column("text"))
                flat, sizes = np.insert(flat, np.cumsum(sizes), last), sizes + 1
                ends = np.concatenate([[0], np.cumsum(sizes)])
                begin, at = at + ends[:-1], at + int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(np.full(len(sizes), part, np.int32)),
                        pa.array(begin),
                        pa.array(sizes.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat)),
                    ],
                    ["doc_id", "part", "at", "n_tokens", "ids"],
                )

    rows = in_order(docs).mapInArrow(run, SCHEMA)
    rows.write.mode("overwrite").options(
        **{
            "orc.stripe.size": str(STRIPE_BYTES),
            # Rows may be long, so a stripe's size is looked at more often than by default.
            "orc.rows.between.memory.checks": str(INDEX_ROWS // 5),
            "orc.create.index": "true",
            "orc.row.index.stride": str(INDEX_ROWS),
            "orc.bloom.filter.columns": "doc_id",
            "orc.bloom.filter.fpp": str(FALSE_HITS),
        }
    ).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files, in the columns of ``SCHEMA``. Spark deals large files out by stripes."""
    return spark.read.schema(SCHEMA).orc(path)


def read_documents(spark: SparkSession, path: str, doc_ids: Iterable[int]) -> DataFrame:
    """Rows of some documents. Row indexes and Bloom filters leave out the stripes and index groups that hold none."""
    return read_tokens(spark, path).filter(F.col("doc_id").isin([int(x) for x in doc_ids]))


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """part and the ids of all parts before it: a row per file, from one narrow column of the files."""
    sums = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        flat, ends = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends, ends[1:], strict=False)]
        made = [pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "part", "at")), *made], CHECKED)


CHECKED = ["doc_id", "part", "at", "n_tokens", "ids_crc32"]


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files.

    start is the number of ids of all documents before it. Only these numbers meet the starts
    of the parts; ids are not shuffled.
    """
    rows = read_tokens(spark, path).select("doc_id", "part", "at", "ids")
    checked = rows.mapInArrow(_checksums, "doc_id long, part int, at long, n_tokens long, ids_crc32 long")
    placed = checked.join(part_starts(spark, path), "part")
    return placed.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op11_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Scratch(spark).root}/tokens"
    write_tokens(table(spark, sf_dir, "documents"), path)
    return checksums(spark, path)
