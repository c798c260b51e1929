"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces."""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm.common import Remembered, int_lists, map_rows, slices_of, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
#: A word with the spaces before it. No piece goes on from a word into a space, so each is segmented by itself.
CHUNK = re.compile(rb" *[^ ]+| +")
#: Bytes of segmented words and their ids that a worker remembers. Those longer than ``LONG`` it does not.
REMEMBERED = 16 << 20
#: Characters of texts whose new words are segmented together.
TOGETHER = 2_000_000
#: Words of one such step, and the bytes beyond which a word takes its own.
BLOCK, LONG = 16_384, 128


Trie = tuple[array, array, array]


def double_array(keys: dict[bytes, int]) -> Trie:
    """Trie of byte strings as three arrays: base, check and value.

    ``byte`` leads from ``node`` to ``base[node] + byte`` if ``check`` there is
    ``node``. ``value`` is the key's number, or -1 where no key ends.
    """
    tree: dict = {}
    for key, number in keys.items():
        at = tree
        for byte in key:
            at = at.setdefault(byte, {})
        at[-1] = number
    base, check, value = [0], [-1], [-1]
    free, tail, todo = 256, 256, [(0, tree)]
    while todo:
        node, at = todo.pop()
        bytes_ = sorted(b for b in at if b >= 0)
        value[node] = at.get(-1, -1)
        if not bytes_:
            continue
        while free < len(check) and check[free] >= 0:
            free += 1
        # A single child fills the first gap; several are placed behind the last such family.
        to = (free if len(bytes_) == 1 else tail) - bytes_[0]
        while any(to + b < len(check) and check[to + b] != -1 for b in bytes_):
            to += 1
        for row in (base, check, value):
            row.extend([-1] * (to + 256 - len(row)))
        base[node] = to
        tail = max(tail, to + bytes_[0]) if len(bytes_) > 1 else tail
        for b in bytes_:
            check[to + b] = node
            todo.append((to + b, at[b]))
    return array("i", base), array("i", check), array("i", value)


class Pieces(NamedTuple):
    """A vocabulary: bytes of each id, its log score, the ids of the 256 single bytes, and the trie."""

    data: list[bytes]
    score: list[float]
    byte_ids: list[int]
    trie: Trie

    @property
    def unknown(self) -> float:
        """Score of a character that has no piece: ten below the least of all."""
        return min(self.score) - 10.0


def load_pieces(path: str = MODEL) -> Pieces:
    """The pieces of a SentencePiece model file, which the driver reads.

    The vocabulary bounds what goes to the executors. A model whose scores are
    minus the rank of a merge has no log scores; it gets those of Zipf's law,
    where the piece of rank r has a probability in proportion to 1 / r.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    usual = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    raw = {i: model.get_score(i) for i in usual}
    if all(s == int(s) for s in raw.values()):
        total = sum(1 / r for r in range(1, len(raw) + 1))
        raw = {i: -math.log((1 - s) * total) for i, s in raw.items()}
    data = [b""] * len(ids)
    byte_ids = [0] * 256
    for i in ids:
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
            data[i] = bytes([int(model.id_to_piece(i)[3:5], 16)])
        elif i in raw:
            data[i] = model.id_to_piece(i).replace(MARKER, " ").encode()
    return Pieces(data, [raw.get(i, 0.0) for i in ids], byte_ids, double_array({data[i]: i for i in usual}))


def width(first: int) -> int:
    """Bytes of the UTF-8 character that starts with this byte."""
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


def segment(chunk: bytes, pieces: Pieces, unknown: float) -> list[int]:
    """Ids of the pieces with the largest sum of scores that make up ``chunk``.

    At equal sums the piece that starts first wins. A character that is no piece
    by itself may also become its bytes, at the score ``unknown``.
    """
    (base, check, value), score = pieces.trie, pieces.score
    size = len(chunk)
    best = [-math.inf] * (size + 1)
    back: list[tuple[int, int]] = [(0, 0)] * (size + 1)
    best[0] = 0.0
    for start in range(size):
        sum_, node, end = best[start], 0, start
        if sum_ == -math.inf:
            continue
        one = start + width(chunk[start])
        alone = False
        while end < size:
            to = base[node] + chunk[end]
            if check[to] != node:
                break
            node, end = to, end + 1
            piece = value[node]
            if piece >= 0:
                alone = alone or end == one
                if sum_ + score[piece] > best[end]:
                    best[end], back[end] = sum_ + score[piece], (start, piece)
        if not alone and sum_ + unknown > best[one]:
            best[one], back[one] = sum_ + unknown, (start, -1)
    ids: list[int] = []
    at = size
    while at:
        start, piece = back[at]
        ids.extend([piece] if piece >= 0 else [pieces.byte_ids[b] for b in reversed(chunk[start:at])])
        at = start
    return ids[::-1]


def segment_all(chunks: list[bytes], pieces: Pieces, unknown: float) -> list[list[int]]:
    """``segment`` of many chunks: the same steps, taken by all chunks at once.

    Very long chunks are left to ``segment``.
    """
    found: list[list[int]] = [[]] * len(chunks)
    order = sorted(range(len(chunks)), key=lambda i: len(chunks[i]))
    trie = [np.array(x, np.int32) for x in pieces.trie]
    score = np.array(pieces.score)
    for at in range(0, len(order), BLOCK):
        block = order[at : at + BLOCK]
        size = len(chunks[block[-1]])
        if size <= LONG:
            rows = [chunks[i] for i in block]
            for i, ids in zip(block, segment_block(rows, size, trie, score, pieces.byte_ids, unknown), strict=True):
                found[i] = ids
        else:
            for i in block:
                found[i] = segment(chunks[i], pieces, unknown)
    return found


def segment_block(
    rows: list[bytes], size: int, trie: list[np.ndarray], score: np.ndarray, byte_ids: list[int], unknown: float
) -> list[list[int]]:
    """Ids of each row of at most ``size`` bytes."""
    base, check, value = trie
    lengths = np.array([len(r) for r in rows])
    data = np.frombuffer(b"".join(r.ljust(size, b"\0") for r in rows), np.uint8).reshape(len(rows), size)
    best = np.full((size + 1, len(rows)), -np.inf)
    best[0] = 0.0
    back = np.zeros((2, size + 1, len(rows)), np.int32)
    for start in range(size):
        row = np.flatnonzero((lengths > start) & (best[start] > -np.inf))
        first = data[row, start]
        one = start + 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)
        alone = np.zeros(len(rows), bool)
        begun, past, node = row, one, np.zeros(len(row), np.int32)
        for end in range(start, size):
            to = base[node] + data[row, end]
            on = (check[to] == node) & (lengths[row] > end)
            row, node, one = row[on], to[on], one[on]
            if not len(row):
                break
            piece = value[node]
            whole = piece >= 0
            ended, piece = row[whole], piece[whole]
            alone[ended[one[whole] == end + 1]] = True
            total = best[start, ended] + score[piece]
            more = total > best[end + 1, ended]
            ended = ended[more]
            best[end + 1, ended] = total[more]
            back[0, end + 1, ended], back[1, end + 1, ended] = start, piece[more]
        missing = ~alone[begun]
        row, past = begun[missing], past[missing]
        more = best[start, row] + unknown > best[past, row]
        row, past = row[more], past[more]
        best[past, row] = best[start, row] + unknown
        back[0, past, row], back[1, past, row] = start, -1
    ids: list[list[int]] = [[] for _ in rows]
    row, end, steps = np.arange(len(rows)), lengths, []
    while len(row):
        start = back[0, end, row]
        steps.append((row, back[1, end, row], start, end))
        row, end = row[start > 0], start[start > 0]
    for step in reversed(steps):
        for r, piece, start, end in zip(*(x.tolist() for x in step), strict=True):
            if piece >= 0:
                ids[r].append(piece)
            else:
                ids[r].extend([byte_ids[b] for b in rows[r][start:end]])
    return ids


def chunks_of(text: str) -> list[bytes]:
    """The text in words with the spaces before them, less one space each where all words have just one."""
    data = text.encode()
    if data[:1] == b" " or data[-1:] == b" " or b"  " in data:
        return CHUNK.findall(b" " + data)
    return data.split(b" ")


class Encoder:
    """Encodes texts, remembering the words it has met, as bytes of 32-bit integers.

    A space is set before each text; spaces are markers. A null or empty text has no ids.
    """

    def __init__(self, pieces: Pieces):
        self.pieces, self.unknown = pieces, pieces.unknown
        self.known = Remembered(REMEMBERED)

    def encode(self, texts: list[str | None]) -> Iterator[list[int]]:
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < TOGETHER:
                size += len(texts[end] or "")
                end += 1
            yield from (np.frombuffer(ids, np.int32).tolist() for ids in self.encode_slice(texts[at:end]))
            at = end

    def encode_slice(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, which are all held at once."""
        self.known.make_room()
        split = [chunks_of(x) if x else [] for x in texts]
        known = self.known
        new = list(set().union(*split).difference(known))
        spaced = [x if x[:1] == b" " else b" " + x for x in new]
        ids = [array("i", x).tobytes() for x in segment_all(spaced, self.pieces, self.unknown)]
        known.learn(new, ids, sum(map(len, new)) + sum(map(len, ids)))
        found = [b"".join(map(known.__getitem__, text)) for text in split]
        for word in new:
            if len(word) > LONG:
                del known[word]
        return found


def decode_ids(ids: list[int] | None, data: list[bytes]) -> str:
    """The text of the ids: markers become spaces, bytes join to characters, and the space set before goes."""
    return b"".join([data[i] for i in ids or ()])[1:].decode(errors="replace")


def encode(docs: DataFrame, keep: list[str], path: str = MODEL) -> DataFrame:
    """Columns ``keep`` and ``ids`` of each row's text.

    Every text decodes to itself: a character without a piece becomes its
    bytes, and so does the marker's own character, which stands for no space
    in a text. Null becomes no ids, like the empty text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(load_pieces(path)))
    kept: list[Encoder] = []

    def rows(texts):
        if not kept:
            kept.append(Encoder(Pieces(*shared.value)))
        return ((ids,) for ids in kept[0].encode(texts))

    return map_rows(docs, keep, ["text"], rows, "ids array<int>")


def decode(encoded: DataFrame, keep: list[str], path: str = MODEL) -> DataFrame:
    """Columns ``keep`` and ``decoded``, the text of ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(path).data)

    def rows(lists):
        data = shared.value
        return ((decode_ids(ids, data),) for ids in lists)

    return map_rows(encoded, keep, ["ids"], rows, "decoded string")


def encode_and_decode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, ids, their number, how many are bytes, and whether they decode to the text (null: empty).

    Texts are encoded, decoded and compared in one pass, in slices of bounded size.
    """
    pieces = load_pieces(path)
    shared = docs.sparkSession.sparkContext.broadcast({"pieces": tuple(pieces)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker keeps the value of a broadcast from task to task, and the encoder with it.
        held = shared.value
        if "encoder" not in held:
            held["encoder"] = Encoder(Pieces(*held["pieces"]))
        encoder = held["encoder"]
        data = encoder.pieces.data
        for batch in batches:
            for piece in slices_of(batch, "text"):
                texts = piece.column("text").to_pylist()
                found = encoder.encode_slice(texts)
                same = [decode_ids(np.frombuffer(x, np.int32).tolist(), data) == (t or "") for x, t in zip(found, texts, strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), int_lists(found), pa.array(same, pa.bool_())], names)

    names = ["doc_id", "ids", "round_trip"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    both = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, round_trip boolean")
    low, high = min(pieces.byte_ids), max(pieces.byte_ids)
    return both.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_ids"),
        F.size(F.filter("ids", lambda i: i.between(low, high))).cast("long").alias("n_bytes"),
        "round_trip",
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(table(spark, sf_dir, "documents"))
