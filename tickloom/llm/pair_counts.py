"""Alignment of two tokenizers, and in how many documents each pair of their ids is linked.

Tokenizer A merges bytes, tokenizer B pieces; each splits a space and the text into tokens
with byte ranges. Where tokens of both end, a group ends; all A and B tokens of a group are linked.

Every document is aligned once. Its numbers, and the pairs of each slice of documents by shard, are stored;
so are, task by task, the sums of how many documents hold each pair. Pairs are dealt into shards by their A id. Over the distinct pairs of a shard a minimal perfect
hash is built: a pair's number lies between 0 and the number of pairs, and the pair itself is
kept at that place, so that a strange pair is told. The tasks' sums become dense count vectors
over these numbers, which are added up in a tree. The stored pairs of each slice are then sent
to their shards, which look their counts up and sum them by document.

What is broadcast is the two vocabularies. A shard holds pairs of the vocabularies alone, however many
the documents; the slices of documents that ask a shard are dealt over many tasks.

A document whose text is null, empty, or not given back exactly by both tokenizers has no tokens:
its numbers are zero and its digest is empty. Rows that repeat a doc_id, or have none, are documents of their own.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain, pairwise
from operator import attrgetter
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm.common import Remembered, Scratch, slices_of, table
from tickloom.llm.token_orc import LETTERS

MODEL_A, MODEL_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
#: What stands before an id in the text of the groups: between ids of a side, before the B side, before a group, and before a word's first.
MARKS = (",", "|", ";", "")
#: Shards of pairs, by A id.
SHARDS = 32
#: Bits of a level of a perfect hash for each key.
BITS = 2
#: Count vectors that are added up by one task, and slices of documents that ask a shard in one task.
FAN, TOGETHER = 16, 1024
#: Distinct pairs of slices that a task holds before it sums them, and twice as many as it keeps of the summed ones.
HELD = 1_000_000
#: Bytes of words and their alignments that a worker remembers, those of one beside its arrays, and the longest word that it does.
REMEMBERED, OVERHEAD, LONGEST = 128 << 20, 600, 256

#: White space in any sense of the word, but for the plain space.
_BLANKS = r"\x09-\x0d\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The place between a visible character and a space. No token of either tokenizer goes across it, and none depends on what lies beyond.
SPLIT = re.compile(rf"(?<=[^ {_BLANKS}])(?= )")
#: The characters before which a space does not split.
BLANKS = frozenset(re.findall(rf"[ {_BLANKS}]", "".join(map(chr, range(0x3001)))))
#: Words that A encodes as one text.
SIDE_BY_SIDE = 256
#: The same place for Arrow, which knows no look-behind.
BEFORE_SPACE = "([^ " + re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", _BLANKS).replace(r"\x85", r"\x{85}").replace(r"\xa0", r"\x{a0}") + "]) "


class Word(NamedTuple):
    """A word's alignment: whether both tokenizers give it back, numbers of A tokens, B tokens, groups and links,
    the groups as text, and its distinct pairs with their numbers of links, as bytes of 64-bit integers."""

    whole: bool
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: bytes
    pairs: bytes
    links: bytes


GROUPS, PAIRS = attrgetter("groups"), attrgetter("pairs")


class Aligned(NamedTuple):
    """Alignments of a slice of documents: numbers of each, digests, and (document, pair, links) of its distinct pairs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digest: list[str]
    doc: np.ndarray
    pair: np.ndarray
    links: np.ndarray


class Aligner:
    """Aligns texts word by word, remembering the words."""

    def __init__(self, vocabulary: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(vocabulary)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        byte = {letter: b for b, letter in LETTERS.items()}
        self.bytes_a = {i: bytes(byte.get(c, 0x3F) for c in entry) for entry, i in self.a.get_vocab().items()}
        self.bytes_b = [self._bytes_b(i) for i in range(self.b.vocab_size())]
        self.size_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        self.size_a[list(self.bytes_a)] = list(map(len, self.bytes_a.values()))
        self.size_b = np.array(list(map(len, self.bytes_b)), np.int64)
        self.space = self.b.piece_to_id(MARKER)
        # Each id as text behind each of the marks that may stand before it.
        self.marked = pa.array([m + str(i) for m in MARKS for i in range(max(len(self.size_a), len(self.size_b)))])
        self.words = Remembered(REMEMBERED, OVERHEAD)

    def _bytes_b(self, piece: int) -> bytes:
        text = self.b.id_to_piece(piece)
        if self.b.is_byte(piece):
            return bytes([int(text[3:5], 16)])
        return text.replace(MARKER, " ").encode()

    def _encoded(self, words: list[bytes], texts: list[str]) -> list[list[int]]:
        """A's ids of each word. Words that ``SPLIT`` would part again are encoded as one text, and its ids told apart by their bytes."""
        out: list[list[int]] = [[]] * len(words)
        fit = [t[:1] == " " and t[-1] not in BLANKS for t in texts]
        alone, joined = [i for i, f in enumerate(fit) if not f], [i for i, f in enumerate(fit) if f]
        parts = [joined[i : i + SIDE_BY_SIDE] for i in range(0, len(joined), SIDE_BY_SIDE)]
        found = self.a.encode_batch_fast(["".join([texts[i] for i in part]) for part in parts], add_special_tokens=False)
        for part, x in zip(parts, found, strict=True):
            ids, size = x.ids, np.cumsum([len(words[i]) for i in part])
            ends = np.cumsum(self.size_a[ids])
            last = np.searchsorted(ends, size)
            if not len(ids) or ends[-1] != size[-1] or (ends[last] != size).any():
                alone += part
                continue
            edges = [0, *(last + 1).tolist()]
            for i, start, end in zip(part, edges, edges[1:], strict=False):
                out[i] = ids[start:end]
        for i, x in zip(alone, self.a.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False), strict=True):
            out[i] = x.ids
        return out

    def _learn(self, words: list[bytes]) -> list[Word]:
        texts = [w.decode() for w in words]
        a = self._encoded(words, texts)
        # B sets a space before each text itself, but for an empty one.
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        b = [x if t != " " else [self.space] for t, x in zip(texts, b, strict=True)]
        return self._aligned(words, a, b) if words else []

    def _whole(self, words: list[bytes], a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Whether the tokens of both sides, ``flattened``, give each word back."""
        fit = np.ones(len(words), bool)
        size, joined = np.array(list(map(len, words)), np.int64), b"".join(words)
        for (flat, word), data, sizes in ((a, self.bytes_a, self.size_a), (b, self.bytes_b, self.size_b)):
            tokens = list(map(data.__getitem__, flat.tolist()))
            if (np.bincount(word, sizes[flat], len(words)) == size).all() and b"".join(tokens) == joined:
                continue
            edges = np.searchsorted(word, np.arange(len(words) + 1)).tolist()
            fit &= [b"".join(tokens[i:j]) == w for (i, j), w in zip(pairwise(edges), words, strict=True)]
        return fit

    def _aligned(self, words: list[bytes], a: list[list[int]], b: list[list[int]]) -> list[Word]:
        """The alignments of many words at once: their bytes stand one after the other, and so do their tokens."""
        (ids_a, word_a), (ids_b, word_b), n = flattened(a), flattened(b), len(words)
        whole = self._whole(words, (ids_a, word_a), (ids_b, word_b))
        if not whole.all():
            ids_a, word_a, ids_b, word_b = ids_a[whole[word_a]], word_a[whole[word_a]], ids_b[whole[word_b]], word_b[whole[word_b]]
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        # A mark at each byte where a token ends; where those of both do, a group ends.
        size = int(ends_a[-1]) + 1 if len(ends_a) else 1
        both, of_b = np.zeros((2, size), bool)
        both[ends_a] = of_b[ends_b] = True
        both &= of_b
        ends, before = np.flatnonzero(both), np.cumsum(both) - both
        group_a, group_b = before[ends_a], before[ends_b]
        word = word_a[both[ends_a]]

        # The text of the groups: each id behind the mark that stands before it.
        in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        at_a = np.arange(len(ids_a)) + (np.cumsum(in_b) - in_b)[group_a]
        at_b = np.arange(len(ids_b)) + np.cumsum(in_a)[group_b]
        opens = np.where(np.diff(word, prepend=-1) != 0, 3, 2)
        entry = np.empty(len(ids_a) + len(ids_b), np.int64)
        entries = len(self.marked) // len(MARKS)
        entry[at_a] = ids_a + entries * np.where(np.diff(group_a, prepend=-1) != 0, opens[group_a], 0)
        entry[at_b] = ids_b + entries * (np.diff(group_b, prepend=-1) != 0)
        text = self.marked.take(pa.array(entry))
        offsets = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1) if len(text) else np.zeros(1, np.int32)
        data = text.buffers()[2].to_pybytes() if len(text) else b""
        tokens_a, tokens_b = np.bincount(word_a, minlength=n), np.bincount(word_b, minlength=n)
        at = offsets[np.concatenate([[0], np.cumsum(tokens_a + tokens_b)])].tolist()

        # Ids that repeat in a group are counted first, so a long group makes no list of all its links.
        low = (1 << 32) - 1
        of_a, times_a = np.unique(group_a << 32 | ids_a, return_counts=True)
        of_b, times_b = np.unique(group_b << 32 | ids_b, return_counts=True)
        own = of_a >> 32
        partners = np.bincount(of_b >> 32, minlength=len(ends))
        start = (np.cumsum(partners) - partners)[own]
        each = partners[own]
        left = np.repeat(np.arange(len(of_a)), each)
        right = np.arange(len(left)) + np.repeat(start - np.cumsum(each) + each, each)
        pair, links, owner = (of_a[left] & low) << 32 | of_b[right] & low, times_a[left] * times_b[right], word[own[left]]
        # Ids are below 2^20 or so, so an owner and a pair are one integer; equal ones are summed, whatever their order.
        order = np.argsort((owner * len(self.size_a) + (pair >> 32)) * len(self.size_b) + (pair & low))
        pair, links, owner = pair[order], links[order], owner[order]
        new = np.flatnonzero((np.diff(pair, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
        links = np.add.reduceat(links, new) if len(new) else links
        pair, owner = pair[new], owner[new]
        n_links = np.bincount(owner, links, n).astype(np.int64).tolist()
        n_groups = np.bincount(word, minlength=n).tolist()
        edge = (8 * np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])).tolist()
        pairs, numbers = pair.tobytes(), links.astype(np.int64).tobytes()
        groups, edges = [data[i:j] for i, j in pairwise(at)], [slice(i, j) for i, j in pairwise(edge)]
        kept = groups, [pairs[e] for e in edges], [numbers[e] for e in edges]
        return list(map(Word, whole.tolist(), tokens_a.tolist(), tokens_b.tolist(), n_groups, n_links, *kept))

    def align(self, texts: pa.StringArray) -> Aligned:
        """The alignments of all texts. A null or empty one is a single space, of no tokens."""
        # Words and their alignments form no cycles; to look for some among so many objects takes a quarter of the time.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._align(texts)
        finally:
            if collecting:
                gc.enable()

    def _align(self, texts: pa.StringArray) -> Aligned:
        self.words.make_room()
        empty = pc.fill_null(pc.equal(pc.binary_length(texts), 0), True).to_numpy(zero_copy_only=False)
        spaced = pc.binary_join_element_wise(pa.scalar(" "), pc.fill_null(texts, ""), "")
        if pc.any(pc.match_substring(spaced, "\0")).as_py():
            split = pa.array([SPLIT.split(t) for t in spaced.to_pylist()], pa.list_(pa.string()))
        else:
            split = pc.split_pattern(pc.replace_substring_regex(spaced, BEFORE_SPACE, "\\1\0 "), "\0")
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        words = list(map(self.words.get, distinct))
        new = [w for w, x in zip(distinct, words, strict=True) if x is None]
        made = dict(zip(new, self._learn(new), strict=True))
        short = [w for w in new if len(w) <= LONGEST]
        held = [made[w] for w in short]
        sizes = sum(map(len, short)) + sum(map(len, map(GROUPS, held))) + 2 * sum(map(len, map(PAIRS, held)))
        self.words.learn(short, held, sizes)
        words = [made[w] if x is None else x for w, x in zip(distinct, words, strict=True)]
        return self._documents(words, coded.indices.to_numpy(), np.diff(split.offsets.to_numpy()), empty)

    def _documents(self, words: list[Word], place: np.ndarray, size: np.ndarray, empty: np.ndarray) -> Aligned:
        n, doc = len(size), np.repeat(np.arange(len(size)), size)
        whole = ~empty
        given, n_a, n_b, n_groups, n_links, groups, pairs, links = zip(*words, strict=True) if words else [()] * len(Word._fields)
        whole[doc[~np.array(given, bool)[place]]] = False

        def total(values: tuple[int, ...]) -> np.ndarray:
            # Sums of integers below 2^53 are exact as doubles.
            sums = np.bincount(doc, np.array(values, np.int64)[place], n).astype(np.int64)
            return np.where(whole, sums, 0)

        ends = np.cumsum(size)
        digest = [
            hashlib.sha256(b";".join([groups[i] for i in place[end - k : end].tolist()])).hexdigest() if w else ""
            for end, k, w in zip(ends.tolist(), size.tolist(), whole.tolist(), strict=True)
        ]
        # Pairs get numbers within the slice, so that a document and a pair are one integer.
        counts = np.array(list(map(len, pairs)), np.int64) // 8
        known, number = np.unique(np.frombuffer(b"".join(pairs), np.int64), return_inverse=True)
        edges = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int64())
        used = whole[doc]
        taken = pa.array(place[used])
        numbers = pa.LargeListArray.from_arrays(edges, pa.array(number.astype(np.int64))).take(taken).flatten().to_numpy()
        links = pa.array(np.frombuffer(b"".join(links), np.int64))
        links = pa.LargeListArray.from_arrays(edges, links).take(taken).flatten().to_numpy()
        key = np.repeat(doc[used], counts[place[used]]) * max(1, len(known)) + numbers
        order = np.argsort(key)
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        own = key[order][first]
        return Aligned(
            total(n_a),
            total(n_b),
            total(n_groups),
            total(n_links),
            digest,
            own // max(1, len(known)),
            known[own % max(1, len(known))],
            np.add.reduceat(links[order], first) if len(first) else links,
        )


def flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The values one after the other, and the list that each comes from."""
    size = np.array(list(map(len, lists)), np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, size.sum()), np.repeat(np.arange(len(lists)), size)


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """64-bit hashes of the keys, others for each level (the finaliser of splitmix64)."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shard_of(pairs: np.ndarray) -> np.ndarray:
    return (mixed(pairs >> 32, 63) % np.uint64(SHARDS)).astype(np.int32)


class PerfectHash:
    """A minimal perfect hash: each of n keys has its own number below n.

    On each level a key sets the bit that its hash names, unless another key names it too; such keys go on
    to the next level, where all hash anew. A key's number is that of the bits set before its own.
    """

    def __init__(self, levels: list[bytes]):
        self.levels, before = [], 0
        for data in levels:
            bits = np.unpackbits(np.frombuffer(data, np.uint8)).astype(bool)
            rank = np.cumsum(bits) - 1 + before
            before += int(bits.sum())
            self.levels.append((bits, rank))

    @staticmethod
    def build(keys: np.ndarray) -> list[bytes]:
        """The bits of each level for distinct ``keys``."""
        levels: list[bytes] = []
        while len(keys):
            size = max(64, -(-BITS * len(keys) // 8) * 8)
            place = (mixed(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone).tobytes())
            keys = keys[~alone[place]]
        return levels

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key. One that the hash was not built of gets any number, or -1."""
        out, rest = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, rank) in enumerate(self.levels):
            place = (mixed(keys[rest], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[place]
            out[rest[hit]] = rank[place[hit]]
            rest = rest[~hit]
        return out


class PairTable:
    """Values by pair: the hash of a shard's pairs and the pairs in the order of their numbers."""

    def __init__(self, levels: list[bytes], keys: bytes):
        self.hash, self.keys = PerfectHash(levels), np.frombuffer(keys, np.int64)

    def numbers(self, pairs: np.ndarray) -> np.ndarray:
        """The number of each pair; a pair that is not in the table raises."""
        found = self.hash.numbers(pairs)
        if len(pairs) and ((found < 0) | (self.keys[found] != pairs)).any():
            raise ValueError("a pair of ids is not in the table: a task's sums miss it")
        return found


def broadcast_models(spark: SparkSession, model_a: str, model_b: str):
    with open(model_a, encoding="utf-8") as a, open(model_b, "rb") as b:
        return spark.sparkContext.broadcast({"a": a.read(), "b": b.read()})


def aligner(held: dict) -> Aligner:
    """A worker keeps the value of a broadcast from task to task, and the aligner with it."""
    if "aligner" not in held:
        held["aligner"] = Aligner(held["a"], held["b"])
    return held["aligner"]


def by_shard(pairs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that holds some of the pairs, with their places in ascending order."""
    shard = shard_of(pairs)
    order = np.argsort(shard, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
        if len(part):
            yield int(shard[part[0]]), part


class Sums:
    """Distinct pairs of a task's documents and how many of these hold each, summed now and then."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, pairs: np.ndarray) -> None:
        """``pairs`` are the distinct ones of each document."""
        self.held.append(np.unique(pairs, return_counts=True))
        self.size += len(self.held[-1][0])
        if self.size > HELD:
            self.held = [self._summed()]
            self.size = len(self.held[0][0])

    def _summed(self) -> tuple[np.ndarray, np.ndarray]:
        pairs, place = np.unique(np.concatenate([h[0] for h in self.held]), return_inverse=True)
        return pairs, np.bincount(place, np.concatenate([h[1] for h in self.held])).astype(np.int64)

    def full(self) -> bool:
        return self.size > HELD // 2 and len(self.held) == 1

    def taken(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Shards, their pairs and counts; what was held goes."""
        if self.held:
            pairs, counts = self._summed()
            self.held, self.size = [], 0
            for shard, part in by_shard(pairs):
                yield shard, pairs[part], counts[part]


def hashed_shards(sums: DataFrame) -> DataFrame:
    """shard, levels and keys: the perfect hash of each shard's distinct pairs, and the pairs in its order."""

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        pairs = frame["pair"].to_numpy()
        levels = PerfectHash.build(pairs)
        keys = np.empty(len(pairs), np.int64)
        keys[PerfectHash(levels).numbers(pairs)] = pairs
        return pd.DataFrame({"shard": [key[0]], "levels": [levels], "keys": [keys.tobytes()]})

    distinct = sums.select("shard", F.explode("pairs").alias("pair")).distinct()
    return distinct.groupBy("shard").applyInPandas(build, "shard int, levels array<binary>, keys binary")


def count_vectors(sums: DataFrame, hashes: DataFrame, scratch: Scratch) -> DataFrame:
    """shard and vector: for each number of the shard's hash the documents that hold its pair, as 64-bit integers."""
    last = sums.agg(F.max("task")).first()[0] or 0
    tasks, width = sums.withColumn("branch", F.floor(F.col("task") / FAN).cast("int")), last // FAN

    def dense(key: tuple, rows: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"shard": [], "branch": [], "vector": []}).astype({"shard": "int32", "branch": "int32"})
        pairs = PairTable(table["levels"][0], table["keys"][0])
        vector = np.zeros(len(pairs.keys), np.int64)
        for own, counts in zip(rows["pairs"], rows["counts"], strict=True):
            vector[pairs.numbers(np.asarray(own, np.int64))] += counts
        return pd.DataFrame({"shard": [key[0]], "branch": [key[1]], "vector": [vector.tobytes()]})

    def added(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        vector = sum(np.frombuffer(v, np.int64) for v in rows["vector"])
        return pd.DataFrame({"shard": [key[0]], "branch": [key[1]], "vector": [vector.tobytes()]})

    kinds = "shard int, branch int, vector binary"
    everywhere = hashes.select("*", F.explode(F.sequence(F.lit(0), F.lit(width))).alias("branch"))
    keys = ["shard", "branch"]
    vectors = tasks.groupBy(*keys).cogroup(everywhere.groupBy(*keys)).applyInPandas(dense, kinds)
    step = 0
    while width > 0:
        step, width = step + 1, width // FAN
        vectors = scratch.store(vectors, f"vectors_{step}")
        vectors = vectors.withColumn("branch", F.floor(F.col("branch") / FAN).cast("int")).groupBy(*keys).applyInPandas(added, kinds)
    return vectors.select("shard", "vector")


ASKED = "task int, slice long, at int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, shard int, docs array<int>, pairs array<long>, links array<long>"
DOCUMENT = ["slice", "at", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def aligned_slices(docs: DataFrame, models) -> DataFrame:
    """A row per document; a row per slice and shard with the slice's pairs of that shard; and, with ``task``, a few rows
    per task and shard with the task's distinct pairs and, as ``links``, in how many of its documents each is linked."""
    kinds = [(f.split()[0], f.split()[1]) for f in ASKED.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}

    def filled(n: int, **columns: object) -> pa.RecordBatch:
        arrays = [columns[name] if name in columns else pa.nulls(n, types[kind]) for name, kind in kinds]
        arrays = [a if isinstance(a, pa.Array) else pa.array(a, types[kind]) for a, (_, kind) in zip(arrays, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, [name for name, _ in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number, sums = task << 32, Sums()

        def summed() -> Iterator[pa.RecordBatch]:
            for shard, pairs, counts in sums.taken():
                yield filled(1, task=[task], shard=[shard], pairs=[pairs], links=[counts])

        for batch in batches:
            for piece in slices_of(batch, "text"):
                found, n = aligner(models.value).align(piece.column("text")), piece.num_rows
                yield filled(
                    n, slice=np.full(n, number), at=np.arange(n, dtype=np.int32), doc_id=piece.column("doc_id"), n_a=found.n_a, n_b=found.n_b,
                    n_groups=found.n_groups, n_links=found.n_links, groups_sha256=found.digest,
                )
                parts = list(by_shard(found.pair))
                if parts:
                    yield filled(
                        len(parts), slice=np.full(len(parts), number), shard=[s for s, _ in parts], docs=[found.doc[p] for _, p in parts],
                        pairs=[found.pair[p] for _, p in parts], links=[found.links[p] for _, p in parts],
                    )
                    sums.add(found.pair)
                    if sums.full():
                        yield from summed()
                number += 1
        yield from summed()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ASKED)


def look_up(asked: DataFrame, tables: DataFrame) -> DataFrame:
    """slice, docs, n_best and count_sum: the sums of one shard for the documents of a slice.

    A task gets the table of a shard first, and then the slices that ask it, one by one.
    """
    slices = asked.agg(F.count_distinct("slice")).first()[0]
    salts = max(1, -(-slices // TOGETHER))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("levels", "array<binary>"), ("keys", "binary"), ("vector", "binary"))]
    first = tables.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), "levels", "keys", "vector",
        F.lit(None).cast("long").alias("slice"), F.lit(None).cast("array<int>").alias("docs"),
        F.lit(None).cast("array<long>").alias("pairs"), F.lit(None).cast("array<long>").alias("links"),
    )
    salt = F.pmod(F.xxhash64("slice"), F.lit(salts)).cast("int").alias("salt")
    rows = first.unionByName(asked.select("shard", salt, F.lit(1).alias("kind"), *nothing, "slice", "docs", "pairs", "links"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counts = best = None
        for batch in batches:
            kinds = batch.column("kind").to_pylist()
            out: list[list] = [[], [], [], []]
            for i, kind in enumerate(kinds):
                if kind == 0:
                    known = PairTable(batch.column("levels")[i].as_py(), batch.column("keys")[i].as_py())
                    counts = np.frombuffer(batch.column("vector")[i].as_py(), np.int64)
                    # All pairs of an A id are in this shard, so the highest of them is here.
                    _, own = np.unique(known.keys >> 32, return_inverse=True)
                    most = np.zeros(own.max(initial=0) + 1, np.int64)
                    np.maximum.at(most, own, counts)
                    best = counts == most[own]
                    continue
                docs, pairs, links = (batch.column(c)[i].values.to_numpy() for c in ("docs", "pairs", "links"))
                number = known.numbers(pairs)
                # Documents ascend, so those of a slice are runs.
                start = np.flatnonzero(np.diff(docs, prepend=-1))
                sums = np.add.reduceat(np.stack([links * best[number], links * counts[number]]), start, axis=1)
                for column, value in zip(out, (batch.column("slice")[i].as_py(), docs[start], sums[0], sums[1]), strict=True):
                    column.append(value)
            types = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["slice", "docs", "n_best", "count_sum"])

    dealt = rows.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    return dealt.mapInArrow(run, "slice long, docs array<int>, n_best array<long>, count_sum array<long>")


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _with_sums(docs: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
    best, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    docs = docs.sort_values("at", kind="stable")
    for at, b, t in zip(sums["docs"], sums["n_best"], sums["count_sum"], strict=True):
        best[at] += b
        total[at] += t
    return docs.assign(n_best=best, count_sum=total)[[f.split()[0] for f in RESULT.split(", ")]]


def pair_counts(sums: DataFrame, scratch: Scratch) -> DataFrame:
    """shard, levels, keys and vector: every pair that is linked anywhere, and in how many documents."""
    hashes = scratch.store(hashed_shards(sums), "hashes")
    return hashes.join(count_vectors(sums, hashes, scratch), "shard")


def align(docs: DataFrame, model_a: str = MODEL_A, model_b: str = MODEL_B) -> DataFrame:
    """The columns of ``RESULT`` for each document; see the module."""
    scratch = Scratch(docs.sparkSession)
    models = broadcast_models(docs.sparkSession, model_a, model_b)
    slices = scratch.store(aligned_slices(docs, models), "slices")
    sums = slices.filter("task IS NOT NULL").select("task", "shard", "pairs", F.col("links").alias("counts"))
    tables = scratch.store(pair_counts(scratch.store(sums, "task_sums"), scratch), "tables")
    found = look_up(slices.filter("shard IS NOT NULL AND task IS NULL"), tables)
    documents = slices.filter("shard IS NULL").select(*DOCUMENT)
    return documents.groupBy("slice").cogroup(found.groupBy("slice")).applyInPandas(_with_sums, RESULT)


def op13_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
