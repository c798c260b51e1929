"""Language identification: script ranges narrow the candidates, and Viterbi with a
switching penalty labels the spans of mixed text.

A word is a run of letters. Each of its letters, with both neighbours in the
word, is a trigram; a word's score for a language is the sum of the log
probabilities of its trigrams there.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.llm.common import Scratch, map_batches, map_rows, table

#: Trigrams are counted in so many hashed bins.
BINS = 1 << 16
#: Log probability that a change of language costs.
PENALTY = 12.0
#: A script is one of a language's if it has at least this share of the language's letters.
SCRIPT_SHARE = 0.01
#: More languages than this are an error: the model has ``BINS`` numbers for each.
MOST_LANGUAGES = 200
#: Characters of texts that are worked on together; the arrays hold some 40 bytes for each.
TOGETHER = 1_000_000
UNKNOWN = "und"

#: First code points of the ranges of scripts (fixed values of the Unicode blocks); 0 stands for all others.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Other"), (0x0750, "Arabic"), (0x0780, "Other"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Other"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Other"),
    (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x13A0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2C60, "Latin"),
    (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Other"), (0x3400, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"),
    (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Other"), (0xFB50, "Arabic"), (0xFE00, "Other"),
    (0xFF21, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Other"), (0x20000, "Han"),
]
NAMES = sorted({name for _, name in SCRIPTS})


class Letters:
    """What is known of each code point: whether it is a letter, its lower case and its script."""

    SIZE = 0x20000

    def __init__(self) -> None:
        chars = [chr(i) for i in range(self.SIZE)]
        self.is_letter = np.array([c.isalpha() for c in chars] + [True])
        lower = [c.lower() for c in chars]
        self.lower = np.array([ord(c) if len(c) == 1 else i for i, c in enumerate(lower)] + [self.SIZE], np.uint32)
        self.starts = np.array([start for start, _ in SCRIPTS])
        self.names = np.array([NAMES.index(name) for _, name in SCRIPTS])


class Words(NamedTuple):
    """Words of several texts: bins of all letters, and per word its first letter in them,
    its first code point in the whole, its script and its text."""

    bins: np.ndarray
    first: np.ndarray
    at: np.ndarray
    script: np.ndarray
    text: np.ndarray
    starts: np.ndarray


def words_of(texts: list[str], letters: Letters) -> Words:
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    known = np.minimum(codes, Letters.SIZE)
    is_letter = letters.is_letter[known]
    high = np.flatnonzero(known == Letters.SIZE)
    is_letter[high] = [chr(c).isalpha() for c in codes[high].tolist()]
    # One place more at both ends, so that every letter has neighbours. Each step works in place.
    low = np.zeros(len(codes) + 2, np.uint32)
    low[1:-1] = np.where(is_letter, letters.lower[known], 0)
    place = np.flatnonzero(is_letter)
    del known, is_letter
    before = low[place]
    mixed = before.astype(np.uint64)
    mixed *= np.uint64(0x9E3779B1)
    for neighbour, factor in ((low[1:], 0x85EBCA77C2B2AE63), (low[2:], 0x27D4EB2F165667C5)):
        part = neighbour[place].astype(np.uint64)
        part *= np.uint64(factor)
        mixed += part
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed >>= np.uint64(48)
    bins = mixed.view(np.int64)
    first = np.flatnonzero(before == 0)
    at = place[first]
    script = letters.names[np.searchsorted(letters.starts, codes[at], side="right") - 1]
    lengths = np.array([len(x) + 1 for x in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return Words(bins, first, at, script, np.searchsorted(starts, at, side="right") - 1, starts)


def together(texts: list[str], most: int = TOGETHER) -> Iterator[tuple[int, int]]:
    """Runs of texts with about ``most`` characters."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and size < most:
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


class Model(NamedTuple):
    languages: list[str]
    #: Log probability of each bin, one column per language.
    log: np.ndarray
    #: Whether a language is a candidate for words of a script.
    candidate: np.ndarray


def counts(docs: DataFrame) -> DataFrame:
    """(lang, kind, bin, n) over all rows of ``docs``: trigrams and letters of each script.

    Each task sums its rows first, so what it shuffles is bounded by languages and bins.
    """

    def rows(batches: Iterator[list[list]]) -> Iterator[list]:
        letters = Letters()
        sums: dict[str, np.ndarray] = {}
        for langs, texts in batches:
            of: dict[str, list[str]] = {}
            for lang, text in zip(langs, texts, strict=True):
                of.setdefault(lang, []).append(text)
            for lang, own in of.items():
                held = sums.setdefault(lang, np.zeros(BINS + len(NAMES), np.int64))
                for start, end in together(own):
                    words = words_of(own[start:end], letters)
                    held[:BINS] += np.bincount(words.bins, minlength=BINS)
                    sizes = np.diff(np.append(words.first, len(words.bins)))
                    held[BINS:] += np.bincount(words.script, sizes, len(NAMES)).astype(np.int64)
        for lang, held in sums.items():
            bins = np.flatnonzero(held)
            yield [[lang] * len(bins), bins.tolist(), held[bins].tolist()]

    found = map_batches(docs, ["lang", "text"], rows, "lang string, bin int, n long", "text")
    return found.groupBy("lang", "bin").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame) -> Model:
    """Model of the rows with ``text`` and ``lang``; others are not learned from."""
    found = counts(docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()))
    found = Scratch(docs.sparkSession).store(found, "counts")
    languages = [r["lang"] for r in found.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages.sort()
    seen = found.toPandas()
    sums = np.zeros((BINS + len(NAMES), len(languages)))
    sums[seen["bin"].to_numpy(np.int64), [languages.index(x) for x in seen["lang"]]] = seen["n"]
    grams, scripts = sums[:BINS] + 0.1, sums[BINS:]
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    candidate = share >= SCRIPT_SHARE
    candidate[~candidate.any(axis=1)] = True
    return Model(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32), candidate)


def best_path(scores: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """The language of each word, by the largest sum of scores less ``PENALTY`` per change.

    All texts take their steps together, the longest ones first in every array,
    so that a step is over the texts that still have words.
    """
    size = np.bincount(text, minlength=n_texts)
    order = np.argsort(-size, kind="stable")
    start = (np.cumsum(size) - size)[order]
    size = size[order]
    active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
    stay = np.ones(scores.shape, bool)
    origin = np.zeros(len(scores), np.int16)
    value = scores[start[: active[0]]].astype(np.float64) if len(active) else np.zeros((0, scores.shape[1]))
    final = np.zeros(len(size), np.int16)
    for step in range(1, len(active)):
        n = active[step]
        if n < len(value):
            final[n : len(value)] = value[n:].argmax(axis=1)
            value = value[:n]
        top = value.argmax(axis=1)
        changed = value[np.arange(n), top] - PENALTY
        row = start[:n] + step
        keep = value >= changed[:, None]
        stay[row], origin[row] = keep, top
        value = np.where(keep, value, changed[:, None]) + scores[row]
    final[: len(value)] = value.argmax(axis=1) if len(value) else 0
    path = np.zeros(len(scores), np.int16)
    now = final
    for step in range(len(active) - 1, -1, -1):
        n = active[step]
        row = start[:n] + step
        path[row] = now[:n]
        if step:
            now[:n] = np.where(stay[row, now[:n]], now[:n], origin[row])
    return path


def label(texts: list[str], model: Model, letters: Letters) -> Iterator[list[dict]]:
    """Spans of each text: language, first and last code point (end exclusive), letters."""
    words = words_of(texts, letters)
    if not len(words.first) or not model.languages:
        yield from ([] for _ in texts)
        return
    # Language by language, so that no array holds all letters times all languages.
    scores = np.empty((len(words.first), len(model.languages)), np.float32)
    for at, column in enumerate(model.log.T):
        scores[:, at] = np.add.reduceat(np.ascontiguousarray(column)[words.bins], words.first)
    scores[~model.candidate[words.script]] -= 1e4
    path = best_path(scores, words.text, len(texts))
    sizes = np.diff(np.append(words.first, len(words.bins)))
    opens = np.flatnonzero(np.append(True, (path[1:] != path[:-1]) | (words.text[1:] != words.text[:-1])))
    closes = np.append(opens[1:], len(path)) - 1
    n_letters = np.add.reduceat(sizes, opens)
    of = words.text[opens]
    begin = words.at[opens] - words.starts[of]
    # The last letter of the last word; letters of a word stand side by side.
    end = words.at[closes] + sizes[closes] - words.starts[of]
    spans = [
        {"lang": model.languages[lang], "start": s, "end": e, "n_letters": n}
        for lang, s, e, n in zip(path[opens].tolist(), begin.tolist(), end.tolist(), n_letters.tolist(), strict=True)
    ]
    edge = np.searchsorted(of, np.arange(len(texts) + 1))
    for low, high in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        yield spans[low:high]


SPANS = "spans array<struct<lang:string,start:long,end:long,n_letters:long>>"


def identify(docs: DataFrame, keep: list[str], model: Model) -> DataFrame:
    """Columns ``keep`` and the spans of each row's text; none for a null text or one without letters."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def rows(given):
        letters, known = Letters(), Model(*shared.value)
        texts = [text or "" for text in given]
        # The path holds a few bytes per word and language.
        most = TOGETHER * 16 // max(16, len(known.languages))
        for start, end in together(texts, most):
            for spans in label(texts[start:end], known, letters):
                yield (spans,)

    return map_rows(docs, keep, ["text"], rows, SPANS, "text")


def main_language(found: DataFrame, keep: list[str]) -> DataFrame:
    """``lang_pred``, the language of most letters (ties: first by name), and ``score``, its share of them."""

    def letters(spans: Column) -> Column:
        return F.aggregate(spans, F.lit(0).cast("long"), lambda n, span: n + span["n_letters"])

    def sums(spans: Column) -> Column:
        langs = F.array_distinct(F.transform(spans, lambda span: span["lang"]))
        return F.transform(langs, lambda x: F.struct((-letters(F.filter(spans, lambda s: s["lang"] == x))).alias("n"), x.alias("lang")))

    best = F.array_min(sums(F.col("spans")))
    told = found.select(*keep, best.alias("__best"), letters(F.col("spans")).alias("__all"))
    score = -F.col("__best.n") / F.col("__all")
    return told.select(
        *keep,
        F.coalesce("__best.lang", F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce(F.when(F.col("__all") > 0, score), F.lit(0.0)).alias("score"),
    )


def remainder(divisor: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a doc_id are not learned from and not held out."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.filter(remainder(3) != 1))
    found = main_language(identify(docs, ["doc_id"], model), ["doc_id"])
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
