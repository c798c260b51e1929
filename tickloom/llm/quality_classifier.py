"""Quality classifier: regularised quadratic discriminant over statistics of documents."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm.common import Scratch, map_batches, map_rows, table
from tickloom.llm.language_id import remainder
from tickloom.llm.quality_rules import MARKS, SYMBOLS, UPPER, LETTERS, repeated_words, without

#: How much of a class's own covariance gives way to the common one, and that to its diagonal.
TO_COMMON, TO_DIAGONAL = 0.2, 0.05
THRESHOLD = 0.3
#: Common words of several languages; their share tells prose from lists. Fixed values.
STOP_WORDS = frozenset(
    b"the of and to in a is that it for on was with as by at be this or from "
    b"de la le et les des en un une du que est "
    b"der die und das ist nicht ein zu den von mit "
    b"el los las y por con una es se del".split()
)
FEATURES = [
    "words", "word_length", "length_spread", "repeated", "distinct", "top_word", "symbols", "upper", "marks", "bare",
    "digits", "stops", "line_words", "dup_lines", "ended",
]
DIGITS = b"0123456789"


def statistics(text: str | None) -> list[float]:
    """Statistics of one text, in the order of ``FEATURES``: logs of sizes, square roots of shares."""
    data = (text or "").encode()
    words = data.split()
    n = max(1, len(words))
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    letters = max(1, without(data, LETTERS))
    chars = max(1, int(lengths.sum()))
    lines = [x for x in data.split(b"\n") if x.strip()]
    often = np.bincount(ids) if words else np.ones(1)
    stops = sum(int(often[number[w]]) for w in STOP_WORDS.intersection(number))
    shares = {
        "repeated": repeated_words(ids) / n,
        "distinct": len(number) / n,
        "top_word": float(often.max()) / n,
        "symbols": without(data, SYMBOLS) / chars,
        "upper": without(data, UPPER) / letters,
        "marks": min(4.0, without(data, MARKS) / n),
        "bare": 1 - len(data.translate(None, SYMBOLS + MARKS).split()) / n,
        "digits": without(data, DIGITS) / chars,
        "stops": stops / n,
        "dup_lines": 1 - len(set(lines)) / max(1, len(lines)),
        "ended": sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines) / max(1, len(lines)),
    }
    logs = {
        "words": np.log1p(len(words)),
        "word_length": np.log1p(lengths.mean()),
        "length_spread": np.log1p(lengths.std()),
        "line_words": np.log1p(len(words) / max(1, len(lines))),
    }
    roots = {k: np.sqrt(max(0.0, v)) for k, v in shares.items()}
    return [float((logs | roots)[name]) for name in FEATURES]


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    return map_rows(docs, keep, ["text"], lambda texts: ((statistics(x),) for x in texts), "features array<double>")


class Discriminant(NamedTuple):
    """Of each class: mean, Cholesky factor of the covariance, log of its determinant and log prior."""

    mean: np.ndarray
    factor: np.ndarray
    log_det: np.ndarray
    log_prior: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row, from the difference of Mahalanobis log densities."""
        density = []
        for c in (0, 1):
            solved = np.linalg.solve(self.factor[c], (x - self.mean[c]).T)
            density.append(self.log_prior[c] - 0.5 * (solved * solved).sum(axis=0) - 0.5 * self.log_det[c])
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def moments(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each class: number of rows, sum and sum of products of ``features``, over all rows.

    Each task sums its rows, and the sums of the tasks are added by Spark.
    """
    d = len(FEATURES)

    def rows(batches):
        sums = np.zeros((2, 1 + d + d * d))
        for labels, lists in batches:
            x, y = np.array(lists, np.float64).reshape(-1, d), np.array(labels, np.int64)
            for c in (0, 1):
                own = x[y == c]
                sums[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        places = np.arange(sums.shape[1]).tolist()
        yield [[0] * len(places) + [1] * len(places), places * 2, sums.ravel().tolist()]

    parts = map_batches(labelled, ["quality", "features"], rows, "label int, place int, part double")
    found = parts.groupBy("label", "place").agg(F.sum("part").alias("total")).collect()
    total = np.zeros((2, 1 + d + d * d))
    for row in found:
        total[row["label"], row["place"]] = row["total"]
    return total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d)


def fit(n: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Discriminant:
    """Without rows of a class it has the mean and covariance of all; without any rows, zero and one."""
    d = sums.shape[1]
    whole = max(1.0, n.sum())
    mean = np.array([sums[c] / n[c] if n[c] else sums.sum(axis=0) / whole for c in (0, 1)])
    own = [products[c] / n[c] - np.outer(mean[c], mean[c]) if n[c] > 1 else np.zeros((d, d)) for c in (0, 1)]
    common = (n[0] * own[0] + n[1] * own[1]) / whole
    factor, log_det = [], []
    for c in (0, 1):
        weight = TO_COMMON if n[c] > d else 1.0
        mixed = (1 - weight) * own[c] + weight * common
        mixed = (1 - TO_DIAGONAL) * mixed + TO_DIAGONAL * np.diag(np.diag(mixed)) + 1e-4 * np.eye(d)
        factor.append(np.linalg.cholesky(mixed))
        log_det.append(2 * np.log(np.diag(factor[-1])).sum())
    return Discriminant(mean, np.array(factor), np.array(log_det), np.log((n + 1) / (n.sum() + 2)))


def learn(described: DataFrame, labels: DataFrame) -> Discriminant:
    """From the rows of ``features`` whose doc_id has a label 0 or 1.

    A doc_id with several labels counts as 1 if most of them are. Rows with the same doc_id all count.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.avg("quality").alias("share"))
    known = known.select("doc_id", (F.col("share") > 0.5).cast("int").alias("quality"))
    return fit(*moments(described.select("doc_id", "features").join(known, "doc_id")))


def classify(described: DataFrame, keep: list[str], model: Discriminant) -> DataFrame:
    """Columns ``keep`` and ``score`` (0 to 1) of each row of ``features``; an empty text has one too."""

    def rows(lists):
        x = np.array(list(lists), np.float64).reshape(-1, len(FEATURES))
        return ((s,) for s in model.score(x).tolist())

    return map_rows(described, keep, ["features"], rows, "score double")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a doc_id are not learned from and not held out."""
    docs = table(spark, sf_dir, "documents")
    described = Scratch(spark).store(features(docs, ["doc_id"]), "features")
    model = learn(described.filter(remainder(5) != 0), table(spark, sf_dir, "labels").filter(remainder(5) != 0))
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    scored = classify(described, ["doc_id"], model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
