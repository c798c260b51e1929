"""Weak supervision: rules vote or abstain, and expectation-maximisation weighs the rules."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.llm.common import Scratch, map_rows, table

WINDOW = 8
MIN_WORDS = 20
#: A row is kept from this posterior probability of quality on.
KEEP_FROM = 0.5
#: Least share of right votes among a rule's votes against quality.
LEAST_RIGHT = 0.9
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_upper long, n_letters long, n_distinct long, n_marks long, n_bare long"
)
SYMBOLS, MARKS = b"#*$%&|<>", b"!?"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
LETTERS = UPPER + UPPER.lower()


def ranks(*columns: np.ndarray) -> np.ndarray:
    """The same number for the same tuple."""
    width = int(columns[1].max()) + 1
    return np.unique(columns[0] * width + columns[1], return_inverse=True)[1].astype(np.int64)


def repeated_words(ids: np.ndarray) -> int:
    """Words that stand in a window of ``WINDOW`` words found twice or more.

    Windows are numbered exactly by doubling: equal pairs, then equal pairs of pairs.
    """
    if len(ids) <= WINDOW:
        return 0
    width = 1
    while width < WINDOW:
        ids = ranks(ids[:-width], ids[width:])
        if int(ids.max()) + 1 == len(ids):
            return 0
        width *= 2
    twice = np.bincount(ids)[ids] > 1
    edge = np.zeros(len(ids) + WINDOW, np.int64)
    edge[: len(ids)] += twice
    edge[WINDOW:] -= twice
    return int((np.cumsum(edge) > 0).sum())


def without(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def measure(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``; all 0 without words."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return (0,) * 10
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    chars = len(b"".join(words).decode())
    bare = len(words) - len(data.translate(None, SYMBOLS + MARKS).split())
    upper = without(data, UPPER)
    return (
        len(words), chars, without(data, SYMBOLS), len(lines) - len(set(lines)), repeated_words(ids),
        upper, without(data, LETTERS), len(number), without(data, MARKS), bare,
    )


def measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    return map_rows(docs, keep, ["text"], lambda texts: map(measure, texts), MEASURES)


def vote(share: Column, good_to: float, bad_from: float) -> Column:
    """1 for quality, -1 against it, 0 abstains."""
    return F.when(share >= bad_from, -1).when(share <= good_to, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules. Each looks at one share of the text and abstains in between its bounds."""
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    length = F.col("word_chars") / n
    return {
        "repeats": vote(F.col("n_repeat_words") / n, 0.05, 0.3),
        "symbols": vote(F.col("n_symbols") / chars, 0.005, 0.05),
        "clutter": vote(F.col("n_symbols") / n, 0.1, 0.8),
        "shouting": vote(F.col("n_upper") / F.greatest("n_letters", F.lit(1)), 0.15, 0.5),
        "marks": vote(F.col("n_marks") / n, 0.1, 0.5),
        "bare": vote(F.col("n_bare") / n, 0.05, 0.2),
        "variety": vote(1 - F.col("n_distinct") / n, 0.75, 0.9),
        "length": F.when((length < 2) | (length > 20), -1).when(length.between(3, 12), 1).otherwise(0),
        "size": F.when(F.col("n_words") < MIN_WORDS, -1).otherwise(0),
    }


@dataclass(frozen=True)
class Model:
    """Share of quality, and how often each rule's votes for and against it are right."""

    prior: float
    right: dict[str, dict[int, float]]

    def weight(self, rule: str, vote: int) -> float:
        """What a vote adds to the log odds of quality: its own odds over those without any vote."""
        share = self.right[rule][vote] if vote > 0 else 1 - self.right[rule][vote]
        return logit(share) - logit(self.prior)

    def posterior(self) -> Column:
        """Over columns named as the rules; an abstention adds nothing."""
        odds = F.lit(logit(self.prior))
        for rule in self.right:
            for vote in (1, -1):
                odds = odds + F.when(F.col(rule) == vote, self.weight(rule, vote)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def logit(share: float) -> float:
    return float(np.log(share / (1 - share)))


def fit(patterns: np.ndarray, counts: np.ndarray, rules: list[str], rounds: int = 100) -> Model:
    """Expectation-maximisation over vote patterns, each with its number of rows.

    It starts from the guess that a row has quality if no rule votes against it.
    A rule is taken to be right in at least ``LEAST_RIGHT`` of its votes
    against quality, and a vote for quality to be no worse than the prior;
    without this, junk of one sort, which meets one rule only, would be
    explained as quality on which that rule errs. Rules are independent given the class.
    """
    quality = 1.0 * ~(patterns < 0).any(axis=1)
    for _ in range(rounds):
        total = counts.sum() + 2
        prior = float(np.clip(((quality * counts).sum() + 1) / total, 0.01, 0.99))
        right: dict[str, dict[int, float]] = {}
        for i, rule in enumerate(rules):
            mass = {v: (counts * (patterns[:, i] == v), quality if v > 0 else 1 - quality) for v in (1, -1)}
            share = {v: float(((m * q).sum() + 1) / (m.sum() + 2)) for v, (m, q) in mass.items()}
            right[rule] = {1: float(np.clip(share[1], prior, 0.999)), -1: float(np.clip(share[-1], LEAST_RIGHT, 0.999))}
        model = Model(prior, right)
        gain = np.array([[model.weight(r, -1), 0.0, model.weight(r, 1)] for r in rules])
        odds = logit(prior) + gain[np.arange(len(rules)), patterns + 1].sum(axis=1)
        before, quality = quality, 1 / (1 + np.exp(-odds))
        if not len(quality) or np.abs(before - quality).max() < 1e-9:
            break
    return model


def learn(measured: DataFrame) -> Model:
    """The model of all rows of ``measures``.

    Only counts of vote patterns reach the driver: 3 to the power of the
    number of rules at most, whatever the number of rows.
    """
    rules = votes()
    seen = measured.select(*(c.alias(r) for r, c in rules.items())).groupBy(*rules).count().orderBy(*rules).collect()
    patterns = np.array([[row[r] for r in rules] for row in seen], np.int64).reshape(-1, len(rules))
    return fit(patterns, np.array([row["count"] for row in seen], np.float64), list(rules))


def judge(measured: DataFrame, keep: list[str], model: Model) -> DataFrame:
    """Measures, ``base_failed``, ``quality`` (posterior probability) and ``kept`` of each row."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    voted = measured.withColumns(votes())
    judged = voted.withColumns({"base_failed": failed, "quality": model.posterior()})
    verdict = F.when(F.col("base_failed"), False).otherwise(F.col("quality") >= KEEP_FROM)
    names = [x.split()[0] for x in MEASURES.split(", ")]
    return judged.select(*keep, *names, "base_failed", "quality", verdict.alias("kept"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null or empty text has no words, fails the base rules and is not kept. Each row counts by itself."""
    measured = Scratch(spark).store(measures(table(spark, sf_dir, "documents"), ["doc_id"]), "measures")
    return judge(measured, ["doc_id"], learn(measured))
