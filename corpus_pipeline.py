"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept. All but the last return the columns of the documents, whatever they are.
Those that hand whole texts to Python workers run in small Arrow batches, so
they write their rows themselves: a frame that runs later would miss that limit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import jaccard_join, language_id, line_dedup, mixing, unigram
from tickloom.llm.common import Scratch, sifted, small_batches, table, with_row_key

#: A document needs at least this share of its letters in its main language.
LEAST_SHARE = 0.3


def restated(docs: DataFrame) -> DataFrame:
    """``docs`` with the length of its texts, where it states one."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def apart(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with its columns under names of no meaning, and doc_id and text besides; and these names.

    So a column of the documents may have the name of one that an operator adds.
    """
    names = [f"__column{i}" for i in range(len(docs.columns))]
    held = [F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)]
    return docs.select(*held, "doc_id", "text"), names


def named(rows: DataFrame, names: list[str], docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language. Those without letters or without a main language go.

    The languages are learned from the documents that state one. Where none does, no
    language can be told, and every document with a letter stays.
    """
    with small_batches(spark):
        model = language_id.learn(docs)
        if not model.languages:
            return docs.filter(F.col("text").rlike(r"\p{L}"))
        held, names = apart(docs)
        spans = language_id.identify(held, names, model)
        found = language_id.main_language(spans, names)
        known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SHARE)
        return Scratch(spark).store(named(found.filter(known), names, docs), "identified")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many hold, which stay in one document each."""
    held, names = apart(docs)
    kept = line_dedup.dedup_lines(held, line_dedup.LineIndex.create(docs), names)
    text = names[docs.columns.index("text")]
    return restated(named(kept.withColumn(text, F.col("kept_text")), names, docs))


def join_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: that of the least row key.

    So one without a doc_id comes first, then the least doc_id, then further texts of a
    doc_id. Rows that repeat doc_id and text are one document and stay or go together;
    of rows without a doc_id that repeat a text with words, one stays.
    """
    scratch = Scratch(spark)
    held, names = apart(docs)
    keyed = with_row_key(held, scratch)
    with small_batches(spark):
        found = scratch.store(jaccard_join.join(keyed.select(F.col("__row").alias("doc_id"), "text")), "components")
    copies = found.filter(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("__row")).distinct()
    copies = scratch.store(copies, "copies")
    marked = sifted(keyed, "__row", copies, copies.count())
    clear, doubtful = marked.filter(~F.col("__maybe")), marked.filter("__maybe")
    kept = clear.union(doubtful.join(copies, "__row", "left_anti").select(*clear.columns))
    unnamed = F.col("doc_id").isNull() & F.coalesce(F.col("text").rlike(mixing.WORD), F.lit(False))
    row = F.struct(*names)
    single = kept.filter(unnamed).groupBy("__row").agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    return named(kept.filter(~unnamed), names, docs).union(named(single, names, docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one taken in part holds its first words."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and token ids of each row, and whether they decode to its text."""
    with small_batches(spark):
        return Scratch(spark).store(unigram.encode_and_decode(docs), "encoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", join_near),
    ("mixing", mix_sources),
    ("sentencepiece", tokenize),
]

#: Language identification and the encoding have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``; what goes from stage to stage is written and read again."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
