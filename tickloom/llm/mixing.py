"""Mixing sources to target weights: Sainte-Laguë quotas of equal blocks, all in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tickloom.llm.common import Scratch, table, with_row_key

WORD = r"[^\x20\x09-\x0D]+"
#: A word with the white space before it.
SPACED_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"

#: Words the mix takes per word there is, and the most it takes of one document.
SHARE, MOST = 1.5, 2
#: Weights of the sources in order, again and again.
WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 32
#: A shard has about so many words, and not many more rows.
SHARD_WORDS, SHARD_ROWS = 4_000_000, 50_000
SEED = "mix"


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and ``size`` (words of the text, 0 for null) of each row."""
    words = F.coalesce(F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))), F.lit(0))
    return docs.select("doc_id", "source", F.when(F.col("text").isNull(), 0).otherwise(words).cast("long").alias("size"))


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: place, source, source_size, target, and its number of shards.

    Targets are in proportion to the weights, up to twice the source's size. Sorted
    by the level at which each is full, the first source that is not full at the
    level of those left sets the level of all.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    found = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
        .withColumn("place", F.row_number().over(order) - 1)
        .withColumn("weight", weight)
        .withColumn("most", MOST * F.col("source_size"))
    )
    filling = W.orderBy(F.col("most") / F.col("weight"), "place")
    before = F.coalesce(F.sum("most").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing))
    whole = F.sum("source_size").over(W.partitionBy())
    levelled = found.withColumn("level", (whole * F.lit(SHARE) - before) / left)
    open_ = F.when(F.col("most") > F.col("level") * F.col("weight"), F.col("level"))
    level = F.min_by(open_, F.when(open_.isNotNull(), F.col("most") / F.col("weight"))).over(W.partitionBy())
    share = F.least(F.coalesce(level, F.lit(0.0)) * F.col("weight"), F.col("most").cast("double"))
    shards = F.ceil(F.greatest(F.col("source_size") / SHARD_WORDS, F.col("n_rows") / SHARD_ROWS))
    return levelled.select("place", "source", "source_size", share.alias("target"), shards.alias("n_shards"))


def quotas(claims: DataFrame, group: list[str], key: str, votes: Column, seats: Column) -> DataFrame:
    """``quota`` of each row: ``seats`` of its group dealt by the highest quotients votes / (2 k + 1).

    A divisor that gives about the right sum fixes all seats but a few per row.
    Rounding is off by half a seat per row at most, which bounds how far the
    right divisor is away; only the quotients within that are ranked.
    """
    whole = W.partitionBy(*group)
    about = F.floor(F.col("votes") * F.col("seats") / F.col("all_votes") + 0.5)
    reach = F.ceil(F.col("votes") * F.col("rivals") / (2 * F.col("all_votes"))) + 1
    rows = (
        claims.withColumns({"votes": votes.cast("double"), "seats": seats.cast("long")})
        .filter((F.col("votes") > 0) & (F.col("seats") > 0))
        .withColumns({"all_votes": F.sum("votes").over(whole), "rivals": F.count("*").over(whole)})
        .withColumns({"least": F.greatest(about - reach, F.lit(0)), "reach_to": about + reach - 1})
        .withColumn("open", F.col("seats") - F.sum("least").over(whole))
    )
    ranked = W.partitionBy(*group).orderBy(F.col("quotient").desc(), key, "k")
    won = (
        rows.select(*group, key, "votes", "open", F.explode(F.sequence("least", "reach_to")).alias("k"))
        .withColumn("quotient", F.col("votes") / (2 * F.col("k") + 1))
        .withColumn("won", F.row_number().over(ranked) <= F.col("open"))
        .groupBy(*group, key)
        .agg(F.min("k").alias("fixed"), F.count(F.when(F.col("won"), 1)).alias("more"))
    )
    return won.select(*group, key, (F.col("fixed") + F.col("more")).alias("quota"))


def mix(sized: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and ``taken`` of each row of ``sizes``."""
    return dealt(sized).select("doc_id", "size", "source_size", "target", "taken")


def dealt(sized: DataFrame) -> DataFrame:
    """The rows of ``sized``, which may have more columns than ``sizes``, with source_size, target and ``taken``.

    Blocks go to sources by quota, and a source's blocks to its shards by quota.
    A shard is its documents in seeded order, one after the other, cut into
    blocks; the first blocks are taken, and again from the start beyond the
    last. So each document is taken as often as any other of its shard, or once
    more, and the one at the end in part. Null sources are one source. Rows without
    words take no part; repeated rows count each by itself.
    """
    targets = source_targets(sized)
    blocks = F.ceil(F.sum("target").over(W.partitionBy()) / BLOCK_WORDS)
    by_source = quotas(targets.withColumn("all", F.lit(0)), ["all"], "place", F.col("target"), blocks)
    planned = targets.join(by_source.select("place", F.col("quota").alias("blocks")), "place", "left")
    seeded = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    number = F.conv(F.substring("seeded", 1, 8), 16, 10).cast("long")
    planned = planned.withColumnRenamed("source", "of")
    seated = (
        sized.join(planned, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("seeded", seeded)
        .withColumn("shard", number % F.greatest(F.col("n_shards"), F.lit(1)))
    )
    shards = seated.groupBy("place", "shard").agg(F.sum("size").alias("shard_size"), F.max("blocks").alias("blocks"))
    by_shard = quotas(shards, ["place"], "shard", F.col("shard_size"), F.coalesce("blocks", F.lit(0)))
    in_order = W.partitionBy("place", "shard").orderBy("seeded", "doc_id", "size")
    placed = seated.join(by_shard, ["place", "shard"], "left").withColumns(
        {
            "end": F.sum("size").over(in_order.rowsBetween(W.unboundedPreceding, 0)),
            "shard_size": F.sum("size").over(W.partitionBy("place", "shard")),
        }
    )
    words = F.least(F.coalesce("quota", F.lit(0)) * BLOCK_WORDS, MOST * F.col("shard_size"))
    rest = F.col("words") - F.col("times") * F.col("shard_size")
    part = F.greatest(F.least(rest - (F.col("end") - F.col("size")), F.col("size")), F.lit(0))
    taken = (
        placed.withColumn("words", words)
        .withColumn("times", F.when(F.col("shard_size") > 0, F.expr("words div shard_size")).otherwise(0))
        .withColumn("taken", (F.col("times") * F.col("size") + part).cast("long"))
    )
    return taken.select(*sized.columns, "source_size", "target", "taken")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(Scratch(spark).store(sizes(table(spark, sf_dir, "documents")), "sizes"))


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0
         ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size
  FROM documents),
found AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][place % 3 + 1] AS weight, 2 * source_size AS most FROM found),
levelled AS (
  SELECT *, most / weight AS full_at,
         ((sum(source_size) OVER ())::DOUBLE * 1.5
          - coalesce(sum(most) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed WINDOW f AS (ORDER BY most / weight, place)),
targets AS (
  SELECT place, source, source_size,
         greatest(ceil(greatest(source_size / 4000000, n_rows / 50000)), 1)::BIGINT AS n_shards,
         least(coalesce((SELECT arg_min(level, full_at) FROM levelled WHERE most > level * weight), 0) * weight,
               most::DOUBLE) AS target
  FROM levelled),
seats AS (SELECT ceil(sum(target) / 32)::BIGINT AS seats FROM targets),
quotients AS (
  SELECT place, unnest(range(0, 2 + (target / 32 * 1.1 + 8)::BIGINT)) AS k, target FROM targets WHERE target > 0),
by_source AS (
  SELECT place, count(*) AS blocks FROM (
    SELECT place FROM quotients ORDER BY target / (2 * k + 1) DESC, place, k LIMIT (SELECT seats FROM seats))
  GROUP BY place),
dealt AS (
  SELECT d.doc_id, d.size, t.*, b.blocks, md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null')) AS seeded
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN by_source b ON b.place = t.place),
sharded AS (
  SELECT *, ('0x' || seeded[1:8])::BIGINT % n_shards AS shard FROM dealt),
shards AS (
  SELECT place, shard, sum(size) AS shard_size, max(blocks) AS blocks FROM sharded GROUP BY place, shard),
shard_quotients AS (
  SELECT place, shard, blocks, shard_size,
         unnest(range(0, 8 + (blocks * shard_size * 1.1 / sum(shard_size) OVER (PARTITION BY place))::BIGINT)) AS k
  FROM shards WHERE shard_size > 0 AND blocks > 0),
by_shard AS (
  SELECT place, shard, count(*) FILTER (won) AS quota FROM (
    SELECT *, row_number() OVER (PARTITION BY place ORDER BY shard_size / (2 * k + 1) DESC, shard, k) <= blocks AS won
    FROM shard_quotients) GROUP BY place, shard),
placed AS (
  SELECT s.*, sum(s.size) OVER (PARTITION BY s.place, s.shard ORDER BY s.seeded, s.doc_id, s.size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS start,
         h.shard_size, least(coalesce(q.quota, 0) * 32, 2 * h.shard_size) AS words
  FROM sharded s JOIN shards h ON h.place = s.place AND h.shard = s.shard
       LEFT JOIN by_shard q ON q.place = s.place AND q.shard = s.shard)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (CASE WHEN shard_size > 0 THEN words // shard_size * size
        + greatest(least(words % shard_size - start, size), 0) ELSE 0 END)::BIGINT AS taken
FROM placed
"""


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each row as often as it is taken.

    A row taken in part holds its first words. Rows that the mix does not take, and
    rows without words, are left out. Each row is dealt by itself, under its row key; rows
    of one key are numbered over all sources, and those behind the first have a hash of key
    and number instead.
    """
    scratch = Scratch(docs.sparkSession)
    keyed = with_row_key(docs, scratch)
    counted = sizes(keyed.withColumn("doc_id", F.col("__row"))).groupBy("doc_id", "source", "size").count()
    before = W.partitionBy("doc_id").orderBy("source").rowsBetween(W.unboundedPreceding, -1)
    counted = counted.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    number = F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("number")
    each = counted.select(F.col("doc_id").alias("row"), "source", "size", "before", number)
    place = F.col("before") + F.col("number")
    each = each.withColumn("doc_id", F.when(place == 1, F.col("row")).otherwise(F.xxhash64("row", place)))
    each = scratch.store(each.drop("before"), "sizes")
    found = dealt(each)
    plan = scratch.store(
        found.filter("taken > 0").select(
            F.col("row").alias("__id"),
            F.col("source").alias("__source"),
            F.col("size").alias("__words"),
            F.col("number").alias("__number"),
            F.col("taken").alias("__taken"),
        ),
        "plan",
    )
    # Rows are numbered only where a key and source have several; the others join as they are.
    again = each.filter("number > 1").select(F.col("row").alias("__id"), F.col("source").alias("__source"))
    again = scratch.store(again.distinct(), "again")
    own = (F.col("__row") == F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
    row = F.to_json(F.struct(*[F.col(c) for c in docs.columns if c != "text"]))
    repeated = keyed.join(again, own, "left_semi")
    repeated = repeated.withColumn("__at", F.row_number().over(W.partitionBy("__row", "source").orderBy(row)))
    once = keyed.join(again, own, "left_anti").join(plan, own)
    joined = once.unionByName(repeated.join(plan, own & (F.col("__at") == F.col("__number"))).drop("__at"))
    times = F.ceil(F.col("__taken") / F.col("__words")).cast("int")
    rows = joined.filter("__taken > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), times)))
    left = F.col("__taken") - (F.col("__copy") - 1) * F.col("__words")
    spaced = F.slice(F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0)), F.lit(1), left.cast("int"))
    text = F.when(left < F.col("__words"), F.array_join(spaced, "")).otherwise(F.col("text"))
    out = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)
