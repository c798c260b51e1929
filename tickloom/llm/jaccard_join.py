"""N-gram Jaccard join by a token-group matrix.

A document is the set of hashes of its five-word shingles. Two documents link when
the sets share three quarters of their union. Result: the component of each
document, that is, all that links reach.

Equal sets are one set from the start, named by a 64-bit hash of it. Sets are
partitioned into groups of similar ones: each set is compared with the set it
seems to be most alike, and what links forms a family. A family is split into groups
of about ``GROUP_SIZE`` members, and a group's row of the matrix is the union of
its members' signatures. A signature is the first quarter of a set's hashes, and
one, in an order that all sets share: two sets that link must share one of these,
for if all of them were missing in the other set, too few hashes would be left.
Any order is right. The first one is by value, and sets that share nothing in it
are done with. Among the others, hashes that many sets hold come last, so that a
passage in very many documents brings none of them together. Hashes that the same
sets have in their signatures, as those of one passage, become one token of their number as weight. A query
set is counted against the groups of other families whose sizes fit, by the tokens that
leave room behind them, in the query and in a member, for all that the two must share if
they link. Only groups with such a token are opened, those of the largest weights first, and
their members compared with the query in full.

Members of one family are not compared with each other: they already have the
same component. So a group of copies, however large, costs no more than its size.
The comparisons come in waves, each against other sets, until one finds no link; hashes
that only one family has left are dropped after each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tickloom.llm.common import Scratch, long_lists, lower_words_of, sifted, slices_of, table

WORDS = 5
#: Documents link when ``PARTS * intersection >= NEAR * union``.
NEAR, PARTS = 75, 100
#: Members of one group, on average.
GROUP_SIZE = 8
#: Waves at most in which a set is compared with one other, the share of a wave's comparisons that must link for
#: another wave, and the least share of its hashes to compare that the other set has. They only decide how much is
#: left to the matrix, which compares all that may still link.
WAVES, WORTH, ALIKE = 10, 0.1, 0.4
#: A family opens its likeliest groups first: so many in the first round, and in each further one so many times more.
FIRST, MORE = 4, 8
#: So many doc_ids at most are broadcast; beyond, the join shuffles both sides.
BROADCAST_IDS = 100_000
#: Hashes that a task meets in so many documents of one slice, and all tasks in so many documents, come last; of more
#: than ``MOST_COMMON`` such hashes, those in twice as many documents, and so on. (They only order the others.)
SEEN_FROM, COMMON_FROM, MOST_COMMON = 2, 8, 250_000
#: Bytes of text whose hashes a task counts at once.
COUNTED_BYTES = 16_000_000


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


NONE = np.zeros(0, np.int64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; of all its words as one if they are too few."""
    words = lower_words_of(text)
    if not words:
        return NONE
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - WORDS + 1)
    mixed = np.full(n, min(len(words), WORDS), np.uint64)
    for place in range(min(len(words), WORDS)):
        mixed = (mixed ^ hashes[place : place + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return np.unique((mixed ^ (mixed >> np.uint64(29))).view(np.int64))


def name_of(hashes: np.ndarray) -> int:
    return signed(xxhash.xxh3_64_intdigest(hashes.tobytes()))


def signature_size(n: int) -> int:
    """So many of ``n`` hashes that a linked set must have one of them."""
    return n - (-(-NEAR * n // PARTS)) + 1 if n else 0


def common_hashes(docs: DataFrame, scratch: Scratch) -> np.ndarray:
    """Hashes that many documents hold, sorted. Each task counts those of its batches, over all rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_of(batch, "text", COUNTED_BYTES):
                found = [NONE, *map(shingles, part.column("text").to_pylist())]
                tokens, held = np.unique(np.concatenate(found), return_counts=True)
                often = held >= SEEN_FROM
                yield pa.RecordBatch.from_arrays([pa.array(tokens[often]), pa.array(held[often])], ["token", "held"])

    seen = docs.select("text").mapInArrow(rows, "token long, held long")
    totals = seen.groupBy("token").agg(F.sum("held").alias("held"))
    often = scratch.store(totals.filter(F.col("held") >= COMMON_FROM), "often")
    least = COMMON_FROM
    while often.filter(F.col("held") >= least).count() > MOST_COMMON:
        least *= 2
    return np.sort(often.filter(F.col("held") >= least).toPandas()["token"].to_numpy(np.int64))


def signature(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The first hashes of a sorted set, in the order that has those of ``last`` at the end."""
    place = np.minimum(np.searchsorted(last, hashes), max(0, len(last) - 1))
    common = last[place] == hashes if len(last) else np.zeros(len(hashes), bool)
    return np.concatenate([hashes[~common], hashes[common]])[: signature_size(len(hashes))]


def sketches(docs: DataFrame, last: np.ndarray) -> DataFrame:
    """Of each row: doc_id, n (size of its set), the set's name, and its signature.

    A task gives the signature of a set once, so that copies cost no more than a row each.
    A row without a doc_id gets none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(last)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            for part in slices_of(batch, "text"):
                ids, sizes, names, lists = part.column("doc_id"), [], [], []
                for text, known in zip(part.column("text").to_pylist(), ids.is_valid().to_pylist(), strict=True):
                    found = shingles(text)
                    name = name_of(found)
                    first = known and name not in given
                    if first:
                        given.add(name)
                    sizes.append(len(found))
                    names.append(name)
                    lists.append(signature(found, shared.value) if first else NONE)
                columns = [ids, pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), long_lists(lists)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "set_id", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, n long, set_id long, signature array<long>"
    return docs.select("doc_id", "text").mapInArrow(rows, ddl)


def contested(rows: DataFrame) -> DataFrame:
    """The rows (token, set_id, n, at, weight, family) of tokens that more than one family has, and ``cost``: how many
    sets have the token, by its weight; from one shuffle by token."""
    dealt = rows.repartition("token")
    cost = (F.count("*") / F.max("weight")).alias("cost")
    ends = dealt.groupBy("token").agg(F.min("family").alias("low"), F.max("family").alias("high"), cost)
    return dealt.join(ends.filter("low < high").select("token", "cost").hint("shuffle_hash"), "token")


def shared_hashes(sketched: DataFrame) -> DataFrame:
    """(token, set_id, places) of the signatures, without hashes that only one set has; ``places`` is n and the hash's place, packed.

    The greatest of the places is asked for so that both sides of the join need the same columns, and so read one shuffle.
    """
    tokens = sketched.select(F.posexplode("signature").alias("at", "token"), "set_id", "n")
    dealt = tokens.select("token", "set_id", (F.shiftleft("n", 32) + F.col("at")).alias("places")).repartition("token")
    ends = dealt.groupBy("token").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"), F.max("places").alias("last"))
    return dealt.join(ends.filter("low < high AND last >= 0").select("token").hint("shuffle_hash"), "token").distinct()


def postings(shared: DataFrame) -> DataFrame:
    """(token, set_id, n, at, weight, family): hashes that the same sets have as one token, with their number and first place.

    Each set is a family. Should two lists of sets have the same name, their hashes are one token
    too; that can only make sets look more alike.
    """
    dealt = shared.repartition("token")
    lists = dealt.groupBy("token").agg(
        F.count("*").alias("held"), F.bit_xor(F.xxhash64("set_id")).alias("sets"), F.max("places").alias("last")
    )
    named = lists.filter("last >= 0").select("token", F.xxhash64("held", "sets").alias("name"))
    met = dealt.join(named, "token").groupBy(F.col("name").alias("token"), "set_id")
    rows = met.agg(F.count("*").alias("weight"), F.min("places").alias("places"))
    n, at = F.shiftright("places", 32).alias("n"), F.col("places").bitwiseAND((1 << 32) - 1).alias("at")
    return rows.select("token", "set_id", n, at, "weight", F.col("set_id").alias("family"))


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """set_id and all hashes of the sets ``wanted`` (set_id, doc_id), from the text of one document each.

    Texts are sifted by doc_id where they are read and never shuffled; the hashes are, once, by set_id. A text that passes
    by chance may only give a wanted set the same hashes again.
    """
    chosen = sifted(docs.select("doc_id", "text"), "doc_id", wanted.select("doc_id"), wanted.count()).filter("__maybe")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_of(batch, "text"):
                found = [shingles(text) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(map(name_of, found), pa.int64()), long_lists(found)], ["set_id", "hashes"])

    made = chosen.select("text").mapInArrow(rows, "set_id long, hashes array<long>")
    return made.join(wanted.select("set_id"), "set_id", "left_semi").dropDuplicates(["set_id"])


class Verifier:
    """Tells which pairs of sets link. The hashes of a set are made from its text once, when a pair first names it."""

    def __init__(self, docs: DataFrame, names: DataFrame, scratch: Scratch):
        self.docs, self.names, self.scratch = docs, names, scratch
        self.made: list[DataFrame] = []
        self.tables: list[str] = []

    def _load(self, pairs: DataFrame, compared: int, name: str) -> DataFrame:
        """The sets of the pairs."""
        ids = missing = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
        for sets in self.made:
            missing = missing.join(sets.select("set_id"), "set_id", "left_anti")
        wanted = self.scratch.store(self.names.join(missing, "set_id"), f"{name}-wanted")
        self.made.append(self.scratch.store(full_sets(self.docs, wanted), f"{name}-sets"))
        self.tables.append(f"{name}-sets")
        self.scratch.drop(f"{name}-wanted")
        return union(self.made).join(F.broadcast(ids) if 2 * compared <= BROADCAST_IDS else ids, "set_id", "left_semi")

    def linked(self, pairs: DataFrame, name: str) -> tuple[DataFrame, int]:
        """The rows (a, b) of ``pairs`` whose sets link, stored; and the number of pairs."""
        pairs = self.scratch.store(pairs, f"{name}-pairs")
        compared = pairs.count()
        sets = self._load(pairs, compared, name)
        left = sets.select(F.col("set_id").alias("a"), F.col("hashes").alias("left"))
        right = sets.select(F.col("set_id").alias("b"), F.col("hashes").alias("right"))
        both = pairs.join(right, "b").join(left, "a")
        common = F.size(F.array_intersect("left", "right"))
        near = PARTS * common >= NEAR * (F.size("left") + F.size("right") - common)
        links = self.scratch.store(both.filter(near).select("a", "b"), name)
        self.scratch.drop(f"{name}-pairs")
        return links, compared


def sizes_fit(n_a: Column, n_b: Column) -> Column:
    return PARTS * F.least(n_a, n_b) >= NEAR * F.greatest(n_a, n_b)


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(set_id, family): the least id that edges (a, b) reach, for each id they name.

    Each round, every id takes the least label among its own and its
    neighbours', and then that of its label; labels only fall, and the rounds
    end when none does. Each round is a written table.
    """
    both = scratch.store(edges.union(edges.select("b", "a")).distinct(), f"{name}-edges")
    near = both.groupBy("a").agg(F.min("b").alias("near"))
    labels = scratch.store(near.select(F.col("a").alias("set_id"), F.least("a", "near").alias("family")), f"{name}-0")
    total, step = F.sum(F.col("family").cast("decimal(20,0)")), 0
    last = labels.agg(total).first()[0]
    while True:
        step += 1
        sent = both.join(labels, both["a"] == labels["set_id"]).groupBy("b").agg(F.min("family").alias("near"))
        fallen = labels.join(sent, labels["set_id"] == sent["b"]).select("set_id", F.least("family", "near").alias("family"))
        up = labels.select(F.col("set_id").alias("of"), F.col("family").alias("next"))
        jumped = fallen.join(up, F.col("family") == F.col("of"))
        labels = scratch.store(jumped.select("set_id", F.least("family", "next").alias("family")), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        before, last = last, labels.agg(total).first()[0]
        if before == last:
            scratch.drop(f"{name}-edges")
            return labels


def with_family(rows: DataFrame, families: DataFrame) -> DataFrame:
    return rows.join(families, "set_id", "left").withColumn("family", F.coalesce("family", "set_id"))


def star_pairs(posted: DataFrame, seed: int) -> DataFrame:
    """(a, b): a set, and the set with which it seems to have most in common.

    For each token, one set that has it is the one to compare the others with: that with the fewest
    hashes before it, so with the least of its own that the others lack. Later seeds shuffle this order more
    and more. This only finds families early; what it leaves out is left to ``open_groups``.
    """
    chance = F.pmod(F.xxhash64(F.lit(seed), "set_id"), F.lit(1000)) / 1000
    first = F.struct(((F.col("at") + 1) * (1 + seed * chance)).cast("float").alias("place"), "family", "set_id", F.col("n").cast("int").alias("n"))
    hubs = posted.groupBy("token").agg(F.min(first).alias("hub"))
    rows = posted.join(hubs, "token").filter("hub.family <> family").filter(sizes_fit(F.col("n"), F.col("hub.n")))
    hub = F.struct(F.col("hub.set_id").alias("set_id"), F.col("hub.n").alias("n"))
    met = rows.groupBy(F.col("set_id").alias("a"), "n", hub.alias("hub")).agg(F.sum("weight").alias("common"))
    best = met.groupBy("a", "n").agg(F.max(F.struct("common", "hub")).alias("best"), F.sum("common").alias("all"))
    alike = (F.col("best.common") >= ALIKE * F.col("all")) & (F.col("best.common") >= need(F.col("n"), F.col("best.hub.n")))
    return best.filter(alike).select("a", F.col("best.hub.set_id").alias("b"))


def unseen(n: Column) -> Column:
    """Hashes of a set of ``n`` that are not in its signature."""
    return F.ceil(NEAR * n / PARTS) - 1


def need(n: Column, m: Column) -> Column:
    """Hashes that the signatures of two sets must have in common if the sets link (less one, for rounding).

    Both signatures show all hashes up to the first of their ends. Of the set whose
    signature ends there the rest is not seen, so the overlap is at most the count of
    common hashes plus that rest. A link needs NEAR / (NEAR + PARTS) of n + m.
    """
    return F.ceil(NEAR * (n + m) / (NEAR + PARTS)) - F.greatest(unseen(n), unseen(m)) - 1


def grouped(posted: DataFrame) -> DataFrame:
    """set_id, n, family, its size, and group: the members of a family dealt to groups by hash."""
    members = posted.select("set_id", "family", "n").distinct()
    sized = members.groupBy("family").agg(F.count("*").alias("family_size"))
    number = F.pmod(F.xxhash64("set_id"), F.ceil(F.col("family_size") / GROUP_SIZE))
    return members.join(sized, "family").withColumn("group", F.xxhash64("family", number))


def spare(n: Column, m: Column) -> Column:
    """Hashes, besides one, that the signatures of two sets must have in common if the sets link."""
    return F.ceil(NEAR * (n + m) / (NEAR + PARTS)) - F.ceil(NEAR * F.greatest(n, m) / PARTS)


def early(at: Column, n: Column, m: Column) -> Column:
    """Whether, of a set of ``n``, the hash at this place may be one of the first ``1 + spare`` that it shares with a linked set of ``m``."""
    return at <= n - F.ceil(NEAR * F.greatest(n, m) / PARTS) + 1


def matched(posted: DataFrame, members: DataFrame) -> DataFrame:
    """(token, set_id, n, of, other, weight): the tokens by which the matrix cannot rule out that a set and a group link.

    The tokens have one order, those that few sets hold for their weight first. ``rest`` is the weight of a token and all behind it
    in a set. Linked sets share ``1 + spare`` hashes at least that are ``early`` in both, and the first of their tokens
    has all of these from it on; so it has such a rest in both, and others need not be joined. A group has the largest
    rest and the first place of its members. Of the sizes in a group those that fit the query's count; ``spare`` first grows and
    then falls with the size, so an end of them has the least of it, less one for rounding.
    """
    order = Window.partitionBy("set_id").orderBy(F.desc("cost"), "token").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bounds = members.groupBy("group").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    rest = F.sum("weight").over(order).alias("rest")
    rows = posted.select("token", "set_id", "weight", "at", rest).join(members.join(bounds, "group"), "set_id")
    group = ["token", F.col("group").alias("of"), F.col("family").alias("other"), F.col("family_size").alias("other_size"), "low", "high"]
    matrix = rows.select(*group, "rest", "at").repartition("token")
    matrix = matrix.groupBy("token", "of", "other", "other_size", "low", "high").agg(
        F.max("rest").alias("most"), F.min("at").alias("first")
    )
    smaller = (F.col("family_size") < F.col("other_size")) | (
        (F.col("family_size") == F.col("other_size")) & (F.col("family") < F.col("other"))
    )
    low = F.greatest(F.col("low"), F.ceil(NEAR * F.col("n") / PARTS))
    high = F.least(F.col("high"), F.floor(PARTS * F.col("n") / NEAR))
    least = F.least(spare(F.col("n"), low), spare(F.col("n"), high)) - (low < high).cast("int")
    fits = (low <= high) & (F.col("rest") > least) & (F.col("most") > least)
    fits = fits & early(F.col("at") + 1, F.col("n"), low) & early(F.col("first") + 1, high, F.col("n"))
    queries = rows.select("token", "set_id", "n", "family", "family_size", "weight", "rest", "at")
    return queries.join(matrix, "token").filter(smaller & fits).select("token", "set_id", "n", "of", "other", "weight")


def open_groups(posted: DataFrame, members: DataFrame) -> DataFrame:
    """(set_id, n, of, other, common): sets and groups of two families that the matrix cannot rule out, and the weight
    by which it cannot. Groups keep their members while families merge."""
    return matched(posted, members).groupBy("set_id", "n", "of", "other").agg(F.sum("weight").alias("common"))


def pairs_of(opened: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b): the sets, each with the members of its groups whose sizes fit."""
    inside = members.select(F.col("group").alias("of"), F.col("set_id").alias("b"), F.col("n").alias("m"))
    return opened.join(inside, "of").filter(sizes_fit(F.col("n"), F.col("m"))).select(F.col("set_id").alias("a"), "b")


def apart(opened: DataFrame, families: DataFrame) -> DataFrame:
    """The rows of ``opened`` whose set and group are of two families by now, with these as ``family`` and ``into``."""
    here = with_family(opened.drop("family", "into"), families)
    there = families.select(F.col("set_id").alias("other"), F.col("family").alias("into"))
    there = here.join(there, "other", "left").withColumn("into", F.coalesce("into", "other"))
    return there.filter("family <> into")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each row.

    Each row is a document. A null text, or one without words, has an empty set and
    links with nothing; so does a row without a doc_id, whose component is null.
    """
    scratch = Scratch(docs.sparkSession)
    sketched = scratch.store(sketches(docs, common_hashes(docs, scratch)), "sketches")
    rows = scratch.store(sketched.select("doc_id", "n", "set_id"), "rows")
    filled = rows.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    names = scratch.store(filled.groupBy("set_id").agg(F.min("doc_id").alias("doc_id")), "names")
    posted = scratch.store(postings(scratch.store(shared_hashes(sketched), "shared")), "posted")
    scratch.drop("sketches", "often", "shared")

    verifier = Verifier(docs, names, scratch)
    edges, last = [], "posted"
    for wave in range(WAVES):
        links, compared = verifier.linked(star_pairs(posted, wave), f"links{wave}")
        edges.append(links)
        families = components(union(edges), scratch, f"families{wave}")
        left = with_family(posted.drop("family"), families).select("token", "set_id", "n", "at", "weight", "family")
        posted = scratch.store(contested(left), f"posted{wave}")
        scratch.drop(last)
        last = f"posted{wave}"
        if links.count() <= WORTH * compared:
            break
    members = scratch.store(grouped(posted), "members")
    opened = scratch.store(open_groups(posted, members), "opened")
    scratch.drop(last)

    # One link merges two families, and what is between them need not be opened any more. A family's rank
    # limit is applied before the shuffle, so that no task gets all rows of one. The rounds end with the last row.
    most, step = FIRST, 0
    between = Window.partitionBy("family").orderBy(F.desc("common"), "set_id", "of")
    while not (opened := scratch.store(apart(opened, families), f"opened{step}")).isEmpty():
        ranked = opened.withColumn("place", F.row_number().over(between)).filter(F.col("place") <= most)
        chosen = scratch.store(ranked.drop("place"), f"chosen{step}")
        links, _ = verifier.linked(pairs_of(chosen, members), f"links-{step}-opened")
        edges.append(links)
        families = components(union(edges), scratch, f"joined{step}")
        opened = opened.join(chosen.select("set_id", "of"), ["set_id", "of"], "left_anti")
        most, step = most * MORE, step + 1
    scratch.drop("members", "opened", "names", *verifier.tables)

    named = with_family(rows, families)
    least = named.filter("n > 0").groupBy("family").agg(F.min("doc_id").alias("least"))
    found = named.join(least, "family", "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("least")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
places AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS place FROM split WHERE len(words) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[place:place + 4], ' ') AS shingle FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other)
SELECT r.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""
