"""N-gram Jaccard join by grouped prefixes, exact, and its components.

Shingles have one order: the more documents share one, the later it comes; equals
go by hash. Two sets whose similarity reaches t share a shingle among the first
size - ceil(t * size) + 1 of each. Documents with one set are collapsed first, then
sets of one size and prefix into a group. Groups are paired by shared prefix
shingles, filtered by size and by how many they share, and the sets of the pairs
that remain are compared in full.

A group of m near copies would make m * m pairs. So the first round compares the
sets of each shingle with its smallest group only; those found linked form a
component. The second round pairs only sets that share a prefix shingle and are in
different components yet, and where that shingle stands early enough in both. It
passes over no similar pair but those already connected, so the components are those
of all links.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.llm.components import components
from adstream.llm.tables import discard, membership, passes, pieces, set_apart, split_join, stored, unused
from adstream.llm.words import ascii_fold, mixed, sets

LOCAL_REPEATS = 3
SLOTS = 1 << 22
BATCH_ROWS = 1000
COUNTED_AT_ONCE = 1 << 22
ARROW_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@dataclass(frozen=True)
class Similarity:
    """At least ``percent`` in a hundred of the union of two shingle sets."""

    width: int = 5
    percent: int = 80

    def least(self, size):
        """The fewest shingles that a set of this size can share with a similar one."""
        return -(-self.percent * size // 100)

    def linked(self, shared, one, other):
        return 100 * shared >= self.percent * (one + other - shared)


def _long(column: str) -> Column:
    return F.col(column).cast("bigint")


def common_levels(docs: DataFrame, width: int) -> np.ndarray:
    """How common a shingle is, by the low bits of its hash: a table of SLOTS bytes.

    Batches of all documents are counted, and what is repeated within one of them is
    added up. A slot has the binary logarithm of its most frequent shingle's count. The
    least frequent are left out where more than a quarter of the slots would be taken,
    so the table tells the most frequent ones apart at any number of documents. It
    decides the order of shingles only: a wrong level costs time and loses nothing.
    """

    def tallied(made):
        value, times = np.unique(np.concatenate(made or [np.empty(0, np.uint64)]), return_counts=True)
        keep = times >= LOCAL_REPEATS
        return pa.RecordBatch.from_arrays(
            [pa.array(value[keep].view(np.int64)), pa.array(times[keep])],
            ["shingle", "times"],
        )

    def counted(batches):
        # Repeats are counted within about COUNTED_AT_ONCE shingles: a batch of long
        # texts is counted in parts, so that a task holds no more than that.
        for batch in batches:
            made, held = [], 0
            for piece in pieces([batch]):
                for _, s in sets(piece.column(0), width, ascii_fold()):
                    made.append(s)
                    held += len(s)
                    if held >= COUNTED_AT_ONCE:
                        yield tallied(made)
                        made, held = [], 0
            yield tallied(made)

    made = docs.select("text").mapInArrow(counted, "shingle bigint, times bigint")
    total = made.groupBy("shingle").agg(F.sum("times").alias("times"))
    slot = F.col("shingle").bitwiseAND(F.lit(SLOTS - 1)).cast("int")
    level = F.floor(F.log2("times")).cast("int")
    taken = total.groupBy(slot.alias("slot")).agg(F.max(level).alias("level"))
    taken = stored(taken, "common_levels")
    sizes = taken.groupBy("level").count().orderBy(F.desc("level")).collect()
    least, room = 1, SLOTS // 4
    for row in sizes:
        room -= row["count"]
        if room < 0:
            least = row["level"] + 1
            break
    rows = taken.where(F.col("level") >= least).toPandas()
    discard(taken)
    levels = np.zeros(SLOTS, np.uint8)
    levels[rows["slot"].to_numpy(np.int64)] = rows["level"].to_numpy(np.int64)
    return levels


def profiles(docs: DataFrame, like: Similarity, levels: np.ndarray) -> DataFrame:
    """Size, digests of the set and of its prefix, and the prefix, of each document."""

    def profiled(batches):
        for batch in pieces(batches):
            rows = [[] for _ in range(6)]
            for _, s in sets(batch.column(1), like.width, ascii_fold()):
                size = len(s)
                head = s[:0]
                if size:
                    level = levels[s & np.uint64(SLOTS - 1)]
                    head = s[level.argsort(kind="stable")[: size - like.least(size) + 1]]
                sums = [np.add.reduce(mixed(x + np.uint64(k)), dtype=np.uint64) for x in (s, head) for k in (1, 2)]
                for column, x in zip(rows, [size, *np.array(sums, np.uint64).view(np.int64), head.view(np.int64)], strict=True):
                    column.append(x)
            heads = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum([len(x) for x in rows[5]])]).astype(np.int32),
                pa.array(np.concatenate([*rows[5], np.empty(0, np.int64)])),
            )
            made = [batch.column(0), *[pa.array(x, pa.int64()) for x in rows[:5]], heads]
            yield pa.RecordBatch.from_arrays(made, ["doc_id", "size", "s1", "s2", "p1", "p2", "prefix"])

    schema = "doc_id bigint, size bigint, s1 bigint, s2 bigint, p1 bigint, p2 bigint, prefix array<bigint>"
    return docs.select(_long("doc_id").alias("doc_id"), "text").mapInArrow(profiled, schema)


def _sets_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(doc_id, set) of the documents that are in ``ids``, and of some more."""
    wanted = membership(ids.select(F.xxhash64("id").alias("key")), "key")

    def picked(batches):
        for batch in pieces(batches):
            ids, texts = batch.column(0), batch.column(1)
            keep = passes(wanted, batch.column(2).to_numpy())
            rows = np.flatnonzero(keep)
            made = [s.tobytes() for _, s in sets(texts.take(pa.array(rows)), width, ascii_fold())]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows)), pa.array(made, pa.binary())], ["doc_id", "set"]
            )

    known = docs.select(_long("doc_id").alias("doc_id"), "text").where("doc_id is not null")
    known = known.withColumn("key", F.xxhash64("doc_id"))
    return known.mapInArrow(picked, "doc_id bigint, set binary")


def verified(docs: DataFrame, pairs: DataFrame, like: Similarity) -> DataFrame:
    """The pairs (a, b) of documents whose whole sets are similar, stored."""
    pairs = stored(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    found = stored(_sets_of(docs, ids, like.width), "sets")
    one = found.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a"))
    other = found.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b"))

    def compared(batches):
        for batch in pieces(batches):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(bool(len(x) and len(y) and like.linked(shared, len(x), len(y))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], ["a", "b"]
            ).filter(pa.array(keep, pa.bool_()))

    joined = split_join(split_join(pairs, one, ["a"]), other, ["b"])
    made = joined.select("a", "b", "set_a", "set_b").mapInArrow(compared, "a bigint, b bigint")
    made = stored(made, "links_found")
    discard(pairs, found)
    return made


def _tokens(heads: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """(group_id, size, place, shingle) of each prefix, those that ``only`` lets through."""

    def exploded(batches):
        for batch in pieces(batches):
            prefix = batch.column(2)
            shingle = prefix.flatten()
            row = pc.list_parent_indices(prefix)
            count = pc.list_value_length(prefix).to_numpy(zero_copy_only=False)
            place = np.arange(len(shingle)) - np.repeat(np.cumsum(count) - count, count)
            made = [batch.column(k).take(row) for k in (0, 1)]
            rows = pa.RecordBatch.from_arrays(
                [*made, pa.array(place.astype(np.int32)), shingle], ["group_id", "size", "place", "shingle"]
            )
            yield rows if only is None else rows.filter(pa.array(passes(only, shingle.to_numpy())))

    made = heads.select("group_id", "size", "prefix")
    return made.mapInArrow(exploded, "group_id bigint, size bigint, place int, shingle bigint")


def _alike(one: str, other: str, percent: int) -> Column:
    """Whether two sizes leave room for the similarity."""
    small, large = F.least(one, other), F.greatest(one, other)
    return small * 100 >= large * percent


def _enough(one: str, other: str, shared: str, percent: int) -> Column:
    """Whether two prefixes share enough for their sets to be similar.

    What is not in both prefixes is in the rest of that set whose prefix ends first.
    """
    def rest(size):
        return F.ceil(F.col(size) * percent / 100) - 1

    needed = F.ceil((F.col(one) + F.col(other)) * percent / (100 + percent))
    return F.col(shared) + F.greatest(rest(one), rest(other)) >= needed


@contextmanager
def _small_batches(spark):
    """Arrow batches of at most BATCH_ROWS rows while the steps run.

    Rows carry whole texts and shingle sets; batches of the usual ten thousand of
    them, held by the JVM and the Python worker at once, fill an executor.
    """
    before = spark.conf.get(ARROW_BATCH)
    spark.conf.set(ARROW_BATCH, str(min(BATCH_ROWS, int(before))))
    try:
        yield
    finally:
        spark.conf.set(ARROW_BATCH, before)


def jaccard_components(docs: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document.

    Every step after the levels is stored as it goes, in small Arrow batches; the
    levels count repeats within the usual batches.
    """
    levels = common_levels(docs, like.width)
    with _small_batches(docs.sparkSession):
        return _jaccard_components(docs, like, levels)


def _jaccard_components(docs: DataFrame, like: Similarity, levels: np.ndarray) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document.

    Documents link when their shingle sets are similar; a component is the smallest
    doc_id that links reach. An empty or null text has no shingles and no links. A
    null doc_id has no component and links with nothing. Rows of one doc_id are one
    document with several texts: it links where any of them does. Repeated rows
    and further columns change nothing. No rows give no rows.
    """
    percent = like.percent
    seen = stored(profiles(docs, like, levels), "profiles")
    known = seen.where("size > 0 and doc_id is not null")
    whole = known.groupBy("size", "s1", "s2").agg(
        F.min("doc_id").alias("set_id"),
        F.first("p1").alias("p1"),
        F.first("p2").alias("p2"),
        F.count("*").alias("rows"),
    )
    whole = stored(whole, "distinct_sets")
    groups = whole.groupBy("size", "p1", "p2").agg(
        F.min("set_id").alias("group_id"), F.count("*").alias("sets"), F.sum("rows").alias("rows")
    )
    groups = stored(groups, "groups")
    copies = split_join(known, whole.drop("p1", "p2", "rows"), ["size", "s1", "s2"])
    copies = copies.select(F.col("doc_id").alias("a"), F.col("set_id").alias("b"))

    # A document that is alone in its group is its head; others are moved to find theirs.
    crowded = groups.where("rows > 1").withColumn("key", F.xxhash64("size", "p1", "p2"))
    alone, rest = set_apart(known, F.xxhash64("size", "p1", "p2"), crowded, "key")
    firsts = groups.select("group_id", "size", "p1", "p2")
    same = ["group_id", "size", "p1", "p2"]
    rest = split_join(rest.withColumn("group_id", F.col("doc_id")), firsts, same).dropDuplicates(same)
    heads = alone.withColumn("group_id", F.col("doc_id")).unionByName(rest.select(*alone.columns, "group_id"))
    often = _tokens(heads).groupBy("shingle").agg(F.count("*").alias("groups"), F.min("group_id").alias("leader"))
    often = stored(often.where("groups > 1").drop("groups"), "shared_shingles")
    shared = split_join(_tokens(heads, membership(often, "shingle", 4)), often, ["shingle"])
    shared = stored(shared, "shared")
    discard(often)

    members = split_join(
        whole.drop("s1", "s2", "rows"), groups.where("sets > 1").drop("sets", "rows"), ["size", "p1", "p2"]
    ).select("group_id", "set_id", "size")
    members = stored(members, "members")

    stars = (
        shared.where("group_id <> leader")
        .groupBy(F.col("leader").alias("ga"), F.col("group_id").alias("gb"))
        .agg(F.count("*").alias("both"), F.first("size").alias("size"))
    )
    sizes = groups.select(F.col("group_id").alias("ga"), F.col("size").alias("size_a"))
    stars = split_join(stars, sizes, ["ga"])
    stars = stars.where(_alike("size_a", "size", percent) & _enough("size_a", "size", "both", percent))
    own = members.where("set_id <> group_id").select(
        F.col("group_id").alias("a"), F.col("set_id").alias("b")
    )
    leaders = members.select(F.col("group_id").alias("gb"), F.col("set_id").alias("b"))
    outer = split_join(stars.select("ga", "gb"), leaders, ["gb"], "left")
    outer = outer.select(F.col("ga").alias("a"), F.coalesce("b", "gb").alias("b"))
    first = verified(docs, outer.unionByName(own), like)

    parts = stored(components(first), "first_components")
    sets_now = members.select("group_id", "set_id").unionByName(
        shared.select("group_id", F.col("group_id").alias("set_id")).distinct()
    ).distinct()
    sets_now = split_join(
        sets_now, parts.select(F.col("node").alias("set_id"), "component"), ["set_id"], "left"
    ).withColumn("component", F.coalesce("component", "set_id"))
    sets_now = stored(sets_now, "set_components")

    placed = split_join(
        shared.drop("leader"), sets_now.select("group_id", "component").distinct(), ["group_id"]
    )
    mixed_tokens = (
        placed.groupBy("shingle")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("shingle")
    )
    placed = stored(split_join(placed, mixed_tokens, ["shingle"]), "placed")
    # Of a similar pair, the first shingle that both have stands early in both: before
    # it, each set can spare only what the overlap leaves over.
    needed = F.ceil((F.col("size_a") + F.col("size_b")) * percent / (100 + percent))
    own_needed = F.ceil(F.col("size") * 2 * percent / (100 + percent))
    larger = placed.select(
        "shingle", F.col("component").alias("ca"), F.col("group_id").alias("ga"),
        F.col("size").alias("size_a"), F.col("place").alias("place_a"),
    )
    smaller = placed.where(F.col("place") <= F.col("size") - own_needed).select(
        "shingle", F.col("component").alias("cb"), F.col("group_id").alias("gb"),
        F.col("size").alias("size_b"), F.col("place").alias("place_b"),
    )
    first_of_two = (F.col("size_b") < F.col("size_a")) | (
        (F.col("size_b") == F.col("size_a")) & (F.col("gb") < F.col("ga"))
    )
    crossed = (
        split_join(larger, smaller, ["shingle"])
        .where(
            first_of_two
            & (F.col("ca") != F.col("cb"))
            & (F.col("size_b") * 100 >= F.col("size_a") * percent)
            & (F.col("place_a") <= F.col("size_a") - needed)
            & (F.col("place_b") <= F.col("size_b") - needed)
        )
        .select("ga", "gb", "ca", "cb")
        .distinct()
    )
    torn = (
        sets_now.groupBy("group_id")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("group_id")
    )
    torn = split_join(sets_now, torn, ["group_id"])
    of_a = [F.col("group_id").alias("ga"), F.col("component").alias("ca"), F.col("set_id").alias("a")]
    of_b = [F.col("group_id").alias("gb"), F.col("component").alias("cb"), F.col("set_id").alias("b")]
    within = split_join(
        torn.select(*of_a).withColumnRenamed("ga", "gb"), torn.select(*of_b), ["gb"]
    ).where("ca < cb")
    second = split_join(crossed, sets_now.select(*of_a), ["ga", "ca"])
    second = split_join(second, sets_now.select(*of_b), ["gb", "cb"])
    second = second.select("a", "b").unionByName(within.select("a", "b"))
    second = second.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = first.unionByName(verified(docs, second, like)).unionByName(copies)
    found = components(links)
    discard(whole, groups, shared, members, first, parts, sets_now, placed)
    return split_join(
        seen.select("doc_id", F.col("size").alias("n_shingles")),
        found.withColumnRenamed("node", "doc_id"),
        ["doc_id"],
        "left",
    ).select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """One document of each component, that with the smallest doc_id, all columns kept.

    Documents without shingles, and those with a null doc_id, all stay. Of rows with
    one doc_id and one text a single one stays. Further columns may have any name.

    Most documents are alone, and those stay where they are: only rows that a filter
    over the ids of linked and repeated documents lets through are moved and decided
    exactly, so the filter's mistakes cost time and change nothing.
    """
    found = stored(jaccard_components(docs, like), "components")
    with _small_batches(docs.sparkSession):
        return _representatives(docs, found)


def _representatives(docs: DataFrame, found: DataFrame) -> DataFrame:
    ids = found.where("doc_id is not null").groupBy("doc_id")
    ids = ids.agg(F.min("component_id").alias("component_id"), F.count("*").alias("rows"))
    ids = stored(ids.withColumn("stays", F.col("doc_id") == F.col("component_id")), "component_ids")
    discard(found)
    number = _long("doc_id")
    doubtful = ids.where("not stays or rows > 1").select(F.xxhash64("doc_id").alias("key"))
    sure, rest = set_apart(docs, F.when(number.isNotNull(), F.xxhash64(number)), doubtful, "key")
    key = unused("_kept_id", docs)
    kept = ids.where("stays").select(F.col("doc_id").alias(key))
    one = split_join(rest.withColumn(key, number), kept, [key], "left_semi").dropDuplicates([key, "text"])
    return sure.unionByName(one.select(docs.columns))
