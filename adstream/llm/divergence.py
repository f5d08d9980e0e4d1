"""Source divergence audit: which sources of a language use its words differently.

The words of a language are found by iceberg prefix refinement over their bytes. Each
level counts the documents of every prefix of its length, keeps the frequent ones, and
lets the next, longer level look only at terms that have them. What is shorter than a
level's length is a whole term. Levels go on until every frequent prefix is one. A
level hands the next its open prefixes as a bit filter of bounded size: a crowded
filter lets more terms be counted, and drops none, so counts stay exact.

Counts are kept sparse. A source's divergence from another sums over all kept terms:
those that neither, or only one of the two has are summed from how many terms have
which count, and only terms that both have are compared one by one, in blocks of terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstream.llm.tables import membership, passes, split_join, stored

# A-Z to a-z, and what is no letter below 0x80 to a blank.
FOLD = bytes(b if b > 0x7F else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))
FIRST = 12
HELD = 1_000_000
HELD_BYTES = 1 << 27
PIECE = 1 << 22
BLOCK_ENTRIES = 20_000
DENSE = 1 << 22
UNIT = 1_000_000_000


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, from pieces of about PIECE bytes cut where no term is."""
    if len(text) <= PIECE:
        yield text.translate(FOLD).split()
        return
    text, at = text.translate(FOLD), 0
    while at < len(text):
        stop = text.find(b" ", at + PIECE)
        stop = len(text) if stop < 0 else stop
        yield text[at:stop].split()
        at = stop


def _keys(group: str, values: list[bytes]) -> np.ndarray:
    """What Spark's ``xxhash64`` makes of the group and each value, as int64."""
    seed = xxhash.xxh64_intdigest(group.encode(), seed=42)
    made = [xxhash.xxh64_intdigest(v, seed=seed) for v in values]
    return np.array(made, np.uint64).view(np.int64)


def _filter(keys: DataFrame, value: str) -> np.ndarray:
    return membership(keys.select(F.xxhash64("lang", value).alias("key")), "key")


class _Tally:
    """Counts by (lang, source) and value, given out when there are many."""

    def __init__(self):
        self.counts: dict[tuple[str, str], Counter] = {}
        self.bytes = 0

    def full(self) -> bool:
        return self.bytes > HELD_BYTES or sum(map(len, self.counts.values())) > HELD

    def rows(self, letting) -> Iterator[pa.RecordBatch]:
        """The counts of the values that ``letting`` (lang, values) lets through."""
        for (lang, source), counts in self.counts.items():
            values = list(counts)
            if letting is not None:
                values = [v for v, let in zip(values, letting(lang, values), strict=True) if let]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(values), pa.string()),
                    pa.array([source] * len(values), pa.string()),
                    pa.array(values, pa.binary()),
                    pa.array([counts[v] for v in values], pa.int64()),
                ],
                ["lang", "source", "value", "times"],
            )
        self.counts, self.bytes = {}, 0


def _tallied(
    docs: DataFrame, values: Callable[[bytes], Iterable[Iterable[bytes]]], letting, by_source: bool
) -> DataFrame:
    """Partial counts of the values that each document gives."""

    def made(batches):
        tally = _Tally()
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, text in enumerate(batch.column(2)):
                text = text.as_py()
                counts = tally.counts.setdefault((langs[k], sources[k] if by_source else ""), Counter())
                for some in values(text):
                    counts.update(some)
                tally.bytes += len(text)
                if k % 64 == 0 and tally.full():
                    yield from tally.rows(letting)
        yield from tally.rows(letting)

    return docs.mapInArrow(made, "lang string, source string, value binary, times bigint")


def _named(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    return docs.select(*names, text.cast("binary").alias("text"))


def kept_terms(docs: DataFrame, least: int = 3) -> DataFrame:
    """(lang, term) of the terms, as bytes, that at least ``least`` documents of a language have.

    A document is a row: a repeated row is one more. Null texts and languages count
    as empty.
    """
    named = _named(docs)
    whole, before, length, letting = None, 0, FIRST, None
    while True:

        def prefixes(text, before=before, length=length):
            found: set[bytes] = set()
            for terms in _terms(text):
                found.update(t[:length] for t in terms if len(t) >= before)
            yield found

        level = _tallied(named, prefixes, letting, by_source=False)
        level = level.groupBy("lang", "value").agg(F.sum("times").alias("documents"))
        level = stored(level.where(F.col("documents") >= least).select("lang", "value"), "prefixes")
        ended = F.length("value") < length
        done = level.where(ended).select("lang", F.col("value").alias("term"))
        whole = done if whole is None else whole.unionByName(done)
        going = level.where(~ended)
        if going.isEmpty():
            return whole
        open_ones = _filter(going, "value")

        def letting(lang, values, cut=length, found=open_ones):
            return passes(found, _keys(lang, [v[:cut] for v in values]))

        before, length = length, 2 * length


def term_counts(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, term, times, total) of the kept terms that a source has.

    ``total`` is the number of occurrences in the whole language.
    """
    found = _filter(kept, "term")

    def letting(lang, values):
        return passes(found, _keys(lang, values))

    made = _tallied(_named(docs), _terms, letting, by_source=True).withColumnRenamed("value", "term")
    # One exchange serves the sums, the join and the window. A term has at most a row
    # for each task and source in it.
    summed = made.repartition("lang", "term").groupBy("lang", "source", "term")
    summed = summed.agg(F.sum("times").alias("times")).join(kept, ["lang", "term"], "left_semi")
    of_lang = Window.partitionBy("lang", "term")
    return summed.withColumn("total", F.sum("times").over(of_lang))


def _part(times: str, sum_: str, terms: str) -> Column:
    """1 + floor(UNIT * (times + 1) / (sum + terms)), exact at any count."""
    below = f"greatest({sum_} + {terms}, 1L)"
    return F.expr(
        f"1 + if({times} < 9000000000L, {UNIT}L * ({times} + 1) div {below}, "
        f"cast({UNIT} as decimal(10,0)) * cast({times} + 1 as decimal(20,0)) "
        f"div cast({below} as decimal(20,0)))"
    )


def _apart(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _both_have(table: pa.Table) -> pa.Table:
    """For sources that share terms of a block: what these add beyond counts of 0."""
    lang = table.column("lang")[0].as_py()
    names = table.column("source").combine_chunks().dictionary_encode()
    source = names.indices.to_numpy().astype(np.int64)
    term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.argsort(term, kind="stable")
    term, source = term[order], source[order]
    p, zero = (table.column(c).to_numpy()[order] for c in ("p", "zero"))
    first = np.searchsorted(term, term)
    width = np.searchsorted(term, term, side="right") - first
    upto = np.cumsum(width)
    size = len(names.dictionary)
    dense = size * size <= DENSE
    pair, value = np.empty(0, np.int64), np.zeros(size * size if dense else 0, np.int64)
    at = 0
    while at < len(term):
        done = upto[at - 1] if at else 0
        stop = max(int(np.searchsorted(upto, done + (1 << 20))), at + 1)
        one = np.repeat(np.arange(at, stop), width[at:stop])
        start = np.repeat(upto[at:stop] - width[at:stop] - done, width[at:stop])
        other = np.repeat(first[at:stop], width[at:stop]) + np.arange(len(one)) - start
        one, other = one[one != other], other[one != other]
        more = _far(p[one], p[other]) - _far(p[one], zero[other])
        more += _far(zero[one], zero[other]) - _far(zero[one], p[other])
        these = source[one] * size + source[other]
        if dense:
            np.add.at(value, these, more)
        else:
            pair, place = np.unique(np.concatenate([pair, these]), return_inverse=True)
            value, before = np.zeros(len(pair), np.int64), value
            np.add.at(value, place, np.concatenate([before, more]))
        at = stop
    if dense:
        pair = np.flatnonzero(value)
        value = value[pair]
    one, other = np.divmod(pair, size)
    return pa.table({
        "lang": pa.array([lang] * len(pair), pa.string()),
        "source": names.dictionary.take(pa.array(one)),
        "item": names.dictionary.take(pa.array(other)),
        "value": value,
    })


def _pairs(counts: DataFrame, groups: DataFrame, entries: int) -> DataFrame:
    """(lang, source, item, value) of each ordered pair of a language's sources."""
    one = groups.select("lang", "source", "zero", "terms", "own")
    other = groups.select(
        "lang", F.col("source").alias("item"), F.col("zero").alias("zero_b"), F.col("own").alias("own_b")
    )
    beside = split_join(one, other, ["lang"]).where("source <> item")
    neither = beside.select(
        "lang", "source", "item",
        (F.expr("terms - own - own_b") * _apart("zero", "zero_b")).alias("value"),
    )
    alike = counts.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    alike = split_join(alike, other, ["lang"]).where("source <> item")
    single = alike.select(
        "lang",
        F.inline(
            F.array(
                F.struct("source", "item", (F.col("times") * _apart("p", "zero_b")).alias("value")),
                F.struct(
                    F.col("item").alias("source"), F.col("source").alias("item"),
                    (F.col("times") * _apart("zero_b", "p")).alias("value"),
                ),
            )
        ),
    )
    block = F.pmod(F.xxhash64("term"), F.lit(entries // BLOCK_ENTRIES + 1))
    double = (
        counts.select("lang", "source", "term", "p", "zero", block.alias("block"))
        .groupBy("lang", "block")
        .applyInArrow(_both_have, "lang string, source string, item string, value bigint")
    )
    parts = neither.unionByName(single).unionByName(double)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least: int = 3, ranks: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) in the documents.

    Part ``pair`` has each other source of the language and the divergence from it,
    all of them; part ``term`` the ``ranks`` terms that a source has most beyond its
    language. Null text, lang and source count as empty. Ties go by the item's UTF-8
    bytes. A repeated row is a further document. A language without kept terms has
    pairs of value 0; a source without another has none. No rows give no rows.
    """
    kept = stored(kept_terms(docs, least), "kept_terms")
    counts = stored(term_counts(docs, kept), "term_counts")
    terms = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    of_lang = Window.partitionBy("lang")
    groups = (
        _named(docs)
        .groupBy("lang", "source")
        .agg(F.lit(0).cast("bigint").alias("sum"), F.lit(0).cast("bigint").alias("own"))
        .unionByName(
            counts.groupBy("lang", "source").agg(F.sum("times").alias("sum"), F.count("*").alias("own"))
        )
        .groupBy("lang", "source")
        .agg(F.sum("sum").alias("sum"), F.sum("own").alias("own"))
        .withColumn("lang_sum", F.sum("sum").over(of_lang))
        .join(terms, "lang", "left")
        .withColumn("terms", F.coalesce("terms", F.lit(0)))
        .withColumn("zero", _part("0L", "sum", "terms"))
    )
    groups = stored(groups, "groups")
    told = split_join(counts, groups.drop("own"), ["lang", "source"]).select(
        "lang", "source", "term", "zero",
        _part("times", "sum", "terms").alias("p"),
        _part("total", "lang_sum", "terms").alias("q"),
    )
    told = stored(told, "told_terms")
    pairs = _pairs(told, groups, told.count())
    term = F.col("term").cast("string").alias("item")
    above = told.where("p > q").select("lang", "source", term, _apart("p", "q").alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(df: DataFrame, part: str) -> DataFrame:
        return df.select(
            "lang", "source", F.lit(part).alias("part"), "item", "value",
            F.row_number().over(by_value).alias("rank"),
        )

    return ranked(pairs, "pair").unionByName(ranked(above, "term").where(F.col("rank") <= ranks))
