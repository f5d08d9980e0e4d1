"""Substring dedup by hashing lines and the sentences within them.

Units are normalised and hashed, digests grouped over all documents, and of each
digest only the earliest occurrence by document and place is kept. Units are whole
lines, and the sentences in them: a passage that was copied into another line shares
its inner sentences with the original. Runs of repeated sentences are extended word
by word into the sentences beside them, as a passage may begin and end anywhere. A
long unit is cut where its words say, so a passage within one is found too.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstream.llm.tables import discard, membership, passes, set_apart, split_join, stored
from adstream.llm.words import ascii_fold, chunks, find_words, mixed

NEWLINE = 0x0A
STOPS = b".!?"
# A unit of more words is cut at words of less weight than REACH on either side.
LONG_UNIT = 24
REACH = 4
PLACES = 1 << 31
TEXTS = 10**9
ISLAND = -2


@dataclass(frozen=True)
class Repeats:
    """Fewest words of what is removed: of a line, and of a passage in other lines.

    Fewer are ordinary repetition, such as headings. A sentence with fewer words than ``unit_words`` is no
    unit, as it repeats by chance: it belongs to the unit of the sentence after it.
    """

    line_words: int = 12
    words: int = 25
    unit_words: int = 4


def _cuts(weight: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Words of less weight than those before and no more than those after them."""
    least = np.ones(len(weight), bool)
    for k in range(1, REACH + 1):
        same = line[k:] == line[:-k]
        least[k:] &= (weight[k:] < weight[:-k]) | ~same
        least[:-k] &= (weight[:-k] <= weight[k:]) | ~same
    return least


def _units(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray, unit_words: int):
    """Words of a chunk of texts, and the first and last word of each line and unit."""
    start, end, text, value = find_words(data, offsets, fold)
    if not len(start):
        return None
    ends_line = np.cumsum(data == NEWLINE)[start]
    new_line = np.ones(len(start), bool)
    new_line[1:] = (text[1:] != text[:-1]) | (ends_line[1:] != ends_line[:-1])
    line = np.cumsum(new_line)
    new = new_line.copy()
    new[1:] |= np.isin(data[end[:-1] - 1], np.frombuffer(STOPS, np.uint8))
    sentence = np.cumsum(new) - 1
    new[1:] &= new_line[1:] | (np.bincount(sentence)[sentence[:-1]] >= unit_words)
    unit = np.cumsum(new) - 1
    # The weight of a word follows from the low bits of its characters.
    low = (fold[data] & 63).astype(np.int64)
    low[:-1] *= (data[1:] & 0xC0) != 0x80
    total = np.concatenate([[0], np.cumsum(low)])
    weight = (total[end] - total[start]) * 37 % 101
    new |= _cuts(weight, line) & (np.bincount(unit)[unit] > LONG_UNIT)
    runs = []
    for begins in (new_line, new):
        first = np.flatnonzero(begins)
        runs.append((first, np.append(first[1:], len(start)) - 1))
    return start, end, text, value, runs[0], runs[1]


def _digests(value: np.ndarray, first: np.ndarray, last: np.ndarray, kind: int) -> list[pa.Array]:
    place = (np.arange(len(value)) - np.repeat(first, last - first + 1)).astype(np.uint64)
    terms = [value * (mixed(place + np.uint64(k)) | np.uint64(1)) for k in (1, 1 << 32)]
    sums = [mixed(np.add.reduceat(t, first) + np.uint64(kind)) for t in terms]
    return [pa.array(x.view(np.int64)) for x in sums]


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, a number that tells texts of one doc_id apart, and the text."""
    apart = F.pmod(F.xxhash64("text"), F.lit(TEXTS)).cast("int")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), apart.alias("text_no"), "text")
    return docs.where("doc_id is not null and text is not null")


def unit_table(docs: DataFrame, how: Repeats) -> DataFrame:
    """(doc_id, text_no, line, unit, last, start, end, words, h1, h2) of each unit with a word.

    start and end are code points of the text, end exclusive. A unit ends with its line,
    and with a sentence of ``how.unit_words``, that is before white space that follows a
    full stop, question or exclamation mark; long ones are cut. Its digest is of its words
    in lower case (A-Z), so white space does not count. Lines of ``how.line_words`` have a
    row of their own, marked by ``line``, with the numbers of their first and last unit;
    else ``last`` is ``unit``.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_no", pa.int32()), ("line", pa.bool_()), ("unit", pa.int32()), ("last", pa.int32()),
        ("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()),
    ])

    def hashed(batches):
        fold = ascii_fold()
        for batch in batches:
            for row, data, offsets in chunks(batch.column(2)):
                found = _units(data, offsets, fold, how.unit_words)
                if found is None:
                    continue
                start, end, text, value, lines, units = found
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                owners = text[units[0]]
                base = np.searchsorted(owners, owners)
                of = np.searchsorted(units[0], np.arange(len(start)), side="right") - 1
                for kind, (first, last) in enumerate((units, lines)):
                    made = _digests(value, first, last, kind)
                    owner = text[first]
                    at = points[offsets[owner]]
                    numbers = [of[x] - base[of[first]] for x in (first, last)]
                    places = [points[start[first]] - at, points[end[last]] - at, last - first + 1]
                    rows = pa.RecordBatch.from_arrays(
                        [
                            *[batch.column(k).take(pa.array(row + owner)) for k in (0, 1)],
                            pa.array(np.full(len(first), kind == 1)),
                            *[pa.array(x.astype(np.int32)) for x in (*numbers, *places)],
                            *made,
                        ],
                        schema=schema,
                    )
                    yield rows.filter(pa.array(last - first + 1 >= how.line_words)) if kind else rows

    return _texts(docs).mapInArrow(
        hashed,
        "doc_id bigint, text_no int, line boolean, unit int, last int, start int, end int, words int, h1 bigint, h2 bigint",
    )


def _asked_key() -> Column:
    """A number of (doc_id, text_no, unit), the unit in both halves of its text's number."""
    unit = F.col("unit").cast("bigint")
    return F.xxhash64("doc_id", "text_no").bitwiseXOR(unit).bitwiseXOR(F.shiftleft(unit, 32))


def _words_of(docs: DataFrame, asked: DataFrame, how: Repeats) -> DataFrame:
    """(doc_id, text_no, unit, hashes, starts, ends) of the units that are asked for, and
    of some more: their words, first to last."""
    wanted = membership(asked.select(_asked_key().alias("key")), "key")

    def picked(batches):
        fold = ascii_fold()
        for batch in batches:
            keys = batch.column(3).to_numpy()
            for row, data, offsets in chunks(batch.column(2)):
                found = _units(data, offsets, fold, how.unit_words)
                if found is None:
                    continue
                start, end, text, value, _, (first, last) = found
                owner = text[first]
                number = np.arange(len(first)) - np.searchsorted(owner, owner)
                hit = np.flatnonzero(passes(wanted, keys[row + owner] ^ number ^ (number << 32)))
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                base = points[offsets[owner]]
                count = last[hit] - first[hit] + 1
                ends_at = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                word = np.arange(ends_at[-1]) + np.repeat(first[hit] - ends_at[:-1], count)
                at = np.repeat(base[hit], count)
                lists = (value[word].view(np.int64), points[start[word]] - at, points[end[word]] - at)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k).take(pa.array(row + owner[hit])) for k in (0, 1)],
                        pa.array(number[hit].astype(np.int32)),
                        *[pa.ListArray.from_arrays(ends_at, pa.array(x.astype(np.int64))) for x in lists],
                    ],
                    ["doc_id", "text_no", "unit", "hashes", "starts", "ends"],
                )

    made = _texts(docs).withColumn("key", F.xxhash64("doc_id", "text_no")).mapInArrow(
        picked,
        "doc_id bigint, text_no int, unit int, hashes array<bigint>, starts array<bigint>, ends array<bigint>",
    )
    return made.dropDuplicates(["doc_id", "text_no", "unit"])


def _equal_words(one: Column, other: Column) -> Column:
    """How many words two lists of words have in common at their beginning."""
    same = F.zip_with(one, other, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differ = F.array_position(same, F.lit(False))
    return F.coalesce(F.when(differ > 0, differ - 1).otherwise(F.size(same)), F.lit(0)).cast("bigint")


def _placed(of: str) -> Column:
    """The document, text and unit that a rank stands for, and the unit that has it."""
    places, texts = (F.lit(n).cast("decimal(10,0)") for n in (PLACES, TEXTS))
    rank = F.col(of)["earliest"]
    unit = F.pmod(rank, places)
    text = ((rank - unit) / places).cast("decimal(28,0)")
    number = F.pmod(text, texts)
    return F.struct(
        ((text - number) / texts).cast("bigint").alias("doc_id"), number.cast("int").alias("text_no"),
        unit.cast("int").alias("unit"), F.col(of)["unit"].alias("at"),
    )


def _runs(units: DataFrame, part: Column, how: Repeats) -> DataFrame:
    """Neighbouring units with the same island and part as one row."""
    occurrence = F.struct("earliest", "unit")
    counts = F.col("words") >= how.unit_words
    made = units.groupBy("doc_id", "text_no", "island", part.alias("part")).agg(
        F.min("unit").alias("first"),
        F.max("unit").alias("last"),
        F.min("start").cast("bigint").alias("start"),
        F.max("end").cast("bigint").alias("end"),
        F.sum("words").alias("words"),
        F.coalesce(F.sum(F.when(counts, F.col("words"))), F.lit(0)).alias("counted"),
        F.count("*").alias("units"),
        F.min_by(occurrence, "unit").alias("kept"),
        F.min_by(occurrence, F.struct(-F.col("words"), "unit")).alias("anchor"),
    )
    return made.withColumns({"kept": _placed("kept"), "anchor": _placed("anchor")})


def _extended(docs: DataFrame, runs: DataFrame, how: Repeats) -> DataFrame:
    """Islands with the words beyond their ends, and the place of what is kept of all runs.

    What stands before and after an island is compared with what stands before and
    after the earliest occurrence of its longest unit.
    """
    near, kept = F.col("anchor"), F.col("kept")
    first, last = F.col("first") - 1, F.col("last") + 1
    moved = near["unit"] - near["at"]
    own = (F.col("doc_id"), F.col("text_no"))
    theirs = (near["doc_id"], near["text_no"])
    asks = [
        F.struct(F.lit(role).alias("role"), text[0].alias("doc_id"), text[1].alias("text_no"), unit.cast("int").alias("unit"))
        for role, text, unit in (
            ("kept", (kept["doc_id"], kept["text_no"]), kept["unit"]),
            ("before", own, first),
            ("after", own, last),
            ("kept_before", theirs, first + moved),
            ("kept_after", theirs, last + moved),
        )
    ]
    asks = F.when(F.col("part") == ISLAND, F.array(*asks)).otherwise(F.array(asks[0]))
    run = F.struct("doc_id", "text_no", "island", "part").alias("run")
    asked = runs.select(run, F.explode(asks).alias("ask")).select("run", "ask.*").where("unit >= 0")
    asked = stored(asked, "asked_units")
    told = split_join(asked, _words_of(docs, asked, how), ["doc_id", "text_no", "unit"])

    def of(role, column):
        return F.max(F.when(F.col("role") == role, F.col(column)))

    sides = told.groupBy("run").agg(
        *[of(role, "hashes").alias(role) for role in ("before", "after", "kept_before", "kept_after")],
        of("before", "starts").alias("starts"),
        of("after", "ends").alias("ends"),
        of("kept", "starts").alias("kept_starts"),
    )
    sides = sides.select(
        "run", "starts", "ends",
        F.get("kept_starts", F.lit(0)).alias("kept_start"),
        _equal_words(F.reverse("before"), F.reverse("kept_before")).alias("words_before"),
        _equal_words(F.col("after"), F.col("kept_after")).alias("words_after"),
    )
    joined = split_join(runs.withColumn("run", run), sides, ["run"])
    more = F.col("words_before") + F.col("words_after")
    starts = F.get("starts", (F.size("starts") - F.col("words_before")).cast("int"))
    ends = F.get("ends", (F.col("words_after") - 1).cast("int"))
    return joined.select(
        "doc_id", "text_no", "island", "part",
        F.when(F.col("words_before") > 0, starts).otherwise(F.col("start")).alias("start"),
        F.when(F.col("words_after") > 0, ends).otherwise(F.col("end")).alias("end"),
        (F.col("words") + more).alias("words"), (F.col("counted") + more).alias("counted"),
        "units", kept["doc_id"].alias("kept_doc_id"), "kept_start",
    )


def repeated_spans(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """(doc_id, start, end, words, units, kept_doc_id, kept_start) of what goes.

    A span is a run of neighbouring units that each occurred earlier, with the words
    beside it that were copied along, if that makes ``how.words``; else each run of
    whole lines of ``how.line_words`` or more that occurred earlier. units counts the
    whole ones; the kept place is the earliest occurrence of the first of them. Two
    spans may share words of the unit between them. Null and empty texts, and null
    doc_ids, have none and repeat nothing. Repeated rows are one document; different
    texts of one doc_id are documents in the order of a hash of theirs. Offsets are
    those of the original text. No rows give no rows.
    """
    places, texts = (F.lit(n).cast("decimal(10,0)") for n in (PLACES, TEXTS))
    units = stored(unit_table(docs, how), "units")
    # The rank of an occurrence, its document before its text and place, as one number.
    rank = (F.col("doc_id").cast("decimal(19,0)") * texts + F.col("text_no")) * places + F.col("unit")
    earliest = units.groupBy("h1", "h2").agg(F.min(rank).alias("earliest"), F.count("*").alias("times"))
    earliest = stored(earliest.where("times > 1").drop("times"), "repeated_digests")
    _, units_again = set_apart(units, F.col("h1"), earliest, "h1")
    again = split_join(units_again, earliest, ["h1", "h2"]).where(rank > F.col("earliest"))
    again = again.drop("h1", "h2").distinct()

    text = Window.partitionBy("doc_id", "text_no")
    line_end = F.max(F.when(F.col("line"), F.col("last"))).over(text.orderBy("unit", F.desc("line")))
    again = again.withColumn("whole", F.coalesce(line_end >= F.col("unit"), F.lit(False))).where("not line")
    order = text.orderBy("unit")
    again = again.withColumn("island", F.col("unit") - F.row_number().over(order))
    again = stored(again.drop("line", "last"), "repeated_units")
    discard(units, earliest)

    order = Window.partitionBy("doc_id", "text_no", "island").orderBy("unit")
    part = F.col("unit") - F.row_number().over(order)
    lines = again.where("whole").withColumn("part", part)
    runs = _runs(again, F.lit(ISLAND), how).unionByName(_runs(lines, F.col("part"), how))
    found = _extended(docs, stored(runs, "runs"), how)
    enough = (F.col("part") == ISLAND) & (F.col("counted") >= how.words)
    passage = F.max(enough).over(Window.partitionBy("doc_id", "text_no", "island"))
    found = found.withColumns({"enough": enough, "passage": passage})
    return found.where(F.col("enough") | (~F.col("passage") & (F.col("part") != ISLAND))).select(
        "doc_id", "start", "end", "words", "units", "kept_doc_id", "kept_start"
    )
