"""Secret scans with multipart credential linking, in DataFrame functions only.

Three base kinds are secrets by their form. Three weak kinds (an identifier, an
endpoint, a bare random-looking value) are not, and are reported only where parts
that complete each other co-occur: in one scope, within some characters of each
other. A scope ends at a blank line. The interval join is a range window over each
text's parts by position: it sees how many parts of every kind lie around a part
without making pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstream.llm.tables import split_join, unused

# The base kinds' patterns and least lengths, in their order.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

IDENTIFIER = r"""((?i:user|username|login|account|client_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)"""
ENDPOINT = r"""((?i:https?|ftp|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|redis|mongodb|amqp))://([A-Za-z0-9.:/_@-]+)"""
VALUE = r"([A-Za-z0-9+/_-]*[0-9][A-Za-z0-9+/_-]*)"
BREAK = r"\n[\x20\t\r]*\n"

BASE = ("assign", "access", "hex")
KINDS = {
    "assign": (ASSIGN, 2, LEAST_ASSIGN),
    "access": (ACCESS, 0, LEAST_ACCESS),
    "hex": (HEX, 0, LEAST_HEX),
    "identifier": (IDENTIFIER, 2, 3),
    "endpoint": (ENDPOINT, 2, 4),
    "value": (VALUE, 0, 20),
    "break": (BREAK, 0, 0),
}
MARK = "[SECRET]"


@dataclass(frozen=True)
class Linking:
    """How many characters apart the parts of one credential may start."""

    reach: int = 200


def _some(text: Column, kind: str) -> Column:
    """Whether the text may hold the kind: a cheap test that never misses one."""
    tests = {
        "assign": ASSIGN,
        "access": r"AKIA[A-Z0-9]{16}",
        "hex": r"[0-9a-f]{24}",
        "identifier": IDENTIFIER,
        "endpoint": ENDPOINT,
        "value": r"[A-Za-z0-9+/_-]{20}",
    }
    return text.rlike(tests[kind])


def suspect(text: Column) -> Column:
    """Whether a text can hold anything to report: a base kind, or weak kinds that link."""
    base = _some(text, "assign") | _some(text, "access") | _some(text, "hex")
    weak = _some(text, "identifier") | _some(text, "endpoint")
    return F.coalesce(base | (weak & _some(text, "value")), F.lit(False))


def _matches(text: Column, kind: str) -> Column:
    """An array of (kind, k, gap, size, fits): characters since the match before it, and in it."""
    pattern, group, least = KINDS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(whole.alias("m"), part.alias("p"), F.slice(gaps, 1, F.size(whole)).alias("g"))
    return F.transform(
        zipped,
        lambda x, k: F.struct(
            F.lit(kind).alias("kind"),
            k.cast("long").alias("k"),
            F.length(x["g"]).cast("long").alias("gap"),
            F.length(x["m"]).cast("long").alias("size"),
            (F.length(x["p"]) >= least).alias("fits"),
        ),
    )


def parts(docs: DataFrame) -> DataFrame:
    """Parts of every kind with their start and end, one row more for each text.

    The row more has a null kind, and ``rows`` says how many equal rows there are.
    Texts go by doc_id and their hash, so texts of one doc_id stay apart.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    mark = F.array(
        F.struct(
            F.lit(None).cast("string").alias("kind"), F.lit(0).cast("long").alias("k"),
            F.lit(0).cast("long").alias("gap"), F.lit(0).cast("long").alias("size"),
            F.lit(False).alias("fits"),
        )
    )
    found = F.when(
        suspect(F.col("text")),
        F.concat(mark, *[_matches(F.col("text"), kind) for kind in KINDS]),
    ).otherwise(mark)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.explode(found).alias("m"))
    rows = rows.select("doc_id", "text_key", "m.*").where("kind is null or k is not null")
    rows = rows.repartition("doc_id", "text_key").groupBy(
        "doc_id", "text_key", "kind", "k", "gap", "size", "fits"
    )
    rows = rows.agg(F.count("*").alias("rows"))
    before = Window.partitionBy("doc_id", "text_key", "kind").orderBy("k")
    end = F.sum(F.col("gap") + F.col("size")).over(before.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    return rows.where("kind is null or fits").drop("k", "gap", "fits")


def linked_parts(docs: DataFrame, how: Linking = Linking()) -> DataFrame:
    """``parts`` with ``reported``: base kinds, and weak ones that others complete.

    A value is reported beside an identifier, an endpoint or an access id; an
    identifier beside an assignment or a value; an endpoint where both an identifier
    or access id and a secret (assignment or value) are near. A value inside a base
    match of its text is that match, not a part of its own.
    """
    text = Window.partitionBy("doc_id", "text_key")
    order = text.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    found = parts(docs)
    base = F.col("kind").isin(*BASE)
    found = (
        found.withColumn("scope", F.count(F.when(F.col("kind") == "break", 1)).over(order))
        .withColumn(
            "covered",
            F.max(F.when(base, F.col("end"))).over(
                text.orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
            ),
        )
        .where("kind is null or kind <> 'break'")
    )
    free = (F.col("kind") != "value") | F.col("covered").isNull() | (F.col("covered") < F.col("end"))
    found = found.where(F.col("kind").isNull() | free)
    near = Window.partitionBy("doc_id", "text_key", "scope").orderBy("start")
    near = near.rangeBetween(-how.reach, how.reach)

    def by(*kinds: str) -> Column:
        return F.count(F.when(F.col("kind").isin(*kinds), 1)).over(near) > 0

    who, secret = by("identifier", "access"), by("assign", "value")
    completed = (
        F.when(F.col("kind") == "value", who | by("endpoint"))
        .when(F.col("kind") == "identifier", secret)
        .when(F.col("kind") == "endpoint", who & secret)
        .otherwise(base)
    )
    return found.withColumn("reported", F.coalesce(completed, F.lit(False)))


def scan(docs: DataFrame, how: Linking = Linking()) -> DataFrame:
    """Counts and spans of the secrets of each document.

    Columns: doc_id, text_key, n_assign, n_access, n_hex, base (base spans) and spans
    (all), both arrays of (start, order of the kind, end, kind) in that order, in code
    points with exclusive ends. A null or empty text has none. A null doc_id and every
    repeated row keep their row. No rows give no rows.
    """
    rank = F.array_position(F.lit(list(KINDS)), F.col("kind")).cast("int")
    span = F.struct("start", rank.alias("rank"), "end", "kind")
    base = F.col("kind").isin(*BASE)
    found = (
        linked_parts(docs, how)
        .groupBy("doc_id", "text_key")
        .agg(
            *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE],
            F.sort_array(F.collect_list(F.when(base, span))).alias("base"),
            F.sort_array(F.collect_list(F.when(F.col("reported"), span))).alias("spans"),
            F.max(F.when(F.col("kind").isNull(), F.col("rows"))).alias("rows"),
        )
    )
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows")))).drop("rows", "copy")


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def redacted(docs: DataFrame, how: Linking = Linking()) -> DataFrame:
    """The documents with a mark in place of each reported span, all columns kept.

    Only texts that can hold a secret are moved. Equal texts are scanned once, and are
    told by two hashes of theirs. Spans that overlap or touch become one mark; n_chars,
    where the table has it, is the new text's length. A null or empty text, a null
    doc_id and repeated rows stay as they are; further columns may have any name.
    """
    text = F.col("text").cast("string")
    suspicious = suspect(text)
    dirty = docs.where(suspicious)
    other_hash = F.xxhash64(F.lit("other"), text)
    one, two, spans_of, merged_of, text_of = (
        unused(name, docs) for name in ("_key", "_other_key", "_spans", "_merged", "_text")
    )
    texts = dirty.select(other_hash.alias("doc_id"), text.alias("text")).dropDuplicates(["doc_id", "text"])
    spans = scan(texts, how).where(F.size("spans") > 0)
    spans = spans.select(
        F.col("text_key").alias(one), F.col("doc_id").alias(two), F.col("spans").alias(spans_of)
    )
    keyed = dirty.withColumn(one, F.xxhash64(text)).withColumn(two, other_hash)
    joined = split_join(keyed, spans, [one, two], "left")
    merged = F.expr(
        f"aggregate({spans_of}, cast(array() as array<struct<a: bigint, b: bigint>>), (done, x) -> "
        "if(size(done) > 0 and element_at(done, -1).b >= x.start, "
        "concat(slice(done, 1, size(done) - 1), array(named_struct("
        "'a', element_at(done, -1).a, 'b', greatest(element_at(done, -1).b, x.end)))), "
        "concat(done, array(named_struct('a', x.start, 'b', x.end)))))"
    )
    rebuilt = F.expr(
        f"concat(array_join(transform({merged_of}, (x, k) -> concat("
        f"substring({text_of}, cast(if(k = 0, 0, {merged_of}[k - 1].b) + 1 as int), "
        f"cast(x.a - if(k = 0, 0, {merged_of}[k - 1].b) as int)), '{MARK}')), ''), "
        f"substring({text_of}, cast(element_at({merged_of}, -1).b + 1 as int)))"
    )
    changed = F.size(merged_of) > 0
    clean = (
        joined.withColumn(text_of, text)
        .withColumn(merged_of, merged)
        .withColumn("text", F.when(changed, rebuilt).otherwise(F.col(text_of)))
    )
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")))
    return docs.where(~suspicious).unionByName(clean.select(docs.columns))
