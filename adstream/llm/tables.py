"""Tables in the shared folder, joins that can be split, and membership filters."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adstream.session import shared_folder
from adstream.sources import files

MOST_BITS = 1 << 27
SHIFTS = (0, 32)


def reachable(spark: SparkSession) -> None:
    """Let Python workers that share this machine's files import this package.

    Elsewhere it is submitted with the job, as a file of ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Later steps then start from files, whatever becomes of the executors that
    made them, and an expensive step runs once.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made.stored_at = path
    return made


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``stored`` once nothing will read them: what was made of them
    has been stored in turn, so a lost executor sends no one back to them."""
    for made in tables:
        files.remove(made.sparkSession, made.stored_at)


def unused(name: str, *tables: DataFrame) -> str:
    """The name, with underscores behind it until no column of the tables has it."""
    taken = {c.lower() for table in tables for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join whose hot keys adaptive execution can split.

    It splits a partition only between an exchange and the join. A side that was
    aggregated by the same keys would get no such exchange, so both sides get one
    more key, a hash of the others.
    """
    shard = unused("_join_shard", left, right)
    keyed = F.hash(*on)
    both = left.withColumn(shard, keyed).join(
        right.withColumn(shard, keyed), [*on, shard], how
    )
    return both.drop(shard)


def hashed_sample(df: DataFrame, bound: int, *keys: str, draw: int = 0) -> DataFrame:
    """At most ``bound`` rows, those of the lowest hashes of their keys.

    Rows are cut to the share of hashes that holds about twice as many before they are
    ordered, so little is moved however many there are. The share follows the number
    of different hashes, as equal rows are all below the cut or all above it.
    """
    mark = F.xxhash64(*keys, F.lit(draw))
    rows = df.agg(F.approx_count_distinct(mark)).first()[0]
    if rows > 4 * bound:
        df = df.where(mark < F.lit(int(-(1 << 63) + (1 << 64) * (4 * bound / rows))))
    return df.orderBy(mark, *keys).limit(bound)


def membership(keys: DataFrame, column: str, per_key: int = 16) -> np.ndarray:
    """A Bloom filter over a column of mixed longs, two bits a key, as packed words.

    It has ``per_key`` bits a key, but no more than MOST_BITS, so the driver gets at
    most ``MOST_BITS / 64`` rows. With more keys than that it lets more through, never
    less; an exact join follows wherever it is used. Of other keys about a share of
    ``4 / per_key ** 2`` pass.
    """
    key = F.col(column)
    keys = keys.where(key.isNotNull())
    count = keys.agg(F.approx_count_distinct(key)).first()[0]
    bits = 1 << 16
    while bits < min(per_key * count, MOST_BITS):
        bits *= 2
    slots = F.array(*[F.shiftright(key, k).bitwiseAND(F.lit(bits - 1)) for k in SHIFTS])
    words = (
        keys.select(F.explode(slots).alias("slot"))
        .select(F.shiftright("slot", 6).cast("int").alias("word"), F.expr("cast(slot & 63 as int)").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
        .toPandas()
    )
    found = np.zeros(bits // 64, np.uint64)
    found[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).view(np.uint64)
    return found


def passes(found: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which int64 keys the filter lets through."""
    let = np.ones(len(keys), bool)
    for k in SHIFTS:
        slot = (keys >> k) & (len(found) * 64 - 1)
        let &= (found[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) != 0
    return let


def set_apart(df: DataFrame, key: Column, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose key is surely not among the keys, and the rest of them.

    Keys are mixed longs. Where few rows meet a key, most then stay where they are, and
    only the rest is moved for the exact join that has to follow. A null key meets none.
    """
    found = membership(keys, column)

    @F.arrow_udf("boolean")
    def met(values: pa.Array) -> pa.Array:
        return pa.array(passes(found, values.to_numpy(zero_copy_only=False)))

    mark = unused("_met", df)
    marked = df.withColumn(mark, met(F.coalesce(key, F.lit(0).cast("bigint"))) & key.isNotNull())
    return marked.where(~F.col(mark)).select(df.columns), marked.where(mark).select(df.columns)


def pieces(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few, so that what is made of one stays small."""
    for batch in batches:
        for k in range(0, len(batch), rows):
            yield batch.slice(k, rows)


def running_totals(df: DataFrame, key: str, value: str, block: int = 4096) -> DataFrame:
    """(key, value) with the sum of ``value`` over all smaller keys, one row a key.

    Sums run inside blocks of keys; only one row a block is summed in one task.
    """
    of = F.floor(F.col(key) / block)
    blocks = df.groupBy(of.alias("_block")).agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    smaller = (
        Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = df.withColumn("_block", of).withColumn(
        "_inside", F.coalesce(F.sum(value).over(smaller), F.lit(0))
    )
    joined = split_join(inside, blocks, ["_block"])
    return joined.select(key, (F.col("_inside") + F.col("_base")).alias(value))
