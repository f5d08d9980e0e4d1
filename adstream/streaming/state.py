"""What a windowed query still holds: windows that have not closed yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def open_windows(
    spark: SparkSession,
    checkpoint: str,
    names: Sequence[str],
    operator: int = 0,
    batch: int | None = None,
) -> DataFrame:
    """The groups in a windowed aggregate's state, flat: keys, window bounds, sums so far.

    Read from the query's checkpoint, as of its last batch or an earlier one, while it
    runs or afterwards. ``operator`` tells the aggregates of a query with several apart
    (see ``state_operators``). ``names`` are for the aggregate's buffers, in order, as
    Spark gives them the names of functions. A query without state gives an error.
    """
    reader = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load()
    keys = state.schema["key"].dataType
    buffers = state.schema["value"].dataType
    if len(names) != len(buffers):
        raise ValueError(f"the aggregate has the buffers {buffers.simpleString()}")
    window = next(k.name for k in keys if isinstance(k.dataType, T.StructType))
    # By place, as several buffers may have one name.
    ddl = ", ".join(f"`{n}`: {b.dataType.simpleString()}" for n, b in zip(names, buffers, strict=True))
    return state.select("key", F.col("value").cast(f"struct<{ddl}>").alias("value")).select(
        *[F.col(f"key.`{k.name}`").alias(k.name) for k in keys if k.name != window],
        F.col(f"key.`{window}`.start").alias("window_start"),
        F.col(f"key.`{window}`.end").alias("window_end"),
        "value.*",
    )


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query: their ids, names and partitions."""
    found = spark.read.format("state-metadata").option("path", checkpoint).load()
    return found.select("operatorId", "operatorName", "stateStoreName", "numPartitions")
