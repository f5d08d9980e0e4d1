"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Stateful queries keep (campaign, window) groups; RocksDB holds them off-heap
# and on local disk, and uploads only changes at each commit. Join state format 3
# keeps both sides of a join in one store, so a commit writes one file, not four.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

_STARTING = threading.RLock()


def build_session(
    app: str = "adstream",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session in UTC with adaptive execution and RocksDB state.

    ``shuffle_partitions`` also fixes the number of state stores of a stateful
    query for the life of its checkpoint; leave it unset to keep the cluster's.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **STREAM_CONF,
        **(conf or {}),
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder path that every executor can reach.

    It lies below ``spark.checkpoint.dir``, or else below the warehouse, which a
    cluster's executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.sparkContext.getCheckpointDir()
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_adstream"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def own_session(spark: SparkSession, **settings: str) -> SparkSession:
    """A session beside ``spark`` with its settings and some of its own.

    What is set there is not seen by ``spark`` or by queries started from it. Names
    have ``__`` for each dot and begin after ``spark.sql.``.
    """
    made = spark.newSession()
    own = {f"spark.sql.{k.replace('__', '.')}": v for k, v in settings.items()}
    for key, value in (spark.conf.getAll | own).items():
        if spark.conf.isModifiable(key):
            made.conf.set(key, value)
    return made


def state_width(spark: SparkSession, per_core: int = 1) -> int:
    """State partitions for a new checkpoint: some per core of the cluster.

    The number lasts as long as the checkpoint, whatever the input grows to, so it
    follows the machines and not the input.
    """
    return per_core * spark.sparkContext.defaultParallelism


@contextmanager
def stream_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """State settings for the queries started inside; the session's own come back.

    A query copies its session when it is started, so they need not last longer. One
    query at a time starts this way.
    """
    wanted = dict(STREAM_CONF)
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    with _STARTING:
        before = {key: spark.conf.get(key, None) for key in wanted}
        try:
            for key, value in wanted.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)
