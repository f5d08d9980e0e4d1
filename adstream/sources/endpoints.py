"""Where rows come from and go to: a Kafka topic, a folder of files, a JDBC table."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class KafkaTopic:
    """A topic. Needs the public spark-sql-kafka package on the class path.

    ``group_id`` is optional; Spark makes one per query when it is left out. Lost
    offsets end a bounded read, which would be short without a word; a stream goes on
    unless ``fail_on_data_loss`` is set.
    ``max_offsets_per_trigger`` and ``min_partitions`` bound a micro-batch and
    split large topic partitions over more tasks. ``partition`` reads one partition of
    the topic only, ``headers`` adds the records' headers to what is read.
    """

    servers: str
    topic: str
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    group_id: str | None = None
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    partition: int | None = None
    headers: bool = False
    extra: dict[str, str] = field(default_factory=dict)

    def read_options(self, streaming: bool = True) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss or not streaming).lower(),
        }
        if self.partition is not None:
            del options["subscribe"]
            options["assign"] = json.dumps({self.topic: [self.partition]})
        if self.headers:
            options["includeHeaders"] = "true"
        if self.group_id:
            options["kafka.group.id"] = self.group_id
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        if streaming and self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if not streaming:
            options["endingOffsets"] = "latest"
        return options | self.extra

    def write_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "topic": self.topic} | self.extra

    def only(self, partition: int) -> KafkaTopic:
        """One partition of the topic."""
        return replace(self, partition=partition)


@dataclass(frozen=True)
class FileFolder:
    """A folder of files with a known schema."""

    path: str
    format: str = "parquet"
    schema: T.StructType | str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def only(self, partition: int) -> FileFolder:
        """One partition of a folder that is written by the column ``partition``."""
        return replace(self, path=f"{self.path.rstrip('/')}/partition={partition}")


@dataclass(frozen=True)
class JdbcTable:
    """A database table. Needs the database's JDBC driver on the class path."""

    url: str
    table: str
    driver: str | None = None
    properties: dict[str, str] = field(default_factory=dict)

    def write_options(self) -> dict[str, str]:
        options = {"url": self.url, "dbtable": self.table, "truncate": "true"}
        if self.driver:
            options["driver"] = self.driver
        return options | self.properties


def endpoint(text: str) -> KafkaTopic | FileFolder:
    """``kafka://host:port[,host:port]/topic``, or else a folder path."""
    if not text.startswith("kafka://"):
        return FileFolder(text)
    servers, _, topic = text.removeprefix("kafka://").partition("/")
    if not servers or not topic:
        raise ValueError(f"not a topic: {text!r}")
    return KafkaTopic(servers, topic)
