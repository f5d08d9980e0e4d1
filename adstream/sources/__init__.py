"""Sources and sinks."""

from adstream.sources.endpoints import FileFolder, JdbcTable, KafkaTopic, endpoint
from adstream.sources.readers import (
    read_events,
    read_latencies,
    read_latency_curve,
    read_lines,
    read_partitions,
    read_results,
)
from adstream.sources.versions import (
    VersionedFolder,
    drop_old,
    newest,
    read_version,
    versions,
    write_version,
)
from adstream.sources.writers import (
    console,
    stream_writer,
    write_events,
    write_latency,
    write_mapping,
    write_results,
)

__all__ = [
    "FileFolder",
    "JdbcTable",
    "KafkaTopic",
    "VersionedFolder",
    "console",
    "drop_old",
    "endpoint",
    "newest",
    "read_events",
    "read_latencies",
    "read_latency_curve",
    "read_lines",
    "read_partitions",
    "read_results",
    "read_version",
    "versions",
    "stream_writer",
    "write_events",
    "write_latency",
    "write_mapping",
    "write_results",
    "write_version",
]
