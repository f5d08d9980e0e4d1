"""A table that is replaced as a whole while others read it.

Each write makes a version folder of its own, so files that a running query has begun
to read stay. The newest version whose write has finished counts. Old versions are
removed on request, once no reader holds them and they have been superseded for a
while.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from adstream.sources import files

_NAME = re.compile(r"/version-(\d{12})-[0-9a-f]{32}$")


@dataclass(frozen=True)
class VersionedFolder:
    """Versions of a table below one path."""

    path: str
    format: str = "parquet"

    def _at(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"


def _number(version: str) -> int:
    return int(_NAME.search(version)[1])


def _begun(spark: SparkSession, folder: VersionedFolder) -> list[str]:
    found = files.matching(spark, folder._at("version-*"))
    return sorted((v for v in found if _NAME.search(v)), key=lambda v: (_number(v), v))


def versions(spark: SparkSession, folder: VersionedFolder) -> list[str]:
    """Paths of all finished versions, the newest last."""
    return [v for v in _begun(spark, folder) if files.exists(spark, f"{v}/_SUCCESS")]


def newest(spark: SparkSession, folder: VersionedFolder) -> str:
    """The path of the newest finished version."""
    found = versions(spark, folder)
    if not found:
        raise FileNotFoundError(f"{folder.path} has no finished version")
    return found[-1]


def write_version(table: DataFrame, folder: VersionedFolder) -> str:
    """Write a new version and give its path; readers see it once it is whole.

    Of two writers at a time both versions last, and the later name counts.
    """
    spark = table.sparkSession
    begun = _begun(spark, folder)
    number = _number(begun[-1]) + 1 if begun else 0
    path = folder._at(f"version-{number:012d}-{uuid.uuid4().hex}")
    table.write.format(folder.format).save(path)
    if not files.exists(spark, f"{path}/_SUCCESS"):
        files.write_text(spark, f"{path}/_SUCCESS", "")  # where the committer leaves none
    return path


def read_version(spark: SparkSession, folder: VersionedFolder, version: str | None = None) -> DataFrame:
    """The table of a version, by default the newest."""
    return spark.read.format(folder.format).load(version or newest(spark, folder))


def hold(spark: SparkSession, folder: VersionedFolder, reader: str, step: int) -> str:
    """The version that a reader's step uses: the newest when it first asked.

    The step that repeats after a failure gets the same version. What the reader's
    earlier steps held is let go.
    """
    mark = folder._at(f"_held/{reader}-{step:012d}")
    if files.exists(spark, mark):
        text = files.read_text(spark, mark)
        if text:  # empty where its writer was lost
            return text
    version = newest(spark, folder)
    files.write_text(spark, mark, version)
    for other in files.matching(spark, folder._at(f"_held/{reader}-*")):
        if int(other.rsplit("-", 1)[1]) < step:
            files.remove(spark, other)
    return version


def let_go(spark: SparkSession, folder: VersionedFolder, reader: str) -> None:
    """Give up all that a reader holds, as when it will not run again."""
    for mark in files.matching(spark, folder._at(f"_held/{reader}-*")):
        files.remove(spark, mark)


def drop_old(spark: SparkSession, folder: VersionedFolder, hours: float = 24.0) -> list[str]:
    """Remove versions that were superseded ``hours`` ago and that no reader holds.

    That covers readers that hold nothing, such as a stream joined with one version
    for its whole life, as long as they are restarted within the time. Unfinished
    versions older than the newest go by the same rule. Gives the removed paths.
    """
    held = {files.read_text(spark, m) for m in files.matching(spark, folder._at("_held/*"))}
    begun = _begun(spark, folder)
    finished = versions(spark, folder)
    before = (time.time() - hours * 3600) * 1000
    gone = []
    for version in begun:
        later = [v for v in finished if (_number(v), v) > (_number(version), version)]
        if later and version not in held and files.changed_ms(spark, f"{later[0]}/_SUCCESS") <= before:
            files.remove(spark, version)
            gone.append(version)
    return gone
