"""Whitening of embeddings: the components of most variance, scaled to unit variance.

Entries become whole numbers, so sums are exact. The covariance is summed in parts on
the executors, from centred vectors; its largest eigenvalues and their vectors come
from contour integration (``feast``), and a last pass whitens every vector. The driver
holds one square matrix of a vector's length, whatever the number of vectors.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.feast import largest

STEP = 1024
SHIFT = 100_000
LARGEST = 2.0**62
ROWS = 2048
NOTHING = 1e-12


@dataclass
class Whitening:
    """Of the vectors of one length: their number, sums, components and eigenvalues."""

    rows: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean; the mean's whole part goes first, so little is rounded."""
        whole = np.array([s // self.rows for s in self.sums], np.int64)
        part = np.array([(s % self.rows) / self.rows for s in self.sums])
        return (x - whole).astype(float) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (rows * x - sums) squared, exact; None where no long can hold one."""
        near = (np.abs(self.centred(x)).max(initial=0.0) + 1) * self.rows
        wide = near * near * x.shape[1] >= 2**62 or np.abs(x).max(initial=0) * float(self.rows) >= 2**62
        x, sums = x.astype(object if wide else np.int64), np.array(self.sums, object)
        apart = x * self.rows - (sums if wide else sums.astype(np.int64))
        return [v if v < 2**63 else None for v in map(int, (apart * apart).sum(axis=1))]


def vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and whole-number vectors of a column of lists, by length and ROWS at a time.

    Lists that are null, empty, hold null or non-finite entries, or entries beyond a
    long, are left out.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[lengths > 0]):
        every = np.flatnonzero(lengths == length)
        for at in range(0, len(every), ROWS):
            rows = every[at : at + ROWS]
            flat = column.take(pa.array(rows)).flatten().cast(pa.float64())
            entry = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False).reshape(len(rows), length)
            with np.errstate(invalid="ignore", over="ignore"):
                scaled = np.floor(STEP * entry)
                good = (np.abs(scaled) < LARGEST).all(axis=1)
            if good.any():
                yield rows[good], scaled[good].astype(np.int64) + SHIFT


def _summed(
    df: DataFrame, column: str, part: Callable[[int, np.ndarray], np.ndarray], kind: str
) -> dict[int, dict[int, object]]:
    """For each vector length, sums over all vectors of what ``part`` makes of a block."""

    def made(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in vectors(batch.column(0)):
                new = part(x.shape[1], x)
                old = total.get(x.shape[1])
                total[x.shape[1]] = new if old is None else old + new
        for length, values in total.items():
            for at in range(0, len(values), 1 << 16):
                these = values[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(these), length, np.int64)),
                        pa.array(np.arange(at, at + len(these))),
                        pa.array(list(map(str, these)) if kind == "string" else these),
                    ],
                    ["length", "place", "value"],
                )

    exact = "decimal(38,0)" if kind == "string" else kind
    parts = df.select(column).mapInArrow(made, f"length bigint, place bigint, value {kind}")
    rows = parts.groupBy("length", "place").agg(F.sum(F.col("value").cast(exact)).alias("value"))
    found: dict[int, dict[int, object]] = defaultdict(dict)
    for row in rows.collect():
        found[row.length][row.place] = row.value
    return found


def _triangle(centred: np.ndarray) -> np.ndarray:
    return (centred.T @ centred)[np.triu_indices(centred.shape[1])]


def _square(values: dict[int, object], size: int) -> np.ndarray:
    made = np.zeros((size, size))
    made[np.triu_indices(size)] = [values[k] for k in range(size * (size + 1) // 2)]
    return made + np.triu(made, 1).T


def fit(df: DataFrame, column: str, components: int) -> dict[int, Whitening]:
    """A whitening for each vector length in the column.

    It has at most ``components`` components, and only those of which the variance is
    not zero in double precision; vectors that are all equal have none.
    """

    def added(_, x):
        return np.array([*x.sum(axis=0, dtype=object), len(x)], object)

    sums = _summed(df, column, added, "string")
    empty = (np.empty((0, 0)), np.empty(0), 0.0)
    made = {
        length: Whitening(int(at[length]), [int(at[k]) for k in range(length)], *empty)
        for length, at in sums.items()
    }
    spread = _summed(df, column, lambda length, x: _triangle(made[length].centred(x)), "double")
    for length, one in made.items():
        covariance = _square(spread[length], length) / one.rows
        one.trace = float(np.trace(covariance))
        values, found = largest(covariance, components)
        real = values > NOTHING * one.trace
        one.values, one.components = values[real], found[:, real]
    check = _summed(df, column, lambda length, x: _triangle(made[length].whitened(x)), "double")
    for length, one in made.items():
        size = len(one.values)
        off = _square(check.get(length, {}), size) / one.rows - np.eye(size)
        one.identity_error = float(np.abs(off).max(initial=0.0))
    return made


def whitened(df: DataFrame, id_column: str, column: str, components: int = 8) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), long form.

    One row a vector and component. Vectors that are null or empty or hold null or
    non-finite entries (or entries beyond a long) give no rows; a null id stays, a
    repeated row is one more vector. Vectors of another length are whitened by
    themselves, with their own n. Components without variance give no rows, so equal
    vectors have none. A deviation too large for a long is null. Further columns
    change nothing. No rows give no rows.
    """
    fitted = fit(df, column, components)
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    kind = df.schema[id_column].dataType.simpleString()

    def made(batches):
        for batch in batches:
            for rows, x in vectors(batch.column(1)):
                one = fitted[x.shape[1]]
                size = len(one.values)
                if not size:
                    continue
                each = np.repeat(rows, size)
                columns = [
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(each), one.rows, np.int64)),
                    pa.array([v for v in one.deviations(x) for _ in range(size)], pa.int64()),
                    pa.array(one.whitened(x).ravel()),
                    pa.array(np.tile(one.values / one.trace, len(rows))),
                    pa.array(np.full(len(each), one.identity_error)),
                ]
                ids = batch.column(0).take(pa.array(each))
                yield pa.RecordBatch.from_arrays([ids, *columns], ["id", *names])

    schema = (
        f"id {kind}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    return df.select(id_column, column).mapInArrow(made, schema).withColumnRenamed("id", id_column)
