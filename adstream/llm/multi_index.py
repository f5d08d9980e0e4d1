"""Near-duplicate vectors by an inverted multi-index.

Vectors of length one are cut in halves, each half with a codebook of its own; the
pairs of codewords form a grid of cells, and a vector lies in the cell of its two
nearest codewords. A vector visits cells in the order of the multi-sequence
algorithm, by the sum of its distances to the two codewords, as many as reach the
target recall, and is compared in double precision with every vector in them.

Equal vectors are one class. Cells are cut into blocks of bounded size, and so are
their visitors, so a crowded cell is many tasks. A block gives, for each of its
vectors, how many it is linked with, and one link to the smallest vector of its
local component: never its pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adstream.llm.components import components
from adstream.llm.tables import hashed_sample, split_join, stored

#: Pairs of codewords that are put in order at once.
ORDERED = 1 << 22


@dataclass(frozen=True)
class Index:
    """Least cosine, target recall, and the bounds of the samples it is fitted on.

    Codebooks come from ``sample`` vectors. ``queries`` others, each compared with all
    vectors and with a made partner at the least cosine, tell how many cells reach
    ``recall`` of both. ``per_cell`` vectors in a cell are aimed at, with at most
    ``codewords`` in a codebook.
    """

    cosine: float = 0.95
    recall: float = 0.995
    sample: int = 4096
    queries: int = 2048
    per_cell: int = 64
    codewords: int = 512
    rounds: int = 12
    block: int = 1024


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=-1, keepdims=True)


def _matrix(binary, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in binary), np.float64).reshape(-1, size)


def classes(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that can link, the vector as doubles in binary.

    A vector that is null, empty or zero, or holds null or non-finite components, or
    has no id, is left out.
    """

    def packed(batches):
        for batch in batches:
            ids, made = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v = np.array(v, np.float64)
                if np.isfinite(v).all() and v.any():
                    ids.append(i)
                    made.append(v.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(made, pa.binary())], ["vec_id", "vector"]
            )

    known = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where("vec_id is not null and embedding is not null and not exists(embedding, x -> x is null)")
    return known.mapInArrow(packed, "vec_id bigint, vector binary")


def _codebook(half: np.ndarray, size: int, rounds: int) -> np.ndarray:
    """Lloyd's k-means from distinct points; an emptied codeword stays where it is."""
    points = np.unique(half, axis=0)
    book = points[np.random.default_rng(5).permutation(len(points))[:size]].copy()
    for _ in range(rounds):
        near = _distances(half, book).argmin(axis=1)
        count = np.bincount(near, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, near, half)
        book[count > 0] = total[count > 0] / count[count > 0, None]
    return book


def _distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (book**2).sum(1)[None] - 2 * points @ book.T
    return np.maximum(square, 0)


class Grid:
    """The two codebooks and the number of cells that a vector visits."""

    def __init__(self, sample: np.ndarray, size: int, rounds: int):
        self.half = sample.shape[1] // 2
        self.books = [
            _codebook(h, size, rounds) for h in (sample[:, : self.half], sample[:, self.half :])
        ]
        self.cells = 1

    def near(self, unit: np.ndarray) -> list[np.ndarray]:
        return [
            _distances(h, b)
            for h, b in zip((unit[:, : self.half], unit[:, self.half :]), self.books, strict=True)
        ]

    def home(self, unit: np.ndarray) -> np.ndarray:
        one, other = (d.argmin(axis=1) for d in self.near(unit))
        return one * len(self.books[1]) + other

    def places(self, unit: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """How many cells each vector visits until it has seen its given one."""
        one, other = self.near(unit)
        made = np.empty(len(unit), np.int64)
        for k in range(len(unit)):
            total = (one[k][:, None] + other[k][None]).ravel()
            made[k] = np.count_nonzero(total <= total[cell[k]])
        return made

    def visits(self, unit: np.ndarray, cells: int) -> np.ndarray:
        """The nearest cells of each vector in order.

        The t-th cell of the multi-sequence order is the a-th and b-th nearest codeword
        of the halves with a * b <= t, so only such pairs are ordered.
        """
        shape = [len(b) for b in self.books]
        a, b = np.divmod(np.arange(shape[0] * shape[1]), shape[1])
        step = max(1, ORDERED // np.count_nonzero((a + 1) * (b + 1) <= cells))
        parts = [self._visits(unit[k : k + step], cells) for k in range(0, max(len(unit), 1), step)]
        return np.concatenate(parts)

    def _visits(self, unit: np.ndarray, cells: int) -> np.ndarray:
        one, other = self.near(unit)
        rank_one, rank_other = one.argsort(axis=1, kind="stable"), other.argsort(axis=1, kind="stable")
        cells = min(cells, one.shape[1] * other.shape[1])
        a, b = np.divmod(np.arange(one.shape[1] * other.shape[1]), other.shape[1])
        front = (a + 1) * (b + 1) <= cells
        a, b = a[front], b[front]
        rows = np.arange(len(unit))[:, None]
        first, second = rank_one[:, a], rank_other[:, b]
        total = one[rows, first] + other[rows, second]
        order = total.argsort(axis=1, kind="stable")[:, :cells]
        return (first * other.shape[1] + second)[rows, order]


def _partners(unit: np.ndarray, cosine: float) -> np.ndarray:
    """A vector for each, in a random direction and at exactly the given cosine."""
    aside = np.random.default_rng(7).normal(size=unit.shape)
    aside -= (aside * unit).sum(1)[:, None] * unit
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    aside = np.divide(aside, length, out=np.zeros_like(aside), where=length > 1e-9)
    return _unit(cosine * unit + max(0.0, 1 - cosine**2) ** 0.5 * aside)


def _fit(reps: DataFrame, size: int, how: Index) -> Grid:
    """Codebooks, and the cells to visit so that ``how.recall`` of links are seen.

    True links of the queries may be few or none, so the cells also reach as many of
    the partners made for them at the least cosine, the hardest links there can be.
    """
    rows = reps.count()
    sample = hashed_sample(reps.select("rep", "vector"), how.sample, "rep").toPandas()["vector"]
    sample = _unit(np.frombuffer(b"".join(sample), np.float64).reshape(-1, size))
    wanted = max(2, round((rows / how.per_cell) ** 0.5))
    grid = Grid(sample, min(how.codewords, wanted), how.rounds)
    asked = hashed_sample(reps.select("rep", "vector"), how.queries, "rep", draw=1).toPandas()
    asked_ids = asked["rep"].to_numpy(np.int64)
    asked = _unit(np.frombuffer(b"".join(asked["vector"]), np.float64).reshape(-1, size))

    def ranked(batches):
        one, other = grid.near(asked)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            unit = _unit(_matrix(batch.column(1), size))
            q, v = np.nonzero(asked @ unit.T >= how.cosine)
            keep = asked_ids[q] != ids[v]
            q, cell = q[keep], grid.home(unit)[v[keep]]
            place = np.empty(len(q), np.int64)
            for k in np.unique(q):
                total = (one[k][:, None] + other[k][None]).ravel()
                mine = q == k
                place[mine] = np.searchsorted(np.sort(total), total[cell[mine]], side="right")
            yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int64)), pa.array(place)], ["asked", "cells"])

    seen = reps.select("rep", "vector").mapInArrow(ranked, "asked bigint, cells bigint")
    seen = seen.groupBy("asked", "cells").agg(F.count("*").alias("links"))
    share = F.col("links") / F.sum("links").over(Window.partitionBy("asked"))
    seen = seen.select("cells", share.alias("share")).groupBy("cells").agg(F.sum("share").alias("share"))
    seen = seen.toPandas().sort_values("cells")
    if len(seen):
        reached = seen["share"].cumsum() >= how.recall * seen["share"].sum() - 1e-9
        grid.cells = int(seen["cells"][reached].iloc[0])
    made = _partners(asked, how.cosine)
    place = np.sort(grid.places(asked, grid.home(made)))
    grid.cells = max(grid.cells, int(place[int(np.ceil(how.recall * len(place) - 1e-9)) - 1]))
    return grid


def _block_links(ids, units, sizes, others, other_units, other_sizes, back, how):
    """Links of each vector of two blocks, and the smallest of its component in them.

    ``back`` says which (other, own) pairs are also seen from the other side; those
    count for the visitor only here, and for the other one there.
    """
    q, v = np.nonzero(units @ other_units.T >= how.cosine)
    keep = ids[q] != others[v]
    q, v = q[keep], v[keep]
    count, other_count = np.zeros(len(ids), np.int64), np.zeros(len(others), np.int64)
    np.add.at(count, q, other_sizes[v])
    alone = ~back(v, q)
    np.add.at(other_count, v[alone], sizes[q[alone]])
    root, other_root = ids.copy(), others.copy()
    while len(q):
        low = np.minimum(root[q], other_root[v])
        before = root.sum() + other_root.sum()
        np.minimum.at(root, q, low)
        np.minimum.at(other_root, v, low)
        if root.sum() + other_root.sum() == before:
            break
    return count, root, other_count, other_root


def near_duplicates(vectors: DataFrame, how: Index = Index()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each vector, from (vec_id, embedding).

    Vectors link at a cosine of ``how.cosine`` or more; n_links counts other vectors,
    component_id is the smallest vec_id that links reach, kept whether that is the
    vector itself. Vectors that cannot link (see ``classes``) have no links and are
    kept; a null vec_id has no component and is not. Vectors of each dimension have an
    index of their own and link among themselves. Repeated rows are one vector and each
    keep their row. No rows give no rows.
    """
    known = stored(classes(vectors).distinct(), "vectors")
    width = F.octet_length("vector")
    every = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    widths = sorted(r[0] for r in known.select(width).distinct().collect())
    if not widths:
        return every.select(
            "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    parts = [_links(known.where(width == w), w // 8, how) for w in widths]
    found, copies = (reduce(DataFrame.unionByName, some) for some in zip(*parts, strict=True))
    degree = found.groupBy("rep").agg(F.sum("links").alias("links"))
    chains = found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")).distinct()
    graph = chains.unionByName(copies.where("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b")))
    parts = components(graph).withColumnRenamed("node", "vec_id")
    degrees = split_join(copies, degree, ["rep"], "left").groupBy("vec_id").agg(
        F.sum(F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links")
    )
    made = split_join(split_join(every, degrees, ["vec_id"], "left"), parts, ["vec_id"], "left")
    made = made.withColumn("component_id", F.coalesce("component", "vec_id"))
    return made.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def _links(known: DataFrame, size: int, how: Index) -> tuple[DataFrame, DataFrame]:
    """Links of vectors of one dimension, (rep, links, root), and (vec_id, rep, members)."""
    reps = known.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("members"))
    reps = stored(reps, "vector_classes")
    grid = _fit(reps, size, how)

    def placed(batches):
        for batch in batches:
            unit = _unit(_matrix(batch.column(1), size))
            visits = grid.visits(unit, grid.cells)
            home = grid.home(unit)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2),
                    pa.array([u.tobytes() for u in unit], pa.binary()), pa.array(home.astype(np.int64)),
                    pa.array(list(visits.astype(np.int64)), pa.list_(pa.int64())),
                ],
                ["rep", "members", "unit", "home", "visits"],
            )

    index = stored(
        reps.select("rep", "vector", "members").mapInArrow(
            placed, "rep bigint, members bigint, unit binary, home bigint, visits array<bigint>"
        ),
        "multi_index",
    )
    own = index.groupBy(F.col("home").alias("cell")).agg(F.count("*").alias("n"))
    guests = index.select(F.explode("visits").alias("cell")).groupBy("cell").agg(F.count("*").alias("m"))
    # One row a cell of the grid, so at most codewords * codewords.
    cells = stored(
        own.join(guests, "cell").select(
            "cell",
            F.ceil(F.col("n") / how.block).alias("blocks"),
            F.ceil(F.col("m") / how.block).alias("guest_blocks"),
        ),
        "cells",
    )

    def some(of):
        return F.pmod(F.xxhash64("rep"), F.col(of))

    base = split_join(index.withColumnRenamed("home", "cell"), cells, ["cell"]).select(
        "cell", some("blocks").alias("block"), F.explode(F.sequence(F.lit(0), F.col("guest_blocks") - 1)).alias("guest_block"),
        "rep", "members", "unit", "visits",
    )
    guest = split_join(
        index.select("rep", "members", "unit", "home", F.explode("visits").alias("cell")), cells, ["cell"]
    ).select(
        F.col("cell").alias("at_cell"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at_block"),
        some("guest_blocks").alias("own_block"),
        *[F.col(c).alias(f"guest_{c}") for c in ("rep", "members", "unit", "home")],
    )
    keys = ["cell", "block", "guest_block"]

    def linked(guests: pa.Table, owners: pa.Table) -> pa.Table:
        ids, sizes = (guests.column(f"guest_{c}").to_numpy() for c in ("rep", "members"))
        others, other_sizes = (owners.column(c).to_numpy() for c in ("rep", "members"))
        home = guests.column("guest_home").to_numpy()
        seen = owners.column("visits").to_pylist()

        def back(v, q):
            table = np.array(seen, np.int64).reshape(len(others), -1)
            return (table[v] == home[q][:, None]).any(axis=1)

        units = _matrix(guests.column("guest_unit"), size)
        other_units = _matrix(owners.column("unit"), size)
        count, root, other_count, other_root = _block_links(
            ids, units, sizes, others, other_units, other_sizes, back, how
        )
        made = pa.table({
            "rep": np.concatenate([ids, others]),
            "links": np.concatenate([count, other_count]),
            "root": np.concatenate([root, other_root]),
        })
        return made.filter(pa.array(np.concatenate([(count > 0) | (root != ids), (other_count > 0) | (other_root != others)])))

    found = (
        guest.groupBy("at_cell", "at_block", "own_block")
        .cogroup(base.groupBy(*keys))
        .applyInArrow(linked, "rep bigint, links bigint, root bigint")
    )
    found = stored(found, "vector_links")
    copies = split_join(known, reps, ["vector"]).select("vec_id", "rep", "members")
    return found, stored(copies, "vector_copies")
