"""Exact Hamming and Jaccard joins of large query sets: bit blocks by the pigeonhole principle, sets by their size.

Every base row lies in one cell per block of bits (the block's value) and in one cell for its number of set bits.
Two rows within Hamming distance ``r`` are, over ``m`` blocks, within ``r // m`` in some block, and within one less in
all blocks but ``r % m + 1``; a query visits just the cells in that reach, or all cells of sizes within the bound where these hold
fewer rows. A Jaccard distance ``t`` from a set of ``n`` bits means a Hamming distance of at most ``t * n / (1 - t)``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.operators import blocks
from nearfield.session import materialize

ROWS_PER_CELL = 512
MIN_WIDTH, MAX_WIDTH = 4, 12
VISIT_COST = 32  # a visited cell costs about as much as comparing this many rows
CELLS_AT_ONCE = 4_000_000


@dataclass(frozen=True)
class Layout:
    """Blocks of at most ``width`` of ``bits`` bits. Cell ``j << width | value`` is block ``j``; sizes follow behind."""

    bits: int
    width: int

    @property
    def blocks(self) -> int:
        return -(-self.bits // self.width)

    @property
    def cells(self) -> int:
        return self.sizes + self.bits + 1

    @property
    def sizes(self) -> int:
        """The cell of the empty set."""
        return self.blocks << self.width

    def slices(self) -> list[slice]:
        edges = np.linspace(0, self.bits, self.blocks + 1).astype(int)
        return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]

    def matrix(self, column: pa.Array) -> np.ndarray:
        m = blocks.bits(column)
        if len(m) and m.shape[1] != self.bits:
            raise ValueError("binary vectors must have the same length")
        return m

    def values(self, m: np.ndarray) -> np.ndarray:
        """Value of each block of each row."""
        return np.stack([m[:, s] @ (1 << np.arange(s.stop - s.start)) for s in self.slices()], axis=1).astype(np.int64)

    def cells_of(self, m: np.ndarray) -> np.ndarray:
        """All cells of each row: one per block, then its size."""
        own = self.values(m) + (np.arange(self.blocks) << self.width)
        return np.concatenate([own, self.sizes + m.sum(1).astype(np.int64)[:, None]], axis=1)


def choose_layout(bits: int, rows: int) -> Layout:
    """Blocks so wide that a cell holds some hundred rows, within a bound on the number of cells."""
    width = int(np.log2(max(1.0, rows / ROWS_PER_CELL)))
    return Layout(bits, min(max(width, MIN_WIDTH), MAX_WIDTH, bits))


class BlockedBits(blocks.BinaryKernel):
    """A pair that several visited cells share counts in the first of them only."""

    def __init__(self, metric: str, layout: Layout):
        super().__init__(metric)
        self.layout = layout

    def load(self, batch, query):
        m = self.layout.matrix(batch.column("vector"))
        if not query:
            return m, batch.column("number")[0].as_py() if batch.num_rows else 0
        return m, batch.column("reach").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)

    def costs(self, q, b):
        (qm, reach), (bm, number) = q, b
        costs = super().costs(qm, bm)
        for j, s in enumerate(self.layout.slices()[:number]):
            if (reach[:, j] >= 0).any():
                costs[blocks.bit_costs(qm[:, s], bm[:, s], "hamming") <= reach[:, j, None]] = np.inf
        return costs


@dataclass(frozen=True)
class Plan:
    """Which cells a batch of queries visits, from the rows counted per cell."""

    layout: Layout
    counts: np.ndarray
    metric: str

    def distances(self, values: np.ndarray) -> list[np.ndarray]:
        """Per block the distance of each query to every value of the block."""
        ones = np.array([i.bit_count() for i in range(1 << self.layout.width)], np.uint8)
        every = np.arange(1 << self.layout.width)
        return [ones[v[:, None] ^ every[None, :]] for v in values.T]

    def work(self, distances: list[np.ndarray]) -> np.ndarray:
        """(query, block, reach + 1): cost of visiting all cells of the block within the reach."""
        width, out = self.layout.width, []
        for j, d in enumerate(distances):
            held = self.counts[j << width : (j + 1) << width]
            cost = np.where(held > 0, held + VISIT_COST, 0).astype(float)
            place = np.arange(len(d))[:, None] * (width + 2) + d + 1
            flat = np.bincount(place.ravel(), np.broadcast_to(cost, d.shape).ravel(), len(d) * (width + 2))
            out.append(np.cumsum(flat.reshape(len(d), width + 2), axis=1))
        return np.stack(out, axis=1)

    def limits(self, size: np.ndarray, tau: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hamming radius, least and greatest size of rows that can lie within ``tau``."""
        n = self.layout.bits
        if self.metric == "hamming":
            radius = np.floor(np.minimum(tau, n) + 1e-6)
            return radius.astype(np.int64), size - radius, size + radius
        like = 1.0 - np.minimum(tau, 1.0) - 1e-9
        some = like > 0
        like = np.where(some, like, 1.0)
        radius = np.where(some, np.minimum(np.floor((1 - like) * size / like + 1e-6), n), n)
        return radius.astype(np.int64), np.where(some, like * size - 1e-6, 0), np.where(some, size / like + 1e-6, n)

    def first(self, distances: list[np.ndarray], k: int) -> np.ndarray:
        """Reach of a first look: around the query in the block where that takes least, ``k`` rows at least, and its own cell in the others."""
        width = self.layout.width
        work = self.work(distances)
        rows = np.stack([np.stack([np.where(d <= r, self.counts[j << width : (j + 1) << width], 0).sum(1) for r in range(width + 1)], 1)
                         for j, d in enumerate(distances)], axis=1)
        need = np.minimum((rows < k).sum(2), width)
        cost = np.take_along_axis(work, need[:, :, None] + 1, axis=2)[:, :, 0]
        mean = self.counts[: self.layout.sizes].sum() / max(1, np.count_nonzero(self.counts[: self.layout.sizes]))
        reach = np.where(work[:, :, 1] <= 4 * (mean + VISIT_COST), 0, -1)
        best = cost.argmin(1)[:, None]
        np.put_along_axis(reach, best, np.take_along_axis(need, best, axis=1), axis=1)
        return reach

    def within(self, size: np.ndarray, distances: list[np.ndarray], tau: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Reach per block (-1: none) and, for queries that take sizes instead, the sizes to visit."""
        m, width = self.layout.blocks, self.layout.width
        radius, low, high = self.limits(size, tau)
        work = self.work(distances)
        least = np.minimum(radius // m - 1, width)
        at = lambda r: np.take_along_axis(work, np.broadcast_to((r + 1)[:, None, None], (len(r), m, 1)), axis=2)[:, :, 0]
        more = at(np.minimum(least + 1, width)) - at(least)
        # the blocks that must reach one further are those where it takes least
        rank = np.argsort(np.argsort(more, axis=1, kind="stable"), axis=1)
        reach = np.minimum(least[:, None] + (rank <= (radius % m)[:, None]), width)
        by_blocks = np.take_along_axis(work, reach[:, :, None] + 1, axis=2).sum((1, 2))
        every, held = np.arange(self.layout.bits + 1), self.counts[self.layout.sizes :]
        sizes = (every >= low[:, None]) & (every <= high[:, None]) & (held > 0)
        by_size = (sizes * (held + VISIT_COST)).sum(1)
        return np.where((by_blocks < by_size)[:, None], reach, -1), sizes & (by_size <= by_blocks)[:, None]

    def visits(self, distances: list[np.ndarray], reach: np.ndarray, sizes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(query, cell) of every visit."""
        q, cell = [], []
        for j, d in enumerate(distances):
            start = j << self.layout.width
            i, v = np.nonzero((d <= reach[:, j, None]) & (reach[:, j, None] >= 0) & (self.counts[start : start + d.shape[1]] > 0))
            q.append(i), cell.append(v + start)
        if sizes is not None:
            i, v = np.nonzero(sizes)
            q.append(i), cell.append(v + self.layout.sizes)
        return np.concatenate(q), np.concatenate(cell)


def _sliced(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[pa.RecordBatch]:
    rows = max(1, CELLS_AT_ONCE // layout.cells)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def place(base: DataFrame, layout: Layout) -> DataFrame:
    """Every row once per cell it lies in, with the number of its block (the sizes come last)."""
    schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("number", T.IntegerType()), *base.schema.fields])
    each = layout.blocks + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches, layout):
            cell = layout.cells_of(layout.matrix(batch.column("vector")))
            rows = pa.array(np.repeat(np.arange(batch.num_rows), each))
            number = np.tile(np.arange(each), batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(cell.ravel(), pa.int32()), pa.array(number, pa.int32()),
                                              *[c.take(rows) for c in batch.columns]], names=schema.names)

    return base.mapInArrow(run, schema)


def count_cells(base: DataFrame, layout: Layout) -> np.ndarray:
    """Rows per cell; the number of cells is bounded by the layout, so they come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(layout.cells, np.int64)
        for batch in _sliced(batches, layout):
            total += np.bincount(layout.cells_of(layout.matrix(batch.column("vector"))).ravel(), minlength=layout.cells)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(total[cell])], names=["cell", "n"])

    counts = np.zeros(layout.cells, np.int64)
    for row in base.select("vector").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[row["cell"]] = row["n"]
    return counts


def visit(queries: DataFrame, plan: Plan, k: int | None = None) -> DataFrame:
    """One row per query and visited cell; a first look when ``k`` is given, else all that ``tau`` allows."""
    schema = T.StructType([T.StructField("cell", T.IntegerType()), *queries.schema.fields, T.StructField("reach", T.ArrayType(T.ShortType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches, plan.layout):
            m = plan.layout.matrix(batch.column("vector"))
            distances, sizes = plan.distances(plan.layout.values(m)), None
            if k is not None:
                reach = plan.first(distances, k)
            else:
                reach, sizes = plan.within(m.sum(1), distances, batch.column("tau").to_numpy(zero_copy_only=False))
            q, cell = plan.visits(distances, reach, sizes)
            reach = pa.array(list(reach.astype(np.int16)), pa.list_(pa.int16()))
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), *[c.take(pa.array(q)) for c in [*batch.columns, reach]]],
                                             names=schema.names)

    return materialize(queries.mapInArrow(run, schema), "bit-visits")  # read for the counts and for the blocks


def exact_bits(base: DataFrame, queries: DataFrame, k: int, metric: str, key: str, qid: str, options: dict, base_rows: int,
               query_rows: int, layout: Layout | None = None) -> DataFrame:
    """Hits of an exact join in two rounds: a first look gives every query a bound on its k-th cost, then it
    visits the cells that hold all rows within it. With a ``radius`` in the options that is the bound, in one round.

    Ties at the bound are kept; empty sets, repeated rows and fewer than ``k`` rows need no special care.
    """
    base = materialize(base, "bits")
    rows = base.count()
    if rows == 0:
        return blocks.score_blocks(blocks.pair_small_queries(base, queries.limit(0)), blocks.BinaryKernel(metric), k, **options)
    if layout is None:
        layout = choose_layout(8 * base.select(F.octet_length("vector")).first()[0], rows)
    plan, kernel = Plan(layout, count_cells(base, layout), metric), BlockedBits(metric, layout)
    placed, radius = place(base, layout), options.get("radius")

    def score(visits: DataFrame) -> DataFrame:
        return blocks.score_blocks(blocks.pair_cells(placed, visits, key, qid, base_rows, query_rows), kernel, k, **options)

    if radius is not None:
        return score(visit(queries.withColumn("tau", F.lit(float(radius))), plan))
    kth = blocks.best_per(score(visit(queries, plan, k)), [qid], k, ["cost", *[f.name for f in options["keys"]]]).filter(F.col("rank") == k)
    bounded = queries.join(kth.select(qid, F.col("cost").alias("tau")), qid, "left").withColumn("tau", F.coalesce("tau", F.lit(float("inf"))))
    return score(visit(bounded, plan))
