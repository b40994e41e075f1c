"""Cell-based search: pruned exact joins, and inverted-file search with plain, 8-bit and product codes.

A model (pivots, centroids, code books, value ranges) is bounded by its parameters and lives on the
driver; rows never do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.operators import blocks
from nearfield.session import materialize

MAX_CELLS = 16_384
JUDGED_QUERIES = 256
DISTANCES_AT_ONCE = 4_000_000


# ---------------------------------------------------------------- assignment


def _squared(m: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum(blocks.squared_distances(m, centers), 0.0)


def _matrix(column: pa.Array, cosine: bool) -> np.ndarray:
    m = blocks.dense(column)
    return blocks.unit(m) if cosine else m


def _slices(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[pa.RecordBatch]:
    """Non-empty batches, cut so that rows times cells stays within 4 million distances (32 MB)."""
    rows = max(1, DISTANCES_AT_ONCE // max(1, cells))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def assign_cells(df: DataFrame, centers: np.ndarray, cosine: bool = False, vector: str = "vector") -> DataFrame:
    """Add ``cell`` (nearest centre) and ``radius`` (distance to it); no shuffle."""
    schema = T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("radius", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, len(centers)):
            m = _matrix(batch.column(vector), cosine)
            cell = _squared(m, centers).argmin(axis=1)
            diff = m - centers[cell]
            radius = np.sqrt(np.sum(diff * diff, axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(radius)], names=schema.names)

    return df.mapInArrow(run, schema)


def probe_cells(queries: DataFrame, centers: np.ndarray, nprobe: int, cosine: bool = False) -> DataFrame:
    """One row per query and probed cell: the ``nprobe`` nearest centres."""
    schema = T.StructType([T.StructField("cell", T.IntegerType()), *queries.schema.fields])
    n = min(nprobe, len(centers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, len(centers)):
            d = _squared(_matrix(batch.column("vector"), cosine), centers)
            near = np.argsort(d, axis=1, kind="stable")[:, :n]
            rows = pa.array(np.repeat(np.arange(batch.num_rows), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(near.ravel(), pa.int32()), *[c.take(rows) for c in batch.columns]], names=schema.names)

    return queries.mapInArrow(run, schema)


# ---------------------------------------------------------------- exact search with pruning


def pick_pivots(base: DataFrame, key: str, n: int, cosine: bool) -> np.ndarray:
    """``n`` rows in hash order of their key; any choice keeps the search exact."""
    if n > MAX_CELLS:
        raise ValueError(f"at most {MAX_CELLS} cells")
    rows = base.orderBy(F.xxhash64(key), key).select("vector").limit(n).collect()
    m = np.array([r[0] for r in rows], dtype=np.float64)
    return blocks.unit(m) if cosine else m


def exact_cells(base: DataFrame, queries: DataFrame, k: int, kernel: blocks.Kernel, metric: str, key: str, qid: str,
                options: dict, base_rows: int, query_rows: int, n_pivots: int | None = None,
                grid: tuple[int, int] | None = None, judge: bool = False) -> DataFrame:
    """Exact nearest-neighbour join after Lu et al. 2012: rows lie in cells around pivots.

    Round one searches the nearest cells that hold ``k`` rows and gives every query an upper bound
    on its k-th cost. Round two visits just the cells whose best possible cost is within it.
    With a ``radius`` in the options it is the bound of every query, and one round visits the cells that can lie within it.

    Where the bounds leave so many cells that visiting them would move more rows than a ``grid`` of that shape, the
    queries meet the table on the grid, with the bounds found so far. ``judge`` looks at some queries before round one
    and leaves it out where the grid is to be expected; the answer is the same either way.
    """
    cosine, radius = metric == "cosine", options.get("radius")
    if n_pivots is None:
        n_pivots = int(min(MAX_CELLS, max(16, base.count() ** 0.5 / 4)))
    pivots = pick_pivots(base, key, n_pivots, cosine)
    if len(pivots) == 0:
        return blocks.score_blocks(blocks.pair_small_queries(base, queries.limit(0)), kernel, k, **options)
    placed = assign_cells(base, pivots, cosine)
    stats = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("radius").alias("r")).collect()
    counts, radii = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for row in stats:
        counts[row["cell"]], radii[row["cell"]] = row["n"], row["r"]

    def bounds(m: np.ndarray) -> np.ndarray:
        """Lowest cost any member of a cell can have."""
        if metric == "ip":
            norms = np.sqrt(np.einsum("ij,ij->i", m, m))
            return -(m @ pivots.T) - norms[:, None] * (radii * (1 + 1e-9) + 1e-9 * np.sqrt(np.square(pivots).sum(1)))[None, :]
        c, p = blocks.centred(m, pivots)
        error = blocks.rounding(c, p, 1.0) * (np.square(c).sum(1)[:, None] + np.square(p).sum(1)[None, :])
        low = np.maximum(np.sqrt(np.maximum(_squared(m, pivots) - error, 0.0)) - radii[None, :] * (1 + 1e-9), 0.0)
        if metric == "l2":
            return low
        # unit vectors: cost = -cos = d^2/2 - 1; a zero row or query costs 0, never less than this
        return low * low / 2 - 1

    def slack(tau: np.ndarray) -> np.ndarray:
        return 1e-6 * (1 + np.abs(np.where(np.isfinite(tau), tau, 0.0)))

    def chosen(batch: pa.RecordBatch, first: bool) -> np.ndarray:
        """(query, cell): whether the query visits the cell in this round."""
        m = _matrix(batch.column("vector"), cosine)
        d = np.where(counts[None, :] > 0, _squared(m, pivots), np.inf)
        order = np.argsort(d, axis=1, kind="stable")
        reached = np.cumsum(counts[order], axis=1)
        need = (reached - counts[order]) < k
        home = np.zeros_like(need)
        np.put_along_axis(home, order, need, axis=1)
        home &= counts[None, :] > 0
        if first:
            return home
        tau = np.full(batch.num_rows, radius) if radius is not None else batch.column("tau").to_numpy(zero_copy_only=False)
        home = home & (radius is None)
        return (bounds(m) <= tau[:, None] + slack(tau)[:, None]) & ~home & (counts > 0)[None, :]

    def visit(source: DataFrame, first: bool) -> DataFrame:
        plain = [f for f in source.schema.fields if f.name != "home"]
        schema = T.StructType([T.StructField("cell", T.IntegerType()), *plain])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches, len(pivots)):
                qi, cell = np.nonzero(chosen(batch, first))
                take = pa.array(qi)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int32()), *[batch.column(f.name).take(take) for f in plain]], names=schema.names)

        return materialize(source.mapInArrow(run, schema), "visits")  # read for the counts and for the blocks

    def visits(source: DataFrame) -> int:
        """How many rows ``visit`` of the last round would write."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches, len(pivots)):
                yield pa.RecordBatch.from_arrays([pa.array([int(chosen(batch, False).sum())])], names=["n"])

        return source.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0

    def kth_cost(hits: DataFrame, source: DataFrame) -> DataFrame:
        """The queries with the cost of their k-th hit."""
        kth = blocks.best_per(hits, [qid], k, ["cost", *[f.name for f in options["keys"]]]).filter(F.col("rank") == k)
        return source.join(kth.select(qid, F.col("cost").alias("tau")), qid, "left").select(
            *queries.columns, F.coalesce("tau", F.lit(float("inf"))).alias("tau"))

    def on_grid(source: DataFrame) -> DataFrame:
        # a query with a null or NaN has no hits; in a block it would make every cost NaN
        whole = source.filter(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)))
        pairs = blocks.pair_grid(base, whole, key, qid, grid, base_rows, query_rows)
        return blocks.score_blocks(pairs, kernel, k, **options)

    moved = float("inf")
    if grid is not None and not np.isnan(radii).any():  # base rows with a null or NaN stay in cells of their own
        n_query = queries.count()
        moved = int(counts.sum()) * grid[1] + n_query * grid[0]
    if judge and radius is None and np.isfinite(moved) and n_query:
        some = materialize(queries.orderBy(F.xxhash64(qid)).limit(JUDGED_QUERIES), "judged")
        hits = blocks.score_blocks(blocks.pair_small_queries(base, some, base_rows, query_rows), kernel, k, **options)
        if visits(kth_cost(hits, some)) * n_query / min(n_query, JUDGED_QUERIES) > moved:
            return on_grid(queries)
    if radius is not None and visits(queries) > moved:
        return on_grid(queries)
    rows = materialize(placed.drop("radius"), "cells").select("cell", *base.columns)
    if radius is not None:
        return blocks.score_blocks(blocks.pair_cells(rows, visit(queries, False), key, qid, base_rows, query_rows), kernel, k, **options)
    near = blocks.pair_cells(rows, visit(queries, True), key, qid, base_rows, query_rows)
    found = materialize(blocks.score_blocks(near, kernel, k, **options), "near-hits")
    bounded = materialize(kth_cost(found, queries), "bounded")
    if visits(bounded) > moved:
        return on_grid(bounded)  # meets the first cells again, so their hits are not added
    far = blocks.pair_cells(rows, visit(bounded, False), key, qid, base_rows, query_rows)
    return found.unionByName(blocks.score_blocks(far, kernel, k, **options))


# ---------------------------------------------------------------- inverted file


@dataclass(frozen=True)
class CellIndex:
    """Rows assigned to k-means cells, with the model that assigned them."""

    rows: DataFrame
    centers: np.ndarray
    metric: str
    id: str

    @property
    def cosine(self) -> bool:
        return self.metric == "cosine"


def train_centers(df: DataFrame, n: int, key: str, seed: int = 7, iterations: int = 10, vector: str = "vector") -> np.ndarray:
    """k-means centres fitted on all rows, where they lie; the key keeps its order within a partition fixed."""
    points = df.sortWithinPartitions(key).select(array_to_vector(F.col(vector)).alias("features"))
    model = KMeans(k=n, seed=seed, maxIter=iterations, initMode="random").fit(points)
    return np.array(model.clusterCenters(), dtype=np.float64)


def _unit_column(df: DataFrame) -> DataFrame:
    from nearfield.functions.vectors import normalize

    return df.withColumn("vector", normalize("vector"))


def build_cells(base: DataFrame, nlist: int = 1024, metric: str = "l2", *, id: str = "id", vector: str = "vector",
                seed: int = 7) -> CellIndex:
    """Train ``nlist`` cells on all rows and assign every row."""
    if not 1 <= nlist <= MAX_CELLS:
        raise ValueError(f"nlist must be between 1 and {MAX_CELLS}")
    rows = base.select(id, F.col(vector).alias("vector")).filter(F.col("vector").isNotNull())
    centers = train_centers(_unit_column(rows) if metric == "cosine" else rows, nlist, id, seed)
    placed = assign_cells(rows, centers, metric == "cosine").drop("radius")
    return CellIndex(materialize(placed, "ivf"), centers, metric, id)


def save_cells(index: CellIndex, path: str) -> None:
    """Write the assigned rows with one folder per cell; a probe then reads only its cells."""
    index.rows.write.partitionBy("cell").parquet(path)


def _probed(index: CellIndex, queries: DataFrame, qid: str, query_vector: str, nprobe: int) -> DataFrame:
    q = queries.select(qid, F.col(query_vector).alias("vector"))
    return probe_cells(q, index.centers, nprobe, index.cosine)


def _ranked(hits: DataFrame, qid: str, id: str, k: int, metric: str) -> DataFrame:
    from nearfield.operators.search import score_of

    return blocks.best_per(hits, [qid], k, ["cost", id]).select(qid, "rank", id, score_of(metric))


def near_cells(asked: DataFrame, centers: np.ndarray, nprobe: int, cosine: bool = False, drop: tuple[str, ...] = ()) -> DataFrame:
    """Each query with ``near``, its ``nprobe`` nearest cells in order."""
    keep = [f for f in asked.schema.fields if f.name not in drop]
    schema = T.StructType([*keep, T.StructField("near", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, len(centers)):
            d = _squared(_matrix(batch.column("vector"), cosine), centers)
            near = np.argsort(d, axis=1, kind="stable")[:, :nprobe].astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array((np.arange(len(near) + 1) * near.shape[1]).astype(np.int32)), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in keep], column], names=schema.names)

    return asked.mapInArrow(run, schema)


def grid_hits(rows: DataFrame, near: DataFrame, kernel: blocks.Kernel, metric: str, n_cells: int, k: int, nprobes: Sequence[int], shape: tuple[int, int],
              id: str, qid: str, final: int = 0) -> DataFrame:
    """Best hits ``(qid, id, cell, probe, cost)`` of queries with their ``near`` cells among rows ``(id, cell, …)``, both sides of any size.

    Both sides are dealt over a grid of tasks, whose base rows come cell by cell; where all cells are probed the rows of several meet the
    queries together. A task gives at most ``k`` rows per query and step of ``nprobes`` (the probes that one setting has more than the one before).
    With ``final`` rows carry ``vector`` and a hit has ``exact``, its cost on raw vectors, so that no vector moves with a hit; a task that sees
    all rows then gives just the ``final`` best of them by that cost.
    """
    steps = np.array(sorted(set(nprobes)))
    every = steps.tolist() == [n_cells]  # each query meets all rows, whatever their cells
    # rows of one cell are few, so more queries meet them at once
    cut = {} if every else {"cell": "cell", "base_rows": max(1, blocks.BASE_ROWS // 2), "query_rows": 8 * blocks.QUERY_ROWS}
    grid = blocks.pair_grid(rows, near, id, qid, shape, **cut)
    schema = T.StructType([near.schema[qid], rows.schema[id], T.StructField("cell", T.IntegerType()), T.StructField("probe", T.IntegerType()),
                           *([T.StructField("exact", T.DoubleType())] if final else []), T.StructField("cost", T.DoubleType())])
    base_rows, query_rows = grid.base_rows, grid.query_rows
    plain = blocks.DenseKernel(metric)

    def kept_of(query: pa.RecordBatch) -> blocks.Kept:
        return blocks.Kept(k, [id], np.full(query.num_rows * len(steps), np.inf))

    def opened(query: pa.RecordBatch):
        near = np.array(query.column("near").to_pylist(), np.int64).reshape(query.num_rows, -1)
        rank = np.tile(np.arange(1, near.shape[1] + 1), len(near))
        order = np.argsort(near.ravel(), kind="stable")
        sides = query, kernel.load(query, True), plain.load(query, True) if final else None
        if every:
            order, rank = np.argsort(near, axis=1), rank.reshape(near.shape)
            return *sides, None, None, np.take_along_axis(rank, order, axis=1), kept_of(query)
        return *sides, near.ravel()[order], order // near.shape[1], rank[order], kept_of(query)

    def score(cell: int, pieces: list[pa.RecordBatch], sides: list) -> None:
        for part in blocks._cut(pieces, base_rows):
            b, whole = kernel.load(part, False), plain.load(part, False) if final else None
            for query, loaded, vectors, cell_of, query_of, rank_of, kept in sides:
                if every:
                    qi, bi, cost = blocks.score_pair(kernel, loaded, b, part, k, kept.tau, [id], kept=kept)
                    asks, who = qi, qi
                    rank = rank_of[qi, part.column("cell").to_numpy()[bi]]
                else:
                    low, high = np.searchsorted(cell_of, [cell, cell + 1])
                    if low == high:
                        continue
                    own, rank = query_of[low:high], rank_of[low:high]
                    who = own * len(steps) + np.searchsorted(steps, rank)
                    qi, bi, cost = blocks.score_pair(kernel, loaded[own], b, part, k, kept.tau[who], [id], kept=kept)
                    asks, who, rank = own[qi], who[qi], rank[qi]
                if not len(qi):
                    continue
                columns = [query.column(qid).take(pa.array(asks)), part.column(id).take(pa.array(bi)), part.column("cell").take(pa.array(bi)), pa.array(rank.astype(np.int32))]
                if final:
                    columns.append(pa.array(plain.exact(vectors, whole, asks, bi, None) + 0.0))
                kept.add(who, pa.RecordBatch.from_arrays([*columns, pa.array(cost)], names=schema.names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, cell, waiting, sides = None, None, [], None

        def end() -> Iterator[pa.RecordBatch]:
            if sides:
                score(cell, waiting, sides)
                for side in sides:
                    yield from side[-1].give(final if shape[0] == 1 else 0)

        for batch in batches:
            for at, side, own, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "side", "cell")), batch.column("payload")):
                if at != part:
                    yield from end()
                    part, cell, waiting, sides = at, None, [], None
                if side and sides is None:
                    sides, waiting, cell = [opened(q) for q in blocks._cut(waiting, query_rows)], [], own
                if side and (own != cell or sum(b.num_rows for b in waiting) >= base_rows):
                    score(cell, waiting, sides)
                    cell, waiting = own, []
                waiting.append(blocks.decode(payload.as_buffer()))
        yield from end()

    return grid.packed.mapInArrow(run, schema)


def _on_grid(index: CellIndex, rows: DataFrame, kernel: blocks.Kernel, queries: DataFrame, k: int, nprobe: int, qid: str, query_vector: str,
             final: int = 0) -> DataFrame | None:
    """Hits of a query side of any size; nothing where it is counted small."""
    from nearfield.operators.search import cost_bytes, grid_of, query_volume

    asked = queries.select(qid, F.col(query_vector).alias("vector"))
    if query_volume(asked, cost_bytes("vector", "l2"))[1]:
        return None
    nprobe = min(nprobe, len(index.centers))
    near = near_cells(asked, index.centers, nprobe, index.cosine)
    shape = grid_of(rows, near, cost_bytes("vector", "l2"), k, whole=final > 0)
    return grid_hits(rows, near, kernel, index.metric, len(index.centers), k, [nprobe], shape, index.id, qid, final)


def ivf_search(index: CellIndex, queries: DataFrame, k: int, nprobe: int = 16, *, qid: str = "qid",
               query_vector: str = "vector") -> DataFrame:
    """Search the ``nprobe`` nearest cells of each query; exact when all cells are probed.

    A query side that is not small meets the cells on a grid of tasks, each of which keeps the best hits of its queries over all cells.
    """
    hits = _on_grid(index, index.rows.select(index.id, "cell", "vector"), blocks.DenseKernel(index.metric), queries, k, nprobe, qid, query_vector)
    if hits is not None:
        return _ranked(hits, qid, index.id, k, index.metric)
    probes = _probed(index, queries, qid, query_vector, nprobe)
    pairs = blocks.pair_cells(index.rows.select("cell", index.id, "vector"), probes, index.id, qid)
    hits = blocks.score_blocks(pairs, blocks.DenseKernel(index.metric), k, [index.rows.schema[index.id]], queries.schema[qid])
    return _ranked(hits, qid, index.id, k, index.metric)


def _rerank(hits: DataFrame, index: CellIndex, queries: DataFrame, k: int, qid: str, query_vector: str) -> DataFrame:
    """Score the short list on raw vectors: two equi-joins and a Column expression."""
    from nearfield.functions.vectors import cost_column

    pairs = hits.select(qid, index.id).join(index.rows.select(index.id, F.col("vector").alias("__b")), index.id)
    pairs = pairs.join(queries.select(qid, F.col(query_vector).alias("__q")), qid)
    exact = pairs.select(qid, index.id, cost_column("__q", "__b", index.metric).alias("cost"))
    return _ranked(exact, qid, index.id, k, index.metric)


class ScalarCodeKernel(blocks.DenseKernel):
    """Base vectors stored as one byte per dimension."""

    def __init__(self, metric: str, low: np.ndarray, step: np.ndarray):
        super().__init__(metric)
        self.low, self.step = low, step

    def load(self, batch, query):
        if query:
            return super().load(batch, True)
        m = blocks.bytes_matrix(batch.column("code"), np.uint8) * self.step + self.low
        return blocks.unit(m) if self.metric == "cosine" else m


def sq8_ranges(rows: DataFrame, vector: str = "vector") -> tuple[np.ndarray, np.ndarray]:
    """Per-dimension minimum and maximum: one partial row per batch, then one small aggregate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = blocks.dense(batch.column(vector))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(m.shape[1])), pa.array(m.min(0)), pa.array(m.max(0))], names=["d", "lo", "hi"])

    parts = rows.select(vector).mapInArrow(run, "d long, lo double, hi double")
    dims = parts.groupBy("d").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("d").collect()
    return np.array([r["lo"] for r in dims]), np.array([r["hi"] for r in dims])


def scalar_codes(m: np.ndarray, low: np.ndarray, step: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((m - low) / step), 0, 255).astype(np.uint8)


def product_codes(m: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    """Number of the nearest centre in each sub-space."""
    start, codes = 0, []
    for book in books:
        codes.append(_squared(m[:, start : start + book.shape[1]], book).argmin(1).astype(np.uint16))
        start += book.shape[1]
    return np.stack(codes, axis=1)


def sq8_encode(rows: DataFrame, low: np.ndarray, step: np.ndarray) -> DataFrame:
    """Replace ``vector`` by a binary ``code`` of one byte per dimension."""
    keep = [f for f in rows.schema.fields if f.name != "vector"]
    schema = T.StructType([*keep, T.StructField("code", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = blocks.dense(batch.column("vector"))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(f.name) for f in keep], blocks.bytes_column(scalar_codes(m, low, step))], names=schema.names)

    return rows.mapInArrow(run, schema)


def sq8_search(index: CellIndex, queries: DataFrame, k: int, nprobe: int = 16, *, refine: int = 4, qid: str = "qid",
               query_vector: str = "vector") -> DataFrame:
    """Rank on 8-bit codes inside the probed cells, then score ``k * refine`` rows on raw vectors."""
    low, high = sq8_ranges(index.rows)
    step = np.where(high > low, (high - low) / 255.0, 1.0)
    coded = sq8_encode(index.rows.select("cell", index.id, "vector"), low, step)
    probes = _probed(index, queries, qid, query_vector, nprobe)
    pairs = blocks.pair_cells(coded, probes, index.id, qid)
    kernel = ScalarCodeKernel(index.metric, low, step)
    hits = blocks.score_blocks(pairs, kernel, k * refine, [index.rows.schema[index.id]], queries.schema[qid])
    short = blocks.best_per(hits, [qid], k * refine, ["cost", index.id])
    return _rerank(short, index, queries, k, qid, query_vector)


class ProductCodeKernel(blocks.Kernel):
    """Base vectors stored as one code per sub-space; distances come from per-query tables."""

    def __init__(self, metric: str, books: list[np.ndarray]):
        self.metric, self.books = metric, books
        self.last: tuple = (None, None)

    def load(self, batch, query):
        if query:
            return _matrix(batch.column("vector"), self.metric == "cosine")
        return blocks.bytes_matrix(batch.column("code"), np.uint16)

    def tables(self, q: np.ndarray) -> Iterator[np.ndarray]:
        """Per sub-space the cost of each query with each centre."""
        start = 0
        for book in self.books:
            piece = q[:, start : start + book.shape[1]]
            yield _squared(piece, book) if self.metric == "l2" else -(piece @ book.T)
            start += book.shape[1]

    def costs(self, q, b):
        total = np.zeros((len(q), len(b)))
        for part, table in enumerate(self.tables(q)):
            total += table[:, b[:, part]]
        return total

    def factors(self, q, b):
        """With what the codes stand for, the centres of their sub-spaces side by side."""
        last, decoded = self.last
        if last is not b:  # a base block meets one query block after the other
            decoded = np.concatenate([book[b[:, part]] for part, book in enumerate(self.books)], axis=1)
            self.last = b, decoded
        return blocks.dense_factors(q, decoded, self.metric)

    def exact(self, q, b, qi, bi, costs):
        out = np.zeros(len(qi))
        for part, table in enumerate(self.tables(q)):
            out += table.ravel()[qi * table.shape[1] + b[:, part].astype(np.int64)[bi]]
        return out


def pq_books(rows: DataFrame, dim: int, m: int, nbits: int, key: str, seed: int = 7, rounds: int = 5) -> list[np.ndarray]:
    """One code book of ``2**nbits`` centres per sub-space, all fitted together: a pass over all rows per round.

    The books start from rows in hash order of their key. A task adds up its rows per centre; a centre without rows stays.
    """
    if dim % m:
        raise ValueError("the dimension must be a multiple of m")
    if not 1 <= nbits <= 16:
        raise ValueError("nbits must be between 1 and 16")
    width, size = dim // m, 2**nbits
    first = rows.orderBy(F.xxhash64(key, F.lit(seed)), key).select("vector").limit(size).collect()
    if not first:
        return [np.zeros((size, width))] * m
    start = np.array([r[0] for r in first], np.float64)[np.arange(size) % len(first)]
    books = [np.ascontiguousarray(start[:, p * width : (p + 1) * width]) for p in range(m)]
    names = [f"s{d}" for d in range(width)]

    def sums(books: list[np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, many = np.zeros((m * size, width)), np.zeros(m * size, np.int64)
            for batch in _slices(batches, size):
                mat = blocks.dense(batch.column("vector"))
                at = product_codes(mat, books).astype(np.int64) + np.arange(m) * size
                parts = mat.reshape(-1, width)
                for d in range(width):
                    total[:, d] += np.bincount(at.ravel(), weights=parts[:, d], minlength=len(total))
                many += np.bincount(at.ravel(), minlength=len(many))
            own = np.flatnonzero(many)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(many[own]), *[pa.array(total[own, d]) for d in range(width)]], names=["at", "n", *names])

        return run

    for _ in range(rounds):
        parts = rows.select("vector").mapInArrow(sums(books), "at long, n long, " + ", ".join(f"{n} double" for n in names))
        added = parts.groupBy("at").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).toPandas()
        books = [b.copy() for b in books]
        for r in added.itertuples(index=False):
            books[r.at // size][r.at % size] = np.array(r[2:]) / r.n
    return books


def pq_encode(rows: DataFrame, books: list[np.ndarray], cosine: bool = False, raw: bool = False) -> DataFrame:
    """Replace ``vector`` (with ``raw``, add to it) by a binary ``code``, two bytes per sub-space."""
    keep = [f for f in rows.schema.fields if raw or f.name != "vector"]
    schema = T.StructType([*keep, T.StructField("code", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, max(len(book) for book in books)):
            codes = product_codes(_matrix(batch.column("vector"), cosine), books)
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in keep], blocks.bytes_column(codes)], names=schema.names)

    return rows.mapInArrow(run, schema)


def pq_search(index: CellIndex, queries: DataFrame, k: int, nprobe: int = 16, *, m: int = 4, nbits: int = 8,
              refine: int = 8, qid: str = "qid", query_vector: str = "vector") -> DataFrame:
    """Rank on product codes (Jégou et al. 2011) inside the probed cells, then on raw vectors.

    A query side that is not small meets the cells on a grid of tasks, and its hits carry their cost on raw vectors.
    """
    rows = index.rows.select(index.id, "vector")
    books = pq_books(_unit_column(rows) if index.cosine else rows, index.centers.shape[1], m, nbits, index.id)
    whole = pq_encode(index.rows.select("cell", index.id, "vector"), books, index.cosine, raw=True)
    hits = _on_grid(index, whole, ProductCodeKernel(index.metric, books), queries, k * refine, nprobe, qid, query_vector, final=k)
    if hits is not None:
        short = blocks.best_per(hits, [qid], k * refine, ["cost", index.id])
        return _ranked(short.select(qid, index.id, F.col("exact").alias("cost")), qid, index.id, k, index.metric)
    coded = pq_encode(index.rows.select("cell", index.id, "vector"), books, index.cosine)
    probes = _probed(index, queries, qid, query_vector, nprobe)
    pairs = blocks.pair_cells(coded, probes, index.id, qid)
    kernel = ProductCodeKernel(index.metric, books)
    hits = blocks.score_blocks(pairs, kernel, k * refine, [index.rows.schema[index.id]], queries.schema[qid])
    short = blocks.best_per(hits, [qid], k * refine, ["cost", index.id])
    return _rerank(short, index, queries, k, qid, query_vector)


def binary_ivf_search(base: DataFrame, queries: DataFrame, k: int, metric: str = "hamming", nlist: int = 1024,
                      nprobe: int = 16, *, id: str = "id", vector: str = "bits", qid: str = "qid",
                      query_vector: str | None = None) -> DataFrame:
    """Cells of packed binary vectors: k-means on the unpacked bits, then exact bit distances inside."""
    from nearfield.functions.vectors import unpack_bits

    rows = unpack_bits(base.select(id, F.col(vector).alias("bits")).filter(F.col("bits").isNotNull()), "bits", "vector")
    q = queries.select(qid, F.col(query_vector or vector).alias("bits")).filter(F.col("bits").isNotNull())
    q = unpack_bits(q, "bits", "vector")
    centers = train_centers(rows, nlist, id)
    placed = materialize(assign_cells(rows, centers).drop("radius", "vector"), "bin-ivf")
    probes = probe_cells(q, centers, nprobe).drop("vector")
    kernel = blocks.BinaryKernel(metric)
    kernel.column = kernel.query_column = "bits"
    pairs = blocks.pair_cells(placed.select("cell", id, "bits"), probes, id, qid)
    hits = blocks.score_blocks(pairs, kernel, k, [base.schema[id]], queries.schema[qid])
    return _ranked(hits, qid, id, k, metric)


def auto_search(base: DataFrame, queries: DataFrame, k: int, metric: str = "l2", *, index: CellIndex | None = None,
                id: str = "id", vector: str = "vector", qid: str = "qid", query_vector: str | None = None,
                nprobe: int = 16) -> DataFrame:
    """Exact, whatever the size; only an ``index`` named by the caller makes it a search of probed cells."""
    from nearfield.operators.search import knn

    if index is not None:
        return ivf_search(index, queries, k, nprobe, qid=qid, query_vector=query_vector or vector)
    return knn(base, queries, k, metric, id=id, vector=vector, qid=qid, query_vector=query_vector)
