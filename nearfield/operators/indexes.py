"""A stored cell index: built once, opened by searches that read only the folders of the cells they probe.

An index is a folder: ``rows`` (one sub-folder per cell, with ids, vectors, codes and attributes), ``model`` (centres, value ranges, code books)
and ``meta``, which is written last, so a build that stopped half-way does not open. Kinds: ``flat`` (raw vectors), ``sq8`` (one byte per dimension),
``pq`` (one number per sub-space) and ``binary`` (packed bits). Searches on codes rank the nearest ``k * refine`` rows again on raw vectors.

A query side that is counted small is sent to the tasks with its probes, and the probed cells are scanned where they lie, without a shuffle of
the index; a cell of any size is as many tasks as its files have splits. A larger query side meets the cells on a grid of tasks, each
of which keeps the best hits of its queries over all cells. The model is bounded by ``nlist``, ``m`` and ``nbits``; rows never come to the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.operators import blocks, cells
from nearfield.session import broadcast_if_small

KINDS = ("flat", "sq8", "pq", "binary")
PROBE_PAIRS = 2_000_000  # (query, cell) pairs that are sent to the tasks at most


@dataclass(frozen=True)
class StoredIndex:
    """An opened index. ``rows`` is read lazily; ``centers`` and ``arrays`` are the model."""

    spark: SparkSession
    path: str
    kind: str
    metric: str
    id: str
    centers: np.ndarray
    arrays: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    @property
    def cosine(self) -> bool:
        return self.metric == "cosine" and self.kind != "binary"

    @property
    def column(self) -> str:
        """What the cells are scanned by."""
        return {"flat": "vector", "binary": "bits"}.get(self.kind, "code")

    @property
    def books(self) -> list[np.ndarray]:
        return [self.arrays[f"book{i}"] for i in range(sum(n.startswith("book") for n in self.arrays))]

    def kernel(self) -> blocks.Kernel:
        if self.kind == "sq8":
            return cells.ScalarCodeKernel(self.metric, self.arrays["low"][0], self.arrays["step"][0])
        if self.kind == "pq":
            return cells.ProductCodeKernel(self.metric, self.books)
        if self.kind == "binary":
            kernel = blocks.BinaryKernel(self.metric)
            kernel.column = kernel.query_column = "bits"
            return kernel
        return blocks.DenseKernel(self.metric)

    def encoded(self, rows: DataFrame) -> DataFrame:
        """Rows (id, vector or bits, attributes) with ``cell`` and, for the coded kinds, ``code``."""
        source = rows
        if self.kind == "binary":
            from nearfield.functions.vectors import unpack_bits

            source = unpack_bits(rows, "bits", "vector")
        placed = cells.assign_cells(source, self.centers, self.cosine).drop("radius")
        if self.kind == "binary":
            return placed.drop("vector")
        if self.kind == "flat":
            return placed
        kind, cosine, arrays, books = self.kind, self.cosine, self.arrays, self.books
        schema = T.StructType([*placed.schema.fields, T.StructField("code", T.BinaryType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in cells._slices(batches, max((len(b) for b in books), default=1)):
                if kind == "sq8":
                    codes = cells.scalar_codes(blocks.dense(batch.column("vector")), arrays["low"][0], arrays["step"][0])
                else:
                    codes = cells.product_codes(cells._matrix(batch.column("vector"), cosine), books)
                yield pa.RecordBatch.from_arrays([*batch.columns, blocks.bytes_column(codes)], names=schema.names)

        return placed.mapInArrow(run, schema)


def _source(base: DataFrame, kind: str, id: str, vector: str | None, attributes: Sequence[str]) -> DataFrame:
    name = "bits" if kind == "binary" else "vector"
    return base.select(id, F.col(vector or name).alias(name), *attributes).filter(F.col(name).isNotNull())


def build_index(base: DataFrame, path: str, kind: str = "flat", *, nlist: int = 1024, metric: str | None = None, id: str = "id",
                vector: str | None = None, attributes: Sequence[str] = (), m: int = 4, nbits: int = 8, centers: np.ndarray | None = None,
                seed: int = 7) -> StoredIndex:
    """Train the model on all rows, write the index to an empty ``path`` and open it.

    ``attributes`` are columns that searches may filter on. ``centers`` fixes the cells instead of k-means. Rows without a vector are left out.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {', '.join(KINDS)}")
    if not 1 <= nlist <= cells.MAX_CELLS:
        raise ValueError(f"nlist must be between 1 and {cells.MAX_CELLS}")
    spark, metric = base.sparkSession, metric or ("hamming" if kind == "binary" else "l2")
    rows = _source(base, kind, id, vector, attributes)
    train = rows
    if kind == "binary":
        from nearfield.functions.vectors import unpack_bits

        train = unpack_bits(rows, "bits", "vector")
    elif metric == "cosine":
        train = cells._unit_column(rows)
    if centers is None:
        centers = cells.train_centers(train, nlist, id, seed)
    arrays: dict[str, np.ndarray] = {}
    if kind == "sq8":
        low, high = cells.sq8_ranges(rows)
        arrays = {"low": low[None, :], "step": np.where(high > low, (high - low) / 255.0, 1.0)[None, :]}
    elif kind == "pq":
        books = cells.pq_books(train.select(id, "vector"), np.shape(centers)[1], m, nbits, id, seed)
        arrays = {f"book{i}": b for i, b in enumerate(books)}
    index = StoredIndex(spark, path, kind, metric, id, np.asarray(centers, np.float64), arrays)
    _write_rows(index, rows, "error")
    model = [(name, i, [float(x) for x in row]) for name, matrix in {"centers": index.centers, **arrays}.items() for i, row in enumerate(matrix)]
    spark.createDataFrame(model, "name string, at int, row array<double>").coalesce(1).write.parquet(f"{path}/model")
    meta = json.dumps({"kind": kind, "metric": metric, "id": id})
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{path}/meta")
    return index


def _write_rows(index: StoredIndex, rows: DataFrame, mode: str) -> None:
    """Few files per cell; a cell with many rows is split by size."""
    index.encoded(rows).hint("rebalance", "cell").write.partitionBy("cell").mode(mode).parquet(f"{index.path}/rows")


def open_index(spark: SparkSession, path: str) -> StoredIndex:
    """Open a finished index; only its model is read."""
    from nearfield.sources.ann_dataset import path_exists

    if not path_exists(spark, f"{path}/meta"):
        raise FileNotFoundError(f"{path} holds no finished index")
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    parts: dict[str, list] = {}
    for r in spark.read.parquet(f"{path}/model").orderBy("name", "at").collect():  # bounded by nlist and the code books
        parts.setdefault(r["name"], []).append(r["row"])
    arrays = {name: np.array(rows, np.float64) for name, rows in parts.items()}
    return StoredIndex(spark, path, meta["kind"], meta["metric"], meta["id"], arrays.pop("centers"), arrays)


def append_rows(index: StoredIndex, base: DataFrame, vector: str | None = None) -> None:
    """Add rows under the stored model; only new files are written."""
    attributes = [c for c in index.rows.columns if c not in (index.id, "vector", "bits", "code", "cell")]
    _write_rows(index, _source(base, index.kind, index.id, vector, attributes), "append")


# ---------------------------------------------------------------- search


def _asked(index: StoredIndex, queries: DataFrame, qid: str, query_vector: str | None) -> DataFrame:
    name = "bits" if index.kind == "binary" else "vector"
    rows = queries.select(qid, F.col(query_vector or name).alias(name)).filter(F.col(name).isNotNull())
    if index.kind != "binary":
        return rows
    from nearfield.functions.vectors import unpack_bits

    return unpack_bits(rows, "bits", "vector")


def _scannable(index: StoredIndex, filter: Column | str | None) -> DataFrame:
    rows = index.rows
    return rows if filter is None else rows.filter(filter)


def search_index(index: StoredIndex, queries: DataFrame, k: int, nprobe: int = 16, *, refine: int = 4, filter: Column | str | None = None,
                 qid: str = "qid", query_vector: str | None = None) -> DataFrame:
    """The ``k`` nearest rows among the ``nprobe`` nearest cells of each query: (qid, rank, id, score).

    ``flat`` and ``binary`` score exactly inside the cells; ``sq8`` and ``pq`` rank on codes and then score the best ``k * refine`` on raw vectors
    (``refine=0``: scores stay those of the codes). ``filter`` may use the index's attributes and applies before ranking.
    """
    coded = index.column == "code"
    keep = k * refine if coded and refine else k
    hits, probed = _hits(index, queries, keep, [nprobe], filter, qid, query_vector, shared_bound=True, final=k if coded and refine else 0)
    if not (coded and refine):
        return cells._ranked(hits, qid, index.id, k, index.metric)
    if "exact" in hits.columns:
        short = blocks.best_per(hits, [qid], keep, ["cost", index.id])
        return cells._ranked(short.select(qid, index.id, F.col("exact").alias("cost")), qid, index.id, k, index.metric)
    short = blocks.best_per(hits, [qid], keep, ["cost", index.id]).select(qid, index.id, "cell")
    return _refined(index, short, queries, probed, k, qid, query_vector)


def search_settings(index: StoredIndex, queries: DataFrame, k: int, nprobes: Sequence[int], *, filter: Column | str | None = None,
                    qid: str = "qid", query_vector: str | None = None) -> DataFrame:
    """Results for several ``nprobe`` in one pass over the index: (nprobe, qid, rank, id, score).

    A hit carries the rank of its cell among the query's probes, so that each setting is the best of the hits up to its rank. Codes are not
    refined. A query and cell give at most ``k`` rows to the shuffle.
    """
    hits, _ = _hits(index, queries, k, nprobes, filter, qid, query_vector, shared_bound=False)
    at = F.explode(F.filter(F.array(*[F.lit(int(n)) for n in sorted(set(nprobes))]), lambda n: n >= F.col("probe")))
    every = hits.select(at.alias("nprobe"), qid, index.id, "cost")
    from nearfield.operators.search import score_of

    return blocks.best_per(every, ["nprobe", qid], k, ["cost", index.id]).select("nprobe", qid, "rank", index.id, score_of(index.metric))


def _hits(index: StoredIndex, queries: DataFrame, k: int, nprobes: Sequence[int], filter, qid: str, query_vector: str | None,
          shared_bound: bool, final: int = 0) -> tuple[DataFrame, Column | None]:
    """Best ``k`` rows per query and task (or cell): (qid, id, cell, probe, cost), and the condition that keeps the probed cells."""
    from nearfield.operators.search import cost_bytes, query_volume

    asked = _asked(index, queries, qid, query_vector)
    nprobes = [min(n, len(index.centers)) for n in nprobes]
    nprobe = max(nprobes)
    count, fits = query_volume(asked, cost_bytes("vector", "l2"))
    if not fits or count * nprobe > PROBE_PAIRS:
        return _grid_hits(index, asked, k, nprobes, filter, qid, final), None
    asked = asked.repartition(max(1, count * len(index.centers) // cells.DISTANCES_AT_ONCE)).sortWithinPartitions(qid)
    probes = _probes(asked, index, nprobe).toArrow()
    names = [c for c in ("bits", "vector") if c in probes.schema.names]
    held = blocks.encode(probes.select([qid, *names]).combine_chunks().to_batches()[0]) if len(probes) else b""
    near = np.array(probes["near"].to_pylist(), np.int64).reshape(len(probes), nprobe)
    cell_of, query_of = near.ravel(), np.repeat(np.arange(len(near)), near.shape[1])
    rank_of = np.tile(np.arange(1, near.shape[1] + 1), len(near))
    order = np.argsort(cell_of, kind="stable")
    sent = index.spark.sparkContext.broadcast((held, cell_of[order], query_of[order], rank_of[order]))
    used = np.unique(cell_of).tolist()
    probed = F.col("cell").isin([int(c) for c in used]) if len(used) < len(index.centers) else F.lit(True)
    rows = _scannable(index, filter).filter(probed).select(index.id, index.column, "cell")
    kernel, id_name, many = index.kernel(), index.id, len(near)
    schema = T.StructType([asked.schema[qid], rows.schema[index.id], T.StructField("cell", T.IntegerType()), T.StructField("probe", T.IntegerType()),
                           T.StructField("cost", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = loaded = None
        tau = np.full(many, np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            if query is None:
                raw, cell_of, query_of, rank_of = sent.value
                query = blocks.decode(raw)
                loaded = kernel.load(query, True)
            own = batch.column("cell").to_numpy()
            for cell in np.unique(own).tolist():
                low, high = np.searchsorted(cell_of, [cell, cell + 1])
                at = np.flatnonzero(own == cell)
                for start in range(0, len(at), blocks.BASE_ROWS):
                    part = batch.take(pa.array(at[start : start + blocks.BASE_ROWS]))
                    b = kernel.load(part, False)
                    for first in range(low, high, blocks.QUERY_ROWS):
                        rows_of = query_of[first : min(high, first + blocks.QUERY_ROWS)]
                        bound = tau[rows_of] if shared_bound else np.full(len(rows_of), np.inf)
                        qi, bi, cost = blocks.score_pair(kernel, loaded[rows_of], b, part, k, bound, [id_name])
                        if not len(qi):
                            continue
                        if shared_bound:
                            full = blocks._rank_in_run(blocks._first_per(qi)) == k - 1
                            tau[rows_of[qi[full]]] = np.minimum(tau[rows_of[qi[full]]], cost[full])
                        yield pa.RecordBatch.from_arrays(
                            [query.column(qid).take(pa.array(rows_of[qi])), part.column(id_name).take(pa.array(bi)),
                             pa.array(np.full(len(qi), cell, np.int32)), pa.array(rank_of[first + qi].astype(np.int32)), pa.array(cost)], names=schema.names)

    return rows.mapInArrow(run, schema), probed


def _probes(asked: DataFrame, index: StoredIndex, nprobe: int) -> DataFrame:
    """Each query with ``near``, its ``nprobe`` nearest cells in order."""
    return cells.near_cells(asked, index.centers, nprobe, index.cosine, ("vector",) if index.kind == "binary" else ())


def _grid_hits(index: StoredIndex, asked: DataFrame, k: int, nprobes: Sequence[int], filter, qid: str, final: int) -> DataFrame:
    """The same for a query side of any size; with ``final`` a hit also has ``exact``, its cost on raw vectors."""
    from nearfield.operators.search import cost_bytes, grid_of

    near = _probes(asked, index, max(nprobes))
    rows = _scannable(index, filter).select(index.id, "cell", index.column, *(["vector"] if final else []))
    bytes_of = F.octet_length("bits") * 64 if index.kind == "binary" else cost_bytes("vector", "l2")
    shape = grid_of(rows, near, bytes_of, k * len(set(nprobes)), whole=final > 0)
    return cells.grid_hits(rows, near, index.kernel(), index.metric, len(index.centers), k, nprobes, shape, index.id, qid, final)


def _refined(index: StoredIndex, short: DataFrame, queries: DataFrame, probed: Column | None, k: int, qid: str, query_vector: str | None) -> DataFrame:
    """Score the short list on raw vectors; the list is sent to the probed cells when it is counted small."""
    from nearfield.functions.vectors import cost_column

    rows = index.rows if probed is None else index.rows.filter(probed)
    raw = rows.select("cell", index.id, F.col("vector").alias("__b"))
    pairs = raw.join(broadcast_if_small(short), ["cell", index.id])
    asked = queries.select(qid, F.col(query_vector or "vector").alias("__q"))
    exact = pairs.join(broadcast_if_small(asked, bytes_of=F.size("__q") * 8), qid).select(qid, index.id, cost_column("__q", "__b", index.metric).alias("cost"))
    return cells._ranked(exact, qid, index.id, k, index.metric)


def cell_stats(index: StoredIndex) -> DataFrame:
    """(cell, n): rows of each cell, to see how even the cells are."""
    return index.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))


def settings_recall(index: StoredIndex, queries: DataFrame, truth: DataFrame, k: int, nprobes: Sequence[int], *, qid: str = "qid") -> DataFrame:
    """Recall at ``k`` of each ``nprobe`` against true neighbours (qid, id), from one pass: (nprobe, n, avg_recall, min_recall)."""
    found = search_settings(index, queries, k, nprobes, qid=qid)
    right = found.join(truth.select(qid, index.id).distinct(), [qid, index.id], "left_semi").groupBy("nprobe", qid).agg(F.count(F.lit(1)).alias("good"))
    due = truth.groupBy(qid).agg(F.least(F.count_distinct(index.id), F.lit(k)).alias("due"))
    each = due.select(qid, "due", F.explode(F.array(*[F.lit(int(n)) for n in sorted(set(nprobes))])).alias("nprobe"))
    rows = each.join(right, ["nprobe", qid], "left").select("nprobe", (F.coalesce("good", F.lit(0)) / F.col("due")).alias("recall"))
    return rows.groupBy("nprobe").agg(F.count(F.lit(1)).alias("n"), F.avg("recall").alias("avg_recall"), F.min("recall").alias("min_recall"))
