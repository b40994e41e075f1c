"""Block scoring: the one physical strategy behind every batch search.

Rows are packed into blocks (an Arrow record batch stored in one binary cell), blocks of the two
sides are brought together by an equi-join, and a numpy kernel scores a pair of blocks and emits
only the best ``k`` rows per query. Pairs are never emitted as rows.

Three ways to bring blocks together:

* ``pair_small_queries``: the query side is proven small; its blocks are a broadcast variable and the
  base table is scored where it is scanned, in one Arrow pass without a shuffle or a copied payload.
* ``pair_cells``: both sides carry a ``cell`` value; equal cells meet. Cells of any size are cut
  into blocks, and the blocks of a hot cell are dealt over several tasks.
* ``pair_grid``: every row with every query, neither side small. Both sides are dealt into parts, and a task
  holds one part of the queries while one part of the base blocks streams past it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from nearfield.session import estimated_tasks, materialize, skew_join

BASE_ROWS = 4096
QUERY_ROWS = 1024
BLOCKS_PER_TASK = 16
VOCAB_COLUMNS = 2048
DENSE_COLUMNS = 256
STRIP_CELLS = 1024 * 1024  # costs held at a time in single precision, so that they stay in a core's cache
EXACT_ROWS = 2048  # pairs scored directly at a time, so that their vectors stay in a core's cache
PADDED_CELLS = 4 * 1024 * 1024
MANY_GROUPS = 64
SEED_TASKS = 128
MAXSIM_QUERY_ELEMENTS = 1024
MAXSIM_BASE_ELEMENTS = 8192
CACHE_BYTES = 128 * 1024 * 1024
GRID_QUERY_BYTES = 128 * 1024 * 1024
GRID_BASE_BYTES = 512 * 1024 * 1024
GRID_TASKS_PER_CORE = 3
HIT_BYTES = 64  # of a hit that a part keeps, of which there are up to twice as many as in the end


# ---------------------------------------------------------------- packing


def encode(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def decode(payload) -> pa.RecordBatch:
    with pa.ipc.open_stream(pa.py_buffer(payload)) as reader:
        return reader.read_next_batch()


def pack_groups(df: DataFrame, by: list[str]) -> DataFrame:
    """Pack rows sharing ``by`` into one block. Callers keep such groups at block size by salting."""
    key_fields = [df.schema[c] for c in by]
    schema = T.StructType([*key_fields, T.StructField("payload", T.BinaryType())])

    def run(table: pa.Table) -> pa.Table:
        keys = [table.column(c).slice(0, 1).combine_chunks() for c in by]
        batch = table.drop_columns(by).combine_chunks().to_batches()[0]
        return pa.table([*keys, pa.array([encode(batch)], pa.binary())], names=[*by, "payload"])

    return df.groupBy(*by).applyInArrow(run, schema)


# ---------------------------------------------------------------- kernels


def dense(column: pa.Array) -> np.ndarray:
    """List column of equally long vectors as a float64 matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    if n == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) % n or len(flat) // n != pc.max(pc.list_value_length(column)).as_py():
        raise ValueError("vectors must have the same length")
    return flat.reshape(n, -1)


def bytes_column(rows: np.ndarray) -> pa.Array:
    """A matrix as one binary value per row, from one buffer."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32)), pa.py_buffer(rows)])


def bytes_matrix(column: pa.Array, dtype) -> np.ndarray:
    """The inverse: binary values of equal length as the rows of a matrix, as a view where they lie."""
    column = column.cast(pa.binary())
    if not len(column):
        return np.empty((0, 0), dtype)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.empty(0, np.uint8)
    return np.frombuffer(data.tobytes(), dtype).reshape(len(column), -1)


def centred(q: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides moved by the mean of ``b``: distances stay, norms shrink to the spread of the data."""
    middle = b.mean(axis=0) if len(b) else 0.0
    return q - middle, b - middle


def squared_distances(q: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared L2 distances by one matrix product, right up to ``rounding`` of the centred norms."""
    q, b = centred(q, b)
    out = (-2.0 * q) @ b.T
    out += np.einsum("ij,ij->i", q, q)[:, None]
    out += np.einsum("ij,ij->i", b, b)[None, :]
    return out


def _top(values: np.ndarray) -> float:
    return float(values.max()) if len(values) else 0.0


def rounding(q: np.ndarray, b: np.ndarray, size: float) -> float:
    """Bound on the rounding error of a sum of products whose terms add up to at most ``size``."""
    return 8 * np.finfo(np.float64).eps * (q.shape[1] + 4) * size


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return matrix / np.where(norms == 0, 1.0, norms)[:, None]


@dataclass(frozen=True)
class Factors:
    """Two matrices in single precision whose product is the cost of all pairs, over ``scale``.

    A cost is off by at most the query's ``slack``. ``shared`` tells, for some queries, which pairs can be hits at all; the others cost 0.
    """

    q: np.ndarray
    b: np.ndarray
    scale: float
    slack: np.ndarray
    shared: Callable[[np.ndarray], np.ndarray] | None = None


def single(left: np.ndarray, right: np.ndarray, size: np.ndarray, shared=None) -> Factors | None:
    """Factors of ``left @ right.T``; nothing where numbers are missing, endless or all zero.

    ``size`` bounds half the sum of a query's absolute terms. A sum of n terms in single precision is off by n roundings of that, and two for
    the terms' own; what falls below the least number of that precision is within the share of the scale.
    """
    a, c = np.abs(left).max(initial=0.0), np.abs(right).max(initial=0.0)
    scale = a * c
    if not (0 < a < np.inf and 0 < c < np.inf and 0 < scale < np.inf and np.isfinite(size).all()):
        return None
    slack = 1.5 * np.finfo(np.float32).eps * (left.shape[1] + 8) * (size / scale) + 1e-30
    return Factors((left / a).astype(np.float32), (right / c).astype(np.float32), float(scale), slack, shared)


def dense_factors(q: np.ndarray, b: np.ndarray, metric: str) -> Factors | None:
    """Squared L2 distances or negative inner products; both norms ride along as two more columns."""
    if metric == "l2":
        q, b = centred(q, b)
    own, other = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", b, b)
    if metric != "l2":
        return single(-q, b, np.sqrt(own * _top(other)))
    left = np.concatenate([-2.0 * q, own[:, None], np.ones((len(q), 1))], axis=1)
    right = np.concatenate([b, np.ones((len(b), 1)), other[:, None]], axis=1)
    return single(left, right, own + _top(other))


class Kernel:
    """Scores a base block against a query block. Lower cost is better; infinity is no hit."""

    column = "vector"
    query_column = "vector"

    def load(self, batch: pa.RecordBatch, query: bool):
        return batch.column(self.query_column if query else self.column)

    def costs(self, q, b) -> np.ndarray:
        raise NotImplementedError

    def factors(self, q, b) -> Factors | None:
        """What finds candidates without the matrix of ``costs``, for kernels whose ``exact`` needs none."""
        return None

    def exact(self, q, b, qi: np.ndarray, bi: np.ndarray, costs: np.ndarray | None) -> np.ndarray:
        """Final cost of chosen pairs; the default trusts ``costs``."""
        return costs[qi, bi]

    def limit(self, tau: np.ndarray) -> np.ndarray:
        """A bound on final cost as a bound on ``costs``."""
        return tau

    def slack(self, q, b, costs: np.ndarray) -> float:
        """How far a value of ``costs`` may lie from the exact one."""
        return _slack(costs)


class DenseKernel(Kernel):
    """L2, inner product or cosine on float vectors.

    One matrix product in single precision picks candidates with slack; candidates are scored again directly because
    the expanded form loses digits to cancellation and its rounding depends on the position. For L2
    both sides are moved to the block's mean first, and the slack follows the norms, so
    vectors far from the origin lose no neighbour. Numbers out of reach of single precision take ``costs``.
    """

    def __init__(self, metric: str):
        self.metric = metric

    def load(self, batch, query):
        m = dense(super().load(batch, query))
        return unit(m) if self.metric == "cosine" else m

    def costs(self, q, b):
        if q.shape[1] != b.shape[1]:
            raise ValueError("query and base vectors differ in length")
        if self.metric != "l2":
            return -(q @ b.T)
        return squared_distances(q, b)

    def factors(self, q, b):
        if q.shape[1] != b.shape[1]:
            raise ValueError("query and base vectors differ in length")
        return dense_factors(q, b, self.metric)

    def slack(self, q, b, costs):
        if self.metric == "l2":
            q, b = centred(q, b)
            return rounding(q, b, _top(np.square(q).sum(1)) + _top(np.square(b).sum(1)))
        return rounding(q, b, np.sqrt(_top(np.square(q).sum(1)) * _top(np.square(b).sum(1))))

    def limit(self, tau):
        return np.square(tau) if self.metric == "l2" else tau

    def exact(self, q, b, qi, bi, costs):
        out = np.empty(len(qi))
        for s in range(0, len(qi), EXACT_ROWS):
            a, c = q[qi[s : s + EXACT_ROWS]], b[bi[s : s + EXACT_ROWS]]
            if self.metric == "l2":
                d = a - c
                out[s : s + EXACT_ROWS] = np.sqrt(np.sum(d * d, axis=1))
            else:
                out[s : s + EXACT_ROWS] = -np.sum(a * c, axis=1)
        return out


def bits(column: pa.Array) -> np.ndarray:
    """Packed binary vectors as a 0/1 matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    shortest, longest = pc.min_max(pc.binary_length(column)).as_py().values()
    if column.null_count or shortest != longest:
        raise ValueError("binary vectors must have the same length")
    packed = bytes_matrix(column, np.uint8)
    return np.unpackbits(packed, axis=1).astype(np.float64)


def bit_costs(q: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Counts are whole numbers, so the matrix product is exact."""
    own, other = q.sum(1)[:, None], b.sum(1)[None, :]
    both = q @ b.T
    if metric == "hamming":
        both *= -2
        both += own
        both += other
        return both
    union = own + other
    union -= both
    empty = union == 0
    union[empty] = both[empty] = 1.0
    both /= union
    return np.subtract(1.0, both, out=both)


class BinaryKernel(Kernel):
    """Hamming or Jaccard distance on packed bits; two empty sets have Jaccard distance 0."""

    def __init__(self, metric: str):
        self.metric = metric

    def load(self, batch, query):
        return bits(super().load(batch, query))

    def costs(self, q, b):
        return bit_costs(q, b, self.metric)


class MaxSimKernel(Kernel):
    """Late interaction: per query element the best document element, summed over the query.

    Rows whose list is empty are dropped by the caller: they can give no hit.
    """

    def __init__(self, metric: str):
        self.metric = metric

    def load(self, batch, query):
        lists = super().load(batch, query)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        inner = lists.flatten()
        m = bits(inner) if self.metric in ("hamming", "jaccard") else dense(inner)
        return (unit(m) if self.metric == "cosine" else m), starts

    def costs(self, q, b):
        (qm, qs), (bm, bs) = q, b
        out = np.empty((len(qs), len(bs)))
        for q0, q1, qe in _runs(qs, len(qm), MAXSIM_QUERY_ELEMENTS):
            rows = _by_length(qs[q0:q1] - qs[q0], qe.stop - qe.start)
            for b0, b1, be in _runs(bs, len(bm), MAXSIM_BASE_ELEMENTS):
                self.sums(qm[qe], bm[be], rows, _by_length(bs[b0:b1] - bs[b0], be.stop - be.start), out[q0:q1, b0:b1])
        return out

    def sums(self, q, b, rows, docs, out: np.ndarray) -> None:
        """Costs of a run of queries with a run of documents: the n-th elements of all documents at once."""
        if self.metric == "l2":
            q, b = centred(q, b)
        (q_order, q_parts), (b_order, b_parts) = rows, docs
        parts = [b[at] for at in b_parts]
        total = np.zeros(out.shape)
        for at in q_parts:
            own = q[at]
            best = self.element_costs(own, parts[0])
            for part in parts[1:]:
                few = best[:, : len(part)]
                np.minimum(few, self.element_costs(own, part), out=few)
            total[: len(at)] += np.sqrt(np.maximum(best, 0.0, out=best), out=best) if self.metric == "l2" else best
        out[np.ix_(q_order, b_order)] = total

    def element_costs(self, q, b):
        """For L2 the squares, of both sides moved to one middle."""
        if self.metric in ("hamming", "jaccard"):
            return bit_costs(q, b, self.metric)
        if self.metric != "l2":
            return (-q) @ b.T
        own, other = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", b, b)
        pair = (-2.0 * q) @ b.T
        pair += own[:, None]
        pair += other[None, :]
        # the root of a small difference of large numbers has few right digits
        i, j = np.nonzero(pair < 1e-6 * (_top(own) + _top(other)))
        for s in range(0, len(i), 65536):
            pair[i[s : s + 65536], j[s : s + 65536]] = np.square(q[i[s : s + 65536]] - b[j[s : s + 65536]]).sum(axis=1)
        return pair

    def slack(self, q, b, costs):
        """The error of an element's square is at most that of its sums; its root, at most the root of that."""
        if self.metric in ("hamming", "jaccard"):
            return super().slack(q, b, costs)
        (qm, qs), (bm, _) = q, b
        most = int(np.diff(np.append(qs, len(qm))).max())
        if self.metric == "l2":
            # tiles have middles of their own: norms grow by no more than twice the block's spread
            qm, bm = centred(qm, bm)
            wide = 4 * max(_top(np.square(qm).sum(1)), _top(np.square(bm).sum(1)))
            return most * np.sqrt(rounding(qm, bm, 2 * wide))
        return most * rounding(qm, bm, np.sqrt(_top(np.square(qm).sum(1)) * _top(np.square(bm).sum(1))))

    def exact(self, q, b, qi, bi, costs):
        """Chosen pairs element by element, so that copies cost the same wherever they lie."""
        if self.metric in ("hamming", "jaccard"):
            return costs[qi, bi]
        (qm, qs), (bm, bs) = q, b
        q_size, b_size = np.diff(np.append(qs, len(qm))), np.diff(np.append(bs, len(bm)))
        out, many, done = np.empty(len(qi)), q_size[qi] * b_size[bi], 0
        while done < len(qi):
            last = max(done + 1, done + int(np.searchsorted(np.cumsum(many[done : done + 65536]), 65536, side="right")))
            own, other, size = qi[done:last], bi[done:last], many[done:last]
            pair = np.repeat(np.arange(len(own)), size)
            within = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
            left, right = qm[qs[own][pair] + within // b_size[other][pair]], bm[bs[other][pair] + within % b_size[other][pair]]
            cost = np.sqrt(np.sum(np.square(right - left), axis=1)) if self.metric == "l2" else -np.sum(left * right, axis=1)
            runs = np.repeat(b_size[other], q_size[own])
            best = np.minimum.reduceat(cost, np.cumsum(runs) - runs)
            out[done:last] = np.add.reduceat(best, np.cumsum(q_size[own]) - q_size[own])
            done = last
        return out


def _by_length(starts: np.ndarray, total: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows from the longest on, and for each n the positions of the n-th elements of those that have one."""
    sizes = np.diff(np.append(starts, total))
    order = np.argsort(-sizes, kind="stable")
    sizes, starts = sizes[order], starts[order]
    return order, [starts[: np.count_nonzero(sizes > n)] + n for n in range(int(sizes[0]))]


def _runs(starts: np.ndarray, total: int, most: int):
    """Consecutive rows whose elements together stay within ``most`` (a longer row comes alone)."""
    ends = np.append(starts[1:], total)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + most, side="right")))
        yield first, last, slice(starts[first], ends[last - 1])
        first = last


def _spread(n: int, row: np.ndarray, code: np.ndarray, value: np.ndarray, start: int, width: int) -> np.ndarray:
    """Entries of a slice of the vocabulary as a dense matrix; repeated entries add up."""
    inside = (code >= start) & (code < start + width)
    flat = np.bincount(row[inside] * width + code[inside] - start, weights=value[inside], minlength=n * width)
    return flat.reshape(n, width)


class SparseKernel(Kernel):
    """Inner product of sparse rows ``(keys, values)`` over the dimensions a query block uses.

    A hit shares at least one dimension with the query. With ``positive`` weights on both sides that
    is the same as a score above zero.
    """

    positive = False

    def entries(self, batch):
        keys, values = batch.column("keys"), batch.column("values")
        rows = pc.list_parent_indices(keys).to_numpy(zero_copy_only=False).astype(np.int64)
        return batch.num_rows, rows, keys.flatten(), values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)

    def load(self, batch, query):
        """The entries, and of a block of few keys its keys in order with the rows as a matrix."""
        n, row, keys, values = self.entries(batch)
        vocab = pc.unique(keys)
        if not 0 < len(vocab) <= DENSE_COLUMNS or vocab.null_count:
            return n, row, keys, values, None
        vocab = vocab.take(pc.sort_indices(vocab))
        code = pc.index_in(keys, value_set=vocab).to_numpy(zero_copy_only=False).astype(np.int64)
        return n, row, keys, values, (vocab, _spread(n, row, code, values, 0, len(vocab)))

    def common(self, q, b) -> tuple[np.ndarray, np.ndarray] | None:
        """Both matrices over the keys that both blocks have, in the order of the keys."""
        if q[4] is None or b[4] is None:
            return None
        (own, qm), (other, bm) = q[4], b[4]
        if own.equals(other):
            return qm, bm
        at = pc.index_in(own, value_set=other)
        return qm[:, pc.is_valid(at).to_numpy(zero_copy_only=False)], bm[:, pc.drop_null(at).to_numpy(zero_copy_only=False)]

    def factors(self, q, b):
        both = self.common(q, b)
        if both is None:
            return None
        qm, bm = both
        own, other = np.einsum("ij,ij->i", qm, qm), np.einsum("ij,ij->i", bm, bm)

        def shared(rows: np.ndarray) -> np.ndarray:
            return (qm[rows] != 0).astype(np.float32) @ (bm != 0).astype(np.float32).T > 0

        return single(-qm, bm, np.sqrt(own * _top(other)), shared)

    def exact(self, q, b, qi, bi, costs):
        """Products added one by one in the order of the keys: keys that a row lacks change no digit, whatever block it lies in."""
        if costs is not None:
            return costs[qi, bi]
        qm, bm = self.common(q, b)
        out = np.empty(len(qi))
        for s in range(0, len(qi), 65536):
            out[s : s + 65536] = -np.cumsum(qm[qi[s : s + 65536]] * bm[bi[s : s + 65536]], axis=1)[:, -1]
        return out

    def weigh(self, entries: np.ndarray, b) -> np.ndarray:
        return entries

    def costs(self, q, b):
        qn, qrow, qkey, qval = q[:4]
        bn, brow, bkey, bval = b[:4]
        vocab = pc.unique(qkey)
        qcode = pc.index_in(qkey, value_set=vocab).to_numpy(zero_copy_only=False)
        found = pc.index_in(bkey, value_set=vocab)
        hit = pc.is_valid(found).to_numpy(zero_copy_only=False)
        bcode, brow, bval = pc.drop_null(found).to_numpy(zero_copy_only=False).astype(np.int64), brow[hit], bval[hit]
        score = np.zeros((qn, bn))
        shared = None if self.positive else np.zeros((qn, bn))
        for start in range(0, len(vocab), VOCAB_COLUMNS):
            width = min(VOCAB_COLUMNS, len(vocab) - start)
            qm = _spread(qn, qrow, qcode, qval, start, width)
            bm = _spread(bn, brow, bcode, bval, start, width)
            score += qm @ self.weigh(bm, b).T
            if shared is not None:
                shared += (qm != 0).astype(np.float64) @ (bm != 0).astype(np.float64).T
        return np.where((score if shared is None else shared) > 0, -score, np.inf)


class TermKernel(SparseKernel):
    """BM25: saturated term frequency of the document times the query's weighted terms."""

    positive = True

    def __init__(self, k1: float, b: float):
        self.k1, self.b = k1, b

    def load(self, batch, query):
        if query:
            return self.entries(batch)
        keys = batch.column("keys")
        rows = pc.list_parent_indices(keys).to_numpy(zero_copy_only=False).astype(np.int64)
        tf = batch.column("tf").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        rel = batch.column("rel_length").to_numpy(zero_copy_only=False)
        return batch.num_rows, rows, keys.flatten(), tf, rel

    def factors(self, q, b):
        return None

    def weigh(self, entries, b):
        norm = self.k1 * (1 - self.b + self.b * b[4])
        return entries * (self.k1 + 1) / (entries + norm[:, None])


# ---------------------------------------------------------------- pair scoring


def _slack(costs: np.ndarray) -> float:
    finite = costs[np.isfinite(costs)]
    return 1e-9 * (1.0 + (np.abs(finite).max() if len(finite) else 0.0))


def _candidates(costs, k, tau, groups, eps):
    """Positions that may belong to the answer: within slack of the k-th best (row or group)."""
    if groups is None:
        near = costs <= _most(tau, eps)[:, None]
        # the k-th best of a row matters only where the bound leaves much more than k
        many = np.flatnonzero(np.count_nonzero(near, axis=1) > 4 * k)
        if len(many):
            every = len(many) == len(costs)
            some = costs if every else costs[many]
            kth = np.minimum(tau[many], np.partition(some, k - 1, axis=1)[:, k - 1])
            near[slice(None) if every else many] = some <= _most(kth, eps)[:, None]
        qi, bi = np.divmod(np.flatnonzero(near), costs.shape[1])
        hit = costs[qi, bi] < np.inf
        return qi[hit], bi[hit]
    order = np.argsort(groups, kind="stable")
    starts = np.flatnonzero(np.diff(groups[order], prepend=-1))
    best = np.minimum.reduceat(costs[:, order], starts, axis=1)
    own = best[:, groups]
    limit = tau
    if best.shape[1] > k:
        limit = np.minimum(tau, np.partition(best, k - 1, axis=1)[:, k - 1])
    mask = (own <= _most(limit, eps)[:, None]) & (costs < np.inf) & (costs <= own + 2 * eps)
    return np.nonzero(mask)


def _up(limit: np.ndarray) -> np.ndarray:
    """Limits in single precision, no lower than they were."""
    with np.errstate(over="ignore"):
        return np.nextafter(limit.astype(np.float32), np.float32(np.inf))


def _below(costs: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of costs within their row's limit, which are few among many."""
    near = (costs <= limit[:, None]).ravel()
    if len(near) % 8 == 0:
        words = np.flatnonzero(near.view(np.uint64))
        if len(words) * 16 < len(near):
            at = (words[:, None] * 8 + np.arange(8)).ravel()
            return np.divmod(at[near[at]], costs.shape[1])
    return np.divmod(np.flatnonzero(near), costs.shape[1])


def _kth(costs: np.ndarray, k: int) -> np.ndarray:
    """The k-th least value of each row; endless where there are fewer."""
    return np.partition(costs, k - 1, axis=1)[:, k - 1].astype(np.float64) if costs.shape[1] >= k else np.full(len(costs), np.inf)


def _near_pairs(f: Factors, k: int, tau: np.ndarray, groups: np.ndarray | None, held: np.ndarray | None):
    """Positions of a block that may belong to the answer, ordered by query; ``None`` where single precision tells too few apart.

    ``tau`` bounds the k-th cost (or the best cost of the k-th group) of a query, ``held`` its best cost of each group of the block.
    """
    n, many = len(f.q), len(f.b)
    order = np.arange(many)
    starts, right = None, f.b
    if groups is not None:
        order = np.argsort(groups, kind="stable")
        starts = np.flatnonzero(np.diff(groups[order], prepend=-1))
        sizes, right = np.diff(np.append(starts, many)), f.b[order]
    few_groups = starts is not None and 16 * len(starts) <= many
    rows = max(8, STRIP_CELLS // max(1, many))
    buffer = np.empty((min(rows, n), many), np.float32)
    found, total = [], 0
    for s in range(0, n, rows):
        e = min(n, s + rows)
        costs, slack = np.matmul(f.q[s:e], right.T, out=buffer[: e - s]), f.slack[s:e]
        bound = _most(tau[s:e] / f.scale, slack)
        if groups is None:
            qi, bi = _near_rows(costs, k, bound, slack, f.shared and (lambda at: f.shared(s + at)))
        elif few_groups:
            own = None if held is None else _most(held[s:e] / f.scale, slack[:, None])
            qi, bi = _near_groups(costs, k, bound, slack, starts, sizes, own)
        else:
            # rows below the k-th group's best cost are few, once that is known
            qi, bi = _below(costs, _up(np.where(np.isfinite(bound), bound, -np.inf)))
            loose = np.flatnonzero(~np.isfinite(bound) | (np.bincount(qi, minlength=e - s) > 16 * k))
            if len(loose):
                keep = ~np.isin(qi, loose)
                gi, gb = _near_groups(costs[loose], k, bound[loose], slack[loose], starts, sizes, None)
                qi, bi = np.concatenate([qi[keep], loose[gi]]), np.concatenate([bi[keep], gb])
                sort = np.argsort(qi, kind="stable")
                qi, bi = qi[sort], bi[sort]
        total += len(qi)
        if total > 64 * k * (e + rows):
            return None
        found.append((qi + s, order[bi]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _near_rows(costs: np.ndarray, k: int, bound: np.ndarray, slack: np.ndarray, shared) -> tuple[np.ndarray, np.ndarray]:
    open_ = np.flatnonzero(~np.isfinite(bound))
    if len(open_):
        bound[open_] = _most(_kth(costs if len(open_) == len(costs) else costs[open_], k), slack[open_])
    if shared is not None:
        loose = np.flatnonzero(bound >= 0)  # pairs that share nothing come before the k-th here
        if len(loose):
            costs[loose] = np.where(shared(loose), costs[loose], np.inf)
            bound[loose] = np.minimum(bound[loose] if not len(open_) else np.where(np.isin(loose, open_), np.inf, bound[loose]),
                                      _most(_kth(costs[loose], k), slack[loose]))
    qi, bi = _below(costs, _up(bound))
    # the k-th best of a row matters only where the bound leaves much more than k
    many = np.flatnonzero(np.bincount(qi, minlength=len(costs)) > 4 * k)
    many = many[~np.isin(many, open_)]
    if len(many):
        bound[many] = np.minimum(bound[many], _most(_kth(costs[many], k), slack[many]))
        keep = costs[qi, bi] <= _up(bound)[qi]
        qi, bi = qi[keep], bi[keep]
    hit = costs[qi, bi] < np.inf
    return qi[hit], bi[hit]


def _near_groups(costs: np.ndarray, k: int, bound: np.ndarray, slack: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                 held: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows near the best one of their group, of groups near the k-th best; ``costs`` come group by group."""
    best = np.minimum.reduceat(costs, starts, axis=1)
    if best.shape[1] > k:
        bound = np.minimum(bound, _most(_kth(best, k), slack))
    limit = bound[:, None] if held is None else np.minimum(bound[:, None], held)
    gq, g = np.nonzero(best <= _up(limit))
    size = sizes[g]
    pair = np.repeat(np.arange(len(g)), size)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size) + starts[g][pair]
    qi = gq[pair]
    keep = costs[qi, at] <= _up(_most(best[gq, g].astype(np.float64), slack[gq]))[pair]
    return qi[keep], at[keep]


def _most(limit: np.ndarray, eps: float | np.ndarray) -> np.ndarray:
    """The k-th value and the compared one may both be off; a bound from outside is rounded as well."""
    return limit + 1e-12 * np.abs(np.where(np.isfinite(limit), limit, 0.0)) + 2 * eps


def _first_per(values: np.ndarray) -> np.ndarray:
    """True where a run of equal values starts."""
    return np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)


def _rank_in_run(starts: np.ndarray) -> np.ndarray:
    pos = np.arange(len(starts))
    return pos - np.maximum.accumulate(np.where(starts, pos, 0)) if len(starts) else pos


def score_pair(kernel, q, b, base: pa.RecordBatch, k: int, tau: np.ndarray, keys, group=None, radius=None, members=None,
               kept: Kept | None = None):
    """Best ``k`` rows (or best row of the best ``k`` groups) of one base block per query.

    Returns (query positions, base positions, costs), ordered by query, cost and key. Hits for a ``Kept``, which picks
    the best by itself, are in the order of the queries only and may be more than ``k``.
    """
    if base.num_rows == 0 or len(tau) == 0:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    groups = held = values = None
    if group is not None:
        encoded = base.column(group).dictionary_encode(null_encoding="encode")
        groups, values = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
        held = kept.group_bounds(values) if kept is not None else None
    tau = tau if radius is None else np.minimum(tau, radius)
    costs = found = None
    if members is None and (factors := kernel.factors(q, b)) is not None:
        found = _near_pairs(factors, k, kernel.limit(tau), groups, None if held is None else kernel.limit(held))
    if found is None:
        costs = kernel.costs(q, b)
        if members is not None:
            costs = np.where(members[None, :], costs, np.inf)
        found = _candidates(costs, k, kernel.limit(tau), groups, kernel.slack(q, b, costs))
    qi, bi = found
    cost = kernel.exact(q, b, qi, bi, costs)
    cost = cost + 0.0
    keep = cost <= tau[qi] if radius is None else (cost <= tau[qi]) & (cost < radius)
    qi, bi, cost = qi[keep], bi[keep], cost[keep]
    if kept is not None:
        if groups is not None:
            kept.note_groups(values, qi, groups[bi], cost)
        return qi, bi, cost
    table = pa.table({"q": qi, "cost": cost, **{f"k{i}": base.column(c).take(pa.array(bi)) for i, c in enumerate(keys)}})
    sort = [("q", "ascending"), ("cost", "ascending")] + [(f"k{i}", "ascending") for i in range(len(keys))]
    order = pc.sort_indices(table, sort_keys=sort).to_numpy()
    qi, bi, cost = qi[order], bi[order], cost[order]
    if groups is not None:
        first = _first_of_pairs(qi, groups[bi])
        qi, bi, cost = qi[first], bi[first], cost[first]
    keep = _rank_in_run(_first_per(qi)) < k
    return qi[keep], bi[keep], cost[keep]


def _first_of_pairs(q: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Positions where a query meets a group for the first time."""
    pair = q.astype(np.int64) * (int(groups.max(initial=0)) + 1) + groups
    _, first = np.unique(pair, return_index=True)
    first.sort()
    return first


def k_least(q: np.ndarray, cost: np.ndarray, k: int, ties: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the ``k`` least costs of each query, by query, with the queries that have ``k`` and their k-th cost.

    ``ties`` orders positions by query, cost and key; it is asked only about rows at the k-th cost that do not all fit.
    """
    if not len(q):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    order = np.argsort(q.astype(np.uint16) if q.max() < 65536 else q, kind="stable")
    first = _first_per(q[order])
    row, rank = np.cumsum(first) - 1, _rank_in_run(first)
    own, size = q[order][first], np.bincount(row)
    kth = np.full(len(own), np.inf)
    full = np.flatnonzero(size >= k)
    if len(full):
        least, begin = cost[order], np.flatnonzero(first)
        step = max(1, PADDED_CELLS // int(size.max()))
        for s in range(0, len(own), step):
            part = slice(begin[s], begin[s + step] if s + step < len(own) else len(row))
            padded = np.full((min(step, len(own) - s), int(size[s : s + step].max())), np.inf)
            padded[row[part] - s, rank[part]] = least[part]
            kth[s : s + step] = _kth(padded, k)
    ranked, limit = cost[order], kth[row]
    keep = ranked <= limit
    crowded = np.bincount(row[keep], minlength=len(own)) > k
    if not crowded.any():
        return order[keep], own[full], kth[full]
    sure = keep & ((ranked < limit) | ~crowded[row])
    left = np.flatnonzero(keep & ~sure)
    left = left[ties(order[left])]
    room = k - np.bincount(row[sure], minlength=len(own))
    left = left[_rank_in_run(_first_per(row[left])) < room[row[left]]]
    return np.concatenate([order[sure], order[left]]), own[full], kth[full]


class Kept:
    """The best ``k`` hits (or groups) of each query of a block among those added so far; ``tau`` is moved to the k-th cost."""

    def __init__(self, k: int, keys: list[str], tau: np.ndarray, group: str | None = None):
        self.k, self.keys, self.tau, self.group = k, keys, tau, group
        self.hits: list[pa.RecordBatch] = []
        self.fresh = 0
        self.group_at: dict = {}
        self.best_of = np.full((len(tau), 0), np.inf)

    def group_bounds(self, values: pa.Array) -> np.ndarray | None:
        """Each query's best cost so far in each of some groups; only few groups are followed."""
        names = values.to_pylist()
        new = [v for v in names if v not in self.group_at]
        if len(self.group_at) + len(new) > MANY_GROUPS:
            return None
        self.group_at.update({v: len(self.group_at) + i for i, v in enumerate(new)})
        if new:
            self.best_of = np.concatenate([self.best_of, np.full((len(self.tau), len(new)), np.inf)], axis=1)
        return self.best_of[:, [self.group_at[v] for v in names]]

    def note_groups(self, values: pa.Array, qi: np.ndarray, groups: np.ndarray, cost: np.ndarray) -> None:
        names = values.to_pylist()
        if len(qi) and all(v in self.group_at for v in names):
            np.minimum.at(self.best_of, (qi, np.array([self.group_at[v] for v in names])[groups]), cost)

    def add(self, qi: np.ndarray, hits: pa.RecordBatch) -> None:
        self.hits.append(hits.append_column("__q", pa.array(qi.astype(np.int32))))
        self.fresh += hits.num_rows
        if 2 * self.fresh > self.k * len(self.tau):
            self.hits, self.fresh = [self._best()], 0

    def _best(self) -> pa.RecordBatch:
        every = pa.Table.from_batches(self.hits).combine_chunks()
        q, cost = every.column("__q").to_numpy(), every.column("cost").to_numpy()

        def ordered(at: np.ndarray) -> np.ndarray:
            names = ["__q", "cost", *self.keys]
            return pc.sort_indices(every.select(names).take(pa.array(at)), sort_keys=[(c, "ascending") for c in names]).to_numpy()

        if self.group is None:
            own, full, kth = k_least(q, cost, self.k, ordered)
        else:
            order = ordered(np.arange(len(q)))
            groups = every.column(self.group).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            order = order[_first_of_pairs(q[order], groups[order])]
            rank = _rank_in_run(_first_per(q[order]))
            own, last = order[rank < self.k], order[rank == self.k - 1]
            full, kth = q[last], cost[last]
        self.tau[full] = np.minimum(self.tau[full], kth)
        return every.take(pa.array(own)).combine_chunks().to_batches()[0]

    def give(self, final: int = 0) -> Iterator[pa.RecordBatch]:
        """The best hits, or of these the ``final`` best by their ``exact`` cost."""
        if self.hits:
            best = self._best()
            if final:
                names = ["__q", "exact", *self.keys]
                at, *_ = k_least(best.column("__q").to_numpy(), best.column("exact").to_numpy(), final, lambda at: pc.sort_indices(
                    best.select(names).take(pa.array(at)), sort_keys=[(c, "ascending") for c in names]).to_numpy())
                best = best.take(pa.array(at))
            yield best.drop_columns(["__q"])
        self.hits, self.fresh = [], 0


def _held(loaded) -> int:
    """Bytes of what a kernel made of a block."""
    if isinstance(loaded, (tuple, list)):
        return sum(_held(part) for part in loaded)
    return getattr(loaded, "nbytes", 0)


@dataclass(frozen=True)
class SmallQueries:
    """A base table and the packed blocks of a query side that was proven small."""

    base: DataFrame
    payloads: list[bytes]
    rows: int


@dataclass(frozen=True)
class Grid:
    """Packed blocks of both sides; a partition holds one part of the queries (``side`` 0) before one part of the base."""

    packed: DataFrame
    base_rows: int
    query_rows: int


def score_blocks(pairs: DataFrame | SmallQueries | Grid, kernel: Kernel, k: int, keys: list[T.StructField], qid: T.StructField,
                 group: T.StructField | None = None, carry: list[T.StructField] = (), radius: float | None = None,
                 variants: list[tuple[str, int]] | None = None) -> DataFrame:
    """Score joined blocks ``(payload, query_payload)``, a base table against small queries, or the parts of
    a grid; at most ``k`` rows per query and block.

    A task remembers the k-th cost seen per query block and drops what cannot beat it; that bound
    is never below the final k-th cost, so nothing of the answer is lost.
    """
    fields = [qid, *keys, *([group] if group else []), *carry]
    out = T.StructType([*fields, *([T.StructField("variant", T.StringType())] if variants else []),
                        T.StructField("cost", T.DoubleType())])
    key_names, group_name = [f.name for f in keys], group.name if group else None
    base_names = [*key_names, *([group_name] if group else []), *[f.name for f in carry]]
    qid_name = qid.name
    plain_bound = variants is None

    def opened(raw: bytes):
        return prepared(decode(raw))

    def prepared(query: pa.RecordBatch):
        tau = np.full(query.num_rows, np.inf)
        if "tau" in query.schema.names:
            tau = query.column("tau").to_numpy(zero_copy_only=False).astype(np.float64).copy()
        return query, kernel.load(query, True), tau

    def best(base: pa.RecordBatch, b, query: pa.RecordBatch, q, tau: np.ndarray, kept: Kept | None = None) -> Iterator[pa.RecordBatch]:
        for number, (name, size) in enumerate(variants or [(None, k)]):
            members = None
            if variants:
                members = base.column(f"in_{number}").to_numpy(zero_copy_only=False).astype(bool)
            qi, bi, cost = score_pair(kernel, q, b, base, size, tau, key_names, group_name, radius, members, kept)
            if len(qi) == 0:
                continue
            if plain_bound and kept is None:
                full = _rank_in_run(_first_per(qi)) == k - 1
                tau[qi[full]] = np.minimum(tau[qi[full]], cost[full])
            cols = [query.column(qid_name).take(pa.array(qi))]
            cols += [base.column(c).take(pa.array(bi)) for c in base_names]
            cols += [pa.array([name] * len(qi), pa.string())] if variants else []
            hits = pa.RecordBatch.from_arrays([*cols, pa.array(cost)], names=out.names)
            if kept is None:
                yield hits
            else:
                kept.add(qi, hits)

    if isinstance(pairs, SmallQueries):
        rows, held_queries = pairs.rows, pairs.base.sparkSession.sparkContext.broadcast(pairs.payloads)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sides = None
            for batch in batches:
                sides = sides or [opened(raw) for raw in held_queries.value]
                for start in range(0, batch.num_rows, rows):
                    base = batch
                    if batch.num_rows > rows:
                        base = batch.take(pa.array(np.arange(start, min(start + rows, batch.num_rows))))
                    b = kernel.load(base, False)
                    for side in sides:
                        yield from best(base, b, *side)

        return pairs.base.mapInArrow(scan, out)

    if isinstance(pairs, Grid):
        base_rows, query_rows = pairs.base_rows, pairs.query_rows

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, waiting, sides = None, [], None

            def score() -> Iterator[pa.RecordBatch]:
                for base in _cut(waiting, base_rows):
                    b = kernel.load(base, False)
                    for side in sides:
                        yield from best(base, b, *side)
                waiting.clear()

            def end() -> Iterator[pa.RecordBatch]:
                if sides:
                    yield from score()
                    for *_, kept in sides:
                        yield from kept.give() if kept else ()

            for batch in batches:
                for at, side, payload in zip(batch.column("part").to_pylist(), batch.column("side").to_pylist(), batch.column("payload")):
                    if at != part:  # a partition may hold several parts, one after the other
                        yield from end()
                        part, waiting, sides = at, [], None
                    if side and sides is None:
                        sides = [prepared(query) for query in _cut(waiting, query_rows)]
                        # a query gives its best k rows once per part, however many blocks the part has
                        sides = [(*s, Kept(k, key_names, s[2], group_name) if plain_bound else None) for s in sides]
                        waiting.clear()
                    waiting.append(decode(payload.as_buffer()))
                    if sides and sum(b.num_rows for b in waiting) >= base_rows:
                        yield from score()
                    elif sides == []:
                        waiting.clear()
            yield from end()

        return pairs.packed.mapInArrow(stream, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached: dict[bytes, tuple] = {}
        size: dict[bytes, int] = {}
        last = None
        for batch in batches:
            for payload, query_payload in zip(batch.column("payload"), batch.column("query_payload")):
                buffer = payload.as_buffer()
                if last is None or not buffer.equals(last):
                    base, last = decode(buffer), buffer
                    b = kernel.load(base, False)
                raw = query_payload.as_buffer().to_pybytes()
                if raw not in cached:
                    side = opened(raw)
                    size[raw] = 2 * len(raw) + _held(side[1]) + side[2].nbytes
                    while cached and sum(size.values()) > CACHE_BYTES:
                        oldest = next(iter(cached))
                        cached.pop(oldest), size.pop(oldest)
                    cached[raw] = side
                yield from best(base, b, *cached[raw])

    return pairs.mapInArrow(run, out)


# ---------------------------------------------------------------- pairing


def pair_small_queries(base: DataFrame, queries: DataFrame, base_rows: int = BASE_ROWS, query_rows: int = QUERY_ROWS) -> SmallQueries:
    """Every base row with every query; the caller has proven the query side to be within the broadcast bound."""
    return SmallQueries(base, [encode(b) for b in queries.toArrow().to_batches(max_chunksize=query_rows)], base_rows)


def _cut(pieces: list[pa.RecordBatch], rows: int) -> list[pa.RecordBatch]:
    """Blocks of at most ``rows`` rows, put together from smaller ones."""
    if not pieces:
        return []
    whole = pa.Table.from_batches(pieces).combine_chunks()
    if 0 < whole.num_rows <= rows:
        return whole.to_batches()
    return [whole.take(pa.array(np.arange(start, min(start + rows, whole.num_rows)))).combine_chunks().to_batches()[0]
            for start in range(0, whole.num_rows, rows)]


def grid_shape(n_base: int, n_query: int, row_bytes: float, cores: int, hit_bytes: float = 0, whole: bool = False) -> tuple[int, int]:
    """Parts of the base and of the queries: some tasks per core, and parts within the bounds of bytes.

    Every base row moves once per query part and every query once per base part, with the hits that are kept for it
    (``hit_bytes``). Up to the bounds the number of parts follows the cores, not the rows. With ``whole`` it is the queries that are
    dealt out, and a query meets the base in one part as far as the bound allows, for searches whose short lists cost more than the base rows moved.
    """
    side = max(1, int(np.ceil(np.sqrt(GRID_TASKS_PER_CORE * cores))))
    parts = lambda n, size, most: max(1, int(np.ceil(n * size / most)))
    query_parts = max(side, parts(n_query, row_bytes + hit_bytes, GRID_QUERY_BYTES))
    if whole:
        side, query_parts = 1, max(query_parts, GRID_TASKS_PER_CORE * cores)
    elif hit_bytes > row_bytes:  # more query parts then need fewer base parts, which repeat the hits
        side = int(np.ceil(GRID_TASKS_PER_CORE * cores / query_parts))
    return max(side, parts(n_base, row_bytes, GRID_BASE_BYTES)), query_parts


def pair_grid(base: DataFrame, queries: DataFrame, key: str, qid: str, shape: tuple[int, int], base_rows: int = BASE_ROWS,
              query_rows: int = QUERY_ROWS, cell: str | None = None) -> Grid:
    """Every base row with every query, both sides of any size: part (g, h) of a grid of ``shape`` gets base part
    ``g`` and query part ``h``. Rows are packed where they lie; one shuffle moves the blocks. With a ``cell`` column
    a base block holds rows of one cell, and the blocks of a part come cell by cell."""
    n_base, n_query = shape

    def packed(df: DataFrame, own: str, parts: int, rows: int, cell: str | None = None) -> DataFrame:
        schema = T.StructType([T.StructField("own", T.IntegerType()), T.StructField("cell", T.IntegerType()), T.StructField("payload", T.BinaryType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dealt, plain = batch.column("__part").to_numpy(), batch.drop_columns(["__part"])
                dealt = np.stack([dealt, batch.column(cell).to_numpy() if cell else np.zeros_like(dealt)])
                order = np.lexsort(dealt[::-1])
                starts = np.flatnonzero((np.diff(dealt[:, order], prepend=-1) != 0).any(axis=0)) if len(order) else []
                for at in np.split(order, starts[1:]) if len(order) else []:
                    for piece in _cut([plain.take(pa.array(at))], rows):
                        yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int32()) for x in dealt[:, at[0]]), pa.array([encode(piece)], pa.binary())], names=schema.names)

        dealt = df.withColumn("__part", F.pmod(F.xxhash64(own), F.lit(parts)).cast("int"))
        return dealt.mapInArrow(run, schema)

    left = packed(base, key, n_base, base_rows, cell).select(
        F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))).alias("other"), "own", "cell", "payload").select(
        (F.col("own") * n_query + F.col("other")).alias("part"), F.lit(1).alias("side"), "cell", "payload")
    right = packed(queries, qid, n_query, query_rows).select(
        F.explode(F.sequence(F.lit(0), F.lit(n_base - 1))).alias("other"), "own", "cell", "payload").select(
        (F.col("other") * n_query + F.col("own")).alias("part"), F.lit(0).alias("side"), "cell", "payload")
    dealt = left.unionByName(right).repartitionById(n_base * n_query, F.col("part"))
    return Grid(dealt.sortWithinPartitions("part", "side", *(["cell"] if cell else [])), base_rows, query_rows)


def wide(df: DataFrame) -> bool:
    """Whether so many tasks would each emit their own best rows that a first bound pays."""
    return estimated_tasks(df) > 8 * SEED_TASKS


def some_partitions(df: DataFrame, tasks: int = SEED_TASKS) -> DataFrame:
    """The rows of about ``tasks`` evenly spaced partitions; the others are not read.

    The spacing follows the size estimate; a wrong one costs time only, any subset gives a true bound.
    """
    stride = min(10_000, max(1, estimated_tasks(df) // tasks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if TaskContext.get().partitionId() % stride == 0:
            yield from batches

    return df.mapInArrow(run, df.schema)


def _blocks_of(df: DataFrame, spread: Column, rows: int, count: str) -> DataFrame:
    """Block number within the cell, from the cell's row count."""
    return df.withColumn("block", F.pmod(F.xxhash64(spread), F.ceil(F.col(count) / rows).cast("long")).cast("int"))


def pair_cells(base: DataFrame, queries: DataFrame, key: str, qid: str, base_rows: int = BASE_ROWS,
               query_rows: int = QUERY_ROWS) -> DataFrame:
    """Blocks of equal ``cell``. Row counts per cell decide how a cell is cut.

    A cell with ``n`` base and ``m`` query blocks is dealt over ``ceil(n/16) * ceil(m/16)`` join
    keys, so no key ever holds more than 16 blocks of either side.
    """
    def counts(df, name):
        return df.groupBy("cell").agg(F.count(F.lit(1)).alias(name))

    sizes = counts(base, "n_base").join(counts(queries, "n_query"), "cell")
    sizes = materialize(sizes, "cell-sizes")
    sizes = sizes.withColumn("g_parts", F.ceil(F.col("n_base") / (base_rows * BLOCKS_PER_TASK)).cast("int"))
    sizes = sizes.withColumn("h_parts", F.ceil(F.col("n_query") / (query_rows * BLOCKS_PER_TASK)).cast("int"))

    def side(df, spread, rows, count, own, other):
        sized = skew_join(df, sizes, "cell", F.col(spread))
        sized = _blocks_of(sized, F.col(spread), rows, count)
        drop = ["n_base", "n_query"]
        packed = pack_groups(sized.drop(*drop), ["cell", "g_parts", "h_parts", "block"])
        own_part = F.pmod(F.col("block"), F.col(f"{own}_parts")).cast("int").alias(own)
        spread_part = F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)).alias(other)
        return packed.select("cell", own_part, spread_part, "payload")

    left = side(base, key, base_rows, "n_base", "g", "h")
    right = side(queries, qid, query_rows, "n_query", "h", "g").withColumnRenamed("payload", "query_payload")
    return left.join(right.hint("shuffle_hash"), ["cell", "g", "h"]).select("cell", "payload", "query_payload")


# ---------------------------------------------------------------- merging


def best_per(hits: DataFrame, by: list[str], k: int, order: list[str], rank: str = "rank") -> DataFrame:
    """Top ``k`` rows per key under a total order; Spark limits each partition before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*[F.col(c) for c in order])
    return hits.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
