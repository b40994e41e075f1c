"""Best-fit packing of token sequences by the linear grouping scheme.

Pieces of documents are packed into as few sequences of ``capacity`` tokens as the scheme finds. Only the number of
pieces of each length matters for the plan, so the driver gets one count per length (at most ``capacity`` numbers, however many
documents there are) and plans with counts, never with pieces:

1. large lengths, in descending order, are cut into ``GROUPS`` groups of equal cardinality and rounded up to their group's largest;
2. the few rounded sizes give a small linear programme over configurations (which sizes share a sequence), solved by column
   generation; the whole part of its solution is used;
3. actual lengths take the places of the rounded ones, the last of a sequence as long as the actual room allows, so that a configuration
   splits into few runs of alike sequences and rounding costs no room;
4. what is left and all small lengths go, largest first, to the sequence with the least room that still holds them.

The plan is a list of runs: pieces number ``low`` and on of one length lie ``per`` a sequence from sequence ``first`` on. A piece's number
within its length is its place in its task plus the pieces of that length in the tasks before, so no length, however frequent,
is gathered or sorted anywhere, and each piece finds its sequence by a binary search.

Cases. A null or empty text is its end id alone. A document of more tokens than ``capacity`` is cut into full pieces behind a first one that
may be shorter; others are never cut. Rows that share an id, and repeated rows, are packed each. Ties between equal lengths follow the
place in the input. Other columns are not read. An empty table gives no rows and no sequence.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearfield.llm.common import materialize, pieces, register, table
from nearfield.llm.fast_bpe import byte_encoder
from nearfield.session import broadcast_if_small

CAPACITY, GROUPS, SMALL_SHARE = 1024, 32, 8
ROUNDS = 40  # column generation stops after this many rounds a group; any stop leaves a valid plan
PIECES = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint, part int, nth bigint"


# ---------------------------------------------------------------- pieces


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = None, with_ids: bool = False) -> DataFrame:
    """Encode (doc_id, text) rows and cut them; stores and returns one row per piece.

    ``part`` and ``nth`` number the pieces of equal length: the task, and the place among that task's pieces of the length.
    """

    def run(batches):
        encode, part = byte_encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            for rows, found in pieces(batch):
                out: list[tuple] = []
                for doc, text in zip(rows["doc_id"].to_pylist(), found):
                    ids = np.concatenate([encode(text.decode()), tail]).astype("<u4")
                    n, at = len(ids), 0
                    for piece in range(-(-n // capacity)):
                        stop = at + ((n - 1) % capacity + 1 if piece == 0 else capacity)
                        own = ids[at:stop]
                        out.append((doc, piece, at, stop - at, zlib.crc32(own.tobytes()), part, int(seen[stop - at])) + ((own.astype(np.int32),) if with_ids else ()))
                        seen[stop - at] += 1
                        at = stop
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return materialize(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema), "pieces")


# ---------------------------------------------------------------- plan


def best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The configuration of greatest worth (a knapsack over whole sizes): number of each size, and the worth."""
    good = np.flatnonzero(worth > 1e-12)
    order = good[np.argsort(sizes[good], kind="stable")]
    own, value = sizes[order], worth[order]
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    upto = np.searchsorted(own, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if upto[c]:
            tried = best[c - own[: upto[c]]] + value[: upto[c]]
            k = int(tried.argmax())
            if tried[k] > best[c]:
                best[c], last[c] = tried[k], k
    counts, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[order[last[c]]] += 1
            c -= int(own[last[c]])
    return counts, float(best[capacity])


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(number of each size, how many sequences) from the linear programme over configurations, rounded down."""
    m = len(sizes)
    if not m:
        return []
    basis = np.diag(capacity // sizes).astype(float)
    need = demand.astype(float)
    for _ in range(ROUNDS * m):
        price = np.linalg.solve(basis.T, np.ones(m))
        column, worth = best_configuration(sizes, price, capacity)
        if worth <= 1 + 1e-9:
            break
        amount, change = np.linalg.solve(basis, np.column_stack([need, column])).T
        ratio = np.where(change > 1e-9, np.maximum(amount, 0) / np.maximum(change, 1e-9), np.inf)
        basis[:, int(ratio.argmin())] = column
    amount = np.floor(np.linalg.solve(basis, need) + 1e-9).astype(np.int64)
    return [(basis[:, k].astype(np.int64), int(n)) for k, n in enumerate(amount) if n > 0]


class Plan:
    """Sequences planned from the number of pieces of each length (``counts[s]`` pieces of length s)."""

    def __init__(self, counts: np.ndarray, capacity: int, groups: int = GROUPS):
        self.capacity, self.left = capacity, counts.astype(np.int64).copy()
        self.next = np.zeros(capacity + 1, np.int64)  # number of the first piece of each length that is not placed
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, low, first sequence, per sequence, offset
        self.room: dict[int, list[tuple[int, int]]] = {}  # room left: runs of sequences (first, how many)
        self._large(max(1, capacity // SMALL_SHARE), groups)
        for size in range(capacity, 0, -1):
            self._best_fit(size)

    def _put(self, size: int, first: int, many: int, per: int, offset: int) -> None:
        self.runs.append((size, int(self.next[size]), first, per, offset))
        self.next[size] += many * per
        self.left[size] -= many * per

    def _open(self, many: int) -> int:
        self.sequences += many
        return self.sequences - many

    def _free(self, room: int, first: int, many: int) -> None:
        if room and many:
            self.room.setdefault(room, []).append((first, many))

    def _large(self, small: int, groups: int) -> None:
        """Rounded sizes, configurations, and the actual lengths put in their places."""
        own = [(s, int(self.left[s])) for s in range(self.capacity, small, -1) if self.left[s]]
        each = -(-sum(n for _, n in own) // groups)
        demand: dict[int, int] = {}  # pieces of each rounded size
        filled, size = each, 0
        for s, n in own:
            while n:
                if filled == each:
                    filled, size = 0, s
                take = min(n, each - filled)
                demand[size] = demand.get(size, 0) + take
                filled, n = filled + take, n - take
        names = np.array(sorted(demand), np.int64)
        least = np.concatenate([[small], names[:-1]]) + 1  # a rounded size stands for the lengths above the next smaller one
        found = configurations(names, np.array([demand[s] for s in names.tolist()], np.int64), self.capacity)
        for config, many in sorted(found, key=lambda f: f[0][::-1].tolist(), reverse=True):
            slots = [k for k in reversed(range(len(names))) for _ in range(config[k])]
            self._substitute([(int(least[k]), int(names[k])) for k in slots], many)

    def _substitute(self, slots: list[tuple[int, int]], many: int) -> None:
        """Fill up to ``many`` sequences whose slots stand for lengths from .. to.

        Every slot takes the greatest length left of its range, the last one the greatest that fits into the actual room. As many
        sequences as the lengths allow are filled alike; a sequence for which a slot finds nothing is left to the best fit.
        """
        while many:
            sizes: list[int] = []
            for k, (low, high) in enumerate(slots):
                top = self.capacity - sum(sizes) if k == len(slots) - 1 else high
                sizes.append(next((s for s in range(top, low - 1, -1) if self.left[s] > sizes.count(s)), 0))
            if not all(sizes):
                return
            alike = min(many, *(int(self.left[s]) // sizes.count(s) for s in sizes))
            base, used = self._open(alike), 0
            for size in dict.fromkeys(sizes):
                self._put(size, base, alike, sizes.count(size), used)
                used += size * sizes.count(size)
            self._free(self.capacity - used, base, alike)
            many -= alike

    def _best_fit(self, size: int) -> None:
        """Place all pieces of one length where the room is least; new sequences when there is none."""
        room = size
        while self.left[size]:
            while room < self.capacity and not self.room.get(room):
                room += 1
            runs = self.room.get(room) if room < self.capacity else None
            if runs:
                first, many = runs.pop()
            else:
                room, many = self.capacity, -(-int(self.left[size]) // (self.capacity // size))
                first = self._open(many)
            per = room // size
            full = min(many, int(self.left[size]) // per)
            if full:
                self._put(size, first, full, per, self.capacity - room)
                self._free(room - per * size, first, full)
            if full < many:
                rest = int(self.left[size])
                if rest:  # fewer than fill one sequence
                    self._put(size, first + full, 1, rest, self.capacity - room)
                    self._free(room - rest * size, first + full, 1)
                    full += 1
                self._free(room, first + full, many - full)

    def place(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and numbers."""
        runs = np.array(sorted(self.runs), np.int64).reshape(-1, 5)
        at = np.searchsorted(runs[:, 0] << 42 | runs[:, 1], lengths << 42 | numbers, "right") - 1
        size, low, first, per, offset = runs[at].T
        return first + (numbers - low) // per, offset + (numbers - low) % per * size


# ---------------------------------------------------------------- the operator


def pack(stored: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (see ``token_pieces``)."""
    many = materialize(stored.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for r in many.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    plan = Plan(counts, capacity, groups)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    base = broadcast_if_small(many.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    placed = stored.join(base, ["length", "part"]).withColumn("sequence_id", F.lit(0).cast("bigint")).withColumn("offset", F.lit(0).cast("bigint"))

    def run(batches):
        for batch in batches:
            number = batch["base"].to_numpy() + batch["nth"].to_numpy()
            new = dict(zip(("sequence_id", "offset"), plan.place(batch["length"].to_numpy().astype(np.int64), number)))
            yield pa.RecordBatch.from_arrays([pa.array(new[n]) if n in new else batch[n] for n in batch.schema.names], schema=batch.schema)

    return placed.mapInArrow(run, placed.schema).drop("base", "part", "nth")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: (sequence_id, ids, documents with offset and length); needs pieces stored ``with_ids``.

    A group is one sequence, at most ``capacity`` ids.
    """
    rows = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    one = packed.groupBy("sequence_id").agg(rows.alias("rows"))
    return one.select("sequence_id", F.flatten("rows.ids").alias("ids"),
                      F.transform("rows", lambda r: F.struct(r["doc_id"], r["piece"], r["offset"], r["length"])).alias("documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    stored = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return pack(stored).select("doc_id", "piece", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32", "sequence_id", "offset")


register("op12_packing", op12_packing)
