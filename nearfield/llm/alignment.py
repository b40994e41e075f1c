"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often over the corpus.

Both tokenizers cut the same bytes (a space and the text), so each is a list of ends. Ends that both have cut a document into groups;
between two neighbouring ends of either lies one link, an A token and a B token that overlap. How many documents hold a pair of
ids linked is counted externally:

1. a task links its documents and, whenever it holds ``RUN_RECORDS`` links, sorts them to distinct (pair, document) records, cuts those by
   the radix of the A id and writes one compressed run per radix, with the documents' own facts beside them: a chunk;
2. the runs of a radix are merged over a heap of their heads, block by block, and each pair's documents are added up. A radix with many
   bytes of runs (one frequent A id may have a third of all records) is dealt over slots by chunk, and the slots' sums are added;
3. the counts of a radix come in side-major order (all pairs of one A id next to each other), which yields each A id's highest count;
4. the runs are read once more, beside their radix's counts, and give each document's contributions back to its chunk, where they are added.

A task of 3 and 4 holds the counted pairs of one radix, whose number is bounded by the two vocabularies, not by the corpus; a task of 2 and 4
reads its runs one after the other. All tables in between lie in the shared folder.

Cases. A null or empty text, and one whose joined token bytes are not a space and the text, has no tokens and only zeros. Special tokens'
strings in texts are plain text. Repeated rows and rows that share an id count as documents each. Texts of any length are
whole. Equal highest counts of an A id are all best. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm.common import materialize, pieces, register, table
from nearfield.llm.fast_bpe import byte_encoder

RADIX, RUN_RECORDS, SLOT_BYTES = 64, 2_000_000, 8 << 20
LINK_BYTES = 1 << 20  # texts that are linked at once
BLOCK_PAIRS, BUFFER_PAIRS = 4096, 1 << 18  # of the merge: pairs per block of a run, pairs held before sums are handed on
FACTS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
CHUNKS = ("chunk bigint, docs array<struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string>>, "
          "runs array<struct<radix:int,size:bigint,data:binary>>")


# ---------------------------------------------------------------- stored arrays


def shrink(*arrays: np.ndarray) -> bytes:
    """Non-negative integer arrays in their narrowest types, compressed."""
    small = [a.astype(np.min_scalar_type(int(a.max(initial=0)))) for a in arrays]
    head = np.array([len(small), *(x for a in small for x in (a.itemsize, len(a)))], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head, *(a.tobytes() for a in small)]))


def expand(data: bytes, first: int | None = None) -> list[np.ndarray]:
    """The arrays of ``shrink`` as int64; with ``first`` only so many of them."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(n, 2).tolist()
    out, at = [], 8 * (1 + 2 * n)
    for size, many in head[:first]:
        out.append(np.frombuffer(raw, f"<u{size}", many, at).astype(np.int64))
        at += size * many
    return out


# ---------------------------------------------------------------- tokens and links


class Sides:
    """Both tokenizers of a worker: A a byte-level BPE file, B a sentencepiece model with byte fallback."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a, self.b = byte_encoder(path_a, special=False), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [self.a.bytes_of.get(i, b"") for i in range(max(self.a.bytes_of) + 1)]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.size_a, self.size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.names = [f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in ",|"] + [f"{i}{mark}" for i in range(len(self.bytes_b)) for mark in ",;"]
        self.width = -(-len(self.bytes_a) // RADIX)

    def key(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of a pair; pairs of one radix, and therein of one A id, are neighbours."""
        return (a % RADIX * self.width + a // RADIX) * len(self.bytes_b) + b

    def pair(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place, b = np.divmod(key, len(self.bytes_b))
        return place % self.width * RADIX + place // self.width, b

    def radix(self, key: np.ndarray) -> np.ndarray:
        return key // (self.width * len(self.bytes_b))

    def tokens(self, texts: list[str]) -> list[tuple]:
        """For each text the ids of both sides, or None where their bytes are not a space and the text."""
        out: list = [None] * len(texts)
        own = [i for i, t in enumerate(texts) if t]
        for i, b in zip(own, self.b.encode([texts[i] for i in own], num_threads=1) if own else ()):
            a, raw = self.a(" " + texts[i]), b" " + texts[i].encode()
            if b"".join(map(self.bytes_b.__getitem__, b)) == raw and b"".join(map(self.bytes_a.__getitem__, a.tolist())) == raw:
                out[i] = a.astype(np.int64), np.array(b, np.int64)
        return out

    def link(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """Facts of each text (n_a, n_b, n_groups, n_links, groups_sha256), and (text number, pair) of every link."""
        found = self.tokens(texts)
        n = len(texts)
        many_a, many_b = (np.array([0 if f is None else len(f[k]) for f in found], np.int64) for k in (0, 1))
        if not many_a.sum():
            return [(0, 0, 0, 0, "")] * n, np.empty(0, np.int64), np.empty(0, np.int64)
        a, b = (np.concatenate([f[k] for f in found if f is not None]) for k in (0, 1))
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])  # over all texts: each starts where the last one ended
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        ends = ends[np.concatenate([[True], ends[1:] != ends[:-1]])]
        at = np.searchsorted(end_a, ends)
        doc_a = np.repeat(np.arange(n), many_a)
        doc = doc_a[at]
        last_a, last_b = end_b[np.searchsorted(end_b, end_a)] == end_a, end_a[np.searchsorted(end_a, end_b)] == end_b
        groups = np.bincount(doc_a[last_a], minlength=n)
        # tokens in the order of the written groups: a group's A tokens, then its B tokens
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        upto_a, upto_b = (np.concatenate([[0], np.cumsum(np.bincount(g))]) for g in (group_a, group_b))
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + upto_b[group_a]] = a * 2 + last_a
        code[np.arange(len(b)) + upto_a[group_b + 1]] = 2 * len(self.bytes_a) + b * 2 + last_b
        stop = np.cumsum(many_a + many_b)
        facts, get = [], self.names.__getitem__
        for i, (x, y, g, k, to) in enumerate(zip(many_a.tolist(), many_b.tolist(), groups.tolist(), np.bincount(doc, minlength=n).tolist(), stop.tolist())):
            text = "".join(map(get, code[to - x - y: to].tolist()))[:-1]
            facts.append((x, y, g, k, hashlib.sha256(text.encode()).hexdigest() if x else ""))
        return facts, doc, self.key(a[at], b[np.searchsorted(end_b, ends)])


_SIDES: dict[tuple[str, str], Sides] = {}


def sides(path_a: str, path_b: str) -> Sides:
    if (path_a, path_b) not in _SIDES:
        _SIDES[path_a, path_b] = Sides(path_a, path_b)
    return _SIDES[path_a, path_b]


# ---------------------------------------------------------------- runs


def runs_of(own: Sides, doc: np.ndarray, key: np.ndarray) -> list[dict]:
    """Sorted runs, one per radix: distinct pairs, documents of each, and per document its number (as steps) and links."""
    if not len(key):
        return []
    record, links = np.unique(key << 24 | doc, return_counts=True)
    key, doc = record >> 24, record & 0xFFFFFF
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    step = np.diff(doc, prepend=0)
    step[head] = doc[head]
    pairs, radix = key[head], own.radix(key[head])
    cuts = np.searchsorted(radix, np.arange(RADIX + 1))
    bounds = np.append(head, len(record))
    out = []
    for r in np.flatnonzero(np.diff(cuts)).tolist():
        low, high = cuts[r], cuts[r + 1]
        rows = slice(bounds[low], bounds[high])
        data = shrink(np.diff(pairs[low:high], prepend=0), np.diff(bounds[low: high + 1]), step[rows], links[rows] - 1)
        out.append({"radix": r, "size": len(data), "data": data})
    return out


def read_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a run, in order, and the documents of each."""
    step, many = expand(data, 2)
    return np.cumsum(step), many


def read_records(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each record of a run: pair, document number and links."""
    pair, many, step, links = expand(data)
    total = np.cumsum(step)
    before = np.cumsum(many) - many
    doc = total - np.repeat(total[before] - step[before], many)
    return np.repeat(np.cumsum(pair), many), doc, links + 1


def merge(runs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way merge of sorted (pairs, documents) runs over a heap of their heads; yields distinct pairs in order with their sums.

    The run with the least head gives a block; whatever lies below the next head is complete.
    """
    held = list(runs)
    heap = [(int(p[0]), i, 0) for i, (p, _) in enumerate(held) if len(p)]
    heapq.heapify(heap)
    pairs, many, waiting = [], [], 0
    while heap:
        _, i, at = heapq.heappop(heap)
        own, n = held[i]
        pairs.append(own[at: at + BLOCK_PAIRS])
        many.append(n[at: at + BLOCK_PAIRS])
        waiting += len(pairs[-1])
        if at + BLOCK_PAIRS < len(own):
            heapq.heappush(heap, (int(own[at + BLOCK_PAIRS]), i, at + BLOCK_PAIRS))
        if waiting >= BUFFER_PAIRS or not heap:
            every, place = np.unique(np.concatenate(pairs), return_inverse=True)
            total = np.zeros(len(every), np.int64)
            np.add.at(total, place, np.concatenate(many))
            done = int(np.searchsorted(every, heap[0][0])) if heap else len(every)
            if done:
                yield every[:done], total[:done]
            pairs, many, waiting = [every[done:]], [total[done:]], len(every) - done


# ---------------------------------------------------------------- the jobs


def store_chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Encode, link and store: one row per chunk, with its documents' facts and its runs."""

    def run(batches):
        own, part, made = sides(path_a, path_b), TaskContext.get().partitionId(), 0
        facts, links, waiting = [], [], 0

        def chunk():
            doc, key = (np.concatenate([x[k] for x in links]) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | made]), pa.array([facts], kinds[0]), pa.array([runs_of(own, doc, key)], kinds[1])],
                                              names=["chunk", "docs", "runs"])

        for batch in batches:
            for rows, found in pieces(batch, size=LINK_BYTES):
                new, doc, key = own.link([t.decode() for t in found])
                links.append((doc + len(facts), key))
                facts += [dict(zip(names, (i, *f))) for i, f in zip(rows["doc_id"].to_pylist(), new)]
                waiting += len(doc)
                if waiting >= RUN_RECORDS or len(facts) >= 1 << 20:
                    yield chunk()
                    facts, links, waiting, made = [], [], 0, made + 1
        if facts:
            yield chunk()

    names = [c.split()[0] for c in FACTS.split(", ")]
    kinds = (pa.list_(pa.struct([(n, pa.string() if n == "groups_sha256" else pa.int64()) for n in names])),
             pa.list_(pa.struct([("radix", pa.int32()), ("size", pa.int64()), ("data", pa.binary())])))
    return materialize(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, CHUNKS), "chunks")


class Dealt:
    """The runs of stored chunks, a radix dealt over as many slots as its bytes ask for."""

    def __init__(self, chunks: DataFrame):
        runs = chunks.select("chunk", F.explode("runs").alias("r")).select("chunk", "r.radix", "r.size", "r.data")
        sizes = runs.groupBy("radix").agg(F.sum("size").alias("size")).collect()  # at most RADIX rows
        slots = {r["radix"]: -(-r["size"] // SLOT_BYTES) for r in sizes}
        self.slots = F.element_at(F.array(*[F.lit(slots.get(r, 1)).cast("bigint") for r in range(RADIX)]), F.col("radix") + 1)
        self.groups = max(1, sum(slots.values()))
        self.runs = runs.select("radix", F.pmod(F.xxhash64("chunk"), self.slots).alias("slot"), "chunk", "data")

    def placed(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.groups, "radix", "slot").sortWithinPartitions("radix", "slot", "chunk")


def count_pairs(dealt: Dealt) -> DataFrame:
    """(radix, pair, n): in how many documents each pair is linked."""

    def groups(batches):
        """Runs of one (radix, slot) after the other; of each only the pairs are kept."""
        last, held = None, []
        for batch in batches:
            for radix, slot, data in zip(*(batch[c].to_pylist() for c in ("radix", "slot", "data"))):
                if (radix, slot) != last and held:
                    yield last[0], held
                    held = []
                last = (radix, slot)
                held.append(read_pairs(data))
        if held:
            yield last[0], held

    def run(batches):
        for radix, held in groups(batches):
            for pairs, n in merge(held):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), radix, np.int32)), pa.array(pairs), pa.array(n)], names=["radix", "pair", "n"])

    summed = dealt.placed(dealt.runs).mapInArrow(run, "radix int, pair bigint, n bigint")
    return summed.groupBy("radix", "pair").agg(F.sum("n").alias("n"))


def radix_counts(counted: DataFrame, per_id: int) -> DataFrame:
    """(radix, data): all counted pairs of a radix in side-major order, with 1 for those with their A id's highest count."""

    def run(batches):
        last, held = None, []

        def row():
            pairs, n = (np.concatenate(x) for x in zip(*held))
            head = np.flatnonzero(np.concatenate([[True], np.diff(pairs // per_id) != 0]))
            highest = np.repeat(np.maximum.reduceat(n, head), np.diff(np.append(head, len(n))))
            return pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([shrink(np.diff(pairs, prepend=0), n, n == highest)])], names=["radix", "data"])

        for batch in batches:
            radix = batch["radix"].to_numpy()
            for r in np.unique(radix).tolist():
                if r != last and held:
                    yield row()
                    held = []
                last = r
                held.append(tuple(batch[c].to_numpy()[radix == r] for c in ("pair", "n")))
        if held:
            yield row()

    return counted.repartition(RADIX, "radix").sortWithinPartitions("radix", "pair").mapInArrow(run, "radix int, data binary")


def contributions(dealt: Dealt, counts: DataFrame) -> DataFrame:
    """(chunk, data): what the pairs of one run give to the documents of its chunk (document numbers, sums of counts, best links)."""
    each = counts.select("radix", F.explode(F.sequence(F.lit(0).cast("bigint"), dealt.slots - 1)).alias("slot"), F.lit(-1).cast("bigint").alias("chunk"), "data")

    def run(batches):
        pairs = n = best = None
        for batch in batches:
            chunks, out = [], []
            for chunk, data in zip(batch["chunk"].to_pylist(), batch["data"].to_pylist()):
                if chunk < 0:  # the counts come before the runs of their slot
                    pairs, n, best = expand(data)
                    pairs = np.cumsum(pairs)
                    continue
                key, doc, links = read_records(data)
                at = np.searchsorted(pairs, key)
                size = int(doc.max()) + 1
                total, good, seen = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, bool)
                np.add.at(total, doc, links * n[at])
                np.add.at(good, doc, links * best[at])
                seen[doc] = True
                own = np.flatnonzero(seen)
                chunks.append(chunk)
                out.append(shrink(np.diff(own, prepend=0), total[own], good[own]))
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(out, pa.binary())], names=["chunk", "data"])

    return dealt.placed(dealt.runs.unionByName(each)).mapInArrow(run, "chunk bigint, data binary")


def add_up(chunks: DataFrame, given: DataFrame) -> DataFrame:
    """One row per document: its facts with ``n_best`` and ``count_sum`` added up over its chunk's contributions."""
    facts = chunks.select("chunk", F.lit(0).alias("kind"), "docs", F.lit(None).cast("binary").alias("data"))
    parts = given.select("chunk", F.lit(1).alias("kind"), F.lit(None).cast(chunks.schema["docs"].dataType).alias("docs"), "data")
    names = [c.split()[0] for c in FACTS.split(", ")]

    def run(batches):
        docs = total = best = None

        def rows():
            return pa.RecordBatch.from_arrays([*(docs.field(n) for n in names), pa.array(best), pa.array(total)], names=[*names, "n_best", "count_sum"])

        for batch in batches:
            for i, kind in enumerate(batch["kind"].to_pylist()):
                if kind == 0:  # a chunk's documents come before what is given to them
                    if docs is not None:
                        yield rows()
                    docs = batch["docs"][i].values
                    total, best = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
                else:
                    own, n, good = expand(batch["data"][i].as_py())
                    own = np.cumsum(own)
                    total[own] += n
                    best[own] += good
        if docs is not None:
            yield rows()

    placed = facts.unionByName(parts).repartition("chunk").sortWithinPartitions("chunk", "kind")
    return placed.mapInArrow(run, FACTS + ", n_best bigint, count_sum bigint")


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per (doc_id, text) row: n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum."""
    chunks = store_chunks(docs, path_a, path_b)
    dealt = Dealt(chunks)
    counts = materialize(radix_counts(count_pairs(dealt), len(sides(path_a, path_b).bytes_b)), "radix-counts")
    return add_up(chunks, contributions(dealt, counts))


def pair_table(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The alignment lexicon (a, b, documents): how many documents hold each pair of ids linked."""
    counted = count_pairs(Dealt(store_chunks(docs, path_a, path_b)))

    def run(batches):
        own = sides(path_a, path_b)
        for batch in batches:
            a, b = own.pair(batch["pair"].to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), batch["n"]], names=["a", "b", "documents"])

    return counted.mapInArrow(run, "a bigint, b bigint, documents bigint")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


register("op13_alignment", op13_alignment)
