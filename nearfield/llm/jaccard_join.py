"""N-gram Jaccard join with Bayesian candidate pruning.

Documents with equal shingle sets are one node, so copies are never expanded. Nodes that share a MinHash band are
candidates (24 bands of 4 values: a pair at the threshold is missed with a chance of 3e-6). Candidates are compared
MinHash value by MinHash value: after t values, m of them equal, the similarity has the posterior Beta(m+1, t-m+1), and a
pair is dropped once the chance of reaching the threshold falls below ``TOLERANCE``. Survivors are verified on their whole shingle sets.

No pair is ever a row. Buckets and components are cut into chunks; a task takes two chunks, compares them as
matrices and returns one row per document: its number of links and the least document it is linked to. So a group of n
near copies costs n rows per pair of chunks, and no bucket, however large, is dropped.

Cases. Words are lower-cased runs of letters and digits. A text of fewer than five words is one shingle; one
without words (null, empty) has no shingle, is linked to nothing and is a class of its own. Rows that share an
id are kept apart by their texts; a repeated row is a copy. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm.common import components, grouped, materialize, pieces, register, star, table
from nearfield.llm.decontamination import split_words

PIECE = 1 << 20  # bytes of text made into shingles at once
WIDTH = 5
UP, DOWN = 4, 5  # the threshold 0.8 as a fraction, so that verification is exact
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
STEP = 8
TOLERANCE = 1e-6
BUCKET_CHUNK, SET_CHUNK = 1024, 256
_rng = np.random.default_rng(20240501)
FACTOR = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
PLACE = _rng.integers(1, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a published finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    split = [split_words(t) for t in texts]
    code = {w: word_hash(w) for w in set().union(*split)} if split else {}
    out = []
    for words in split:
        h = np.fromiter(map(code.__getitem__, words), np.uint64, len(words))
        n = len(h) - width + 1
        if n < 1:
            out.append(mix((h * PLACE[: len(h)]).sum(keepdims=True) + np.uint64(len(h))) if len(h) else h)
            continue
        total = np.zeros(n, np.uint64)
        for i in range(width):
            total += h[i: i + n] * PLACE[i]
        out.append(np.unique(mix(total)))
    return out


def minhash(shingles: np.ndarray) -> np.ndarray:
    """``HASHES`` MinHash values (32 bits) of a set."""
    low = np.full(HASHES, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 2048):
        low = np.minimum(low, (shingles[at: at + 2048, None] * FACTOR + SHIFT).min(0))
    return (low >> np.uint64(32)).astype(np.uint32)


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, node, n, signature) per row; ``node`` identifies the shingle set, null without words."""

    def run(batches):
        for batch in batches:
            for rows, texts in pieces(batch, size=PIECE):
                sets = shingle_sets(texts)
                yield pa.RecordBatch.from_arrays([
                    rows["doc_id"], rows["text_hash"], pa.array([signed(int((mix(s) * mix(s + np.uint64(len(s)))).sum())) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()), pa.array([minhash(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "text_hash", "node", "n", "signature"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id bigint, text_hash bigint, node bigint, n int, signature binary")


def least_matches(tolerance: float = TOLERANCE) -> dict[int, int]:
    """After t compared values, the fewest equal ones with which a pair is kept.

    P(similarity >= s | m of t equal) under a uniform prior is P(Binomial(t + 1, s) <= m).
    """
    s, out = UP / DOWN, {}
    for t in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(t + 1, m) * s**m * (1 - s) ** (t + 1 - m)
        out[t] = m
    return out


LEAST = least_matches()


def survivors(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) that Bayesian pruning keeps; with ``same`` a is b and each pair is given once."""
    equal = np.zeros((len(a), len(b)), np.uint8)
    for i in range(STEP):
        equal += a[:, i, None] == b[None, :, i]
    kept = equal >= LEAST[STEP]
    if same:
        kept = np.triu(kept, 1)
    p, q = np.nonzero(kept)
    m = equal[p, q].astype(np.int32)
    for t in range(STEP, HASHES, STEP):
        if not len(p):
            break
        m += (a[p, t: t + STEP] == b[q, t: t + STEP]).sum(1, dtype=np.int32)
        good = m >= LEAST[t + STEP]
        p, q, m = p[good], q[good], m[good]
    return p, q


def chunk_pairs(rows: DataFrame, size: str, chunk: int) -> DataFrame:
    """Deal the rows of each group over chunks of about ``chunk`` nodes and send them to every pair (i <= j) of chunks."""
    count = F.ceil(F.col(size) / chunk).cast("int")
    own = rows.withColumn("c", F.pmod(F.xxhash64("node", F.lit(5)), count).cast("int"))
    return (own.withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
            .withColumns({"i": F.least("c", "other"), "j": F.greatest("c", "other")}).drop("other"))


def bucket_members(nodes: DataFrame) -> DataFrame:
    """(bucket, node, m): nodes of every band bucket with m >= 2 nodes; of buckets with the same nodes only one is given."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring(F.col("signature"), k * (ROWS * 4) + 1, F.lit(ROWS * 4))))
    bands = nodes.select("node", F.explode(keys).alias("bucket"))
    buckets = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y"))
    once = buckets.where("m > 1").groupBy("m", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "m")
    return bands.join(once, "bucket")


def candidate_edges(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Edges (a, b) that join the pruned candidates of each bucket to their least node."""
    dealt = chunk_pairs(members, "m", BUCKET_CHUNK).join(nodes.select("node", "signature"), "node")
    sorted_ = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").select("bucket", "i", "j", "c", "node", "signature")

    def run(batches):
        for (_, i, j), rows in grouped(batches, ["bucket", "i", "j"]):
            node, c = rows["node"].to_numpy(), rows["c"].to_numpy()
            order = np.argsort(node)
            node, c = node[order], c[order]
            sig = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint32).reshape(len(node), HASHES)[order]
            left, right = np.flatnonzero(c == i), np.flatnonzero(c == j)
            p, q = survivors(sig[left], sig[right], i == j)
            label = star(len(node), left[p], right[q])
            moved = np.flatnonzero(label != np.arange(len(node)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(node[label[moved]]), pa.array(node[moved])], names=["a", "b"])

    return sorted_.mapInArrow(run, "a bigint, b bigint")


def exact_links(sets: DataFrame) -> DataFrame:
    """(node, links, least): verified links of the nodes of each component, counted in documents.

    ``sets`` has (component, size, node, copies, shingles, signature).
    """
    dealt = chunk_pairs(sets, "size", SET_CHUNK).repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")

    def run(batches):
        for (_, i, j), rows in grouped(batches, ["component", "i", "j"]):
            node, c, copies = (rows[k].to_numpy() for k in ("node", "c", "copies"))
            sets_of = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]
            sig = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint32).reshape(len(node), HASHES)
            left, right = np.flatnonzero(c == i), np.flatnonzero(c == j)
            p, q = survivors(sig[left], sig[right], i == j)
            p, q = left[p], right[q]
            size = np.array([len(s) for s in sets_of], np.int64)
            good = common_counts(sets_of, p, q) * (UP + DOWN) >= UP * (size[p] + size[q])
            p, q = p[good], q[good]
            links = np.bincount(p, copies[q], len(node)) + np.bincount(q, copies[p], len(node))
            order = np.argsort(node)
            rank = np.empty_like(order)
            rank[order] = np.arange(len(node))
            label = star(len(node), rank[p], rank[q])
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links.astype(np.int64)), pa.array(node[order[label[rank]]])], names=["node", "links", "least"])

    return dealt.select("component", "i", "j", "c", "node", "copies", "shingles", "signature").mapInArrow(run, "node bigint, links bigint, least bigint")


def common_counts(sets: list[np.ndarray], p: np.ndarray, q: np.ndarray, columns: int = 8192) -> np.ndarray:
    """Exact intersection sizes of the pairs of sets p-q."""
    if len(p) < 64:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(p.tolist(), q.tolist())], np.int64)
    value, code, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    twice = seen[code] > 1  # a shingle of one set is in no intersection
    place = np.cumsum(seen > 1) - 1
    row, code = row[twice], place[code[twice]]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(code[-1]) + 1 if len(code) else 0, columns):
        a, b = np.searchsorted(code, [at, at + columns])
        part = np.zeros((len(sets), columns), np.float32)
        part[row[a:b], code[a:b] - at] = 1
        total += part @ part.T
    return total[p, q].astype(np.int64)


def node_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, ..., shingles, signature) from the one document that stands for each node; texts are shuffled once."""
    where = nodes.select(F.col("at.doc_id").alias("doc_id"), F.col("at.text_hash").alias("text_hash"), "node", "component", "size", "copies")
    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")
    same = texts["doc_id"].eqNullSafe(where["doc_id"]) & (texts["text_hash"] == where["text_hash"])
    found = texts.join(where, same).select("node", "component", "size", "copies", "text").dropDuplicates(["node"])

    def run(batches):
        for batch in batches:
            for rows, found_texts in pieces(batch, size=PIECE):
                sets = shingle_sets(found_texts)
                yield pa.RecordBatch.from_arrays([*(rows[k] for k in ("node", "component", "size", "copies")), pa.array([s.tobytes() for s in sets], pa.binary()),
                                                  pa.array([minhash(s).tobytes() for s in sets], pa.binary())],
                                                 names=["node", "component", "size", "copies", "shingles", "signature"])

    return found.mapInArrow(run, "node bigint, component bigint, size bigint, copies bigint, shingles binary, signature binary")


def join_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, class_id, copy_of, n_links, first): the join's result, one row per document row.

    ``class_id`` is the least doc_id reachable over links of at least the threshold, ``copy_of`` the least with the same
    shingle set, ``n_links`` the number of other rows at or above the threshold, ``first`` whether the row stands for its class.
    """
    rows = materialize(signatures(docs), "signatures")
    nodes = materialize(rows.where("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_hash")).alias("at"), F.min("signature").alias("signature")), "nodes")
    found = materialize(components(candidate_edges(nodes, bucket_members(nodes))), "candidates")
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    active = nodes.select("node", "copies", "at").join(found.join(sizes, "component"), "node")
    links = materialize(exact_links(node_sets(docs, active)), "links")
    groups = components(links.where("least <> node").select(F.col("least").alias("a"), F.col("node").alias("b")))
    linked = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.join(linked, "node", "left").join(groups, "node", "left").select(
        "node", "at", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    leaders = known.groupBy("component").agg(F.min("at").alias("leader"))
    told = known.join(leaders, "component").select("node", "n_links", "leader", F.col("at.doc_id").alias("copy_of"))
    own = F.struct("doc_id", "text_hash")
    # a hot node has many rows on one side and one on the other: the adaptive skew join splits it
    return rows.select("doc_id", "text_hash", "node").join(told, "node", "left").select(
        "doc_id", "text_hash", F.when(F.col("leader").isNull(), F.col("doc_id")).otherwise(F.col("leader.doc_id")).alias("class_id"),
        F.when(F.col("leader").isNull(), F.col("doc_id")).otherwise(F.col("copy_of")).alias("copy_of"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce(F.col("leader").eqNullSafe(own), F.lit(True)).alias("leads"), F.col("leader").isNull().alias("alone"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, with all columns; documents without words stay."""
    found = materialize(join_copies(docs).select("doc_id", "text_hash", (F.col("leads") | F.col("alone")).alias("stays"), "alone"), "classes")
    names = docs.columns
    nested = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("d"))
    chosen = found.where("stays").groupBy("doc_id", "text_hash").agg(F.max("alone").alias("alone"))
    same = nested["doc_id"].eqNullSafe(chosen["doc_id"]) & (nested["text_hash"] == chosen["text_hash"])
    kept = nested.join(chosen, same).select(nested["doc_id"], nested["text_hash"], "alone", "d")
    one = kept.where("not alone").dropDuplicates(["doc_id", "text_hash"])  # repeated rows of a leading document
    return one.unionByName(kept.where("alone")).select(*[F.col(f"d.`{c}`").alias(c) for c in names])


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_copies(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_of", "n_links")


register("op6_jaccard_join", op6_jaccard_join)
