"""LM scoring with a hashed maximum-entropy model: P(word | history) = P(class | history) * P(word | class, history).

P(class | history) is a softmax over ``CLASSES`` classes of summed weights of hashed features of the history: the word before, the
two words before, and, skipping one, the word two before. Classes come from frequency and shape (first letter, closing
mark, non-ASCII), the commonest words being classes of their own; class 0 holds words
met at most once, and the unknown word as one more type.

P(word | class, history) goes down a binary tree over the class, whose branches are the first ``DEPTH`` bits of the word's hash. Each
node that parts words is a maximum-entropy choice of two: the log-odds of the training counts below it and hashed weights of
(feature, node), for the same three features. Words that end at one leaf share it by their training counts. Without weights this is the
word's share of its class. Probabilities sum to one over the known words and "unknown". Words of class 0 share it evenly.

Tokenised once: a task turns its documents into a block of word codes with the hashes of its local vocabulary (equal words are decided by
96 bits). Local counts are summed over all training documents by word, and each block gets the counts of its own words back; no vocabulary is
broadcast, and no words are stored. Training
starts from the observed class counts of each feature and goes ``ROUNDS`` steps; in each, every task sums
observed minus expected counts over its part of that round's documents (all training documents are used once), the sums are added in
Spark and the driver gets one table of ``FEATURES`` x ``CLASSES`` weights, one of ``BRANCHES`` weights of tree nodes and the counts at the leaves of
the trees, sizes that do not depend on the data.

Cases. A null or empty text is one end token. Rows without an id are trained on. Repeated rows are scored one by one, and equally. Very
long texts are one row of a block. Other columns are not read. Without training documents all words are unknown; scores stay
finite. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearfield.llm.common import discard, grouped, materialize, parts, pieces, register, release, table

SINGLES, SHAPES = 15, 16
CLASSES = 1 + SHAPES + SINGLES
FEATURES = 1 << 15
BRANCHES = 1 << 20  # hashed weights of (feature, tree node)
DEPTH = 12  # bits of a word's hash that lead down the tree of its class
ROUNDS, RATE, CALM, SHARE = 4, 0.5, 4.0, 0.6
BLOCK_BYTES = 12 << 20
PART_BYTES = 16 << 20  # stored input of one file of coded blocks
GATHERED, CHOSEN = 1 << 17, 1 << 21  # tokens whose class shares, and tree choices that are added up at once
WORD_ROWS = 65_536
TASK_SUMS = 64  # tables of sums that are added at once
SLICE = 1 << 12  # tokens scored at once, so that what a step makes of them stays in the cache
BIAS_SLICES = 8  # slices whose class shares are added in 32 bits
TABLE_WAYS = 1 << 14  # tree weights per row
TABLE_ROWS = 512  # features per row when gradients are added
NEAR_ENDS = np.array([chr(c) in ".,;:!?|)" for c in range(256)])
BLOCK = "block bigint, doc_id array<bigint>, held array<boolean>, lengths binary, codes binary, hashes binary, checks binary, shapes binary, n binary"
SUMS = "at bigint, task int, sums binary"


def word_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of coded documents, one row each, with hashes, shapes and training counts of their local words."""

    def run(batches):
        made = 0

        def flush():
            nonlocal made
            block, made = (TaskContext.get().partitionId() << 20) + made, made + 1
            coded = pa.chunked_array(words).dictionary_encode().chunks  # numbered as they come; no chunk without words
            local = [b"", *(coded[0].dictionary.cast(pa.binary()).to_pylist() if coded else [])]  # the end of a document is word 0
            lengths = np.concatenate(counts) + 1
            flat, inner = np.zeros(lengths.sum(), np.int32), np.ones(lengths.sum(), bool)
            inner[np.cumsum(lengths) - 1] = False
            flat[inner] = np.concatenate([np.zeros(0, np.int32), *[c.indices.to_numpy() for c in coded]]) + 1
            n = np.bincount(flat[np.repeat(~np.array(held, bool), lengths)], minlength=len(local))
            digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, local)), "<u8").reshape(-1, 2)
            arrays = [lengths.astype(np.int32), flat, digests[:, 0], digests[:, 1].astype(np.uint32), shapes(local), n.astype(np.int64)]
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())), *[pa.array([squeezed(v)], pa.binary()) for v in arrays]],
                names=["block", "doc_id", "held", "lengths", "codes", "hashes", "checks", "shapes", "n"])

        ids, held, words, counts, size = [], [], [], [], 0
        for batch in batches:
            for rows, texts in pieces(batch):
                ids += rows["doc_id"].to_pylist()
                held += rows["held_out"].to_pylist()
                own, count = split(rows["text"])
                words.append(own)
                counts.append(count)
                size += sum(map(len, texts))
                if size >= BLOCK_BYTES:
                    yield flush()
                    ids, held, words, counts, size = [], [], [], [], 0
        if ids:
            yield flush()

    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(run, BLOCK)


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts (null: none) one after the other, A-Z lower-cased, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words, stop = lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    some = pc.greater(pc.binary_length(words), 0)  # white space at either end leaves an empty one
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return words.filter(some), np.diff(before[stop], prepend=0)


def squeezed(v: np.ndarray) -> bytes:
    """An array as compressed planes of its bytes behind its length: a block's row is a third as large on its way through Spark."""
    planes = np.ascontiguousarray(np.ascontiguousarray(v).view(np.uint8).reshape(len(v), v.itemsize).T)
    return np.int64(len(v)).tobytes() + pa.compress(pa.py_buffer(planes), "zstd", asbytes=True)


def unsqueezed(raw, kind) -> np.ndarray:
    n, width = int(np.frombuffer(raw, np.int64, 1)[0]), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(raw.slice(8), n * width, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).reshape(-1).view(kind)


def shapes(words: list[bytes]) -> np.ndarray:
    """0 .. 7 for each word, from a closing mark, a start that is no letter a-z and letters that are not ASCII."""
    ends = np.fromiter((w[-1] if w else 0 for w in words), np.uint8, len(words))
    starts = np.fromiter((w[0] if w else 97 for w in words), np.uint8, len(words))
    ascii_only = np.fromiter(map(bytes.isascii, words), bool, len(words))
    return (NEAR_ENDS[ends] + 2 * ((starts < 97) | (starts > 122)) + 4 * ~ascii_only).astype(np.uint8)


def word_counts(blocks: DataFrame) -> DataFrame:
    """(block, counts, firsts): the training counts over all documents of each block's words, and which of them no earlier block has.

    A word has one row per block at most, so the sum over a word is small whatever its frequency.
    """

    def explode(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x, h, n = (unsqueezed(batch[k][i].as_buffer(), t) for k, t in (("hashes", np.int64), ("checks", np.int32), ("n", np.int64)))
                for at in range(0, len(x), WORD_ROWS):
                    own = slice(at, at + WORD_ROWS)
                    size = len(x[own])
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (np.full(size, batch["block"][i].as_py()), np.arange(at, at + size, dtype=np.int32), x[own], h[own], n[own])],
                                                     names=["block", "at", "x", "h", "n"])

    def pack(batches):
        for (block,), rows in grouped(batches, ["block"]):
            order = np.argsort(rows["at"].to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([squeezed(rows["c"].to_numpy()[order])], pa.binary()), pa.array([squeezed(rows["first"].to_numpy()[order])], pa.binary())],
                                             names=["block", "counts", "firsts"])

    same = Window.partitionBy("x", "h")
    words = blocks.select("block", "hashes", "checks", "n").mapInArrow(explode, "block bigint, at int, x bigint, h int, n bigint")
    counted = words.select("block", "at", F.sum("n").over(same).alias("c"), (F.min("block").over(same) == F.col("block")).alias("first"))
    return counted.repartition("block").sortWithinPartitions("block").mapInArrow(pack, "block bigint, counts binary, firsts binary")


def classes(b: dict, top: np.ndarray) -> np.ndarray:
    """Class of each local word of a block; ``top`` are the hashes of the words that are classes of their own."""
    out = 1 + b["shapes"] * 2 + (b["counts"] >= 32)
    place = np.argsort(top)
    at = np.searchsorted(top[place], b["hashes"]).clip(max=max(0, len(top) - 1))
    if len(top):
        own = top[place][at] == b["hashes"]
        out[own] = 1 + SHAPES + place[at[own]]
    return np.where(b["counts"] <= 1, 0, out).astype(np.uint8)


def leaves(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - DEPTH)).astype(np.int64)


def totals(coded: DataFrame) -> dict:
    """One-row statistics, the commonest words, the training tokens of each class (``sizes``) and of each leaf of its tree (``leaves``)."""

    def common(batches):
        for batch in batches:
            for b in unpack(batch):
                c, x = b["counts"][b["firsts"]], b["hashes"][b["firsts"]]
                best = np.lexsort((x, -c))[:SINGLES]
                sums = [c.sum(), (c > 0).sum(), (c == 1).sum(), (c == 2).sum()]
                yield pa.RecordBatch.from_pylist([{"n": int(sums[0]), "v": int(sums[1]), "v1": int(sums[2]), "v2": int(sums[3])},
                                                  *[{"c": int(c[i]), "x": int(x[i].view(np.int64))} for i in best if c[i] > 2]], schema=schema)

    schema = pa.schema([(k, pa.int64()) for k in ("n", "v", "v1", "v2", "c", "x")])
    coded = coded.select("hashes", "shapes", "counts", "firsts")  # the codes stay where they lie
    # at most SINGLES + 1 numbers of each block
    seen = coded.mapInArrow(common, "n bigint, v bigint, v1 bigint, v2 bigint, c bigint, x bigint")
    n, v, v1, v2 = seen.agg(*[F.coalesce(F.sum(k), F.lit(0)) for k in ("n", "v", "v1", "v2")]).first()
    top = np.array([r["x"] for r in seen.where("c is not null").orderBy(F.desc("c"), "x").limit(SINGLES).collect()], np.int64).view(np.uint64)

    def placed(batches):
        sums = np.zeros((CLASSES, 1 << DEPTH), np.int64)
        for batch in batches:
            for b in unpack(batch):
                f = b["firsts"]
                np.add.at(sums, (classes(b, top)[f], leaves(b["hashes"][f])), b["counts"][f])
        for k, row in enumerate(sums.astype(float)):
            yield sums_row(k, row)

    below = np.zeros((CLASSES, 1 << DEPTH))
    for k, sums in added(coded, placed):
        below[k] = sums
    odds = branches(below)
    odds[0] = np.nan  # its words share it evenly
    return {"n": n, "v": v, "v1": v1, "v2": v2, "top": top, "sizes": dict(enumerate(below.sum(1))), "leaves": below, "odds": odds}


def branches(below: np.ndarray) -> np.ndarray:
    """Log-odds (1 against 0) of each tree node from the counts at the leaves, nodes in heap order from 1; NaN where nothing is parted."""
    out = np.full(below.shape, np.nan, np.float32)
    for d in range(DEPTH):
        n = below.reshape(len(below), 1 << d, 2, -1).sum(3)
        both = n.all(2)
        out[:, 1 << d: 2 << d][both] = np.log(n[both][:, 1] / n[both][:, 0])
    return out


def unpack(batch: pa.RecordBatch, stats: dict | None = None):
    """Blocks of a batch, one after the other, of the columns it has; with statistics also the classes of their words."""
    kinds = {"lengths": np.int32, "codes": np.int32, "hashes": np.uint64, "shapes": np.uint8, "counts": np.int64, "firsts": bool}
    for i in range(batch.num_rows):
        b = {k: unsqueezed(batch[k][i].as_buffer(), t) for k, t in kinds.items() if k in batch.schema.names}
        if stats:
            b["classes"] = classes(b, stats["top"])
        if "held" in batch.schema.names:
            b |= {"held": np.array(batch["held"][i].as_py(), bool), "doc_id": batch["doc_id"][i].values}
        yield b


def choices(b: dict, code: np.ndarray, features: np.ndarray, odds: np.ndarray, weights: np.ndarray, places: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Branch taken and log-odds of branch 1 (NaN: nothing is parted) at the ``DEPTH`` tree nodes above each token (words ``code``), by depth; the places of the three weights are added to ``places``."""
    down = np.arange(DEPTH, 0, -1, dtype=np.uint32)[:, None]
    leaf, k = leaves(b["hashes"].take(code)).astype(np.uint32), b["classes"].take(code).astype(np.uint32)
    node = (leaf >> down) + (np.uint32(1) << np.arange(DEPTH, dtype=np.uint32))[:, None]  # the prefix behind a 1, so that depths differ
    z = odds.ravel().take((node + (k << np.uint32(DEPTH))).astype(np.intp), mode="clip")
    node = (node * np.uint32(CLASSES) + k) * np.uint32(0x9E3779B1)
    shift = np.uint32(32 - (len(weights).bit_length() - 1))
    for i in range(3):
        mixed = (features[i].astype(np.uint32) * np.uint32(3) + np.uint32(i + 1)) * np.uint32(0x85EBCA6B) ^ node
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0xC2B2AE35)
        mixed >>= shift
        at = mixed.astype(np.intp)
        z += weights.take(at, mode="clip")
        if places is not None:
            places.append(at)
    return leaf >> (down - np.uint32(1)) & np.uint32(1) > 0, z


def way_scores(b: dict, code: np.ndarray, features: np.ndarray, odds: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Natural log of P(leaf | class, history) of tokens whose words have a way down a tree; 0 for the others."""
    one, z = choices(b, code, features, odds, weights)
    away = np.where(one, -z, z)
    lost = np.log1p(np.exp(-np.abs(away))) + np.maximum(away, 0)
    return -np.where(np.isnan(z), 0, lost).sum(0, dtype=float)


def histories(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Three feature numbers per token from the hashes of the words before it; ``first`` marks the tokens that begin a document."""
    none = np.zeros(2, np.uint64)
    one, two = np.concatenate([none[:1], hashes[:-1]]), np.concatenate([none, hashes[:-2]])[: len(hashes)]
    one[first] = two[first] = 1
    second = np.flatnonzero(first) + 1
    two[second[second < len(two)]] = 1
    spread = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)  # noqa: E731  15 bits
    return np.stack([spread(one), spread(one * np.uint64(0xC2B2AE3D27D4EB4F) + two * np.uint64(0x165667B19E3779F9)), spread(two + np.uint64(1 << 40))])


def slices(b: dict, chosen: np.ndarray):
    """Tokens of the chosen documents in slices: (positions in the block, features)."""
    tokens, lengths = np.flatnonzero(np.repeat(chosen, b["lengths"])), b["lengths"][chosen]
    codes, begins = b["codes"][tokens], np.zeros(len(tokens), bool)  # a history does not leave its document
    begins[np.cumsum(lengths) - lengths] = True
    for at in range(0, len(tokens), SLICE):
        # the two words before a slice belong to its history
        low, own = max(0, at - 2), tokens[at: at + SLICE]
        reach = slice(low, at + len(own))
        yield own, histories(b["hashes"][codes[reach]], begins[reach])[:, at - low:]


def class_logs(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Log-probabilities by class and token; numpy reduces short rows slowly."""
    z = weights.take(features[0], axis=0)
    z += weights.take(features[1], axis=0)
    z += weights.take(features[2], axis=0)
    z = np.add(z.T, bias[:, None], order="C")
    z -= z.max(0)
    e = np.exp(z)
    e = e[:8] + e[8:16] + e[16:24] + e[24:]  # added as numpy adds a row, which the last digits of a score depend on
    e = e[::2] + e[1::2]
    z -= np.log((e[0] + e[1]) + (e[2] + e[3]))
    return z


def class_scores(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Log-probabilities of the classes for each token."""
    return class_logs(weights, bias, features).T


def add_rows(into: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """into[:, at] += rows for each line of ``at``, with repeated places; class by class, which stays in the cache."""
    for k, column in enumerate(rows):
        column = column.astype(float)
        for places in at:
            into[k] += np.bincount(places, column, into.shape[1])


def empty_sums() -> tuple[np.ndarray, np.ndarray]:
    """Observed and expected counts of a task; in 64 bits, as 32-bit floats stop counting at 2^24."""
    return np.zeros((FEATURES + 1, CLASSES), np.int64), np.zeros((FEATURES + 1, CLASSES))


def added_up(sums: list[bytes]) -> bytes:
    return sum(np.frombuffer(x) for x in sums).tobytes()


def rounded(sums: np.ndarray) -> np.ndarray:
    """Sums to the 24 bits that the weights made from them have, so that they compress; the counting itself is in 64 bits."""
    return sums.astype(np.float32).astype(float)


def sums_row(at: int, sums: np.ndarray) -> pa.RecordBatch:
    """A row of ``SUMS`` of this task."""
    return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([squeezed(sums.ravel())], pa.binary())], names=["at", "task", "sums"])


def added(coded: DataFrame, run) -> list:
    """(at, sums) added over the tasks of ``run``, which gives rows of ``SUMS``; of many tasks ``TASK_SUMS`` at a time."""

    def total(key, rows):
        sums = added_up([unsqueezed(x.as_buffer(), float) for x in rows["sums"]])
        return pa.table({"at": [key[0].as_py()], "task": pa.array([key[-1].as_py()], pa.int32()), "sums": pa.array([squeezed(np.frombuffer(sums))], pa.binary())})

    tasks = max(1, coded.sparkSession.sparkContext.defaultParallelism)
    sums = coded.coalesce(tasks).mapInArrow(run, SUMS)  # a task sends one table of sums
    while tasks > 1:
        tasks = -(-tasks // TASK_SUMS)
        sums = sums.withColumn("task", (F.col("task") / TASK_SUMS).cast("int")).groupBy("at", "task").applyInArrow(total, SUMS)
    return [(r["at"], unsqueezed(pa.py_buffer(r["sums"]), float)) for r in sums.select("at", "sums").collect()]


def gather(coded: DataFrame, stats: dict, model: dict | None, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Observed and expected counts (features + 1 bias row) x classes over the training documents of a round; without a model all documents, observed only.

    And of the tree weights: observed minus expected, and the variance of what is expected.
    """
    held = coded.sparkSession.sparkContext.broadcast((model, {k: stats[k] for k in ("top", "odds")}))
    width = FEATURES + 1

    def run(batches):
        model, stats = held.value
        seen, due = empty_sums()
        off, swing = np.zeros((2, BRANCHES if model else 0))
        due_by_class = np.zeros((CLASSES, width))
        some = np.zeros(CLASSES, np.float32)
        rows, shares, filled = np.empty((3, GATHERED), np.int64), np.empty((CLASSES, GATHERED), np.float32), 0
        room = CHOSEN + SLICE * DEPTH
        ways, left, wide, made = np.empty((3, room), np.int32), np.empty(room, np.float32), np.empty(room, np.float32), 0

        def add_ways():
            values = [v[:made].astype(float) for v in (left, wide)]
            for way in ways:
                way = way[:made].astype(np.intp)
                for into, v in zip((off, swing), values):
                    into += np.bincount(way, v, BRANCHES)

        for batch in batches:
            for b in unpack(batch, stats):
                chosen = ~b["held"] & ((np.arange(len(b["held"])) % ROUNDS == turn) if model else True)
                target = np.where(b["counts"] <= 2, 0, b["classes"])  # as if the token itself had not been counted
                for at, (own, features) in enumerate(slices(b, chosen)):
                    y = target[b["codes"][own]].astype(np.int64)
                    for f in features:
                        np.add.at(seen.reshape(-1), f * CLASSES + y, np.ones(len(y), np.int64))
                    seen[-1] += np.bincount(y, minlength=CLASSES)
                    if model:
                        p = np.exp(class_logs(model["weights"], model["bias"], features))
                        if at % BIAS_SLICES == 0:
                            due[-1] += some
                            some = np.zeros(CLASSES, np.float32)
                        some = np.concatenate([some[None], np.ascontiguousarray(p.T)]).sum(0)  # one token after the other
                        now = slice(filled, filled + len(own))
                        rows[:, now], shares[:, now], filled = features, p, now.stop
                        if filled > GATHERED - SLICE:
                            add_rows(due_by_class, rows[:, :filled], shares[:, :filled])
                            filled = 0
                        inner, places = np.flatnonzero((y > 0) & (y <= SHAPES)), []
                        one, z = choices(b, b["codes"][own[inner]], features[:, inner], stats["odds"], model["ways"], places)
                        parted = np.flatnonzero(~np.isnan(z))
                        p = 1 / (1 + np.exp(-z.take(parted)))
                        now = slice(made, made + len(parted))
                        left[now], wide[now], made = one.take(parted) - p, p * (1 - p), now.stop
                        for way, place in zip(ways, places):
                            way[now] = place.take(parted)
                        if made >= CHOSEN:
                            add_ways()
                            made = 0
        add_rows(due_by_class, rows[:, :filled], shares[:, :filled])
        due[-1] += some
        if made:
            add_ways()
        due += due_by_class.T
        for at in range(0, width, TABLE_ROWS):
            yield sums_row(at, np.concatenate([seen[at: at + TABLE_ROWS].astype(float), rounded(due[at: at + TABLE_ROWS])]))
        for at in range(0, len(off), TABLE_WAYS):
            yield sums_row(-1 - at, rounded(np.concatenate([off[at: at + TABLE_WAYS], swing[at: at + TABLE_WAYS]])))

    seen, due = np.zeros((2, width, CLASSES))
    off, swing = np.zeros((2, BRANCHES))
    for at, sums in added(coded, run):
        if at < 0:
            off[-1 - at:][:TABLE_WAYS], swing[-1 - at:][:TABLE_WAYS] = sums.reshape(2, -1)
            continue
        part = sums.reshape(2, -1, CLASSES)
        seen[at: at + part.shape[1]], due[at: at + part.shape[1]] = part
    return seen, due, off, swing


def train(coded: DataFrame, stats: dict) -> dict:
    """Weights after ``ROUNDS`` scaled gradient steps from the observed class counts."""
    seen, *_ = gather(coded, stats, None, -1)
    prior = (seen[-1] + 0.5) / (seen[-1].sum() + 0.5 * CLASSES)
    of = seen[:-1]
    near = (of + CALM * prior) / (of.sum(1, keepdims=True) + CALM)
    model = {"weights": (SHARE * (np.log(near) - np.log(prior))).astype(np.float32), "bias": np.log(prior).astype(np.float32), "ways": np.zeros(BRANCHES, np.float32)}
    for turn in range(ROUNDS):
        seen, due, off, swing = gather(coded, stats, model, turn)
        step = np.clip(RATE * (seen - due) / (due + CALM), -1, 1)
        moves = {"weights": step[:-1] / 2, "bias": step[-1] / 2, "ways": np.clip(RATE * off / (swing + 1), -1, 1)}
        model = {k: (model[k] + v).astype(np.float32) for k, v in moves.items()}
        release(coded.sparkSession)  # the sums of a round are as large as those of the next
    return model


def word_scores(b: dict, stats: dict) -> tuple[np.ndarray, np.ndarray]:
    """Natural log of a word's share of its class and log10 of the base probability, for each local word."""
    c = b["counts"].astype(float)
    size = np.array([max(1, stats["sizes"].get(k, 0)) for k in range(CLASSES)], float)
    once = stats["v1"] + 2 * stats["v2"]
    unknown = min(max(stats["v1"] / once, 0.01), 0.99) if once and stats["v1"] else 1.0
    rare = np.where(c == 0, unknown, (1 - unknown) / max(1, stats["v1"]))
    return np.log(np.where(b["classes"] == 0, np.maximum(rare, 1e-300), c.clip(1) / size[b["classes"]])), np.log10((c + 0.5) / (stats["n"] + 0.5 * (stats["v"] + 1)))


def score(coded: DataFrame, model: dict, stats: dict) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    held = coded.sparkSession.sparkContext.broadcast((model, stats))

    def run(batches):
        model, stats = held.value
        for batch in batches:
            for b in unpack(batch, stats):
                if not len(b["lengths"]):
                    continue
                word, base = word_scores(b, stats)
                inner = (b["classes"] > 0) & (b["classes"] <= SHAPES)
                leaf = stats["leaves"][b["classes"], leaves(b["hashes"])]
                word = np.where(b["classes"] == 0, word, np.log(np.where(inner, b["counts"] / leaf.clip(1), 1)))
                log = np.empty(len(b["codes"]))
                for own, features in slices(b, np.ones(len(b["held"]), bool)):
                    code = b["codes"][own]
                    log[own] = class_logs(model["weights"], model["bias"], features)[b["classes"][code], np.arange(len(own))] + word[code]
                    down = np.flatnonzero(inner[code])
                    log[own[down]] += way_scores(b, code[down], features[:, down], stats["odds"], model["ways"])
                head = np.cumsum(b["lengths"]) - b["lengths"]
                n = len(b["lengths"])
                yield pa.RecordBatch.from_arrays([
                    b["doc_id"], pa.array(b["held"]), pa.array(b["lengths"].astype(np.int64)),
                    pa.array(np.add.reduceat((b["counts"] > 0)[b["codes"]].astype(np.int64), head)), pa.array(np.full(n, stats["n"], np.int64)),
                    pa.array(np.add.reduceat(base[b["codes"]], head)), pa.array(np.add.reduceat(log, head) / math.log(10))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return coded.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def op10_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = materialize(word_blocks(table(spark, sf_dir, "documents")), "blocks")
    counts = materialize(word_counts(blocks), "counts")
    release(spark)
    files = parts(table(spark, sf_dir, "documents"), PART_BYTES)  # so that a task that reads a file holds a few blocks
    coded = materialize(blocks.drop("checks", "n").repartition(files, "block").join(counts.repartition(files, "block"), "block"), "coded")
    discard(blocks, counts)
    release(spark)
    stats = totals(coded)
    return score(coded, train(coded, stats), stats)


register("op10_maxent_lm", op10_maxent_lm)
