"""Ranked lexical search by dual trees: the best documents of every item, exactly.

Items and documents are points whose coordinates are terms: an item holds occurrences times weight, a document the saturated term
frequency, and a score is their inner product. Both sides are put into hierarchies of like points (ordered by their heaviest
terms), whose nodes hold the greatest value of each coordinate. The product of two nodes' maxima bounds every score between
them, so a pair of nodes whose bound lies below the weakest k-th score of the node's items is dropped with all documents and
items beneath; what reaches the leaves is scored in 64-bit integers. A bound equal to the k-th score is followed, as ties go
to the smaller id.

One pass over the texts counts the documents' item terms where they lie and stores them in blocks, with what the weights need (documents,
terms, documents by term). The second pass reads the blocks, builds a tree over every ``TREE_DOCS`` documents and walks it with the
item tree, carrying the k-th scores from tree to tree; a task emits at most k rows per item. Nothing is gathered by term or
document, so a term in a third of all documents costs no shuffle. Items go to the tasks in chunks of at most ``CHUNK_BYTES`` of
text, each chunk being one pass.

Cases. A null text, or one without terms, is found by nothing and finds nothing. Rows that share an item id are answered each; rows that share a
document id rank each. Null document ids rank behind others of equal score. Very long texts are read whole. Other columns
are not read. Empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearfield.llm.common import input_bytes, materialize, pieces, register, table
from nearfield.llm.decontamination import split_words

TOP = 10
CHUNK_BYTES = 8 << 20
TASK_BYTES = 32 << 20  # stored blocks that one task of the search reads
TREE_DOCS, LEAF_DOCS, FAN = 16_384, 4, 8
NO_ID = np.iinfo(np.int64).max


def item_chunks(items: DataFrame, chunk_bytes: int = CHUNK_BYTES):
    """(item_id, terms with counts) rows in lists of about ``chunk_bytes`` of text, one after the other."""
    rows = items.where("text is not null").select(F.col("item_id"), F.col("text").cast("binary").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 100)).first()[0] or 0
    n = -(-total // chunk_bytes)
    for i in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r[0], terms) for r in part.toLocalIterator() if (terms := Counter(split_words(bytes(r[1]))))]


# ---------------------------------------------------------------- first pass


def store_blocks(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Count the given terms in (doc_id, text) rows and store blocks of documents.

    A block has the number of documents with any term and of their terms, and for the documents with one of the given terms: id, number of
    all terms, number of entries, and the entries (term number, occurrences).
    """
    held = docs.sparkSession.sparkContext.broadcast(terms)  # bounded by the items' chunk

    def run(batches):
        get, width = {t: i for i, t in enumerate(held.value)}.get, len(held.value)
        for batch in batches:
            for rows, found in pieces(batch):
                split = [split_words(t) for t in found]
                total = np.fromiter(map(len, split), np.int64, len(split))
                known = [[c for c in map(get, words) if c is not None] for words in split]
                many = np.fromiter(map(len, known), np.int64, len(known))
                codes = np.fromiter((c for k in known for c in k), np.int64, int(many.sum()))
                key, tf = np.unique(np.repeat(np.arange(len(many)), many) * max(1, width) + codes, return_counts=True)
                entries = np.bincount(key // max(1, width), minlength=len(many))
                hit = np.flatnonzero(entries)
                ids = rows["doc_id"].fill_null(NO_ID).to_numpy()
                data = (ids[hit], total[hit], entries[hit], (key % max(1, width)).astype(np.int32), tf.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array([int((total > 0).sum())]), pa.array([int(total.sum())]),
                                                  *[pa.array([x.tobytes()], pa.binary()) for x in data]], names=names)

    names = ["docs", "terms", "ids", "lengths", "entries", "term", "tf"]
    kinds = "docs bigint, terms bigint, ids binary, lengths binary, entries binary, term binary, tf binary"
    return materialize(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, kinds), "term-blocks")


def document_frequencies(blocks: DataFrame, width: int) -> np.ndarray:
    """Documents of each term; at most one number per term comes to the driver."""

    def run(batches):
        total = np.zeros(width, np.int64)
        for batch in batches:
            for term in batch["term"]:
                total += np.bincount(np.frombuffer(term.as_py(), np.int32), minlength=width)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    out = np.zeros(width, np.int64)
    found = blocks.select("term").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out[found["term"].to_numpy()] = found["n"].to_numpy()
    return out


# ---------------------------------------------------------------- trees


class Points:
    """Sparse rows: row i has ``term[start[i]:start[i+1]]`` in rising order with ``value`` likewise."""

    def __init__(self, start: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.start, self.term, self.value = start, term, value

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> "Points":
        size = np.diff(self.start)[rows]
        start = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(start[-1]) + np.repeat(self.start[rows] - start[:-1], size)
        return Points(start, self.term[at], self.value[at])

    def like(self, weight: np.ndarray) -> np.ndarray:
        """An order in which rows with the same heaviest terms lie together."""
        part, row = self.value * weight[self.term], np.repeat(np.arange(len(self)), np.diff(self.start))
        by = np.lexsort((self.term, -part, row))
        first = np.full((len(self), 2), -1, np.int64)
        for k in range(2):
            own = np.flatnonzero(np.diff(self.start) > k)
            first[own, k] = self.term[by[self.start[own] + k]]
        return np.lexsort((first[:, 1], first[:, 0]))

    def merged(self, each: int) -> "Points":
        """Nodes over ``each`` rows: the greatest value of every term."""
        if not len(self):
            return self
        node = np.repeat(np.arange(len(self)) // each, np.diff(self.start))
        by = np.lexsort((self.term, node))
        node, term, value = node[by], self.term[by], self.value[by]
        head = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (term[1:] != term[:-1])]))
        start = np.searchsorted(node[head], np.arange(-(-len(self) // each) + 1))
        return Points(start, term[head], np.maximum.reduceat(value, head))

    def products(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Inner product of the given rows, which have entries, with a dense vector."""
        own = self.take(rows)
        return np.add.reduceat(dense[own.term] * own.value, own.start[:-1]) if len(rows) else np.empty(0, np.int64)


def levels(points: Points, leaf: int, top: int = 1) -> list[tuple[Points, int]]:
    """Node levels from the root down to the rows, with the number of children that a node of the level has."""
    found, each = [(points, 1)], leaf
    while len(found[0][0]) > top:
        found.insert(0, (found[0][0].merged(each), each))
        each = FAN
    return found


class Items:
    """The item tree, and the best documents of each item so far."""

    def __init__(self, points: Points, width: int, k: int):
        self.levels, self.width, self.k = levels(points, FAN), width, k
        self.spans = [1]  # items beneath a node of each level
        for _, each in reversed(self.levels[:-1]):
            self.spans.insert(0, self.spans[0] * each)
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in range(len(points))]
        self.kth = np.ones(len(points), np.int64)  # a score must be above 0
        self.scored = self.bounded = 0

    def weakest(self, level: int, node: int) -> int:
        return int(self.kth[node * self.spans[level]: (node + 1) * self.spans[level]].min())

    def offer(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take in scored documents; equal scores rank by id."""
        old_scores, old_ids = self.best[item]
        good = scores >= self.kth[item]
        scores, ids = np.concatenate([old_scores, scores[good]]), np.concatenate([old_ids, ids[good]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.best[item] = scores[order], ids[order]
        if len(order) == self.k:
            self.kth[item] = scores[order[-1]]

    def search(self, documents: Points, ids: np.ndarray) -> None:
        """Walk this tree and a tree over the documents together."""
        tree = levels(documents, LEAF_DOCS)
        dense = np.zeros(self.width, np.int64)
        pending = [(0, node, 0, np.arange(len(tree[0][0]))) for node in range(len(self.levels[0][0]))]
        while pending:
            level, node, depth, nodes = pending.pop()
            points, _ = self.levels[level]
            own = slice(points.start[node], points.start[node + 1])
            dense[points.term[own]] = points.value[own]
            bound = tree[depth][0].products(nodes, dense)
            self.bounded += len(nodes)
            last_item, last_doc = level == len(self.levels) - 1, depth == len(tree) - 1
            if last_item and last_doc:  # rows of both sides: the products are the scores
                self.scored += len(nodes)
                self.offer(node, bound, ids[nodes])
            else:
                good = bound >= self.weakest(level, node)
                nodes, bound = nodes[good], bound[good]
                if last_item and depth == len(tree) - 2:
                    self._leaves(node, tree, nodes[np.argsort(-bound, kind="stable")], -np.sort(-bound), dense, ids)
                elif len(nodes):
                    if not last_doc:
                        nodes, depth = children(nodes, tree[depth][1], len(tree[depth + 1][0])), depth + 1
                    below = [node] if last_item else range(node * self.levels[level][1], min((node + 1) * self.levels[level][1], len(self.levels[level + 1][0])))
                    pending += [(level if last_item else level + 1, n, depth, nodes) for n in below]
            dense[points.term[own]] = 0

    def _leaves(self, item: int, tree, nodes: np.ndarray, bound: np.ndarray, dense: np.ndarray, ids: np.ndarray) -> None:
        """Score the documents of leaves, best bound first, in growing batches, until no bound reaches the k-th score."""
        at, many = 0, 4
        while at < len(nodes) and bound[at] >= self.kth[item]:
            rows = children(nodes[at: at + many], tree[-2][1], len(tree[-1][0]))
            self.scored += len(rows)
            self.offer(item, tree[-1][0].products(rows, dense), ids[rows])
            at, many = at + many, many * 2


def children(nodes: np.ndarray, each: int, total: int) -> np.ndarray:
    found = (nodes[:, None] * each + np.arange(each)).ravel()
    return found[found < total]


# ---------------------------------------------------------------- second pass


def top_documents(docs: DataFrame, items: DataFrame, k: int = TOP, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The k best documents of each item: (item_id, rank, doc_id, score), for (doc_id, text) and (item_id, text) rows."""
    found = [_search_chunk(docs, chunk, k) for chunk in item_chunks(items, chunk_bytes) if chunk]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _search_chunk(docs: DataFrame, items: list[tuple[int, Counter]], k: int) -> DataFrame:
    spark = docs.sparkSession
    names = sorted(set().union(*(t for _, t in items)))
    code = {t: i for i, t in enumerate(names)}
    blocks = store_blocks(docs, names)
    n, total = (x or 0 for x in blocks.agg(F.sum("docs"), F.sum("terms")).first())
    weight = np.floor(1000 * np.log((2 * n + 2) / (2 * document_frequencies(blocks, len(names)) + 1))).astype(np.int64)
    start = np.cumsum([0, *(len(t) for _, t in items)])
    pairs = [sorted((code[w], c) for w, c in t.items()) for _, t in items]
    term, count = (np.array([p[i] for own in pairs for p in own], np.int64) for i in (0, 1))
    points = Points(start, term, count * weight[term])
    order = points.like(np.ones(len(names), np.int64))
    held = spark.sparkContext.broadcast((points.take(order), weight))  # bounded by the items' chunk
    ids = [items[i][0] for i in order.tolist()]

    def trees(batches):
        """Documents of consecutive blocks, up to about ``TREE_DOCS`` at a time: ids, lengths, entries, terms, occurrences."""
        rows, many = [], 0
        kinds = (np.int64, np.int64, np.int64, np.int32, np.int32)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append([np.frombuffer(x, kind).astype(np.int64) for x, kind in zip(row, kinds)])
                many += len(rows[-1][0])
                if many >= TREE_DOCS:
                    yield [np.concatenate(c) for c in zip(*rows)]
                    rows, many = [], 0
        if many:
            yield [np.concatenate(c) for c in zip(*rows)]

    def run(batches):
        points, weight = held.value
        own = Items(points, len(weight), k)
        for doc, length, entries, term, tf in trees(batches):
            m = 100 - 75 + (75 * length * n) // total
            value = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, entries))
            documents = Points(np.concatenate([[0], np.cumsum(entries)]), term, value)
            order = documents.like(weight)
            own.search(documents.take(order), doc[order])
        many = [len(s) for s, _ in own.best]
        if sum(many):
            item = np.repeat(np.arange(len(many)), many)
            doc = np.concatenate([d for _, d in own.best])
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array([ids[i] for i in item.tolist()], pa.int64()), pa.array(doc, mask=doc == NO_ID),
                                              pa.array(np.concatenate([s for s, _ in own.best]))], names=["item", "item_id", "doc_id", "score"])

    tasks = max(spark.sparkContext.defaultParallelism, input_bytes(blocks) // TASK_BYTES)
    found = blocks.select("ids", "lengths", "entries", "term", "tf").coalesce(tasks).mapInArrow(run, "item bigint, item_id bigint, doc_id bigint, score bigint")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("bigint"), "text")
    return top_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), items)


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT row_number() OVER () AS q, item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark WHERE text IS NOT NULL),
it AS (SELECT q, item_id, t.term, count(*) AS c FROM i, unnest(w) AS t(term) GROUP BY ALL),
dt AS (SELECT r, t.term, count(*) AS tf FROM d, unnest(w) AS t(term) GROUP BY ALL),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
dm AS (SELECT r, doc_id, 100 - 75 + ((75 * len(w) * n_docs) // n_terms) AS m FROM d, s WHERE len(w) > 0),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS wt FROM (SELECT term, count(*) AS df FROM dt GROUP BY term), s),
sc AS (SELECT q, item_id, doc_id, r, CAST(sum(c * wt * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
       FROM it JOIN wt USING (term) JOIN dt USING (term) JOIN dm USING (r) GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM sc WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM rk WHERE rank <= 10"""

register("op11_lexical_search", op11_lexical_search, OP11_SQL)
