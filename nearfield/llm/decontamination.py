"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by documents: a row holds a block of whole documents, its terms in sorted order and, for
each term, the sorted list of its positions. Positions count through the block, with a gap behind each document,
so that no list match crosses documents. Test phrases are looked up block by block: for every window of an item
the lists of its terms are intersected, shifted by the term's offset and from the rarest term on, so the
candidates are as few as the rarest term's postings. With ``slack`` > 0 a term may lie up to so many words from its
offset (proximity match); 0 is the exact phrase. The rarest term's own position says which document a match is in, and a match covers
the words from the phrase's start to its end as far as they lie in that document.

Cases. A null text has no words and matches nothing; an item without words has no windows; an item shorter than the window
is one window. Repeated rows and ids are judged row by row. Equal items are reported under each of their ids. Empty
tables give no rows or no hits. Other columns are not carried (``leave_clean`` keeps them all).
A document longer than a block is a block of its own. The items are sent to the tasks in
chunks of at most ``CHUNK_BYTES``, each chunk being one pass over the stored index.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm.common import materialize, pieces, register, row_key, table

WINDOW = 10
BLOCK_BYTES = 2 << 20
CHUNK_BYTES = 16 << 20
# Lower-cases A-Z and turns every other ASCII character outside 0-9 and a-z into white space.
LETTERS = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))



def split_words(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


class Postings:
    """Positional postings of one block: ``terms`` sorted, ``starts`` of their lists in ``positions``, ``words`` per document."""

    def __init__(self, terms: list[bytes], counts: np.ndarray, positions: np.ndarray, words: np.ndarray):
        self.code = {t: i for i, t in enumerate(terms)}
        self.counts, self.positions, self.words = counts, positions, words
        self.starts = np.cumsum(counts) - counts
        self.first = document_starts(words)
        self.size = int(self.first[-1] + words[-1] + GAP) if len(words) else 0
        self.keys = np.repeat(np.arange(len(terms), dtype=np.int64), counts) * self.size + positions

    def lookup(self, windows: list[tuple[bytes, ...]], slack: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window number, start position, position of the rarest term) of every match; windows have equal lengths.

        With ``slack`` the start may lie before the document.
        """
        code = self.code.get
        known = [(n, [code(t, -1) for t in w]) for n, w in enumerate(windows)]
        known = [(n, c) for n, c in known if min(c) >= 0]
        if not known:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        number, terms = np.array([n for n, _ in known], np.int64), np.array([c for _, c in known], np.int64)
        order = np.argsort(self.counts[terms], axis=1, kind="stable")
        rare = np.take_along_axis(terms, order[:, :1], 1)[:, 0]
        many = self.counts[rare]
        row = np.repeat(np.arange(len(rare)), many)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        seen = self.positions[self.starts[rare][row] + inside].astype(np.int64)
        for rank in range(1, terms.shape[1]):
            if not len(row):
                break
            offset = order[row, rank]
            base, due = terms[row, offset] * self.size, seen - order[row, 0] + offset
            low, high = base + np.maximum(due - slack, 0), base + np.minimum(due + slack, self.size - 1)  # no other term's positions
            at = np.minimum(np.searchsorted(self.keys, low), len(self.keys) - 1)
            good = (self.keys[at] >= low) & (self.keys[at] <= high)
            row, seen = row[good], seen[good]
        return number[row], seen - order[row, 0], seen


GAP = 64  # empty positions behind a document; more than any slack


def document_starts(words: np.ndarray) -> np.ndarray:
    return np.cumsum(words + GAP) - (words + GAP)


def invert(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Terms, list lengths, positions and document lengths of a block."""
    split = [split_words(t) for t in texts]
    words = np.fromiter(map(len, split), np.int64, len(split))
    terms = sorted(set().union(*split)) if split else []
    code = {t: i for i, t in enumerate(terms)}
    codes = np.fromiter((code[w] for s in split for w in s), np.int32, int(words.sum()))
    at = np.arange(len(codes), dtype=np.int64) + np.repeat(document_starts(words) - (np.cumsum(words) - words), words)
    return terms, np.bincount(codes, minlength=len(terms)).astype(np.int32), at[np.argsort(codes, kind="stable")].astype(np.int32), words.astype(np.int32)


def build_index(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Index (key, doc_id, text) rows and store the index; one row per block, made where the documents lie."""

    def run(batches):
        for batch in batches:
            for rows, found in pieces(batch, "text", block_bytes):
                terms, counts, positions, words = invert(found)
                yield pa.RecordBatch.from_arrays([
                    pa.array([rows["key"].to_pylist()], pa.list_(pa.string())), pa.array([rows["doc_id"].to_pylist()], pa.list_(pa.int64())),
                    *[pa.array([x], pa.binary()) for x in (words.tobytes(), b" ".join(terms), counts.tobytes(), positions.tobytes())]],
                    names=["key", "doc_id", "words", "terms", "counts", "positions"])

    built = docs.select("key", F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "key array<string>, doc_id array<bigint>, words binary, terms binary, counts binary, positions binary")
    return materialize(built, "postings")


def item_windows(items: list[tuple[object, bytes]], width: int) -> dict[int, dict[tuple, list]]:
    """By length: each distinct window with the ids of the items that have it."""
    by_length: dict[int, dict[tuple, list]] = {}
    for item, text in items:
        words = split_words(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            window = tuple(words[i: i + width])
            ids = by_length.setdefault(len(window), {}).setdefault(window, [])
            if not ids or ids[-1] != item:
                ids.append(item)
    return by_length


def matches(index: DataFrame, items: list[tuple[object, bytes]], width: int = WINDOW, slack: int = 0) -> DataFrame:
    """Per document of the index: n_words, n_hit (words inside a match), the items with a match and the hit spans.

    ``spans`` lists (start, length) in words, merged where they touch or overlap.
    """
    if not 0 <= slack < GAP - width:
        raise ValueError("slack must be small")
    held = index.sparkSession.sparkContext.broadcast(items)  # bounded by the caller's chunks

    def run(batches):
        by_length = item_windows(held.value, width)
        for batch in batches:
            for keys, ids, words, terms, counts, positions in zip(*(c.to_pylist() for c in batch.columns)):
                block = Postings(terms.split(b" ") if terms else [], *(np.frombuffer(x, np.int32).astype(np.int64) for x in (counts, positions, words)))
                cover = np.zeros(block.size + 1, np.int32)
                found: dict[int, set] = {}
                for length, windows in by_length.items():
                    names = list(windows)
                    number, start, seen = block.lookup(names, slack)
                    doc = np.searchsorted(block.first, seen, "right") - 1
                    np.add.at(cover, np.maximum(start, block.first[doc]), 1)
                    np.add.at(cover, np.minimum(start + length, block.first[doc] + block.words[doc]), -1)
                    for n, d in set(zip(number.tolist(), doc.tolist())):
                        found.setdefault(d, set()).update(windows[names[n]])
                hit = np.diff(np.concatenate([[0], np.cumsum(cover[:-1]) > 0, [0]]).astype(np.int8))
                begin, end = np.flatnonzero(hit > 0), np.flatnonzero(hit < 0)
                spans: dict[int, list] = {}
                for d, b, e in zip((np.searchsorted(block.first, begin, "right") - 1).tolist(), begin.tolist(), end.tolist()):
                    at = int(block.first[d])
                    spans.setdefault(d, []).append({"start": b - at, "length": e - b})
                rows = range(len(keys))
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, pa.string()), pa.array(ids, pa.int64()), pa.array(block.words),
                    pa.array([sum(s["length"] for s in spans.get(d, ())) for d in rows], pa.int64()),
                    pa.array([sorted(found.get(d, ()), key=str) for d in rows], pa.list_(pa.int64())),
                    pa.array([spans.get(d, []) for d in rows], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))],
                    names=["key", "doc_id", "n_words", "n_hit", "items", "spans"])

    return index.select("key", "doc_id", "words", "terms", "counts", "positions").mapInArrow(
        run, "key string, doc_id bigint, n_words bigint, n_hit bigint, items array<bigint>, spans array<struct<start:bigint,length:bigint>>")


def item_chunks(benchmark: DataFrame, chunk_bytes: int = CHUNK_BYTES):
    """(item_id, text) rows in lists of about ``chunk_bytes``, one after the other."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("bigint"), F.col("text").cast("binary"))
    total = items.agg(F.sum(F.octet_length("text") + 100)).first()[0] or 0
    n = -(-total // chunk_bytes)
    for i in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r[0], bytes(r[1])) for r in part.collect()]


def search(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, slack: int = 0) -> DataFrame:
    """Matches of all items in all documents (key, doc_id, text); see ``matches``.

    Usually the items are one chunk. With more, each chunk's matches are stored and merged per row.
    """
    index = build_index(docs)
    found = [matches(index, items, width, slack) for items in item_chunks(benchmark)] or [matches(index, [], width)]
    return found[0] if len(found) == 1 else _merge([materialize(f, "matches") for f in found])


def _merge(found: list[DataFrame]) -> DataFrame:
    """Union of the chunks' items and spans per document; equal rows have equal matches, so one stands for its copies."""
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more.where("n_hit > 0"))
    copies = found[0].groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    cells = F.array_distinct(F.flatten(F.transform(F.flatten(F.collect_set("spans")), lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))
    one = every.groupBy("key", "doc_id", "n_words").agg(
        F.size(cells).cast("bigint").alias("n_hit"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        F.flatten(F.collect_set("spans")).alias("spans"))
    ordered = F.transform(F.array_sort(F.transform("items", lambda i: i.cast("string"))), lambda i: i.cast("bigint"))
    return one.join(copies, "key").withColumn("items", ordered).withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(found[0].columns)


def leave_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any match, with all their columns."""
    keyed = docs.select(row_key().alias("key"), F.col("doc_id"), F.col("text"))
    hit = materialize(search(keyed, benchmark).where("n_hit > 0").select("key").distinct(), "hits")
    nested = docs.select(row_key().alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    return nested.join(hit, "key", "left_anti").select(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns])


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.lit("").alias("key"), "doc_id", "text")
    found = search(docs.withColumn("key", row_key()), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.transform("items", lambda i: i.cast("string")), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(names, 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP2_SQL = r"""
WITH d0 AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
d1 AS (SELECT r, doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM d0),
i1 AS (SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
       FROM i1, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM d1, (SELECT DISTINCT n FROM iw), unnest(range(1, len(w) - n + 2)) AS t(i)),
m AS (SELECT r, i, dw.n, item_id FROM dw JOIN iw USING (n, g)),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM m, unnest(range(i, i + n)) AS t(p) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d1 LEFT JOIN h USING (r) LEFT JOIN it USING (r)"""

register("op2_decontamination", op2_decontamination, OP2_SQL)
