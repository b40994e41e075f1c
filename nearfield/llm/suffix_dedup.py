"""Suffix-array dedup: bytes of passages that also start in a document with a smaller id.

The suffixes are dealt out by anchors: the least of the hashes of 24-byte strings in each run of 27 (winnowing), so
equal 50-byte strings hold an equal anchor at an equal offset, and everything that can be said about a
50-byte string is said within 50 bytes of its anchor, its context.

1. Each batch lists its anchors with hashes of anchor and context. Equal contexts are decided at once: all but the least
   document of a batch, then of the table, lose the whole context. Only the least documents move on.
2. Anchors with several contexts need their texts. Per bucket of anchors a suffix array of the contexts is sorted, its LCP table is
   scanned with a stack, and each interval of at least 50 bytes with diverse left extensions is a maximal repeat with
   all its occurrences; those in a larger document than the least one lose the repeat.
3. Anchors with over ``HOT_CONTEXTS`` contexts are decided window by window with a grouped minimum instead,
   which is combined before the shuffle, so no anchor gathers in one task.

Cases. A null text is empty. Rows that share an id do not remove each other's bytes; they are kept apart by their texts. Null ids count as the
largest. Texts under 50 bytes stay as they are. Other columns are not read (``cut_repeats`` keeps them all). No rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm.common import discard, grouped, materialize, parts, pieces, register, release, table
from nearfield.llm.jaccard_join import mix

SPAN, GRAM = 50, 24
RUN = SPAN - GRAM + 1  # anchors are chosen among so many neighbours
SIDE = SPAN - GRAM
CONTEXT = SPAN + SIDE
BATCH_BYTES = 16 << 20  # text whose anchors are combined before they are dealt out
BUCKET_CONTEXTS = 20_000
HOT_CONTEXTS = 50_000
LAST = (1 << 63) - 1
_rng = np.random.default_rng(99)
BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
STEP = _rng.integers(1, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ENTRY = "p int, kind int, docs binary, counts binary, anchor binary, context binary, pos binary"


def sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """Least (or greatest) of each run of ``width`` values."""
    done = 1
    while done * 2 <= width:
        x, done = least(x[:-done], x[done:]), done * 2
    return least(x[: len(x) - (width - done)], x[width - done:]) if done < width else x


def anchors(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of concatenated texts: document number, position in it, anchor hash and context hash."""
    n = len(text)
    doc_of = np.repeat(np.arange(len(starts)), lengths)
    h, width, level = BYTE[text], 1, 0
    half = h
    while width * 2 <= GRAM:
        half, h = h, h[:-width] * STEP[level] + h[width:]
        width, level = width * 2, level + 1
    if width < GRAM:  # 16 + 8 bytes
        gram = mix(h[: len(text) - GRAM + 1] * STEP[7] + half[width:])
    else:
        gram = mix(h)
    low = sliding(gram, RUN, np.minimum)
    begin = np.arange(len(low))
    inside = begin + SPAN <= (starts + lengths)[doc_of[: len(low)]]  # runs that do not cross documents
    low = np.where(inside, low, 0)
    pad = np.zeros(RUN - 1, np.uint64)
    top = sliding(np.concatenate([pad, low, pad]), RUN, np.maximum)
    at = np.flatnonzero((gram == top) & (top > 0))
    doc = doc_of[at]
    pos = at - starts[doc]
    left = np.maximum(at - SIDE, starts[doc])
    right = np.minimum(at + SPAN, (starts + lengths)[doc])
    context = np.zeros(len(at), np.uint64)
    full = right - left == CONTEXT
    if full.any():
        while width < 64:
            h = h[:-width] * STEP[level] + h[width:]
            width, level = width * 2, level + 1
        a = left[full]
        context[full] = mix(mix(h[a]) * STEP[6] + h[a + CONTEXT - 64])
    raw = text.tobytes()
    for i in np.flatnonzero(~full).tolist():
        edge = hashlib.blake2b(raw[left[i]: right[i]], digest_size=8, salt=int(at[i] - left[i]).to_bytes(2, "little"))
        context[i] = int.from_bytes(edge.digest(), "little")
    return doc, pos, gram[at], context


def keep_least(doc_order: np.ndarray, anchor: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort entries by (anchor, context, order); returns the order, the first entry of each class and each entry's class."""
    order = np.lexsort((doc_order, context, anchor))
    a, c = anchor[order], context[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])]) if len(a) else np.empty(0, bool)
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def pack_spans(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[tuple[int, bytes]]:
    """Spans by document, merged where they touch: (document, int32 pairs start, stop)."""
    out = []
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    bounds = np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1, [len(doc)]]) if len(doc) else np.zeros(1, int)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        s, e = merge_spans(start[a:b], stop[a:b])
        out.append((int(doc[a]), np.column_stack([s, e]).astype(np.int32).tobytes()))
    return out


def merge_spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by spans sorted by start."""
    reach = np.maximum.accumulate(stop)
    first = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[first], np.concatenate([reach[:-1][first[1:]], reach[-1:]])


def context_spans(pos: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(pos - SIDE, 0), np.minimum(pos + SPAN, length)


def with_identity(docs: DataFrame) -> DataFrame:
    """(ord, th, text): order of the id, hash of the text, bytes of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("ord"), F.xxhash64(text).alias("th"), text.cast("binary").alias("text"))


def list_anchors(rows: DataFrame, groups: int) -> DataFrame:
    """Packed entries by group of anchors (kind 0) and spans that a batch decides by itself (kind 1)."""

    def run(batches):
        ids, held, size = [], [], 0
        for batch in batches:
            for part, texts in pieces(batch, "text", 1 << 20):
                lengths = np.fromiter(map(len, texts), np.int64, len(texts))
                base = sum(len(x) for x in ids)
                size += int(lengths.sum())
                ids.append(np.column_stack([part["ord"].to_numpy(), part["th"].to_numpy(), lengths]))
                if lengths.max(initial=0) >= SPAN:
                    text = np.frombuffer(b"".join(texts) + b"\0" * CONTEXT, np.uint8)
                    starts = np.concatenate([np.cumsum(lengths) - lengths, [lengths.sum()]])
                    doc, pos, anchor, context = anchors(text, starts, np.append(lengths, CONTEXT))
                    real = doc < len(texts)
                    held.append(((doc[real] + base).astype(np.int32), pos[real].astype(np.int32), anchor[real], context[real]))
                if size >= BATCH_BYTES:
                    yield from combined(ids, held, groups)
                    ids, held, size = [], [], 0
        yield from combined(ids, held, groups)

    return rows.mapInArrow(run, ENTRY)


def combined(ids: list[np.ndarray], held: list[tuple], groups: int):
    """Rows for the anchors of a run of documents: what they decide among themselves, and the rest by group."""
    if not held:
        return
    docs = np.concatenate(ids)
    doc, pos, anchor, context = (np.concatenate(x) for x in zip(*held))
    if not len(doc):
        return
    order, first, number = keep_least(docs[doc, 0], anchor, context)
    later = np.empty(len(order), bool)
    later[order] = docs[doc[order], 0] > docs[doc[order[first]], 0][number]
    start, stop = context_spans(pos[later], docs[doc[later], 2])
    spans = pack_spans(doc[later], start, stop)
    if spans:
        yield rows_of([(d % groups, 1, docs[d].tobytes(), b"", b"", b"", s) for d, s in spans])
    doc, pos, anchor, context = doc[~later], pos[~later], anchor[~later], context[~later]
    group = (anchor % np.uint64(groups)).astype(np.int32)
    order = np.lexsort((doc, group))
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group[order])) + 1, [len(order)]])
    made = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        at = order[a:b]
        own, counts = np.unique(doc[at], return_counts=True)
        made.append((int(group[at[0]]), 0, docs[own].tobytes(), counts.astype(np.int32).tobytes(), six(anchor[at] // np.uint64(groups)),
                     six(context[at]), pos[at].tobytes()))
    if made:
        yield rows_of(made)


def six(x: np.ndarray) -> bytes:
    """The lower 48 bits of each value."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unsix(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64)[:, 0]


def rows_of(made: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=["p", "kind", "docs", "counts", "anchor", "context", "pos"])


def settle(entries: DataFrame) -> DataFrame:
    """Decide equal contexts over the table: rows with ``spans`` (int32 pairs) or, where texts are needed, with ``anchor`` and ``pos``."""

    def run(key, rows):
        kind = rows["kind"].to_pylist()
        docs, counts, anchor, context, pos = ([x for x, k in zip(rows[c].to_pylist(), kind) if k == 0] for c in ("docs", "counts", "anchor", "context", "pos"))
        done = [(np.frombuffer(d, np.int64), s) for d, s, k in zip(rows["docs"].to_pylist(), rows["pos"].to_pylist(), kind) if k == 1]
        out = [(int(d[0]), int(d[1]), s, None, None) for d, s in done]
        if docs:
            docs = np.frombuffer(b"".join(docs), np.int64).reshape(-1, 3)
            doc = np.repeat(np.arange(len(docs)), np.frombuffer(b"".join(counts), np.int32))
            anchor, context, pos = unsix(b"".join(anchor)), unsix(b"".join(context)), np.frombuffer(b"".join(pos), np.int32).astype(np.int64)
            order, first, number = keep_least(docs[doc, 0], anchor, context)
            doc, pos, anchor = doc[order], pos[order], anchor[order]
            later = docs[doc, 0] > docs[doc[first], 0][number]
            start, stop = context_spans(pos[later], docs[doc[later], 2])
            out += [(int(docs[d, 0]), int(docs[d, 1]), s, None, None) for d, s in pack_spans(doc[later], start, stop)]
            # anchors whose least documents differ between contexts
            doc, pos, anchor = doc[~later], pos[~later], anchor[~later]
            new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
            head = np.flatnonzero(new)
            low, high = np.minimum.reduceat(docs[doc, 0], head), np.maximum.reduceat(docs[doc, 0], head)
            open_ = (low != high)[np.cumsum(new) - 1]
            names = (anchor * np.uint64(0x9E3779B97F4A7C15) + np.uint64(int(key[0].as_py()))).view(np.int64)
            out += [(int(docs[d, 0]), int(docs[d, 1]), None, a, p) for d, a, p in zip(doc[open_].tolist(), names[open_].tolist(), pos[open_].tolist())]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]
        columns = list(zip(*out)) or [()] * 5
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["ord", "th", "spans", "anchor", "pos"])

    return entries.groupBy("p").applyInArrow(run, "ord bigint, th bigint, spans binary, anchor bigint, pos int")


def fetch_contexts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, ord, th, start, context) for anchors that need texts; the texts are shuffled once."""
    lists = wanted.groupBy("ord", "th").agg(F.collect_list(F.struct("anchor", "pos")).alias("asked"))  # bounded by the document
    found = rows.join(lists, ["ord", "th"]).dropDuplicates(["ord", "th"])
    at = F.greatest(F.col("a.pos") - SIDE, F.lit(0))
    return (found.select("ord", "th", "text", F.explode("asked").alias("a"))
            .select(F.col("a.anchor").alias("anchor"), "ord", "th", at.alias("start"), F.substring("text", at + 1, F.col("a.pos") + SPAN - at).alias("context")))


def suffix_array(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of at least ``SPAN`` bytes in sorted order: context number, offset, left byte (-1: none) and LCP with the one before."""
    lengths = np.fromiter(map(len, contexts), np.int64, len(contexts))
    width = int(lengths.max())
    text = np.zeros((len(contexts), 2 * width), np.uint8)
    flat = np.frombuffer(b"".join(contexts), np.uint8) + np.uint8(1)  # UTF-8 has no byte 255, so 0 is free as an end
    text[np.repeat(np.arange(len(contexts)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    many = np.maximum(lengths - SPAN + 1, 0)
    number = np.repeat(np.arange(len(contexts)), many)
    offset = np.arange(len(number)) - np.repeat(np.cumsum(many) - many, many)
    view = np.lib.stride_tricks.sliding_window_view(text, width, axis=1)
    suffix = np.ascontiguousarray(view[number, offset])
    order = np.argsort(suffix.view(f"S{width}")[:, 0], kind="stable")
    number, offset, suffix = number[order], offset[order], suffix[order]
    lcp = np.zeros(len(order), np.int64)
    if len(order) > 1:
        differ = (suffix[1:] != suffix[:-1]) | (suffix[1:] == 0)
        lcp[1:] = np.where(differ.any(1), differ.argmax(1), width)
    left = np.where(offset > 0, text[number, np.maximum(offset - 1, 0)].astype(np.int64), -1)
    return number, offset, left, lcp


def maximal_repeats(lcp: np.ndarray, left: np.ndarray, least: int = SPAN):
    """Intervals (length, first, last) of the suffix array that are maximal repeats of at least ``least`` bytes.

    A stack-scan of the LCP table gives the interval tree bottom-up; an interval whose left bytes are all equal is left out, as
    its extension to the left repeats as often. A suffix at the start of its context has no left byte and counts as diverse.
    """
    inside = np.flatnonzero(lcp >= least)
    if not len(inside):
        return
    runs = np.split(inside, np.flatnonzero(np.diff(inside) > 1) + 1)
    for run in runs:
        first, last = int(run[0]) - 1, int(run[-1])
        sides, depth = left[first: last + 1].tolist(), lcp[first: last + 1].tolist()
        # an entry of the stack: length, first suffix, left byte or None if diverse
        stack: list[list] = []
        for i in range(1, last - first + 2):
            now = depth[i] if i <= last - first else 0
            begin, side = i - 1, sides[i - 1] if sides[i - 1] >= 0 else None
            while stack and stack[-1][0] > now:
                length, begin, own = stack.pop()
                side = own if own == side else None
                if side is None:
                    yield length, first + begin, first + i - 1
            if now < least:
                break
            if stack and stack[-1][0] == now:
                stack[-1][2] = side if stack[-1][2] == side else None
            else:
                stack.append([now, begin, side])


def repeat_spans(contexts: DataFrame) -> DataFrame:
    """Spans (ord, th, spans) of the maximal repeats among contexts that a smaller document has as well."""
    buckets = max(1, -(-contexts.count() // BUCKET_CONTEXTS))
    hot = materialize(contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_CONTEXTS).select("anchor"), "hot")
    some = not hot.isEmpty()
    rest = contexts.join(hot, "anchor", "left_anti") if some else contexts
    dealt = rest.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).repartition("bucket").sortWithinPartitions("bucket").select("bucket", "ord", "th", "start", "context")

    def run(batches):
        for _, rows in grouped(batches, ["bucket"]):
            owner, th, start = (rows[k].to_numpy() for k in ("ord", "th", "start"))
            number, offset, left, lcp = suffix_array(rows["context"].to_pylist())
            of, cover = owner[number], np.zeros(len(number), np.int64)
            for length, a, b in maximal_repeats(lcp, left):
                part = of[a: b + 1]
                low = part.min()
                np.maximum(cover[a: b + 1], np.where(part > low, length, 0), out=cover[a: b + 1])
            hit = np.flatnonzero(cover)
            begin = start[number[hit]] + offset[hit]
            spans = pack_spans(doc_number(owner, th)[number[hit]], begin, begin + cover[hit])
            back = {d: i for i, d in enumerate(doc_number(owner, th).tolist())}
            if spans:
                yield pa.RecordBatch.from_arrays([pa.array([int(owner[back[d]]) for d, _ in spans]), pa.array([int(th[back[d]]) for d, _ in spans]),
                                                  pa.array([s for _, s in spans], pa.binary())], names=["ord", "th", "spans"])

    found = dealt.mapInArrow(run, "ord bigint, th bigint, spans binary")
    return found.unionByName(hot_spans(contexts.join(hot, "anchor", "left_semi"))) if some else found


def doc_number(owner: np.ndarray, th: np.ndarray) -> np.ndarray:
    """A number for each distinct (ord, th)."""
    return np.unique(np.column_stack([owner, th]), axis=0, return_inverse=True)[1].reshape(-1)


def hot_spans(contexts: DataFrame) -> DataFrame:
    """Spans among the contexts of very common anchors: the least document of each 50-byte string by a grouped minimum."""
    windows = contexts.where(F.octet_length("context") >= SPAN).select("ord", "th", "start", "context", F.explode(
        F.sequence(F.lit(0), F.octet_length("context") - SPAN)).alias("i")).select(
        "ord", "th", (F.col("start") + F.col("i")).alias("at"), F.substring("context", F.col("i") + 1, F.lit(SPAN)).alias("w"))
    least = windows.groupBy("w").agg(F.min("ord").alias("low"), F.max("ord").alias("high")).where("low < high")
    hit = windows.join(least, "w").where("ord > low")
    little = F.concat(_little(F.col("at")), _little(F.col("at") + SPAN))
    return hit.select("ord", "th", little.alias("spans"))


def _little(c: Column) -> Column:
    """A number as four little-endian bytes."""
    h = F.lpad(F.hex(c.cast("bigint")), 8, "0")
    return F.unhex(F.concat(*[F.substring(h, i, 2) for i in (7, 5, 3, 1)]))


def repeated(docs: DataFrame) -> DataFrame:
    """(ord, th, spans): for each document with repeats, its spans as a list of int32 pairs (start, stop), not yet merged."""
    rows = with_identity(docs)
    told = materialize(settle(list_anchors(rows, parts(docs, 16 << 20))), "anchors")
    release(docs.sparkSession)
    wanted = told.where("anchor is not null").select("ord", "th", "anchor", "pos")
    contexts = materialize(fetch_contexts(rows, wanted), "contexts")
    release(docs.sparkSession)
    spans = told.where("spans is not null").select("ord", "th", "spans").unionByName(materialize(repeat_spans(contexts), "spans"))
    discard(contexts)
    release(docs.sparkSession)
    return spans.groupBy("ord", "th").agg(F.collect_list("spans").alias("spans"))  # bounded by the document


def spans_of(packed: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(packed or ()), np.int32).reshape(-1, 2).astype(np.int64)
    if not len(pairs):
        return pairs[:, 0], pairs[:, 1]
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    return merge_spans(pairs[:, 0], pairs[:, 1])


def kept_bytes(text: bytes, start: np.ndarray, stop: np.ndarray) -> bytes:
    edges = [0, *np.column_stack([start, stop]).ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = with_identity(docs).join(repeated(docs), ["ord", "th"], "left").select("ord", "text", "spans")

    def run(batches):
        for batch in batches:
            out = []
            for text, packed in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                start, stop = spans_of(packed)
                out.append((len(text), int((stop - start).sum()), len(start), hashlib.sha256(kept_bytes(text, start, stop)).hexdigest()))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch["ord"], *[pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()])]],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    out = joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != LAST, F.col("doc_id")))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """Documents without their repeated passages, with all columns; ``n_chars`` follows the text where there is one.

    A span is shrunk to whole characters, so the rest is valid text. A document that loses all its words goes.
    """
    names, found = docs.columns, repeated(docs.select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    nested = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("ord"), F.xxhash64(text).alias("th"),
                         F.col("text").cast("binary").alias("text"), F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("d"))
    joined = nested.join(found, ["ord", "th"], "left").select("text", "spans", "d", F.lit(False).alias("gone"))

    def run(batches):
        for batch in batches:
            texts, gone = [], []
            for text, packed in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                start, stop = spans_of(packed)
                if not len(start):
                    texts.append(text)
                    gone.append(False)
                    continue
                raw = np.frombuffer(text + b"a", np.uint8)
                lead = np.flatnonzero((raw & 0xC0) != 0x80)  # where characters start
                start = lead[np.searchsorted(lead, start, "left")]
                stop = lead[np.searchsorted(lead, stop, "right") - 1]
                good = stop > start
                texts.append(kept_bytes(text, start[good], stop[good]))
                gone.append(not texts[-1].split(None, 1))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), batch["spans"], batch["d"], pa.array(gone, pa.bool_())], names=["text", "spans", "d", "gone"])

    cut = joined.mapInArrow(run, joined.schema).where("not gone")
    text = F.col("text").cast("string")
    return cut.select(*[text.alias(c) if c == "text" else F.when(F.col("spans").isNull(), F.col(f"d.`{c}`")).otherwise(F.char_length(text)).cast(docs.schema[c].dataType).alias(c)
                        if c == "n_chars" else F.col(f"d.`{c}`").alias(c) for c in names])


register("op9_suffix_dedup", op9_suffix_dedup)
