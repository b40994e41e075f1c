"""Quality rules: an isolation forest over rule statistics, its threshold calibrated from labelled rows.

Statistics are counted on whole texts. The forest is fitted on a bounded sample of labelled rows that pass the base rules (``SAMPLE_ROWS``,
the smallest hashes of their row keys): each tree gets about ``TREE_ROWS`` of them, splits at random and so isolates odd rows on
short paths. Of the bad rows only ``BAD_SHARE`` of a tree's good ones stay in it: many alike bad rows would be a cluster of their own, with long
paths, and hide each other. A row's anomaly is 2**(-mean path / expected path). All labelled rows then calibrate the
threshold: the one that rejects most bad rows net of good ones, while at most ``GOOD_LOSS`` of the good rows go.

Cases. A null or empty text has zero words and fails the base rules. Repeated rows and ties get equal verdicts. Unlabelled,
null-labelled or unknown ids only take no part in fitting. Without labelled rows of both kinds nothing but the base rules
rejects. An empty table gives no rows. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import math
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm.common import add, materialize, pieces, register, table

TREES, TREE_ROWS = 128, 256
SAMPLE_ROWS = TREES * TREE_ROWS
GOOD_LOSS = 0.002
BAD_SHARE = 0.012
STRETCH = 20.0  # ratios near 0, where rules tell good from bad, are spread by log(1 + STRETCH * x)
PIECE = 1 << 20  # bytes of text counted at once
LEVELS = 20_000  # steps of the anomaly score at which thresholds are compared
WHITE, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
PRIOR_WORDS, PRIOR_LENGTH = 100, 5.5  # a short text's mean word length is drawn towards a usual one


def repeat_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the list."""
    n = len(words)
    if n <= width:
        return 0
    first: dict[bytes, int] = {}
    codes = np.fromiter(map(first.setdefault, words, count()), np.int64, n)
    keys = codes[: n - width + 1]
    for i in range(1, width):
        if n >= 1 << 31:  # keep pairs inside 64 bits
            raise ValueError("text of over 2**31 words")
        keys = np.unique(keys, return_inverse=True)[1] if i > 1 and n >= 1 << 21 else keys
        keys = keys * n + codes[i: n - width + 1 + i]
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    for i in range(width):
        hit[i: i + len(keys)] |= twice
    return int(hit.sum())


def text_counts(text: bytes) -> tuple[int, ...]:
    """The ``COUNTS`` of one text in UTF-8."""
    words = text.split()
    inside = text.translate(None, WHITE)
    chars = len(inside) - int(np.count_nonzero((np.frombuffer(inside, np.uint8) & 0xC0) == 0x80))
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    symbols = len(inside) - len(inside.translate(None, SYMBOLS))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words), len(lines)


def with_counts(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with their ``COUNTS``; the text of each row is read once, where it lies."""
    base = add(docs, **{c: F.lit(0).cast("bigint") for c in COUNTS})

    def run(batches):
        for batch in batches:
            for rows, found in pieces(batch, size=PIECE):
                found = np.array([text_counts(x) for x in found], np.int64)
                columns = [pa.array(found[:, COUNTS.index(n)]) if n in COUNTS else rows[n] for n in rows.schema.names]
                yield pa.RecordBatch.from_arrays(columns, names=rows.schema.names)

    return base.mapInArrow(run, base.schema)


def ratios(counts: pd.DataFrame | dict) -> np.ndarray:
    """Rule statistics of each row: ratios, so that a long text is no anomaly for its length; on a log scale but for word length."""
    c = {k: np.asarray(counts[k], float) for k in COUNTS}
    words, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1)
    length = (c["word_chars"] + PRIOR_WORDS * PRIOR_LENGTH) / (words + PRIOR_WORDS)
    return np.column_stack([length, *(np.log1p(STRETCH * x) for x in (c["n_symbols"] / words, c["n_dup_lines"] / lines, c["n_repeat_words"] / words))])


def expected_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 1.0 if n <= 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow_tree(rows: np.ndarray, seed: int) -> dict[str, list]:
    """One tree as flat lists: feature (-1 at a leaf), cut, left child (right is the next one), path value at a leaf."""
    rng = np.random.default_rng(seed)
    depth = max(1, math.ceil(math.log2(max(2, len(rows)))))
    tree: dict[str, list] = {"feature": [], "cut": [], "left": [], "path": []}
    todo = [(rows, 0, 0)]
    for name, value in (("feature", -1), ("cut", 0.0), ("left", 0), ("path", 0.0)):
        tree[name].append(value)
    while todo:
        part, at, level = todo.pop()
        low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(1), np.zeros(1))
        able = np.flatnonzero(high > low)
        if level >= depth or len(part) <= 1 or not len(able):
            tree["path"][at] = level + expected_path(len(part))
            continue
        f = int(rng.choice(able))
        cut = float(rng.uniform(low[f], high[f]))
        left = len(tree["feature"])
        for name, value in (("feature", -1), ("cut", 0.0), ("left", 0), ("path", 0.0)):
            tree[name] += [value, value]
        tree["feature"][at], tree["cut"][at], tree["left"][at] = f, cut, left
        todo += [(part[part[:, f] <= cut], left, level + 1), (part[part[:, f] > cut], left + 1, level + 1)]
    return tree


def anomaly(forest: list[dict], rows: np.ndarray, tree_rows: float) -> np.ndarray:
    """Score in (0, 1], higher is odder."""
    total = np.zeros(len(rows))
    for tree in forest:
        feature, cut, left, path = (np.asarray(tree[k]) for k in ("feature", "cut", "left", "path"))
        at = np.zeros(len(rows), int)
        live = np.arange(len(rows)) if feature[0] >= 0 else np.empty(0, int)
        while len(live):
            node = at[live]
            at[live] = left[node] + (rows[live, feature[node]] > cut[node])
            live = live[feature[at[live]] >= 0]
        total += path[at]
    return 2.0 ** (-total / max(1, len(forest)) / max(expected_path(tree_rows), 1e-9))


def fit(labelled: DataFrame, seed: int = 7) -> dict:
    """Forest and threshold from rows with ``COUNTS``, ``quality`` and ``key``.

    Trees are grown in parallel, one group of about ``TREE_ROWS`` rows each; the driver gets the trees and one histogram
    of at most ``LEVELS`` steps.
    """
    fair = labelled.where("quality in (0, 1) and not base_failed")
    sample = fair.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS).select(*COUNTS, "quality", F.xxhash64("key", F.lit(seed)).alias("h"))
    n = fair.limit(SAMPLE_ROWS).count()
    if not n:
        return {"forest": [], "rows": 0.0, "threshold": math.inf}
    each = min(TREES, -(-TREES * TREE_ROWS // n))  # trees that one row goes to
    dealt = sample.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(each - 1)))).withColumn(
        "tree", F.pmod(F.col("h") + F.col("tree") * 37, F.lit(TREES)).cast("int"))

    def grow(key, frame):
        frame = frame.sort_values("h")  # the order of rows must not depend on the shuffle
        good, bad = frame[frame.quality == 1], frame[frame.quality == 0]
        frame = pd.concat([good, bad.head(math.ceil(BAD_SHARE * len(good)))])
        tree = grow_tree(ratios(frame), seed * 1000 + int(key[0]))
        return pd.DataFrame({"tree": [int(key[0])], "rows": [len(frame)], **{k: [v] for k, v in tree.items()}})

    grown = dealt.groupBy("tree").applyInPandas(grow, "tree int, rows int, feature array<int>, cut array<double>, left array<int>, path array<double>")
    forest = [r.asDict() for r in grown.orderBy("tree").collect()]
    model = {"forest": forest, "rows": sum(t["rows"] for t in forest) / len(forest), "threshold": math.inf}
    scored = with_anomaly(fair.select(*COUNTS, "quality"), model)
    steps = scored.groupBy(F.floor(F.col("anomaly") * LEVELS).alias("step"), "quality").agg(F.count(F.lit(1)).alias("n")).collect()
    model["threshold"] = calibrate([(r["step"], r["quality"], r["n"]) for r in steps])
    return model


def calibrate(steps: list[tuple[int, int, int]]) -> float:
    """Least score to reject: most bad rows less good ones, losing at most ``GOOD_LOSS`` of the good rows."""
    good, bad = sum(n for _, q, n in steps if q), sum(n for _, q, n in steps if not q)
    best, at, lost, caught = 0.0, math.inf, 0, 0
    for step in sorted({s for s, _, _ in steps}, reverse=True):
        lost += sum(n for s, q, n in steps if s == step and q)
        caught += sum(n for s, q, n in steps if s == step and not q)
        if not good or not bad or lost > GOOD_LOSS * good:
            break
        if caught / bad - lost / good > best:
            best, at = caught / bad - lost / good, step / LEVELS
    return at


def with_anomaly(rows: DataFrame, model: dict) -> DataFrame:
    """Add ``anomaly`` to rows with ``COUNTS``; the forest has at most TREES * 2 * TREE_ROWS nodes."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    base = add(rows, anomaly=F.lit(0.0))

    def run(batches):
        for batch in batches:
            score = anomaly(held.value["forest"], ratios({c: batch[c].to_numpy(zero_copy_only=False) for c in COUNTS}), held.value["rows"])
            yield pa.RecordBatch.from_arrays([pa.array(score) if n == "anomaly" else batch[n] for n in batch.schema.names], names=batch.schema.names)

    return base.mapInArrow(run, base.schema)


def base_rules(counted: DataFrame) -> DataFrame:
    return add(counted, base_failed=(F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))


def judge(counted: DataFrame, model: dict) -> DataFrame:
    """Add ``anomaly`` and ``kept`` to rows with counts and ``base_failed``."""
    return add(with_anomaly(counted, model), kept=~F.col("base_failed") & (F.col("anomaly") < F.lit(model["threshold"])))


def labelled_rows(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """Counted rows with a quality label (one per id: the larger), without texts."""
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    return counted.select("doc_id", "key", "base_failed", *COUNTS).join(one, "doc_id")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    keyed = base_rules(with_counts(docs)).select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "base_failed", *COUNTS)
    counted = materialize(keyed, "counts")
    model = fit(labelled_rows(counted, table(spark, sf_dir, "labels")))
    return judge(counted, model).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that pass base rules and forest, with all their columns.

    The first pass writes counts only; the second counts again next to the text, which spares a shuffle of texts.
    """
    counted = materialize(base_rules(with_counts(docs.select("doc_id", "text"))).select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "base_failed", *COUNTS), "counts")
    model = fit(labelled_rows(counted, labels))
    rest = [c for c in docs.columns if c != "text"]
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("d"), F.col("text"))  # clashing names stay inside d
    kept = judge(base_rules(with_counts(nested)), model).where("kept")
    return kept.select(*[F.col("text") if c == "text" else F.col(f"d.`{c}`").alias(c) for c in docs.columns])


register("op1_quality_rules", op1_quality_rules)
