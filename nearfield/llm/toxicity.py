"""Toxicity: a lexicon trie intersected with Levenshtein automata, and context windows that separate quotation from abuse.

The lexicon is learned from labelled training rows: words, and stems with several continuations, whose documents are toxic. It is
a trie; walking it with a Levenshtein automaton (with adjacent swaps) accepts a word within the distance its
term allows, or a word whose start is as near to a stem: 1 from four letters, 2 from nine. Words below a stem stay terms of their own; of stems that
continue each other the most precise is taken. Words that are no terms themselves may be exceptions. The product of the two is determinised as words
are read, so a word costs about as many dictionary steps as it has letters before no term is near.
Each hit is then seen in its window of ``WINDOW`` words: quotation marks around it or a reporting word near it make it quoted;
other hits near it make it abuse. A logistic regression over a document's hits gives the score; a near hit counts as its term, less a cost per error.
As labelled texts hold few misspellings and quotations, toxic rows with hits also train as a copy with misspelled hit words (label 1) and as one with
quoted hit words (label 0).

Training rows are a bounded sample of the labelled ones (``SAMPLE_ROWS``, the smallest hashes of their ids). Only texts are inputs.

Cases. Null and empty texts have no hits and get the score of such texts. Rows without an id are not held out and
scored as any other; repeated rows get equal scores. Labels that are null or contradict each other (the larger counts) do no
harm; without labels of both kinds every score is the base rate (or 0). Very long texts are read whole. Columns of ``docs`` named like an output are replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm.common import add, materialize, pieces, register, table

SAMPLE_ROWS = 20_000
TERMS, EXCEPTIONS = 5_000, 20_000
PRECISION = 0.6
EVIDENCE = 12.0  # log-likelihood ratio against the base rate that a term needs, well above the log of the vocabulary's size
WEIGH = 2  # one in so many sample rows is kept from the lexicon and fits the weights
STEM_WORDS = 5  # distinct words a stem must explain
STEM_LETTERS = range(3, 10)
WINDOW = 6
PREDICT = 0.7
QUOTES = "\"'“”„‟«»‹›‘’`"
CLOSING = re.compile(f"[.,;:!?]?[{re.escape(QUOTES)}]")
REPORTING = frozenset("said says say quote quoted quoting wrote writes word words term terms called calling phrase reported cited example slur".split())
TOKEN = re.compile(r"\w+")
SPACES = bytes(b if b >= 128 or chr(b).isalnum() or b == 95 else 32 for b in range(256))  # for ASCII, what TOKEN does
STATES = 200_000  # built states of the automaton that are kept
FEATURES = 6  # exact hit, unquoted hits, all quoted, misspelled hits, hits near each other, what unquoted words tell
AT_LEAST_0 = frozenset((1, 3, 5))
ERROR_COST = 0.3  # log-odds that a hit loses per error


def allowed(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class Trie:
    """Terms and stems; node 0 is the root."""

    def __init__(self, terms: list[str], stems: list[str]):
        self.child: list[dict[str, int]] = [{}]
        self.reach = [0]  # largest distance allowed to a term below
        self.term: list[int | None] = [None]  # distance allowed to the term that ends here
        self.stem: list[int | None] = [None]  # the same of a stem
        self.text = [""]  # the letters from the root
        for text, is_stem in [*((t, False) for t in terms), *((s, True) for s in stems)]:
            limit, node = allowed(text), 0
            self.reach[0] = max(self.reach[0], limit)
            for ch in text:
                if ch not in self.child[node]:
                    self.child[node][ch] = len(self.child)
                    self.child.append({})
                    self.reach.append(0)
                    self.term.append(None)
                    self.stem.append(None)
                    self.text.append(self.text[node] + ch)
                node = self.child[node][ch]
                self.reach[node] = max(self.reach[node], limit)
            if is_stem:
                self.stem[node] = limit
            else:
                self.term[node] = limit


class Matcher:
    """The product of trie and Levenshtein automaton as a lazily built deterministic automaton.

    A state is a set of (node, errors, awaited): the term's letters up to the node are matched with so many errors; with a
    letter awaited, an adjacent swap is half read. ``nearest`` gives the errors of the nearest term or stem and which it is; of equally near ones
    a term before a stem, then the first in alphabetical order.
    """

    def __init__(self, terms: list[str], stems: list[str]):
        self.trie = Trie(terms, stems)
        self.forget()

    def forget(self) -> None:
        """Start again without built states; what ``match`` says does not depend on them."""
        self.sets: list[frozenset] = []
        self.number: dict[frozenset, int] = {}
        self.next: list[dict[str, int]] = []
        self.accept: list[tuple[int, str] | None] = []  # errors and letters of the nearest term that ends here
        self.begun: list[tuple[int, str] | None] = []  # the same of a stem
        self.start = self._state({(0, 0, "")})

    def _state(self, items: set) -> int:
        trie, todo = self.trie, list(items)
        while todo:  # leaving out a letter of the term needs no input
            node, e, awaited = todo.pop()
            if awaited:
                continue
            for to in trie.child[node].values():
                item = (to, e + 1, "")
                if e < trie.reach[to] and item not in items:
                    items.add(item)
                    todo.append(item)
        key = frozenset(items)
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.next.append({})
            for found, limit in ((self.accept, trie.term), (self.begun, trie.stem)):
                found.append(min(((e, trie.text[n]) for n, e, a in key if not a and limit[n] is not None and e <= limit[n]), default=None))
        return self.number[key]

    def _step(self, state: int, ch: str) -> int:
        trie, out = self.trie, set()
        for node, e, awaited in self.sets[state]:
            if awaited:
                if ch == awaited:
                    out.add((node, e, ""))
                continue
            if e < trie.reach[node]:
                out.add((node, e + 1, ""))  # a letter too many
            for own, to in trie.child[node].items():
                if own == ch:
                    out.add((to, e, ""))
                elif e < trie.reach[to]:
                    out.add((to, e + 1, ""))  # another letter
                    if ch in trie.child[to] and e < trie.reach[trie.child[to][ch]]:
                        out.add((trie.child[to][ch], e + 1, own))  # two letters swapped
        return self._state(out) if out else -1

    def match(self, word: str) -> int | None:
        found = self.nearest(word)
        return None if found is None else found[0]

    def nearest(self, word: str) -> tuple[int, str] | None:
        if len(self.sets) > STATES:
            self.forget()
        state, best = self.start, None
        for ch in word:
            to = self.next[state].get(ch)
            if to is None:
                to = self.next[state][ch] = self._step(state, ch)
            if to < 0:
                return best
            state, begun = to, self.begun[to]
            if begun is not None and (best is None or begun[0] < best[0]):
                best = begun
        end = self.accept[state]
        return end if best is None or end is not None and end[0] <= best[0] else best


def distinct_words(text: bytes) -> set[str]:
    """The words that ``TOKEN`` finds in the lower-cased text."""
    if text.isascii():
        return set(text.translate(SPACES).decode().lower().split())
    return set(TOKEN.findall(text.decode().lower()))


def document_features(text: str, hits: dict[str, int], odds: dict[str, float]) -> list[float]:
    """What the windows around the hits of a text say; ``hits`` maps its matching words to their errors, ``odds`` to what they tell.

    Only words with a hit outside quotation tell.
    """
    tokens = [(m.group(), m.start(), m.end()) for m in TOKEN.finditer(text.lower())] if hits else []
    at = [i for i, (w, _, _) in enumerate(tokens) if w in hits]
    quoted = fuzzy = crowd = 0
    meant = set()
    low = text.lower()
    for i in at:
        word, a, b = tokens[i]
        near = {w for w, _, _ in tokens[max(0, i - WINDOW): i + WINDOW + 1]}
        marks = a > 0 and low[a - 1] in QUOTES and CLOSING.match(low, b)
        said = bool(near & REPORTING)
        if marks or said:
            quoted += 1
        else:
            meant.add(word)
        fuzzy += hits[word] > 0
        crowd += any(0 < abs(j - i) <= WINDOW for j in at)
    n = len(at)
    told = min(sum(odds.get(w, 0.0) for w in meant), 20.0)
    return [float(n > fuzzy), np.log1p(n - quoted), float(n > 0 and quoted == n), np.log1p(fuzzy), np.log1p(crowd), told]


def misspelled(text: str, hits: dict[str, int], kind: int) -> str:
    """The text with each hit word of four letters or more misspelled: two letters swapped, one doubled, or one dropped."""

    def change(m: re.Match) -> str:
        word = m.group()
        if word.lower() not in hits or len(word) < 4:
            return word
        i = 1 + (len(word) + kind) % (len(word) - 2)
        return (word[:i] + word[i + 1] + word[i] + word[i + 2:], word[:i] + word[i] + word[i:], word[:i] + word[i + 1:])[kind % 3]

    return TOKEN.sub(change, text)


def quoting(text: str, hits: dict[str, int]) -> str:
    """The text with each hit word in quotation marks."""
    return TOKEN.sub(lambda m: f'"{m.group()}"' if m.group().lower() in hits else m.group(), text)


class Scorer:
    """A worker's matcher with the model; states of the automaton are kept between batches."""

    def __init__(self, model: dict):
        self.matcher = Matcher(model["terms"], model["stems"])
        self.terms, self.exceptions, self.odds = frozenset(model["terms"]), model["exceptions"], model["odds"]
        self.weights = np.array(model["weights"]) if model["weights"] is not None else None

    def nearest(self, texts: list[bytes]) -> list[dict[str, tuple[int, str]]]:
        """For each text its words that match, with errors and the term or stem."""
        words = [distinct_words(t) for t in texts]
        near = {}
        for w in set().union(*words):
            found = self.matcher.nearest(w)
            if found is not None and (w in self.terms or w not in self.exceptions):
                near[w] = found
        return [{w: near[w] for w in own & near.keys()} for own in words]

    def hits(self, texts: list[bytes]) -> list[dict[str, int]]:
        return [{w: e for w, (e, _) in found.items()} for found in self.nearest(texts)]

    def told(self, found: dict[str, tuple[int, str]]) -> dict[str, float]:
        """What each matching word tells: the log-odds of its term less a cost per error."""
        return {w: max(0.0, self.odds.get(term, 0.0) - ERROR_COST * e) for w, (e, term) in found.items()}

    def features(self, texts: list[bytes]) -> np.ndarray:
        return np.array([document_features(t.decode(), {w: e for w, (e, _) in f.items()}, self.told(f)) for t, f in zip(texts, self.nearest(texts))]).reshape(-1, FEATURES)


def evidence_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights of which those of ``AT_LEAST_0`` are not negative: a misspelled, meant or heavier hit never speaks for a text."""
    out = np.zeros(x.shape[1] + 1)
    left = list(range(x.shape[1]))
    while True:
        w = logistic(x[:, left], y)
        bad = [f for f, v in zip(left, w) if f in AT_LEAST_0 and v < 0]
        if not bad:
            out[[*left, -1]] = w
            return out
        left = [f for f in left if f not in bad]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights (bias last) by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.diag([*[ridge] * (x.shape[1] - 1), 1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def term_counts(sample: DataFrame, rate: float) -> DataFrame:
    """(term, stem, toxic, clean, words): documents of each kind with a word or stem, and distinct words below a stem.

    A word's document counts are summed first; a stem's are summed over its words (the documents of a stem's words hardly
    overlap, and a sum errs towards more support on both sides).
    """

    def run(batches):
        seen = {0: Counter(), 1: Counter()}
        for batch in batches:
            for rows, texts in pieces(batch):
                for text, toxic in zip(texts, rows["toxic"].to_pylist()):
                    seen[toxic].update(distinct_words(text))
        for toxic, counts in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([toxic] * len(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())],
                                             names=["term", "toxic", "n"])

    words = sample.select("text", "toxic").mapInArrow(run, "term string, toxic int, n bigint").groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"))
    stems = words.select(F.explode(F.transform(F.array(*[F.lit(i) for i in STEM_LETTERS]), lambda k: F.when(F.char_length("term") >= k, F.substring("term", F.lit(1), k)))).alias("s"),
                         "toxic", "clean").where("s is not null").groupBy("s").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count_if(F.col("toxic") > 0).alias("words"))
    both = words.select("term", F.lit(False).alias("stem"), "toxic", "clean", F.lit(1).cast("bigint").alias("words")).unionByName(
        stems.select(F.col("s").alias("term"), F.lit(True).alias("stem"), "toxic", "clean", "words"))
    n, part = F.col("toxic") + F.col("clean"), lambda c, rate: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (F.col("toxic") + F.col("clean")) / F.lit(rate))).otherwise(0.0)
    good = (F.col("toxic") >= PRECISION * n) & (part("toxic", rate) + part("clean", 1 - rate) >= EVIDENCE)
    return both.where(good & (~F.col("stem") | (F.col("words") >= STEM_WORDS)))


def choose_terms(rows: list) -> tuple[list[str], list[str]]:
    """Words, and of stems that continue each other the most precise (of equals the shortest)."""
    stems: list[str] = []
    for r in sorted((r for r in rows if r["stem"]), key=lambda r: (-r["toxic"] / (r["toxic"] + r["clean"]), len(r["term"]), r["term"])):
        if not any(r["term"].startswith(t) or t.startswith(r["term"]) for t in stems):
            stems.append(r["term"])
    return sorted({r["term"] for r in rows if not r["stem"]}), sorted(stems)


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Lexicon, exceptions and weights from labelled (doc_id, toxic) training rows."""
    one = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")  # at most SAMPLE_ROWS ids
    sample = materialize(known, "labelled")
    weigh = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(WEIGH)) == 0  # rows that the lexicon has not seen
    rate = sample.agg(F.avg("toxic")).first()[0]
    rate = min(max(rate or 0.0, 1e-3), 1 - 1e-3)
    rows = term_counts(sample.where(~weigh), rate).orderBy(F.desc("toxic"), "term", "stem").limit(TERMS).collect()
    terms, stems = choose_terms(rows)
    own = set(terms)
    odds = {r["term"]: float(np.log((r["toxic"] + 0.5) / (r["clean"] + 0.5))) for r in rows if r["term"] in own and not r["stem"]}
    model = {"terms": terms, "stems": stems, "odds": odds, "exceptions": frozenset(), "weights": None}
    model["exceptions"] = exceptions(sample.where(~weigh), model)
    y = np.empty(0)
    for rows in (sample.where(weigh), sample):  # all rows only where the fresh ones are too few to hold both labels
        x = features(rows, model).collect()
        y = np.array([r["toxic"] for r in x], float)
        if 0 < y.sum() < len(y):
            break
    if 0 < y.sum() < len(y):
        model["rate"] = float(y.mean())
        copies = [(r["toxic"], r["misspelled"]) for r in x if r["misspelled"] and r["toxic"]] + [(0, r["quoting"]) for r in x if r["quoting"] and r["toxic"]]
        every = np.array([r["x"] for r in x] + [v for _, v in copies])
        model["weights"] = evidence_weights(every, np.concatenate([y, [float(t) for t, _ in copies]])).tolist()
    else:
        model["rate"] = float(y.mean()) if len(y) else 0.0
    return model


def exceptions(sample: DataFrame, model: dict) -> frozenset:
    """Ordinary words near a term or below a stem: matches, themselves no terms, that clean documents have about as often as toxic ones."""
    held = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own, seen = Scorer(held.value), {0: Counter(), 1: Counter()}
        for batch in batches:
            for rows, texts in pieces(batch):
                for hits, toxic in zip(own.hits(texts), rows["toxic"].to_pylist()):
                    seen[toxic].update(w for w in hits if w not in own.terms)
        for toxic, counts in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([toxic] * len(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())],
                                             names=["word", "toxic", "n"])

    n = sample.select("text", "toxic").mapInArrow(run, "word string, toxic int, n bigint").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"), F.sum("n").alias("n"))
    return frozenset(r["word"] for r in n.where("clean * 2 > n").orderBy(F.desc("n"), "word").limit(EXCEPTIONS).collect())


def features(sample: DataFrame, model: dict) -> DataFrame:
    """(toxic, x, misspelled, quoting): features of each row and, where it has hits, of its two copies."""
    held = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = Scorer(held.value)
        for batch in batches:
            for rows, texts in pieces(batch):
                hits = own.hits(texts)
                some = [i for i, h in enumerate(hits) if h]
                columns = [own.features(texts).tolist()]
                for copy in (lambda i: misspelled(texts[i].decode(), hits[i], i), lambda i: quoting(texts[i].decode(), hits[i])):
                    made = dict(zip(some, own.features([copy(i).encode() for i in some]).tolist()))
                    columns.append([made.get(i) for i in range(len(texts))])
                yield pa.RecordBatch.from_arrays([rows["toxic"], *(pa.array(c, pa.list_(pa.float64())) for c in columns)], names=["toxic", "x", "misspelled", "quoting"])

    return sample.select("toxic", "text").mapInArrow(run, "toxic int, x array<double>, misspelled array<double>, quoting array<double>")


def with_score(docs: DataFrame, model: dict) -> DataFrame:
    """Add ``score`` and ``predicted``; the model is bounded by TERMS and EXCEPTIONS words."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    base = add(docs, score=F.lit(0.0), predicted=F.lit(0))

    def run(batches):
        own = Scorer(held.value)
        for batch in batches:
            for rows, texts in pieces(batch):
                if own.weights is None:
                    score = np.full(len(texts), held.value["rate"])
                else:
                    score = 1 / (1 + np.exp(-(own.features(texts) @ own.weights[:-1] + own.weights[-1])))
                new = {"score": pa.array(score), "predicted": pa.array((score >= PREDICT).astype(np.int32))}
                yield pa.RecordBatch.from_arrays([new[n] if n in new else rows[n] for n in rows.schema.names], names=rows.schema.names)

    return base.mapInArrow(run, base.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = lambda: F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").where(~third()))
    return with_score(docs.select("doc_id", "text", third().alias("held_out")), model).select("doc_id", "held_out", "score", "predicted")


register("op4_toxicity", op4_toxicity)
