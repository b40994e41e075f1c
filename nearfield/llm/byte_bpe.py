"""Byte-level BPE: frequent words in a minimal acyclic transducer, other words merged exactly, and decoding.

The lexicon is counted over the whole corpus. Its words (at most ``LEXICON_WORDS``) with their ids are compiled into an automaton whose
equal suffixes share states: a word is spelled by transitions, and the numbers on them add up to the word's
place in sorted order, which gives its ids (the usual minimal perfect hash of a word automaton). The automaton is a
few flat arrays in one file that Spark ships to the executors, where it is memory-mapped. Words outside it
are merged by rank, pair by pair, as the tokenizers library does.

Cases. A null or empty text has no ids and decodes to an empty text. Special tokens in a text are one id each,
as in the library. Whole texts are split, of any length; a very long word is merged with a heap in n log n.
Rows are handled one by one, so repeats, ties and other columns (names that clash are replaced) do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import tempfile
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm.common import add, materialize, pieces, register, table

LEXICON_WORDS = 1 << 16
CACHE_WORDS = 100_000  # words a worker remembers, in each of two generations
COUNT_WORDS = 200_000  # distinct words a task counts before it hands the counts on
PIECE_BYTES = 2 << 20
# The published split of byte-level BPE, with the white space of Unicode spelled out (Python's has four more).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^{S}{l}{n}]+|[{S}]+(?![^{S}])|[{S}]+"
SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
LATIN_LETTERS, LATIN_NUMBERS = r"A-Za-z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-\u017F", r"0-9\xB2\xB3\xB9\xBC-\xBE"


def split_pattern(letters: str, numbers: str) -> str:
    return (SPLIT.replace("{L}", f"[{letters}]").replace("{N}", f"[{numbers}]").replace("{S}", SPACE).replace("{l}", letters).replace("{n}", numbers))


PATTERN = regex.compile(split_pattern(r"\p{L}", r"\p{N}"))
# The same split for texts below U+0180, where the classes are short enough for the faster standard module.
LATIN_PATTERN, BEYOND_LATIN = re.compile(split_pattern(LATIN_LETTERS, LATIN_NUMBERS)), re.compile("[^\0-\u017F]")


def split_text(text: str) -> list[str]:
    return (PATTERN if BEYOND_LATIN.search(text) else LATIN_PATTERN).findall(text)




NEVER = 1 << 40  # rank of a pair that is not merged
NONE = (NEVER, -1)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges and ids of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = byte_letters()
        spell = lambda s: bytes(letters[c] for c in s)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.ids = {spell(s): i for s, i in data["model"]["vocab"].items() if s not in self.special}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in data["model"]["merges"]]
        self.merges = {(self.ids[spell(a)], self.ids[spell(b)]): (rank, self.ids[spell(a + b)]) for rank, (a, b) in enumerate(pairs)}
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.single = [self.ids[bytes([b])] for b in range(256)]
        keys = np.array([a << 32 | b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        found = np.array(list(self.merges.values()), np.int64).reshape(-1, 2)
        self.pair, self.rank = keys[order], found[order, 0]
        self.made = np.empty(len(keys), np.int64)
        self.made[found[:, 0]] = found[:, 1]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of least rank (leftmost of equals) is merged until none is left."""
        ids = [self.single[b] for b in word]
        if len(ids) < 40:
            get, pairs = self.merges.get, None
            while len(ids) > 1:
                pairs = [get(p, NONE) for p in zip(ids, ids[1:])]
                best = min(pairs)
                if best is NONE:
                    break
                at = pairs.index(best)
                ids[at: at + 2] = [best[1]]
            return ids
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(self.merges[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] != pair[0] or j < 0 or ids[j] != pair[1]:
                continue  # one of the two has been merged since
            ids[i], ids[j], after[i] = self.merges[pair][1], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (ids[a], ids[b]) in self.merges:
                    heapq.heappush(heap, (self.merges[ids[a], ids[b]][0], a, (ids[a], ids[b])))
        return [x for x in ids if x >= 0]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or NEVER."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((b >= 0) & (self.pair[at] == key), self.rank[at], NEVER)

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of many words at once: each step does the best merge of every word of a length class."""
        out: list = [None] * len(words)
        classes: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) < 2 or len(w) > 32 or not len(self.pair):
                out[i] = self.merge(w)
            else:
                classes.setdefault(-(-len(w) // 4) * 4, []).append(i)
        single = np.array(self.single, np.int64)
        for width, own in classes.items():
            text = np.frombuffer(b"".join([words[i].ljust(width, b"\0") for i in own]), np.uint8).reshape(-1, width)
            row, sizes = np.array(own), np.array([len(words[i]) for i in own])
            ids = np.full((len(own), width + 1), -1)  # the last column stays empty
            ids[:, :-1] = np.where(np.arange(width) < sizes[:, None], single[text], -1)
            rank = np.full((len(own), width + 1), NEVER)
            rank[:, :-1] = self._ranks(ids[:, :-1], ids[:, 1:])
            column = np.arange(width)
            while len(row):
                at = rank.argmin(1)
                best = rank[np.arange(len(row)), at]
                done = best == NEVER
                if done.any():
                    for i, found in zip(row[done].tolist(), ids[done].tolist()):
                        out[i] = found[: found.index(-1)]
                    row, ids, rank, at, best = row[~done], ids[~done], rank[~done], at[~done], best[~done]
                    if not len(row):
                        break
                lines = np.arange(len(row))
                take = column + (column > at[:, None])  # closes the gap behind the merged pair
                ids[:, :-1], rank[:, :-1] = np.take_along_axis(ids, take, 1), np.take_along_axis(rank, take, 1)
                ids[lines, at] = self.made[best]
                rank[lines, at] = self._ranks(ids[lines, at], ids[lines, at + 1])
                inner = at > 0
                rank[lines[inner], at[inner] - 1] = self._ranks(ids[lines[inner], at[inner] - 1], ids[lines[inner], at[inner]])
        return out

    def words(self, text: str) -> list[str | int]:
        """Pre-tokens of a text in order; a special token is given as its id."""
        if self.cut is None or not any(s in text for s in self.special):
            return split_text(text)
        return [w for part in self.cut.split(text) for w in ([self.special[part]] if part in self.special else split_text(part))]


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic transducer of a word list with id outputs, as one file's content.

    Words come in sorted order; the states behind the last common prefix are closed then and replaced by an equal
    state where one exists, which shares suffixes. Each transition carries how many words come before its branch.
    """
    words = sorted(entries)
    register_of: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []  # closed states: final, ((byte, state), ...)

    def close(state: list) -> int:
        key = (state[0], tuple(state[1]))
        if key not in register_of:
            register_of[key] = len(states)
            states.append(key)
        return register_of[key]

    path: list[list] = [[False, []]]  # open states along the last word
    last = b""
    for word in words:
        same = len(os.path.commonprefix([last, word]))
        while len(path) > same + 1:
            done = close(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        path += [[False, []] for _ in word[same:]]
        path[-1][0], last = True, word
    while len(path) > 1:
        done = close(path.pop())
        path[-1][1].append((last[len(path) - 1], done))
    root = close(path[0])
    below = np.zeros(len(states), np.int64)  # words spelled from a state on
    for s, (final, arcs) in enumerate(states):  # targets are closed before
        below[s] = final + sum(below[t] for _, t in arcs)
    first = np.zeros(len(states) + 1, np.int32)
    label, target, skip = [], [], []
    for s, (final, arcs) in enumerate(states):
        count = int(final)
        for byte, t in arcs:
            label.append(byte)
            target.append(t)
            skip.append(count)
            count += below[t]
        first[s + 1] = len(label)
    outputs = [entries[w] for w in words]
    stops = np.cumsum([0, *map(len, outputs)])
    arcs_of = np.repeat(np.arange(len(states)), np.diff(first))
    arrays = {"arc": (arcs_of * 256 + np.array(label, np.int64)) if label else np.empty(0, np.int64), "target": np.array(target, np.int32),
              "skip": np.array(skip, np.int32), "final": np.array([f for f, _ in states], np.uint8), "stop": stops.astype(np.int32),
              "id": np.array([i for o in outputs for i in o], np.int32)}
    head = json.dumps({"root": root, "arrays": [(k, a.dtype.str, len(a)) for k, a in arrays.items()]}).encode()
    head += b" " * (-(8 + len(head)) % 8)
    return b"".join([len(head).to_bytes(8, "little"), head, *(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays.values())])


class Lexicon:
    """A compiled lexicon, memory-mapped; looks up many words at once, one byte position after the other."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        at = 8 + int.from_bytes(data[:8], "little")
        head = json.loads(data[8:at])
        self.root = head["root"]
        for name, kind, n in head["arrays"]:
            setattr(self, name, np.frombuffer(data, kind, n, at))
            at += -(-n * np.dtype(kind).itemsize // 8) * 8

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the lexicon, or -1."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(lengths) - lengths
        state, place = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        live = np.arange(len(words))
        for i in range(int(lengths.max(initial=0))):
            live = live[lengths[live] > i]
            if not len(live) or not len(self.arc):
                break
            key = state[live] * 256 + text[start[live] + i]
            found = np.minimum(np.searchsorted(self.arc, key), len(self.arc) - 1)
            good = self.arc[found] == key
            state[live[~good]] = -1
            live, found = live[good], found[good]
            state[live] = self.target[found]
            place[live] += self.skip[found]
        known = (state >= 0) & (self.final[state] == 1) & (lengths > 0)
        return np.where(known, place, -1)

    def output(self, place: int) -> np.ndarray:
        return self.id[self.stop[place]: self.stop[place + 1]]


class Coder:
    """Encoder and decoder of a worker: vocabulary, mapped lexicon, and the words met lately."""

    def __init__(self, path: str, lexicon: str):
        self.vocabulary, self.lexicon = Vocabulary(path), Lexicon(lexicon)
        # of words met lately, in two generations: the ids as decimals, and the bytes they stand for
        self.ids: dict[str | int, str] = {}
        self.bytes: dict[str | int, bytes] = {}
        self.old: tuple[dict, dict] = ({}, {})

    def _learn(self, words: list) -> None:
        spelled = [w.encode() for w in words]
        bytes_of, output = self.vocabulary.bytes_of.__getitem__, self.lexicon.output
        places = self.lexicon.places(spelled).tolist()
        merged = iter(self.vocabulary.merge_many([text for text, place in zip(spelled, places) if place < 0]))
        for word, place in zip(words, places):
            ids = output(place).tolist() if place >= 0 else next(merged)
            self.ids[word] = ",".join(map(str, ids))
            self.bytes[word] = b"".join(map(bytes_of, ids))

    def run(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each text: number of ids, the ids as decimals joined by commas, and the decoded text."""
        split = [self.vocabulary.words(t) for t in texts]
        new = set().union(*split) - self.ids.keys()
        for word in new & self.old[0].keys():
            self.ids[word], self.bytes[word] = self.old[0][word], self.old[1][word]
            new.discard(word)
        for special in [w for w in new if isinstance(w, int)]:
            self.ids[special], self.bytes[special] = str(special), self.vocabulary.bytes_of[special]
            new.discard(special)
        self._learn(list(new))
        out = []
        for words in split:
            ids = ",".join(map(self.ids.__getitem__, words))
            out.append((ids.count(",") + 1 if ids else 0, ids, b"".join(map(self.bytes.__getitem__, words)).decode("utf-8", "replace")))
        if len(self.ids) > CACHE_WORDS:
            self.old, self.ids, self.bytes = (self.ids, self.bytes), {}, {}
        return out


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(path: str, lexicon: str) -> Coder:
    if (path, lexicon) not in _CODERS:
        _CODERS.clear()
        _CODERS[path, lexicon] = Coder(path, lexicon)
    return _CODERS[path, lexicon]


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """(word, n) over all whole texts; words are summed in each task before they are shuffled."""

    def run(batches):
        vocabulary, counts = Vocabulary(path), Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for _, found in pieces(batch.select(["text"])):
                for text in found:
                    counts.update(w for w in vocabulary.words(text.decode()) if isinstance(w, str))
                if len(counts) > COUNT_WORDS:
                    yield rows()
                    counts.clear()
        yield rows()

    return docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words of up to 32 bytes and ship the file; returns its name among Spark's files.

    The list is bounded by ``words``, so the file (a few MB) does not grow with the data.
    """
    counts = materialize(word_counts(docs, path).where("n > 1 and octet_length(word) <= 32"), "words")
    # words by count: few distinct counts, and only as many words as the bound allows come to the driver
    least, room = None, words
    for n, many in sorted(counts.groupBy("n").count().collect(), reverse=True):
        if many > room:
            break
        least, room = n, room - many
    top = counts.where(F.col("n") >= least).select("word").collect() if least else []
    vocabulary = Vocabulary(path)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    local = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)  # on the driver only; addFile serves it
    with open(local, "wb") as file:
        file.write(compile_lexicon({(w := r["word"].encode()): vocabulary.merge(w) for r in top}))
    docs.sparkSession.sparkContext.addFile(local)
    return name


def encode_decode(docs: DataFrame, path: str, lexicon: str) -> DataFrame:
    """Add ``n_tokens``, ``token_ids`` and ``decoded`` to the rows of ``docs``."""
    new = {"n_tokens": F.lit(0).cast("bigint"), "token_ids": F.array().cast("array<int>"), "decoded": F.lit("")}
    return _coded(docs, path, lexicon, new, lambda n, ids, text: (n, np.fromstring(ids, np.int32, sep=",") if ids else [], text))


def _coded(docs: DataFrame, path: str, lexicon: str, new: dict, make) -> DataFrame:
    """Rows of ``docs`` with the columns ``new`` (name: placeholder), filled from ``make(n, ids, text)``."""
    base, names = add(docs, **new), list(new)

    def run(batches):
        own = coder(path, SparkFiles.get(lexicon))
        for batch in batches:
            for rows, found in pieces(batch, "text", PIECE_BYTES):
                made = dict(zip(names, zip(*(make(*x) for x in own.run([t.decode() for t in found])))))
                yield pa.RecordBatch.from_arrays([pa.array(made[n], rows.schema.field(n).type) if n in made else rows[n] for n in rows.schema.names],
                                                 schema=rows.schema)

    return base.mapInArrow(run, base.schema)


def digests(docs: DataFrame, path: str, lexicon: str) -> DataFrame:
    """Add ``n_tokens`` and the hex digests of ids and decoded text, without carrying either."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return _coded(docs, path, lexicon, {"n_tokens": F.lit(0).cast("bigint"), "ids_sha256": F.lit(""), "decoded_sha256": F.lit("")},
                  lambda n, ids, text: (n, sha(ids), sha(text)))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, path, build_lexicon(docs, path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


register("op8_byte_bpe", op8_byte_bpe)
