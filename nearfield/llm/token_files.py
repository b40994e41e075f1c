"""Token ids in Arrow stream files of fixed-size-list batches, with random access to equal-length sequences and masks.

A part file is one Arrow IPC stream. Its batches all have ``BATCH_ROWS`` rows (only the last may have fewer) of two columns:
``ids``, a fixed-size list of ``LENGTH`` unsigned ids, and ``mask``, as many bits, false over the padding that ends
the file. Full batches take the same number of bytes, so sequence i lies at a computed offset and is read from a
memory map without a copy. A second stream, ``<part>.docs.arrow``, holds (doc_id, start, n_tokens) in file order.
Documents lie in ascending doc_id order within and across parts.

Cases. A null or empty text has only its end id. Null ids come first. Rows with equal ids are ordered by text and stay apart. Very
long texts span any number of sequences. Other columns are not read. An empty table gives no rows and no ids.
Files are written under a name of the attempt and then renamed, so a lost or repeated task leaves the same files.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearfield.llm.byte_bpe import byte_letters
from nearfield.llm.common import materialize, pieces, register, table
from nearfield.session import scratch_path

LENGTH, BATCH_ROWS = 1024, 256
CACHE_WORDS = 250_000  # words remembered per worker, in each of two generations
# The split that makes white-space-separated words, and a trailing mark, independent of each other.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARKS = frozenset(".,;:!?")
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u0148\u014a-\u017e]+")  # letters that lower-casing and composing take one by one
NO_SPACE = re.compile("[\x1c-\x1f]")  # white space to Python's split, but letters to the library


class Encoder:
    """Encodes whole texts with the tokenizers library to little-endian unsigned ids.

    If the file's pre-tokenizer never joins two white-space-separated words, each distinct word is encoded once
    and remembered; otherwise each text is encoded as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        splits = [p.get("pattern", {}).get("Regex") for p in model["pre_tokenizer"].get("pretokenizers", [])]
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not any(c.isspace() for c in t["content"]) for t in model["added_tokens"])
        self.suffix = model["model"].get("end_of_word_suffix")
        self.by_word = plain and SPLIT_PATTERN in splits and bool(self.suffix)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.fast = None
        if self.by_word:
            for token, at in self.tokenizer.get_vocab(with_added_tokens=False).items():
                self.ends[at] = token.endswith(self.suffix)
            self.fast, self.id_of_rank = word_ranks(model, self.suffix)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, encoding) -> bytes:
        return np.asarray(encoding.ids, self.dtype).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Encode words not seen lately. Words of Latin letters are one pre-token, so many are encoded as one text and cut at word ends."""
        plain, rest = [], []
        for word in words:
            (plain if LATIN.fullmatch(word) else rest).append(word)
        for at in range(0, len(plain), 10_000):
            run = plain[at: at + 10_000]
            ids = self.id_of_rank[self.fast.encode_to_numpy("".join([w.lower() + "\0" for w in run]), disallowed_special=())]
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(run):
                rest += run
                continue
            data, width = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
            start = 0
            for word, stop in zip(run, (stops * width).tolist()):
                self.young[word] = data[start:stop]
                start = stop
        if rest:
            for word, encoding in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
                self.young[word] = self._ids(encoding)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self._ids(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        odd = [i for i, text in enumerate(texts) if NO_SPACE.search(text)]
        if odd:  # encoded as they are
            known = dict(zip(odd, (self._ids(e) for e in self.tokenizer.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False))))
            rest = iter(self.encode([text for i, text in enumerate(texts) if i not in known]))
            return [known[i] if i in known else next(rest) for i in range(len(texts))]
        split = [text.split() for text in texts]
        new = set().union(*split) - self.young.keys()
        bases = set()
        for word in list(new):
            if word in self.old:
                self.young[word] = self.old[word]
                new.discard(word)
            elif word[-1] in MARKS and LATIN.fullmatch(word, 0, len(word) - 1):
                bases |= {word[:-1], word[-1]}
        marked = [w for w in new if w[-1] in MARKS and LATIN.fullmatch(w, 0, len(w) - 1)]
        self._learn([w for w in (bases | new.difference(marked)) if w not in self.young])
        for word in marked:
            self.young[word] = self.young[word[:-1]] + self.young[word[-1]]
        get = self.young.__getitem__
        out = [b"".join(map(get, words)) for words in split]
        if len(self.young) > CACHE_WORDS:
            self.old, self.young = self.young, {}
        return out


def word_ranks(model: dict, suffix: str):
    """The merges of a word-end BPE as byte strings by rank, for tiktoken, and the vocabulary id of each rank.

    A zero byte stands for the end of a word. It joins the last letter before any other merge, as the file's last letters carry the mark.
    """
    import tiktoken

    vocab, letters = model["model"]["vocab"], {b: c for c, b in byte_letters().items()}
    ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 0]): 256 + b for b in range(256)}
    ids = [vocab.get(letters[b], 0) for b in range(256)] + [vocab.get(letters[b] + suffix, 0) for b in range(256)]
    back = {c: b for b, c in letters.items()}
    for pair in model["model"]["merges"]:
        token = "".join(pair.split(" ") if isinstance(pair, str) else pair)
        whole = token.endswith(suffix)
        spelled = bytes(back[c] for c in (token[: -len(suffix)] if whole else token)) + b"\0" * whole
        if spelled not in ranks:
            ranks[spelled] = len(ids)
            ids.append(vocab[token])
    return tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}), np.array(ids, np.int64)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file; its memory serves all tasks of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Packs ids into sequences of ``length`` and writes batches of ``batch_rows`` sequences."""

    def __init__(self, sink, dtype: np.dtype, length: int = LENGTH, batch_rows: int = BATCH_ROWS):
        self.sink, self.dtype, self.length, self.rows = sink, dtype, length, batch_rows
        self.schema = schema(dtype, length)
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.held = np.empty(length * batch_rows, dtype)
        self.filled = self.total = 0
        self.stride = None

    def append(self, ids: np.ndarray) -> None:
        self.total += len(ids)
        while len(ids):
            taken = ids[: len(self.held) - self.filled]
            self.held[self.filled: self.filled + len(taken)] = taken
            self.filled += len(taken)
            ids = ids[len(taken):]
            if self.filled == len(self.held):
                self._flush()

    def _flush(self) -> None:
        rows = -(-self.filled // self.length)
        values = self.held[: rows * self.length].copy()
        values[self.filled:] = 0
        mask = pa.array(np.arange(len(values)) < self.filled)
        before = self.sink.tell()
        self.writer.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(values), self.length), pa.FixedSizeListArray.from_arrays(mask, self.length)], schema=self.schema))
        if rows == self.rows:
            stride = self.sink.tell() - before if self.stride is not None else None
            if self.stride not in (None, 0, stride):
                raise OSError("batches of equal rows differ in size")
            self.stride = stride or 0  # the first write also holds the schema
        self.filled = 0

    def close(self) -> None:
        if self.filled:
            self._flush()
        self.writer.close()


class SequenceFile:
    """Random access to a part file: ``sequence(i)`` and ``read(start, n)`` over the ids of the part."""

    def __init__(self, path: str):
        system, name = pafs.FileSystem.from_uri(path)
        self.source = pa.memory_map(name) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(name)
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.source))
        self.first = self.source.tell()
        self.length = self.schema.field("ids").type.list_size
        self.last = (None, None)
        size = self.source.size()
        self.rows = self.stride = 0
        if size - self.first > 8:  # more than the end mark
            batch = pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)
            self.rows, self.stride = batch.num_rows, self.source.tell() - self.first

    def batch(self, k: int) -> pa.RecordBatch:
        if self.last[0] != k:
            self.source.seek(self.first + k * self.stride)
            self.last = (k, pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema))
        return self.last[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of sequence i."""
        batch, row = self.batch(i // self.rows), i % self.rows
        cut = slice(row * self.length, (row + 1) * self.length)
        return batch["ids"].values.to_numpy()[cut], batch["mask"].values[cut].to_numpy(zero_copy_only=False)

    def read(self, start: int, n: int) -> np.ndarray:
        """Ids start .. start+n of the part, over as many batches as they span."""
        each, found = self.rows * self.length, []
        while n:
            k, at = divmod(start, each)
            found.append(self.batch(k)["ids"].values.to_numpy()[at: at + n])
            start, n = start + len(found[-1]), n - len(found[-1])
        return found[0] if len(found) == 1 else np.concatenate(found) if found else np.empty(0)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = None) -> DataFrame:
    """Encode (doc_id, text) rows into part files; returns the manifest (part, path, tokens, base), one row per file.

    Texts are shuffled once, by ranges of doc_id (equal ids by text), and encoded where they are written.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")

    def run(batches):
        part, coder = TaskContext.get().partitionId(), encoder(tokenizer)
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name, attempt = f"{root}/part-{part:06d}", uuid.uuid4().hex
        with system.open_output_stream(f"{name}.{attempt}") as sink, system.open_output_stream(f"{name}.docs.{attempt}") as index_sink:
            out = SequenceWriter(sink, coder.dtype)
            index_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
            tail = b"" if end_id is None else np.array([end_id], coder.dtype).tobytes()
            with pa.ipc.new_stream(index_sink, index_schema) as index:
                while batch is not None:
                    for cut, found in pieces(batch):
                        starts, counts = [], []
                        for data in coder.encode([x.decode() for x in found]):
                            ids = np.frombuffer(data + tail, coder.dtype)
                            starts.append(out.total)
                            counts.append(len(ids))
                            out.append(ids)
                        index.write_batch(pa.RecordBatch.from_arrays([cut["doc_id"], pa.array(starts, pa.int64()), pa.array(counts, pa.int64())], schema=index_schema))
                    batch = next(batches, None)
            out.close()
        system.move(f"{name}.docs.{attempt}", f"{name}.docs.arrow")
        system.move(f"{name}.{attempt}", f"{name}.arrow")
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([f"{folder}/part-{part:06d}"]), pa.array([out.total], pa.int64())], names=["part", "path", "tokens"])

    written = materialize(ordered.mapInArrow(run, "part int, path string, tokens bigint"), "manifest")
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per file
    return written.select("part", "path", "tokens", (F.sum("tokens").over(upto) - F.col("tokens")).alias("base"))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) read from the files, ``start`` counted over all parts."""
    files = max(1, manifest.count())

    def run(batches):
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist()):
                data = SequenceFile(f"{path}.arrow")
                system, name = pafs.FileSystem.from_uri(f"{path}.docs.arrow")
                with system.open_input_stream(name) as source, pa.ipc.open_stream(source) as index:
                    for rows in index:
                        sums = [zlib.crc32(data.read(s, n).astype("<u4").tobytes()) for s, n in zip(rows["start"].to_pylist(), rows["n_tokens"].to_pylist())]
                        yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.compute.add(rows["start"], base), rows["n_tokens"], pa.array(sums, pa.int64())],
                                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.select("path", "base").repartition(files).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "token-files")
    folder = folder if "://" in folder else f"file://{os.path.abspath(folder)}"
    manifest = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder, end_id=2)
    return read_token_files(manifest)


register("op3_token_files", op3_token_files)
