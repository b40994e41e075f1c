"""Byte-level BPE ids of whole texts as numpy arrays, for operators that need ids only.

A vocabulary file whose ids rise with the rank of their merge holds the same model as a list of byte strings by rank, which
tiktoken encodes several times as fast as the file's own library; the ids are equal (the tests compare them over all of Unicode).
Any other file, and a text that tiktoken gives up on, is encoded by the tokenizers library.
"""

from __future__ import annotations

import json
import os

import numpy as np

from nearfield.llm.byte_bpe import Vocabulary

# Fixed value: the published split of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteEncoder:
    """Encodes texts with a byte-level BPE file; ``special`` says whether the special tokens' strings in a text are their ids."""

    def __init__(self, path: str, special: bool = True):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.tokenizer.encode_special_tokens = not special
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocabulary, self.fast = Vocabulary(path), None
        self.bytes_of = vocabulary.bytes_of
        split = data.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not data.get("normalizer")
        marks = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in data["added_tokens"])
        ranked = len(vocabulary.made) and (np.diff(vocabulary.made) > 0).all() and max(vocabulary.single) < vocabulary.made[0]
        if plain and marks and ranked and not data["model"].get("ignore_merges"):
            names = vocabulary.special if special else {}
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=vocabulary.ids, special_tokens=names)
            self.allowed = set(names)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special=self.allowed, disallowed_special=())
            except BaseException as error:  # the splitter's bound on backtracking comes as a panic, not as an Exception
                if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)


_ENCODERS: dict[tuple, ByteEncoder] = {}


def byte_encoder(path: str, special: bool = True) -> ByteEncoder:
    """One encoder per worker, file and treatment of special tokens."""
    if (path, special) not in _ENCODERS:
        _ENCODERS[path, special] = ByteEncoder(path, special)
    return _ENCODERS[path, special]
