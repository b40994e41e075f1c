import hashlib
import random

import cases
import public_tokenizers
from nearfield.llm import byte_bpe as b
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)


def test_digests_equal_the_library(spark, tmp_path):
    path = cases.folder(spark, tmp_path, documents=cases.frame(spark))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, text, *_ in cases.rows():
        ids = TOK.encode(text or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), sha(",".join(map(str, ids))), sha(TOK.decode(ids, skip_special_tokens=False))))
    assert sorted((str(r["doc_id"]), *r[1:]) for r in b.op8_byte_bpe(spark, path).collect()) == sorted(want)


def test_merges_are_exact_on_random_texts():
    rnd, v = random.Random(3), b.Vocabulary(PATH)
    letters = [chr(i) for i in [*range(0x180), 0x1680, 0x2028, 0x3000, 0x4E00, 0x301, 0x1F600]]
    pieces = ["the ", "'s", "don't", "<|endoftext|>", "  ", "\n\n", "ment", "a" * 50, "ab" * 60, "123"]
    for _ in range(400):
        text = "".join(rnd.choice(letters if rnd.random() < 0.4 else pieces) for _ in range(rnd.randint(0, 30)))
        words = v.words(text)
        want = TOK.encode(text, add_special_tokens=False).ids
        assert [i for w in words for i in ([w] if isinstance(w, int) else v.merge(w.encode()))] == want
        many = iter(v.merge_many([w.encode() for w in words if isinstance(w, str)]))
        assert [i for w in words for i in ([w] if isinstance(w, int) else next(many))] == want


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["walking", "talking", "walked", "talked", "a", "été", "étés"])}
    (tmp_path / "l.bin").write_bytes(b.compile_lexicon(words))
    lex = b.Lexicon(str(tmp_path / "l.bin"))
    found = lex.places([*words, b"", b"walk", b"walkings", b"zzz"]).tolist()
    assert [lex.output(p).tolist() for p in found[:7]] == list(words.values()) and found[7:] == [-1] * 4
    assert len(lex.final) < sum(map(len, words)) / 2  # suffixes are shared
    (tmp_path / "e.bin").write_bytes(b.compile_lexicon({}))
    assert b.Lexicon(str(tmp_path / "e.bin")).places([b"a"]).tolist() == [-1]


def test_rows_keep_their_columns(spark):
    docs = cases.frame(spark)
    out = b.encode_decode(docs, PATH, b.build_lexicon(docs, PATH)).collect()
    assert all((r["text"] or "") == r["decoded"] and TOK.encode(r["decoded"], add_special_tokens=False).ids == r["token_ids"] and r["n_tokens"] == len(r["token_ids"]) for r in out)
    none = cases.empty(spark)
    assert b.encode_decode(none, PATH, b.build_lexicon(none, PATH)).count() == 0
