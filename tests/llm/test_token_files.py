import zlib

import cases
import numpy as np
import pyarrow as pa
import public_tokenizers
from nearfield.llm import token_files as t
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_round_trip_equals_direct_encoding(spark, tmp_path):
    path = cases.folder(spark, tmp_path, documents=cases.frame(spark))
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in t.op3_token_files(spark, path).collect()))
    tok = Tokenizer.from_file(PATH)
    start, want = 0, {}
    ids = [(-1 if i is None else i, [*tok.encode(x or "", add_special_tokens=False).ids, 2]) for i, x, *_ in cases.rows()]
    assert [(-1 if g[1] is None else g[1]) for g in got] == sorted(i for i, _ in ids)
    for s, i, n, crc in got:
        assert s == start
        start += n
        want.setdefault(-1 if i is None else i, []).append((n, crc))
    for i, found in want.items():
        assert sorted(found) == sorted((len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in ids if k == i)


def test_random_access_is_a_view(tmp_path):
    ids = np.arange(10_000, dtype=np.uint16)
    with pa.OSFile(str(tmp_path / "f.arrow"), "wb") as sink:
        out = t.SequenceWriter(sink, ids.dtype, length=16, batch_rows=8)
        out.append(ids[:5])
        out.append(ids[5:])
        out.close()
    file = t.SequenceFile(f"file://{tmp_path}/f.arrow")
    for i in (0, 7, 8, 300, 624):
        values, mask = file.sequence(i)
        assert values.tolist() == list(range(i * 16, i * 16 + 16)) and mask.all() and not values.flags.owndata
    assert (file.read(123, 4000) == ids[123:4123]).all() and len(file.read(5, 0)) == 0


def test_words_are_encoded_as_the_library_does():
    coder, tok = t.Encoder(PATH), Tokenizer.from_file(PATH)
    texts = ["It's a test, isn't it? Don't", "a b c \x1c d \x85 e", "İstanbul ΣΑΣ ﬁ é ́x", "<|endoftext|> x<|startoftext|>y", "12 3.4,5 ... !!? word. Word, WORD", "日本語 中文"]
    assert coder.by_word
    for _ in range(2):  # the second time from memory
        assert [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode(texts)] == [tok.encode(x, add_special_tokens=False).ids for x in texts]


def test_no_rows(spark, tmp_path):
    assert t.op3_token_files(spark, cases.folder(spark, tmp_path, documents=cases.empty(spark))).count() == 0
