import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import cases
from nearfield.llm import packing as t
from nearfield.llm.fast_bpe import ByteEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def placed(lengths, capacity, groups=t.GROUPS):
    lengths = np.asarray(lengths, np.int64)
    plan = t.Plan(np.bincount(lengths, minlength=capacity + 1), capacity, groups)
    number = np.zeros(len(lengths), np.int64)
    for s in np.unique(lengths):
        number[lengths == s] = np.arange((lengths == s).sum())
    return plan, *plan.place(lengths, number)


def gapless(lengths, sequence, offset, capacity):
    by = {}
    for size, s, o in zip(np.asarray(lengths).tolist(), sequence.tolist(), offset.tolist()):
        by.setdefault(s, []).append((o, size))
    for rows in by.values():
        at = 0
        for o, size in sorted(rows):
            assert o == at
            at += size
        assert at <= capacity
    return len(by)


def least(lengths, capacity):
    """Fewest sequences, by trying all ways (few pieces)."""
    best = [len(lengths)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            go(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1:]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best[0]


def test_plans_are_gapless_and_tight():
    rnd = np.random.default_rng(3)
    for lengths in (rnd.integers(1, 1025, 20000), np.clip(rnd.lognormal(6.2, 0.6, 20000).astype(int), 1, 1024), rnd.integers(1, 60, 5000), [1024] * 50, [513] * 9):
        plan, sequence, offset = placed(lengths, 1024)
        assert gapless(lengths, sequence, offset, 1024) == plan.sequences
        assert plan.sequences <= max(-(-int(np.sum(lengths)) // 1024) * 1.02 + 2, int((np.asarray(lengths) > 512).sum()))


def test_small_cases_come_near_the_fewest():
    rnd = np.random.default_rng(4)
    for _ in range(60):
        lengths = rnd.integers(1, 21, int(rnd.integers(1, 10))).tolist()
        plan, sequence, offset = placed(lengths, 20, 4)
        assert gapless(lengths, sequence, offset, 20) == plan.sequences <= least(sorted(lengths, reverse=True), 20) + 1


def test_configurations_mix_sizes_that_fill_a_sequence():
    found = t.configurations(np.array([300, 424, 600]), np.array([100, 100, 100]), 1024)
    assert sum(n for _, n in found) <= 140 and all((c * [300, 424, 600]).sum() <= 1024 for c, _ in found)
    assert any(c.tolist() == [0, 1, 1] for c, _ in found)  # 424 + 600 fill one exactly
    plan, sequence, offset = placed([600, 424] * 300 + [512] * 100, 1024)
    assert plan.sequences == 350


def test_ids_equal_the_library_over_unicode():
    encode, tok = ByteEncoder(PATH), Tokenizer.from_file(PATH)
    plain = ByteEncoder(PATH, special=False)
    assert encode.fast is not None
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)} .{chr(c)}!" for c in [*range(0, 0x3100, 7), *range(0x3100, 0x20000, 401)] if not 0xD800 <= c < 0xE000]
    texts += ["x<|endoftext|> y<|endoftext|><|endoftext|>", " " * 5000, "ab" * 5000, "", "it's we'll  \n\n end "]
    for text in texts:
        assert encode(text).tolist() == tok.encode(text, add_special_tokens=False).ids
    tok.encode_special_tokens = True
    assert all(plain(x).tolist() == tok.encode(x, add_special_tokens=False).ids for x in texts[-5:])


def test_rows_are_packed_whole(spark, tmp_path):
    path = cases.folder(spark, tmp_path, documents=cases.frame(spark, parts=3))
    rows = t.op12_packing(spark, path).toPandas()
    tok = Tokenizer.from_file(PATH)
    want = []
    for r in cases.rows():
        ids = [*(tok.encode(r[1], add_special_tokens=False).ids if r[1] else []), 2]
        first, at, piece = (len(ids) - 1) % 1024 + 1, 0, 0
        while at < len(ids):
            own = ids[at: at + (first if piece == 0 else 1024)]
            want.append((str(r[0]), piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
            at, piece = at + len(own), piece + 1
    got = [("None" if np.isnan(d) else str(int(d)), *r) for d, r in zip(rows.doc_id.astype(float), rows[["piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None))]
    assert sorted(got) == sorted(want)
    assert gapless(rows.length, rows.sequence_id, rows.offset, 1024) <= -(-int(rows.length.sum()) // 1024) + 1


def test_sequences_hold_the_ids(spark):
    docs = cases.frame(spark, [(i, cases.prose(i, 20 + 7 * i), "en", "s", 1, *cases.EXTRA) for i in range(30)], 4)
    packed = t.pack(t.token_pieces(docs, PATH, 256, end_id=2, with_ids=True), 256)
    tok = Tokenizer.from_file(PATH)
    texts, seen = {r["doc_id"]: [*tok.encode(r["text"]).ids, 2] for r in docs.collect()}, {}
    for s in t.sequences(packed).collect():
        assert len(s["ids"]) <= 256 and len(s["ids"]) == sum(d["length"] for d in s["documents"])
        for d in s["documents"]:
            seen[d["doc_id"], d["piece"]] = s["ids"][d["offset"]: d["offset"] + d["length"]]
    for doc, ids in texts.items():
        assert [x for p in sorted(p for d, p in seen if d == doc) for x in seen[doc, p]] == ids


def test_empty_table(spark, tmp_path):
    assert t.op12_packing(spark, cases.folder(spark, tmp_path, documents=cases.empty(spark))).count() == 0
