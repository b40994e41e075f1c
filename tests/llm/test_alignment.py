import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

import cases
from nearfield.llm import alignment as t
from nearfield.llm.byte_bpe import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["<|endoftext|> <s> </s> <unk> <0x41>", " two  spaces ▁ mark", "\x00\x01 á \U0001f600\U0001f468‍\U0001f469", "  ", "\n\n\n", "ﬁ ﬂ ①"]


def brute(texts):
    """Per text the contract's columns, from the definitions."""
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    letters, names = byte_letters(), {i: s for s, i in tok.get_vocab().items()}
    linked, rows, counts = [], [], Counter()
    for text in texts:
        a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        pieces = [sp.id_to_piece(i) for i in b]
        raw_a = [bytes(letters[c] for c in names[i]) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            a, b, raw_a, raw_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        common, groups, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
        for end in common:
            x, y = i, j
            while i < len(a) and ends_a[i] <= end:
                i += 1
            while j < len(b) and ends_b[j] <= end:
                j += 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
        links, j = [], 0
        for i, (end, raw) in enumerate(zip(ends_a, raw_a)):
            while ends_b[j] <= end - len(raw):
                j += 1
            k = j
            while k < len(b) and ends_b[k] - len(raw_b[k]) < end:
                links.append((a[i], b[k]))
                k += 1
        counts.update(set(links))
        linked.append(links)
        rows.append((len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [r + (sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links)) for r, links in zip(rows, linked)], counts


def test_rows_equal_the_definition(spark, tmp_path, monkeypatch):
    data = [r for r in cases.rows() if r[1] is None or len(r[1]) < 20000] + [(100 + i, x, "en", "s", 1, *cases.EXTRA) for i, x in enumerate(ODD)]
    monkeypatch.setattr(t, "SLOT_BYTES", 64)  # many slots per radix
    path = cases.folder(spark, tmp_path, documents=cases.frame(spark, data, 3))
    got = t.op13_alignment(spark, path).collect()
    rows, counts = brute([r[1] or "" for r in data])
    want = sorted(((str(d[0]), *r) for d, r in zip(data, rows)))
    assert sorted((str(r["doc_id"]), r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"], r["n_best"], r["count_sum"]) for r in got) == want
    assert sum(r[0] == 0 for r in rows) >= 3 and sum(r[0] > 0 for r in rows) > 10
    pairs = t.pair_table(spark.read.parquet(f"{path}/documents.parquet"), A, B).collect()
    assert {(r["a"], r["b"]): r["documents"] for r in pairs} == dict(counts)


def test_small_runs_and_blocks_give_the_same(spark, tmp_path):
    own = t.sides(A, B)
    texts = [cases.prose(i, 50) for i in range(40)]
    facts, doc, key = own.link(texts)
    records = Counter(zip(key.tolist(), doc.tolist()))
    runs = t.runs_of(own, doc, key)
    assert len({r["radix"] for r in runs}) == len(runs) and all(r["size"] == len(r["data"]) for r in runs)
    back = Counter()
    for r in runs:
        pair, d, links = t.read_records(r["data"])
        assert (own.radix(pair) == r["radix"]).all() and (np.diff(pair) >= 0).all()
        back.update({(p, x): n for p, x, n in zip(pair.tolist(), d.tolist(), links.tolist())})
    assert back == records
    a, b = own.pair(key)
    assert (own.key(a, b) == key).all()


def test_merge_adds_equal_pairs_of_all_runs(monkeypatch):
    monkeypatch.setattr(t, "BLOCK_PAIRS", 3)
    monkeypatch.setattr(t, "BUFFER_PAIRS", 5)
    rnd = np.random.default_rng(5)
    runs = [(np.unique(rnd.integers(0, 60, n)), None) for n in (0, 1, 7, 30, 30, 55)]
    runs = [(p, rnd.integers(1, 9, len(p))) for p, _ in runs]
    want = Counter()
    for p, n in runs:
        want.update(dict(zip(p.tolist(), n.tolist())))
    got = [(p, n) for pairs, many in t.merge(iter(runs)) for p, n in zip(pairs.tolist(), many.tolist())]
    assert got == sorted(want.items())


def test_empty_table(spark, tmp_path):
    assert t.op13_alignment(spark, cases.folder(spark, tmp_path, documents=cases.empty(spark))).count() == 0
