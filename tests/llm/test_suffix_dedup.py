import hashlib
import random

import cases
import numpy as np
import pytest
from nearfield.llm import suffix_dedup as s


def data():
    rnd, out = random.Random(6), cases.rows()
    shared = [cases.prose(70 + i, 12 + 3 * i) for i in range(5)]
    for k in range(25):
        text = " ".join(cases.prose(500 + k * 7 + i, rnd.randint(0, 12)) + " " + rnd.choice(shared)[rnd.randint(0, 30):] for i in range(3))
        out.append((300 + k, text, "en", "s", 1, *cases.EXTRA))
    exact = cases.prose(3, 40)[:50]
    out += [(400, exact, "en", "s", 1, *cases.EXTRA), (401, "z" + exact, "en", "s", 1, *cases.EXTRA), (402, exact[:49], "en", "s", 1, *cases.EXTRA), (403, "ab" * 200, "en", "s", 1, *cases.EXTRA),
            (404, "b" + "ab" * 40, "en", "s", 1, *cases.EXTRA), (405, "é" * 40 + "x" + "é" * 40, "en", "s", 1, *cases.EXTRA), (406, "é" * 30, "en", "s", 1, *cases.EXTRA)]
    return out


def brute(rows, digest=True):
    first: dict[bytes, int] = {}
    texts = [((r[0] if r[0] is not None else s.LAST), (r[1] or "").encode()) for r in rows]
    for i, b in texts:
        for p in range(len(b) - 49):
            w = b[p:p + 50]
            first[w] = min(first.get(w, s.LAST), i)
    out = []
    for i, b in texts:
        cut = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                cut[p:p + 50] = True
        spans = int((np.diff(np.concatenate([[0], cut.astype(int)])) > 0).sum())
        kept = np.frombuffer(b, np.uint8)[~cut].tobytes()
        out.append((None if i == s.LAST else i, len(b), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest() if digest else kept))
    return out


@pytest.mark.parametrize("hot,bucket", [(50_000, 20_000), (1, 20_000), (50_000, 10)])
def test_removed_bytes_equal_brute_force(spark, tmp_path, monkeypatch, hot, bucket):
    monkeypatch.setattr(s, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(s, "BUCKET_CONTEXTS", bucket)
    path = cases.folder(spark, tmp_path, documents=cases.frame(spark, data(), 5))
    got = sorted(str(tuple(r)) for r in s.op9_suffix_dedup(spark, path).collect())
    assert got == sorted(map(str, brute(data())))


def test_maximal_repeats_with_all_occurrences():
    contexts = [b"xabcabcy", b"zabcabcw", b"qabcq"]
    number, offset, left, lcp = [], [], [], []
    suffixes = sorted((c[i:], n, i) for n, c in enumerate(contexts) for i in range(len(c)))
    for k, (x, n, i) in enumerate(suffixes):
        before = suffixes[k - 1][0] if k else b""
        lcp.append(next((j for j, (a, b) in enumerate(zip(before, x)) if a != b), min(len(before), len(x))))
        left.append(contexts[n][i - 1] if i else -1)
        number.append(n)
        offset.append(i)
    found = {(contexts[number[a]][offset[a]: offset[a] + n], b - a + 1) for n, a, b in s.maximal_repeats(np.array(lcp), np.array(left), 2)}
    assert found == {(b"abc", 5), (b"abcabc", 2)}  # bc, ca ... repeat no more often than what they lie in


def test_cut_texts_are_valid_and_short_cuts_keep_columns(spark):
    docs = cases.frame(spark, data(), 4)
    out = s.cut_repeats(docs)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert 402 in rows and rows[2]["text"] is None and rows[9]["n_chars"] == len(rows[9]["text"]) and 17 not in rows or rows[17]["text"] != "x" * 3000 + "y"
    assert s.cut_repeats(cases.empty(spark)).count() == 0
