import math
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
from nearfield.llm import maxent_lm as m

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def data():
    rng, out = np.random.default_rng(3), cases.rows()
    for k in range(150):  # an order that a unigram model cannot know
        words = [f"{'abcd'[j % 4]}{rng.integers(0, 12)}" for j in range(60)]
        out.append((1000 + k, " ".join(words), "en", "s", 1, *cases.EXTRA))
    return out


def test_base_matches_and_the_model_learns_order(spark, tmp_path):
    rows = data()
    path = cases.folder(spark, tmp_path, documents=cases.frame(spark, rows, 3))
    tokens = [(i, [*WORD.findall((t or "").translate(LOWER)), None]) for i, t, *_ in rows]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 5)) for i, ws in tokens)
    got = m.op10_maxent_lm(spark, path).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    fresh = [r for r in got if r["held_out"] and (r["doc_id"] or 0) >= 1000]
    assert sum(r["score"] for r in fresh) > 0.9 * sum(r["base_score"] for r in fresh)


def test_classes_and_words_sum_to_one():
    rng = np.random.default_rng(1)
    weights, bias = rng.normal(size=(m.FEATURES, m.CLASSES)).astype(np.float32), rng.normal(size=m.CLASSES).astype(np.float32)
    p = np.exp(m.class_scores(weights, bias, rng.integers(0, m.FEATURES, (3, 50))))
    assert np.allclose(p.sum(1), 1, atol=1e-5)
    counts, classes = np.array([1, 1, 2, 5, 9, 0]), np.array([0, 0, 3, 3, 4, 0])
    stats = {"n": 18, "v": 5, "v1": 2, "v2": 1, "sizes": {0: 2, 3: 7, 4: 9}}
    word, _ = m.word_scores({"counts": counts, "classes": classes}, stats)
    for k in (0, 3, 4):
        assert abs(np.exp(word[classes == k]).sum() - 1) < 1e-9


def test_no_training_rows_and_no_rows(spark, tmp_path):
    only = [r for r in data() if held(r[0])][:5]
    got = m.op10_maxent_lm(spark, cases.folder(spark, tmp_path / "a", documents=cases.frame(spark, only))).collect()
    assert len(got) == len(only) and all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) and r["base_score"] == 0 for r in got)
    assert m.op10_maxent_lm(spark, cases.folder(spark, tmp_path / "b", documents=cases.empty(spark))).count() == 0


def test_ways_down_a_tree_sum_to_one():
    rng = np.random.default_rng(2)
    x = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64) * np.uint64(2))
    c = rng.integers(2, 50, len(x))
    below = np.zeros((m.CLASSES, 1 << m.DEPTH))
    np.add.at(below[5], m.leaves(x), c)
    odds = m.branches(below)
    share = c / below[5][m.leaves(x)]
    b = {"hashes": x, "classes": np.full(len(x), 5, np.uint8)}
    for weights in (np.zeros(m.BRANCHES, np.float32), rng.normal(size=m.BRANCHES).astype(np.float32)):
        p = share * np.exp(m.way_scores(b, np.arange(len(x)), np.repeat([[7], [8], [9]], len(x), axis=1), odds, weights))
        assert abs(p.sum() - 1) < 1e-5
        assert weights.any() or np.allclose(p, c / c.sum(), rtol=0.001)


def test_words_of_one_class_are_told_apart_by_history(spark, tmp_path):
    """Nearly all words are of one shape and frequency, and each is mostly followed by one other: a class says little about which."""
    rng, rows = np.random.default_rng(5), []
    for k in range(300):
        at, words = rng.integers(0, 400), []
        for _ in range(60):
            words.append(f"w{at:03d}x")
            at = (at * 7 + 3) % 400 if rng.random() < 0.9 else rng.integers(0, 400)
        rows.append((k, " ".join(words), "en", "s", 1, *cases.EXTRA))
    got = m.op10_maxent_lm(spark, cases.folder(spark, tmp_path, documents=cases.frame(spark, rows, 3))).collect()
    fresh = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in fresh) > 0.75 * sum(r["base_score"] for r in fresh)


def test_sums_count_beyond_24_bits():
    seen, due = m.empty_sums()
    for table in (seen, due):
        table[-1, 0] = 2**24
        table[-1] += np.bincount([0], minlength=m.CLASSES)
        assert table[-1, 0] == 2**24 + 1
    assert np.frombuffer(m.added_up([np.array([2.0**24]).tobytes(), np.array([1.0]).tobytes()]))[0] == 2**24 + 1


def test_probabilities_of_all_words_sum_to_one(spark, tmp_path):
    """Without weights, the shares of all known words of a class, rare ones too, with "unknown" add up to one, so rare words have no second factor."""
    coded = m.word_blocks(cases.frame(spark, data(), 1))
    coded = coded.join(m.word_counts(coded), "block")
    stats = m.totals(coded)
    assert np.isnan(stats["odds"][0]).all() and np.isnan(stats["odds"][1 + m.SHAPES:]).all()
    sums = np.zeros(m.CLASSES)
    for b in (b for batch in coded.toArrow().to_batches() for b in m.unpack(batch, stats)):
        known = b["firsts"] & (b["counts"] > 0)
        code, k = np.flatnonzero(known), b["classes"][known]
        leaf = stats["leaves"][k, m.leaves(b["hashes"][code])]
        ways = np.exp(m.way_scores(b, code, np.zeros((3, len(code)), np.int64), stats["odds"], np.zeros(m.BRANCHES, np.float32)))
        word = np.exp(m.word_scores(b, stats)[0])
        sums += np.bincount(k, np.where(k == 0, word[code] * ways, ways * np.where(k <= m.SHAPES, b["counts"][code] / leaf, 1)), m.CLASSES)
    inner = np.array([stats["sizes"][k] > 0 for k in range(m.CLASSES)])
    assert np.allclose(sums[1:][inner[1:]], 1, rtol=1e-3) and 0 < sums[0] < 1


def test_blocks_are_stored_small_and_totals_read_no_codes(spark):
    rng = np.random.default_rng(4)
    for v in (rng.integers(0, 2**63, 7).astype(np.uint64), np.arange(300, dtype=np.int32), np.array([True, False]), np.zeros(0, np.int64)):
        back = m.unsqueezed(pa.scalar(m.squeezed(v)).as_buffer(), v.dtype)
        assert back.dtype == v.dtype and back.tolist() == v.tolist()
    coded = m.word_blocks(cases.frame(spark, data(), 1))
    tokens = sum(len(b["codes"]) for batch in coded.toArrow().to_batches() for b in m.unpack(batch))
    assert 0 < sum(len(r["codes"]) for r in coded.collect()) < 4 * tokens / 2
    words = coded.join(m.word_counts(coded), "block")
    assert m.totals(words.select("hashes", "shapes", "counts", "firsts"))["n"] == m.totals(words)["n"] > 0


def test_sums_that_tasks_send_follow_their_documents(spark, monkeypatch):
    """A round's tables have a fixed number of places; what a task sends of them is as small as its part of the corpus."""
    coded = m.word_blocks(cases.frame(spark, data(), 1))
    coded = m.materialize(coded.join(m.word_counts(coded), "block"), "coded")
    stats, sent = m.totals(coded), []
    summed = m.added

    def added(coded, run):
        sent.append(sum(len(r["sums"]) for r in coded.coalesce(1).mapInArrow(run, m.SUMS).collect()))
        return summed(coded, run)

    monkeypatch.setattr(m, "added", added)
    model = {"weights": np.zeros((m.FEATURES, m.CLASSES), np.float32), "bias": np.zeros(m.CLASSES, np.float32), "ways": np.zeros(m.BRANCHES, np.float32)}
    seen, due, off, swing = m.gather(coded, stats, model, 0)
    assert sent[0] < 16 * (m.BRANCHES + (m.FEATURES + 1) * m.CLASSES) / 4
    blocks = [b for batch in coded.toArrow().to_batches() for b in m.unpack(batch, stats)]
    tokens = sum(b["lengths"][~b["held"] & (np.arange(len(b["held"])) % m.ROUNDS == 0)].sum() for b in blocks)
    assert seen[-1].sum() == tokens > 0 and seen[:-1].sum() == 3 * tokens
    assert np.allclose(due[-1], tokens / m.CLASSES) and np.isclose(due[:-1].sum(), 3 * tokens) and off.any() and swing.min() == 0 < swing.max()


def test_slices_and_sums_equal_one_by_one(monkeypatch):
    monkeypatch.setattr(m, "SLICE", 7)
    rng = np.random.default_rng(6)
    lengths = np.array([1, 9, 1, 1, 20, 2, 3], np.int32)
    b = {"lengths": lengths, "codes": rng.integers(0, 5, lengths.sum()).astype(np.int32), "hashes": rng.integers(0, 2**63, 5).astype(np.uint64)}
    begins = np.isin(np.arange(lengths.sum()), np.cumsum(lengths) - lengths)
    every = m.histories(b["hashes"][b["codes"]], begins)
    for chosen in (np.ones(7, bool), np.array([False, True, False, True, True, False, True]), np.zeros(7, bool)):
        parts = list(m.slices(b, chosen))
        own = np.concatenate([np.zeros(0, int), *[o for o, _ in parts]])
        assert own.tolist() == np.flatnonzero(np.repeat(chosen, lengths)).tolist()
        assert all((f == every[:, o]).all() for o, f in parts)
    at, rows, into = rng.integers(0, 4, (3, 50)), rng.random((6, 50)).astype(np.float32), np.zeros((6, 4))
    m.add_rows(into, at, rows)
    want = np.zeros((6, 4))
    for line in at:
        np.add.at(want.T, line, rows.T)
    assert np.allclose(into, want)


def test_words_are_split_at_ascii_white_space_only():
    texts = [None, "", " \t\n\x0b\x0c\r ", "A b", " ÀB\x1c\x85x  y\n", "　\xa0", "Z" * 5000, "\x00 \x7f\x1fz"]
    own, n = m.split(pa.array(texts))
    want = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    assert n.tolist() == [len(w) for w in want] and own.to_pylist() == [x for w in want for x in w]
    own, n = m.split(pa.array(texts).slice(3, 2))
    assert n.tolist() == [len(w) for w in want[3:5]] and own.to_pylist() == want[3] + want[4]
    assert m.split(pa.array([], pa.string()))[1].tolist() == []


def test_only_empty_texts(spark, tmp_path):
    rows = [(i, t, "en", "s", 1, *cases.EXTRA) for i, t in ((1, None), (2, ""), (3, " \n"))]
    got = m.op10_maxent_lm(spark, cases.folder(spark, tmp_path, documents=cases.frame(spark, rows, 2))).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == [(1, 1), (2, 1), (3, 1)] and all(math.isfinite(r["score"]) for r in got)
