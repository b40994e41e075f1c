import random

import cases
import numpy as np
import pytest
from nearfield.llm import common, jaccard_join as j
from nearfield.llm.decontamination import split_words


def near(text, rnd, n):
    words = text.split()
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"edit{rnd.randint(0, 10**6)}"
    return " ".join(words)


def data():
    rnd, out = random.Random(2), cases.rows()
    for g in range(12):
        base = cases.prose(50 + g, 150 + 10 * g)
        out += [(200 + 20 * g + k, near(base, rnd, k), "en", "s", 1, *cases.EXTRA) for k in range(8)]
    return out


def brute(rows):
    sets = []
    for _, text, *_ in rows:
        w = split_words((text or "").encode())
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [[k for k, b in enumerate(sets) if k != i and a and len(a & b) * 5 >= 4 * len(a | b)] for i, a in enumerate(sets)]
    group = list(range(len(rows)))
    for _ in rows:
        group = [min([group[i], *(group[k] for k in links[i])]) for i in range(len(rows))]
    order = lambda i: (rows[i][0] is not None, rows[i][0] or 0)  # noqa: E731  null ids come first
    least = {g: rows[min((i for i in range(len(rows)) if group[i] == g), key=order)][0] for g in group}
    return [(rows[i][0], least[group[i]], len(links[i])) for i in range(len(rows))], group


@pytest.mark.parametrize("chunk", [1024, 2])
def test_links_and_classes_equal_brute_force(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(j, "BUCKET_CHUNK", chunk)
    monkeypatch.setattr(j, "SET_CHUNK", chunk)
    rows = data()
    path = cases.folder(spark, tmp_path, documents=cases.frame(spark, rows, 4))
    got = sorted(str((r["doc_id"], r["class_id"], r["n_links"])) for r in j.op6_jaccard_join(spark, path).collect())
    assert got == sorted(map(str, brute(rows)[0]))


def test_one_of_each_class_stays(spark):
    rows = data()
    docs = cases.frame(spark, rows, 4)
    kept = j.keep_one(docs)
    _, group = brute(rows)
    assert kept.columns == docs.columns and kept.count() == len(set(group))
    assert j.keep_one(cases.empty(spark)).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    a, b = np.sort(base[:810]), np.sort(base[90:])  # similarity 0.8
    sig = np.array([j.minhash(a), j.minhash(b), j.minhash(rng.integers(0, 1 << 63, 800, dtype=np.uint64))])
    p, q = j.survivors(sig, sig, True)
    assert list(zip(p.tolist(), q.tolist())) == [(0, 1)]
    sets = [a, b, *[np.unique(rng.choice(base, 300)) for _ in range(20)]]
    p, q = np.triu_indices(len(sets), 1)
    assert j.common_counts(sets, p, q, 64).tolist() == [len(np.intersect1d(sets[x], sets[y])) for x, y in zip(p, q)]


@pytest.mark.parametrize("most", [500_000, 0])
def test_components_of_chains_and_stars(spark, monkeypatch, most):
    monkeypatch.setattr(common, "BROADCAST_NODES", most)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[100 + i] for i in range(30)} == {100} and got[200] == got[201] == 200
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
