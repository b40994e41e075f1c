import math
import random
import re
from collections import Counter

import numpy as np

import cases
from nearfield.llm import lexical_search as t

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(d, Counter(terms(x))) for d, x in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, total = len(held), sum(s for _, _, s in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, size in held:
            m = 100 - 75 + (75 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in terms(text) if c[w])
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


ITEMS = [(1, "river stone light RIVER"), (2, None), (3, ""), (4, "the of and over_under"), (5, "nothing-here zzz"), (6, "Naïve straße été été"), (6, "walk run slow"), (7, "日本語 x9")]


def test_rows_equal_the_definition(spark, tmp_path):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    data = [(r[0], re.sub(r"(\D)\d+", r"\1 ", r[1]) if r[1] and r[0] != 4 else r[1], *r[2:]) for r in cases.rows()]
    path = cases.folder(spark, tmp_path, documents=cases.frame(spark, data), benchmark=items)
    want = brute([r[:2] for r in data], ITEMS)
    assert rows(t.op11_lexical_search(spark, path)) == want and len(want) > 20


def many(seed, n):
    rnd = random.Random(seed)
    pool = [w for w in cases.WORDS for _ in range(3)] + [f"rare{i}" for i in range(200)]
    return [(i, " ".join(rnd.choice(pool) for _ in range(rnd.randint(1, 60)))) for i in range(n)] + [(n + i, "river stone") for i in range(40)]


def test_trees_of_many_documents_with_ties_and_chunks(spark):
    docs, items = many(1, 700), [(i, x) for i, x in many(2, 60)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    assert rows(t.top_documents(frame, asked)) == want
    assert len(list(t.item_chunks(asked, 6000))) > 1 and rows(t.top_documents(frame, asked, chunk_bytes=6000)) == want
    assert rows(t.top_documents(frame, asked, 3)) == brute(docs, items, 3)


def test_node_pairs_are_pruned_and_bounds_hold():
    rnd = np.random.default_rng(1)

    def points(n, width):
        rows = [np.unique(np.concatenate([[i % 40], rnd.integers(40, width, 3)])) for i in range(n)]
        start = np.cumsum([0, *map(len, rows)])
        return t.Points(start, np.concatenate(rows), rnd.integers(1, 1000, start[-1]))

    docs, asked = points(4000, 4000), points(50, 4000)
    docs = docs.take(docs.like(np.ones(4000, np.int64)))
    own = t.Items(asked.take(asked.like(np.ones(4000, np.int64))), 4000, 5)
    own.search(docs, np.arange(len(docs)))
    assert own.scored < 0.1 * len(docs) * len(asked)
    up = docs.merged(8)
    dense = rnd.integers(0, 50, 4000)
    low, high = docs.products(np.arange(len(docs)), dense), up.products(np.arange(len(up)), dense)
    assert (np.repeat(high, 8)[: len(low)] >= low).all()


def test_empty_tables(spark, tmp_path):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert rows(t.op11_lexical_search(spark, cases.folder(spark, tmp_path / "a", documents=cases.empty(spark), benchmark=items))) == []
    assert rows(t.op11_lexical_search(spark, cases.folder(spark, tmp_path / "b", documents=cases.frame(spark), benchmark=items.limit(0)))) == []
