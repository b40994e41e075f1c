import hashlib
import random
import re
from collections import Counter

import cases
from nearfield.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(10, len(w))
        for g in {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else ():
            for i in range(len(own) - n + 1):
                if tuple(own[i:i + n]) == g:
                    hit |= set(range(i, i + n))
                    found.add(item)
    return len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)


ITEMS = [(1, cases.prose(900, 30)), (2, None), (3, " !! "), (20, "A, b"), (3, cases.prose(4, 30000)[500:900]), (7, cases.prose(900, 30)), (None, "new end"), (40, "never there at all"), (41, "x" * 3000)]


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_matches_equal_brute_force(spark, tmp_path):
    items = [x for x in ITEMS if x[0] is not None]
    path = cases.folder(spark, tmp_path, documents=cases.frame(spark), benchmark=bench(spark, items))
    got = sorted((str(r["doc_id"]), *list(r)[1:]) for r in d.op2_decontamination(spark, path).collect())
    assert got == sorted((str(i), *brute(t, items)) for i, t, *_ in cases.rows())
    assert any(r[-1] for r in got)


def test_chunks_of_items_give_the_same(spark):
    docs = cases.frame(spark).withColumn("key", d.row_key())
    one = d.search(docs, bench(spark, ITEMS)).select("key", "n_words", "n_hit", "items").collect()
    found = [d.materialize(d.matches(d.build_index(docs), c), "m") for c in d.item_chunks(bench(spark, ITEMS), 600)]
    assert len(found) > 2
    assert sorted(map(str, d._merge(found).select("key", "n_words", "n_hit", "items").collect())) == sorted(map(str, one))


def test_proximity_allows_words_between(spark):
    docs = spark.createDataFrame([("k", 1, "zero one two extra three four five"), ("m", 2, "one x y z w two three four five")], "key string, doc_id bigint, text string")
    items = bench(spark, [(1, "one two three four five")])
    hits = lambda slack: {r["doc_id"]: r["n_hit"] for r in d.search(docs, items, 5, slack).collect()}
    assert hits(0) == {1: 0, 2: 0} and hits(1)[1] > 0 and hits(1)[2] == 0


def near(text, items, width, slack):
    """Hit words and items by trying each position of each window's rarest term in the block of all texts."""
    own, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(width, len(w))
        for g in {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else ():
            k = min(range(n), key=lambda i: (RARITY[g[i]], i))
            for p in (p for p, x in enumerate(own) if x == g[k]):
                if all(g[i] in own[max(0, p - k + i - slack): max(0, p - k + i + slack + 1)] for i in range(n) if i != k):
                    hit |= set(range(max(0, p - k), min(len(own), p - k + n)))
                    found.add(item)
    return len(hit), sorted(found)


RARITY = Counter()


def test_proximity_equals_brute_force_in_one_block(spark):
    rnd = random.Random(8)
    texts = ["b a c", "a c", "c b a b", "", "a a c b", "z", "c a"] + [" ".join(rnd.choice("aaaccdeb") for _ in range(rnd.randint(0, 9))) for _ in range(300)]
    items = [(1, "a b c"), (2, "d e"), (3, "e d a c b")]
    RARITY.clear()
    RARITY.update(w for t in texts for w in words(t))
    docs = spark.createDataFrame([(str(i), i, t) for i, t in enumerate(texts)], "key string, doc_id bigint, text string").coalesce(1)
    for slack in (0, 1, 2, 3):
        got = {r["doc_id"]: r for r in d.search(docs, bench(spark, items), 4, slack).collect()}
        assert {i: (r["n_hit"], r["items"]) for i, r in got.items()} == {i: near(t, items, 4, slack) for i, t in enumerate(texts)}, slack
        for r in got.values():
            assert sum(s["length"] for s in r["spans"]) == r["n_hit"] and all(s["start"] >= 0 and 0 < s["length"] <= r["n_words"] - s["start"] for s in r["spans"])
        assert slack != 2 or got[0]["items"]


def test_clean_documents_stay_whole(spark):
    docs = cases.frame(spark)
    clean = d.leave_clean(docs, bench(spark, ITEMS))
    assert clean.columns == docs.columns
    assert sorted(map(str, clean.collect())) == sorted(str(r) for r in docs.collect() if not brute(r["text"], ITEMS)[-1])
    assert d.leave_clean(docs, bench(spark, [])).count() == len(cases.rows())
    assert d.leave_clean(cases.empty(spark), bench(spark, ITEMS)).count() == 0
