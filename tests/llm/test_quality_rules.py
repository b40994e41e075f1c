import re

import cases
import numpy as np
from nearfield.llm import quality_rules as q

WHITE = re.compile(r"[\x20\x09-\x0D]+")


def brute(text):
    words = [w for w in WHITE.split(text or "") if w]
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if WHITE.sub("", line):
            lines += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), lines, len(hit)


def test_counts_match_brute_force():
    texts = ["", " \n ", "a", "a b c", "a b c a b c", "a a a a", "é|é <b>\nx\nx\n\nx \n日本 日本 日本 日本", cases.prose(1, 300) + "\n" + cases.prose(1, 90), "x y z \x1c a"]
    for t in texts:
        assert q.text_counts(t.encode())[:5] == brute(t), t


def test_rows_labels_and_verdicts(spark, tmp_path):
    good = [(100 + i, cases.prose(i, 100 + i % 50), "en", "s", 1, *cases.EXTRA) for i in range(300)]
    bad = [(1000 + i, " ".join("#$%&"[j % 4] * 3 + f"{i}w{j}" for j in range(80)), "en", "s", 1, *cases.EXTRA) for i in range(30)]
    data = cases.rows() + good + bad
    docs = cases.frame(spark, data, 4)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100, 400)] + [(i, 0, 0) for i in range(1000, 1020)] + [(None, 1, 0), (5, None, 0), (99999, 0, 0), (100, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    path = cases.folder(spark, tmp_path, documents=docs, labels=labels)
    rows = q.op1_quality_rules(spark, path).collect()
    assert len(rows) == len(data)
    by_id = {r["doc_id"]: r for r in rows}
    for i, text, *_ in data:
        if i not in (5, None):
            r = by_id[i]
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(text), i
            assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["base_failed"] and r["kept"])
    assert all(not by_id[i]["kept"] for i in range(1000, 1030))  # the last ten have no label
    assert sum(by_id[i]["kept"] for i in range(100, 400)) >= 297
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(r[0] or -1 for r in kept.collect()) == sorted(r["doc_id"] or -1 for r in rows if r["kept"])


def test_no_labels_and_no_rows(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = q.op1_quality_rules(spark, cases.folder(spark, tmp_path / "a", documents=cases.frame(spark), labels=labels)).collect()
    assert all(r["kept"] != r["base_failed"] for r in rows)
    assert q.op1_quality_rules(spark, cases.folder(spark, tmp_path / "b", documents=cases.empty(spark), labels=labels)).count() == 0


def test_outliers_have_short_paths():
    rng = np.random.default_rng(1)
    data = np.vstack([rng.normal(size=(500, 3)), [[9, 9, 9]]])
    score = q.anomaly([q.grow_tree(data[rng.permutation(501)[:256]], s) for s in range(50)], data, 256)
    assert score.argmax() == 500
