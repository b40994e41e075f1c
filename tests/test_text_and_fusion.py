"""BM25, sparse search, fusion and embeddings against plain Python."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from nearfield.operators import fulltext, fusion, search

DOCS = [(0, "red red apple"), (1, "green apple pie with apple"), (2, "pear"), (3, ""), (4, "Red pear, green pear")] + [
    (10 + i, "apple") for i in range(6)]


def docs(spark):
    return spark.createDataFrame(DOCS, "id long, text string")


def bm25(query, k1=1.5, b=0.75):
    toks = {i: t.lower().replace(",", "").split() for i, t in DOCS}
    n, avg = len(toks), sum(map(len, toks.values())) / len(toks)
    df = Counter(t for ts in toks.values() for t in set(ts))
    out = {}
    for i, ts in toks.items():
        tf, score = Counter(ts), 0.0
        for t in query.split():
            if tf[t]:
                score += math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * (k1 + 1) / (tf[t] + k1 * (1 - b + b * len(ts) / avg))
        if score:
            out[i] = score
    return sorted(out.items(), key=lambda p: (-round(p[1], 9), p[0]))


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_bm25(spark, strategy):
    queries = {1: "red apple", 2: "pear pear green", 3: "absent"}
    q = spark.createDataFrame(list(queries.items()), "qid long, text string")
    rows = fulltext.bm25_search(docs(spark).repartition(3), q, 4, strategy=strategy).orderBy("qid", "rank").collect()
    for qid, text in queries.items():
        mine = [(r["id"], r["score"]) for r in rows if r["qid"] == qid]
        want = bm25(text)[:4]
        assert [i for i, _ in mine] == [i for i, _ in want]
        assert [s for _, s in mine] == pytest.approx([s for _, s in want])


def test_bm25_vocabulary_in_slices(spark, monkeypatch):
    from nearfield.operators import blocks

    kernel = blocks.TermKernel(1.5, 0.75)
    import numpy as np
    import pyarrow as pa

    base = pa.RecordBatch.from_pydict({"id": [0, 1], "keys": [["a", "b"], ["c"]], "tf": [[2, 1], [1]], "rel_length": [1.5, 0.5]})
    query = pa.RecordBatch.from_pydict({"qid": [0], "keys": [["c", "a", "b", "z"]], "values": [[1.0, 2.0, 3.0, 4.0]]})
    whole = kernel.costs(kernel.load(query, True), kernel.load(base, False))
    norm = [1.5 * (0.25 + 0.75 * x) for x in (1.5, 0.5)]
    np.testing.assert_allclose(whole, [[-(2 * 2 * 2.5 / (2 + norm[0]) + 3 * 2.5 / (1 + norm[0])), -2.5 / (1 + norm[1])]])
    monkeypatch.setattr(blocks, "VOCAB_COLUMNS", 1)
    np.testing.assert_allclose(kernel.costs(kernel.load(query, True), kernel.load(base, False)), whole)


def test_bm25_candidates_use_whole_corpus_statistics(spark):
    q = spark.createDataFrame([(1, "apple")], "qid long, text string")
    only = spark.createDataFrame([(1,), (12,)], "id long")
    rows = fulltext.bm25_search(docs(spark), q, 5, candidates=only).orderBy("rank").collect()
    want = [p for p in bm25("apple") if p[0] in (1, 12)]
    assert [(r["id"], pytest.approx(r["score"])) for r in rows] == want


def test_bm25_encode_and_empty_corpus(spark):
    rows = {r["id"]: r["sparse"] for r in fulltext.bm25_encode(docs(spark)).collect()}
    assert len(rows) == len(DOCS) and rows[3] == {} and len(rows[1]) == 4
    term = spark.range(1).select(F.xxhash64(F.lit("pie"))).first()[0]
    assert rows[1][term] == pytest.approx(dict(bm25("pie"))[1])
    q = spark.createDataFrame([(1, "a")], "qid long, text string")
    assert fulltext.bm25_search(docs(spark).limit(0), q, 3).count() == 0


def test_sparse_search(spark):
    rows = [(0, {1: 1.0, 2: 2.0}), (1, {2: -1.0}), (2, {3: 5.0}), (3, {})]
    df = spark.createDataFrame(rows, "id long, sparse map<bigint,double>")
    q = spark.createDataFrame([(0, {2: 3.0, 9: 1.0}), (1, {7: 1.0}), (2, {2: 0.1, 3: 9.0})], "qid long, sparse map<bigint,double>")
    got = [(r["qid"], r["id"], round(r["score"], 6)) for r in fusion.sparse_search(df, q, 5).orderBy("qid", "rank").collect()]
    assert got == [(0, 0, 6.0), (0, 1, -3.0), (2, 2, 45.0), (2, 0, 0.2), (2, 1, -0.1)]
    dropped = fusion.sparse_search(df, q, 5, drop_ratio=0.5, strategy="shuffle").filter("qid = 2").collect()
    assert [r["id"] for r in dropped] == [2]


def hits(spark, rows):
    return spark.createDataFrame(rows, "qid long, rank int, id long, score double")


def test_rrf(spark):
    a = hits(spark, [(0, 1, 10, 0.9), (0, 2, 11, 0.8)])
    b = hits(spark, [(0, 1, 11, 5.0), (0, 2, 12, 4.0), (1, 1, 10, 1.0)])
    rows = fusion.rrf({"a": a, "b": b}, 2).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["id"]) for r in rows] == [(0, 11), (0, 10), (1, 10)]
    assert rows[0]["score"] == pytest.approx(1 / 62 + 1 / 61)
    with pytest.raises(ValueError):
        fusion.rrf({}, 2)


def test_weighted(spark):
    near = hits(spark, [(0, 1, 10, 0.0), (0, 2, 11, 4.0), (0, 3, 12, 1.0)])
    text = hits(spark, [(0, 1, 11, 8.0), (0, 2, 12, 8.0)])
    rows = fusion.weighted({"near": near, "text": text}, {"near": 0.5, "text": 0.5}, 3, distances=("near",)).orderBy("rank").collect()
    assert [(r["id"], r["score"]) for r in rows] == [(12, 0.875), (10, 0.5), (11, 0.5)]
    with pytest.raises(ValueError, match="no weight"):
        fusion.weighted({"near": near, "text": text}, {"near": 1.0}, 3)


def test_hash_embedding_and_user_model(spark):
    rows = {r["id"]: r["vector"] for r in fulltext.text_embedding(docs(spark), dim=16).collect()}
    assert len(rows[0]) == 16 and sum(x * x for x in rows[0]) == pytest.approx(1.0, abs=1e-5)
    assert rows[10] == rows[11] and rows[3] == [0.0] * 16

    def model():
        def predict(texts):
            import numpy as np

            return np.array([[len(t), 1.0] for t in texts], dtype=np.float32)

        return predict

    made = {r["id"]: r["vector"] for r in fulltext.text_embedding(docs(spark), model_fn=model).collect()}
    assert made[2] == [4.0, 1.0]


def test_terms_beyond_what_is_sent_give_the_same(spark, monkeypatch):
    q = spark.createDataFrame([(1, "apple pie"), (2, "fruit apple")], "qid long, text string")
    sent = sorted(map(tuple, fulltext.bm25_search(docs(spark), q, 5).collect()))
    monkeypatch.setattr(fulltext, "TERMS_SENT", 1)
    assert [pytest.approx(r) for r in sorted(map(tuple, fulltext.bm25_search(docs(spark), q, 5).collect()))] == sent


def test_request_mappings_run(spark):
    base = spark.createDataFrame([(i, [float(i), 1.0], i % 3, i * 2) for i in range(12)], "id long, v array<float>, g int, x int")
    queries = spark.createDataFrame([(1, [0.0, 1.0]), (2, [11.0, 1.0])], "qid long, v array<float>")
    request = {"vectorField": "v", "filter": "id > 1", "metricType": "L2", "offset": 1, "outputFields": ["x"]}
    rows = search.run_request(base, queries, request, 2).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["id"], r["x"]) for r in rows] == [(1, 3, 6), (1, 4, 8), (2, 10, 20), (2, 9, 18)]
    grouped = search.run_request(base, queries, {"vectorField": "v", "groupByField": "g", "groupSize": 2}, 2).filter("qid = 1").orderBy("rank").collect()
    assert [(r["group_value"], r["id"]) for r in grouped] == [(0, 0), (0, 3), (1, 1), (1, 4)]
    both = [(queries, {"vectorField": "v", "limit": 3, "params": {"metric_type": "L2"}}), (queries, {"vectorField": "v", "limit": 3, "params": {"metricType": "IP"}})]
    fused = fusion.run_hybrid_request(base, both, {"type": "weighted", "params": {"weights": [0.9, 0.1]}}, 2, ["x"])
    assert {r["qid"]: r["id"] for r in fused.filter("rank = 1").collect()} == {1: 0, 2: 11} and "x" in fused.columns
    assert fusion.run_hybrid_request(base, both, None, 2).count() == 4
    with pytest.raises(ValueError):
        fusion.run_hybrid_request(base, [], None, 2)


def test_bm25_encode_of_more_terms_than_are_sent(spark, monkeypatch):
    """Terms that are not sent meet their frequency in a shuffle of their own postings: nothing is repeated over salts."""
    df = docs(spark).unionByName(spark.createDataFrame([(100 + i, f"the word w{i} w{i // 3} w{i}") for i in range(40)] + [(900, None)], docs(spark).schema))
    due = {r["id"]: {} for r in df.collect()}
    for r in fulltext.bm25_weights(df).select("id", F.xxhash64("term").alias("t"), "weight").collect():
        due[r["id"]][r["t"]] = r["weight"]
    for sent in (0, 3, 200_000):
        monkeypatch.setattr(fulltext, "TERMS_SENT", sent)
        monkeypatch.setattr(fulltext, "skew_join", None)
        monkeypatch.setattr(fulltext, "broadcast_if_small", lambda df, *_: df)
        got = {r["id"]: r["sparse"] for r in fulltext.bm25_encode(df).collect()}
        assert got.keys() == due.keys() and got[900] == {}
        for i, row in due.items():
            assert got[i].keys() == row.keys() and all(abs(got[i][t] - w) < 1e-12 for t, w in row.items())
        monkeypatch.undo()
