from collections import Counter
from itertools import product

import cases
from nearfield.llm import sharding


def test_neighbours_on_the_curve_are_neighbours_in_the_grid(spark):
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        rows = sorted((r["curve"], r["cell"]) for r in sharding.hilbert_cells(spark, dims, bits).collect())
        assert [c for c, _ in rows] == list(range(1 << dims * bits))
        point = lambda cell: [cell >> i * bits & (1 << bits) - 1 for i in range(dims)]
        assert all(sum(abs(a - b) for a, b in zip(point(x), point(y))) == 1 for (_, x), (_, y) in zip(rows, rows[1:]))
        assert len({tuple(point(c)) for _, c in rows}) == len(list(product(range(1 << bits), repeat=dims)))


def check(rows, shards, n):
    sizes = Counter(r["shard"] for r in rows)
    assert sum(sizes.values()) == n and max(sizes.values()) - min(sizes[s] for s in range(min(shards, n))) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    by_place = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in by_place] == sorted(r["curve"] for r in rows)


def test_runs_are_even_and_follow_the_curve(spark, tmp_path):
    same = [(7, "same text", "en", "hot", 9, *cases.EXTRA)] * 300  # one hot cell of repeated rows
    path = cases.folder(spark, tmp_path, documents=cases.frame(spark, cases.rows() + same, 4))
    df = sharding.op5_hilbert_sharding(spark, path)
    rows = df.collect()
    check(rows, 40, len(cases.rows()) + 300)
    assert {r["size"] for r in rows if r["doc_id"] == 2} == {16} and {r["text_crc32"] for r in rows if r["doc_id"] == 3} == {0}
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


def test_empty_table_fewer_rows_than_shards_and_clashing_columns(spark, tmp_path):
    assert sharding.op5_hilbert_sharding(spark, cases.folder(spark, tmp_path, documents=cases.empty(spark))).count() == 0
    rows = cases.frame(spark).withColumnRenamed("score", "curve")
    out = sharding.hilbert_shards(rows, {"n": sharding.by_log(rows["n_chars"])}, [rows["doc_id"]], 40)
    check(out.collect(), 40, len(cases.rows()))
    assert out.columns.count("shard") == 1 and dict(out.dtypes)["shard"] == "int"
    assert sharding.manifest(out, ["n_chars"]).count() == len(cases.rows())
