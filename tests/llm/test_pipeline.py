import cases
import corpus_pipeline
import test_decontamination
import test_jaccard_join
import test_suffix_dedup
from nearfield.llm import quality_rules
from nearfield.llm.common import materialize


def test_every_stage_decides_on_all_it_gets(spark, tmp_path):
    """Each stage against brute force on its own input; stage 1's forest against its own verdicts per row."""
    data = [(i, t, a, b, c, *cases.EXTRA) for i, t, a, b, c, *_ in [*test_jaccard_join.data(), *test_suffix_dedup.data()[len(cases.rows()):]]]
    items = test_decontamination.ITEMS
    labels = spark.createDataFrame([(i, int(i % 7 > 0), 0) for i in range(200, 400)], "doc_id bigint, quality int, toxic int")
    path = cases.folder(spark, tmp_path, documents=cases.frame(spark, data, 4), labels=labels, benchmark=test_decontamination.bench(spark, items))
    docs, before = cases.frame(spark, data, 4), None
    names = docs.columns
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, materialize(stage(spark, docs, path), "stage")
        rows, old = docs.collect(), [tuple(r) for r in before.collect()]
        assert at == 4 or docs.columns == names
        if at == 0:
            base = {t for _, t, *_ in old if not ((c := quality_rules.text_counts((t or "").encode()))[0] < 50 or 100 * c[4] > 50 * c[0])}
            assert {r["text"] for r in rows} <= base and len({r["text"] for r in rows}) >= 0.9 * len(base)
        elif at == 1:
            assert len(rows) == len(set(test_jaccard_join.brute(old)[1]))
        elif at == 2:
            left = [(i, kept) for i, _, _, _, kept in test_suffix_dedup.brute(old, digest=False) if kept.split()]
            got = {}
            for r in rows:  # a span is shrunk to whole characters, and two rows may share an id
                got.setdefault(r["doc_id"], []).append(r["text"].encode())
            assert set(got) == {i for i, _ in left}
            assert all(min(map(len, got[i])) >= min(len(k) for j, k in left if j == i) for i in got)
        elif at == 3:
            assert sorted(map(str, rows)) == sorted(str(r) for r in before.collect() if not test_decontamination.brute(r["text"], items)[-1])
        else:
            assert sorted(r["decoded"] for r in rows) == sorted(r[1] or "" for r in old) and all(r["n_tokens"] == len(r["token_ids"]) for r in rows)
    assert rows and sorted(str(r["doc_id"]) for r in corpus_pipeline.run(spark, path).collect()) == sorted(str(r["doc_id"]) for r in rows)


def test_no_rows(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    path = cases.folder(spark, tmp_path, documents=cases.empty(spark), labels=labels, benchmark=test_decontamination.bench(spark, []))
    assert corpus_pipeline.run(spark, path).count() == 0
