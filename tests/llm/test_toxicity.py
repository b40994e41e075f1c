import random
import zlib

import cases
from nearfield.llm import toxicity as t

RUDE = ["idiot", "moron", "worthless", "disgusting"]


def distance(a, b):
    """Optimal string alignment."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
            if i and j and x == b[j - 1] and a[i - 1] == y:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_automaton_equals_distances():
    terms, rnd = ["cat", "scum", "idiot", "worthless", "worth"], random.Random(4)
    m = t.Matcher(terms, ["réeux"])
    for _ in range(4000):
        w = list(rnd.choice(terms))
        for _ in range(rnd.randint(0, 3)):
            i = rnd.randrange(len(w) + 1)
            w[i:i + rnd.randint(0, 1)] = rnd.choice(["", "a", "s", "t"])
        if len(w) > 1 and rnd.random() < 0.3:
            i = rnd.randrange(len(w) - 1)
            w[i], w[i + 1] = w[i + 1], w[i]
        w = "".join(w)
        near = [distance(w, x) for x in terms if distance(w, x) <= t.allowed(x)]
        assert m.match(w) == min(near, default=None), w
    assert m.match("réeuxment") == 0 and m.match("réau") is None and m.match("") is None


def data():
    rnd, docs, labels = random.Random(9), cases.rows(), []
    for i in range(1000, 1600):
        words, bad = cases.prose(i, 60).split(), i % 4 == 0
        for _ in range(3 if bad else 0):
            words.insert(rnd.randrange(60), rnd.choice(RUDE))
        docs.append((i, " ".join(words), "en", "s", 1, *cases.EXTRA))
        labels.append((i, 1, int(bad)))
    docs.append((5000, cases.prose(1, 50) + " you wortless idoit, a m0ron and disgustng " + cases.prose(2, 9), "en", "s", 1, *cases.EXTRA))
    docs += [(5001, cases.prose(3, 50) + " a worthless moron, an idiot " + cases.prose(2, 9), "en", "s", 1, *cases.EXTRA),
             (5002, cases.prose(3, 50) + ' a "worthless" "moron", an “idiot” ' + cases.prose(2, 9), "en", "s", 1, *cases.EXTRA)]
    return docs, labels + [(None, 1, 1), (1000, 1, None), (1001, 0, 0), (88888, 1, 1)]


def test_held_out_and_misspelled_documents(spark, tmp_path):
    docs, labels = data()
    df = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    path = cases.folder(spark, tmp_path, documents=cases.frame(spark, docs, 3), labels=df)
    rows = t.op4_toxicity(spark, path).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    fresh = [i for i, *_ in docs if i and 1000 <= i < 1600 and by_id[i]["held_out"]]
    assert sum(by_id[i]["predicted"] == (i % 4 == 0) for i in fresh) >= 0.98 * len(fresh)
    assert by_id[5000]["predicted"] == 1 and by_id[5000]["score"] > 10 * by_id[1001]["score"]  # only misspelled words
    assert by_id[5001]["predicted"] == 1 and by_id[5002]["predicted"] == 0 and by_id[5002]["score"] < by_id[5001]["score"] / 2  # abuse, and the same in quotes
    assert by_id[2]["predicted"] == by_id[3]["predicted"] == 0


def test_quoted_hits_differ_from_abuse():
    odds = {"idiot": 3.0}
    abuse = t.document_features("you are an idiot and an idiot", {"idiot": 0}, odds)
    quoted = t.document_features('he said the word “idiot” is rude', {"idiot": 0}, odds)
    assert abuse[1] > 0 and abuse[4] > 0 and abuse[2] == 0 and quoted[1] == 0 and quoted[2] == 1


def test_no_labels_and_no_rows(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = t.op4_toxicity(spark, cases.folder(spark, tmp_path / "a", documents=cases.frame(spark), labels=labels)).collect()
    assert {r["score"] for r in rows} == {0.0}
    assert t.op4_toxicity(spark, cases.folder(spark, tmp_path / "b", documents=cases.empty(spark), labels=labels)).count() == 0
    out = t.with_score(cases.frame(spark), t.fit(cases.frame(spark), labels))
    assert dict(out.dtypes)["score"] == "double" and len(out.columns) == len(cases.frame(spark).columns) + 1


def row(term, stem, toxic, clean):
    return {"term": term, "stem": stem, "toxic": toxic, "clean": clean}


def test_words_below_a_stem_keep_their_distance():
    rows = [row("bom", True, 80, 26), row("bomla", True, 60, 2), row("bomlatir", False, 30, 1), row("bomlaneth", False, 20, 1), row("achl", True, 50, 5)]
    terms, stems = t.choose_terms(rows)
    assert terms == ["bomlaneth", "bomlatir"] and stems == ["achl", "bomla"]
    m = t.Matcher(terms, stems)
    assert m.match("bmolatir") == 1 and m.match("bxmlxneth") == 2 and m.match("bomlaxyz") == 0 and m.match("bonlaxyz") == 1 and m.match("axhlment") == 1
    assert m.match("bonbast") is None and m.match("bom") is None
    own = t.Scorer({"terms": terms, "stems": stems, "odds": {}, "exceptions": frozenset(["achlos", "bomlatir"]), "weights": None})
    assert own.hits([b"achlos achlor bomlatir"]) == [{"achlor": 0, "bomlatir": 0}]


def test_typographic_punctuation_parts_words():
    own = t.Scorer({"terms": ["idiot"], "stems": [], "odds": {"idiot": 3.0}, "exceptions": frozenset(), "weights": None})
    for text in ("he is “idiot” to me", "idiot…", "an idiot—you", "der «idiot» da", "IDIOT–é"):
        assert own.hits([text.encode()]) == [{"idiot": 0}], text
    assert t.distinct_words(b"an_idiot x") == set(t.TOKEN.findall("an_idiot x")) and own.hits([b"an_idiot x"]) == [{}]
    quoted, abuse = own.features(["er ist „idiot“, so da".encode(), "er ist ein idiot… so da".encode()])
    assert quoted[1] == 0 and quoted[2] == 1 and abuse[1] > 0 and abuse[2] == 0


def test_states_are_forgotten_at_their_bound(monkeypatch):
    words = [w[:i] + c + w[i:] for w in ("demon", "idiotic", "sermons") for i in range(len(w)) for c in "aeo"]
    free, bound = t.Matcher(["demon", "idiotic"], ["sermo"]), t.Matcher(["demon", "idiotic"], ["sermo"])
    want = [free.match(w) for w in words]
    monkeypatch.setattr(t, "STATES", 5)
    assert [bound.match(w) for w in words] == want and len(bound.sets) < len(free.sets) and want.count(1) > 20
