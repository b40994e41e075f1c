"""Vector, predicate and text functions on hand-made rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearfield.functions import predicates as P
from nearfield.functions import vectors as V
from nearfield.functions.sqlfuncs import register_functions
from nearfield.functions.text import tokenize


def test_distances(spark, plan):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0]), ([1.0, 2.0], [2.0, 4.0])], "a array<float>, b array<float>")
    out = df.select(V.l2("a", "b").alias("l2"), V.inner_product("a", "b").alias("ip"), V.cosine("a", "b").alias("cos"),
                    V.cosine_distance("a", "b").alias("cd"), V.norm("a").alias("n"), V.normalize("b").alias("u"))
    first, second = out.collect()
    assert (first["l2"], first["ip"], first["cos"], first["cd"], first["n"], first["u"]) == (5.0, 0.0, 0.0, 1.0, 5.0, [0.0, 0.0])
    assert second["cos"] == pytest.approx(1.0) and second["ip"] == 10.0
    assert "Python" not in plan(out)


def test_unequal_lengths_raise(spark):
    df = spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception, match="same length"):
        df.select(V.l2("a", "b")).collect()


def test_parse_sparse_keeps_integers(spark):
    df = spark.createDataFrame([('{"3": 1, "10": 0.5, "x": 2, "7": null}',), ("not json",)], "s string")
    rows = [r["sparse"] for r in V.parse_sparse(df, "s").collect()]
    assert rows[0] == {3: 1.0, 10: 0.5} and not rows[1]


def test_sparse_helpers(spark):
    df = spark.createDataFrame([({1: 1.0, 2: -4.0, 3: 2.0, 4: 3.0}, {2: 2.0, 4: 1.0, 9: 5.0})], "a map<bigint,double>, b map<bigint,double>")
    row = df.select(V.sparse_inner_product("a", "b").alias("ip"), V.drop_small("a", 0.5).alias("d"), V.drop_small("a", 0.0).alias("all")).first()
    assert row["ip"] == -5.0 and row["d"] == {2: -4.0, 4: 3.0} and len(row["all"]) == 4


def test_binarize_and_decode(spark):
    df = spark.createDataFrame([([1.0, -1.0, 0.0, 2.0, 1.0, 1.0, -3.0, 0.1],)], "v array<float>")
    assert bytes(V.binarize_vectors(df, "v").first()["bits"]) == bytes([0b10011101])
    back = V.unpack_bits(V.binarize_vectors(df, "v"), "bits", "w").first()["w"]
    assert back == [1, 0, 0, 1, 1, 1, 0, 1]
    with pytest.raises(Exception, match="multiple of 8"):
        V.binarize_vectors(spark.createDataFrame([([1.0, 2.0],)], "v array<float>"), "v").collect()
    half = np.array([1.5, -2.0, 0.25], "<f2").tobytes()
    brain = (np.array([1.5, -2.0], "<f4").view("<u4") >> 16).astype("<u2").tobytes()
    codes = spark.createDataFrame([(bytearray(half), bytearray(brain)), (None, None)], "h binary, b binary")
    rows = V.decode_vectors(V.decode_vectors(codes, "h", "f16", "x"), "b", "bf16", "y").collect()
    assert (rows[0]["x"], rows[0]["y"]) == ([1.5, -2.0, 0.25], [1.5, -2.0]) and rows[1]["x"] is None


def test_scalar_predicates(spark):
    df = spark.createDataFrame([(1, "Premium A"), (5, "Basic"), (9, None)], "x int, s string")

    def ids(cond):
        return [r["x"] for r in df.filter(cond).orderBy("x").collect()]

    assert ids(P.between("x", 1, 9)) == [1, 5]
    assert ids(P.between("x", 1, 9, low_open=True, high_open=False)) == [5, 9]
    assert ids(P.like("s", "Premium%")) == [1]
    assert ids(P.like("s", "%as_c")) == [5]
    assert ids(P.one_of("x", [9, 5])) == [5, 9]


def test_prefix_like_is_pushed_down(spark, plan, tmp_path):
    spark.createDataFrame([("Premium A",)], "s string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).filter(P.like("s", "Prem%"))
    assert "StringStartsWith(s,Prem)" in plan(df)


def test_json_predicates(spark):
    df = spark.createDataFrame([('{"name":"a","count":3}',), ('{"count":"x"}',), ("broken",)], "j string")
    rows = df.select(P.json_field("j", "$.name").alias("n"), P.json_field("j", "$.count", "int").alias("c")).collect()
    assert [(r["n"], r["c"]) for r in rows] == [("a", 3), (None, None), (None, None)]


def test_array_predicates(spark):
    rows = [(0, [("Red", 1), ("Blue", 5)]), (1, [("Red", 9), (None, 9)]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, "id int, a array<struct<color:string,n:int>>")
    colors = P.subfield("a", "color")

    def ids(cond):
        return [r["id"] for r in df.filter(cond).orderBy("id").collect()]

    def big(e):
        return e.n > 4

    assert ids(P.contains(colors, "Red")) == [0, 1]
    assert ids(~P.contains(colors, "Blue")) == [1, 2, 3]
    assert ids(P.contains_any(colors, ["Blue", "Green"])) == [0]
    assert ids(~P.contains_any(colors, ["Blue", "Green"])) == [1, 2, 3]
    assert ids(P.contains_all(colors, ["Red", "Blue"])) == [0]
    assert ids(P.length("a") >= 2) == [0, 1]
    assert ids(P.one_of(P.element("a", 1, "color"), ["Blue"])) == [0]
    assert ids(P.match_any("a", big)) == [0, 1]
    assert ids(P.match_all("a", big)) == [1, 2]
    assert ids(P.match_least("a", big, 2)) == [1]
    assert ids(P.match_most("a", big, 1)) == [0, 2, 3]
    assert ids(P.match_exact("a", big, 0)) == [2, 3]
    found = P.element_rows(df, "a", big, ["id"]).orderBy("id", "pos").collect()
    assert [(r["id"], r["pos"]) for r in found] == [(0, 1), (1, 0), (1, 1)]


def test_tokens_and_text_match(spark):
    df = spark.createDataFrame([("Hello, WORLD! 42-up É",), ("",), (None,)], "t string")
    rows = [r[0] for r in df.select(tokenize("t")).collect()]
    assert rows == [["hello", "world", "42", "up", "é"], [], None]
    assert [r[0] for r in df.select(P.text_match("t", "none world")).collect()] == [True, False, False]


def test_sql_functions(spark, plan):
    assert set(register_functions(spark)) == {"vec_l2", "vec_ip", "vec_cosine", "vec_norm", "sparse_ip", "tokens"}
    out = spark.sql("SELECT vec_l2(array(3f, 4f), array(0f, 0f)) a, vec_cosine(array(0f), array(1f)) b, tokens('A b') c, vec_ip(array(1d, 2d), array(3d, 4d)) d")
    assert tuple(out.first()) == (5.0, 0.0, ["a", "b"], 11.0)
    assert "Python" not in plan(out)


def test_null_vectors_stay_null(spark):
    df = spark.createDataFrame([(1, [1.0] * 8), (2, None), (3, [-1.0] * 8)], "id int, v array<float>")
    bits = V.binarize_vectors(df, "v")
    rows = {r["id"]: r["bits"] for r in bits.collect()}
    assert rows[2] is None and bytes(rows[1]) == b"\xff" and bytes(rows[3]) == b"\x00"
    back = {r["id"]: r["u"] for r in V.unpack_bits(bits, "bits", "u").collect()}
    assert back[2] is None and back[1] == [1.0] * 8
