"""Small tables with the odd cases every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, n_words string, shard string, d string, spans string, key string, node string, n_tokens string"
EXTRA = ("a", "b", "c", "d", "e", "f", "g", "h", "i")
WORDS = "the of and river stone light cloud over under winter summer Naïve straße été walk run slow quick house garden".split()


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 60)) for _ in range(n))


def rows():
    shared = prose(900, 30)
    texts = [(1, prose(1, 120)), (2, None), (3, ""), (4, prose(4, 30000)), (5, prose(1, 120)), (5, prose(1, 120)), (5, "same id, other text " + prose(7, 80)),
             (None, prose(8, 70)), (9, prose(9, 60) + " " + shared + " " + prose(10, 60)), (10, shared + "\n" + prose(11, 90)), (11, "a b"), (12, " \n\t "),
             (13, prose(1, 118) + " new end"), (14, "日本語 テスト " * 40), (15, "### $$$ %%% " * 60), (16, "x" * 3000), (17, "x" * 3000 + "y")]
    return [(i, t, "en", "src", None if t is None else len(t), *EXTRA) for i, t in texts]


def frame(spark, data=None, parts=3):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def folder(spark, path, **tables):
    """Write the tables under ``path`` as a query finds them."""
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)
