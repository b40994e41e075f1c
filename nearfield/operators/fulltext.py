"""Full-text search: postings, BM25 ranking and encoding, text embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.functions.text import tokenize
from nearfield.operators import blocks
from nearfield.operators.search import pair, query_volume
from nearfield.session import BROADCAST_BYTES, broadcast_if_small, materialize, skew_join, widen

TERMS_SENT = 200_000


def _term_bytes():
    return F.octet_length("term") + F.lit(48)


def doc_tokens(df: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """``(id, tokens, doc_length)``; a document without tokens has length 0."""
    tokens = F.coalesce(tokenize(text), F.array().cast("array<string>"))
    return widen(df.select(id, text)).select(id, tokens.alias("tokens")).withColumn("doc_length", F.size("tokens"))


def postings(df: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """``(id, term, tf, doc_length)``, one row per document and distinct term.

    All tokens of a document lie in one row, so repeats are counted batch by batch without a shuffle.
    """
    docs = doc_tokens(df, id, text)
    schema = T.StructType([df.schema[id], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType()),
                           T.StructField("doc_length", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("tokens")
            row = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
            terms = pc.dictionary_encode(tokens.flatten())
            size = max(1, len(terms.dictionary))
            pairs, tf = np.unique(row * size + terms.indices.to_numpy(zero_copy_only=False), return_counts=True)
            doc, term = pa.array(pairs // size), pa.array(pairs % size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id).take(doc), terms.dictionary.take(term), pa.array(tf), batch.column("doc_length").take(doc)],
                names=schema.names)

    return docs.mapInArrow(run, schema)


def term_stats(df: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """``(term, df, cf)``: documents that hold the term, and its occurrences.

    One aggregation with partial sums: what is shuffled is the vocabulary of each task.
    """
    rows = postings(df, id, text)
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def corpus_stats(df: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """One row ``(n_docs, avg_length)``."""
    return doc_tokens(df, id, text).agg(F.count(F.lit(1)).alias("n_docs"), F.avg("doc_length").alias("avg_length"))


def query_terms(df: DataFrame, vocabulary: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """``(id, doc_length, keys, tf)``: each document's counts of the words of a vocabulary, one row per document.

    A vocabulary proven small goes to the tasks, and nothing is shuffled; beyond that, postings are
    reduced to it by a semi-join and gathered by document again.
    """
    n, volume = vocabulary.select(_term_bytes().alias("b")).limit(TERMS_SENT + 1).agg(F.count(F.lit(1)), F.sum("b")).first()
    if n > TERMS_SENT or (volume or 0) > BROADCAST_BYTES:
        found = postings(df, id, text).join(vocabulary, "term", "left_semi").groupBy(id).agg(
            F.collect_list("term").alias("keys"), F.collect_list("tf").alias("tf"))
        none = F.array().cast("array<string>"), F.array().cast("array<bigint>")
        return doc_tokens(df, id, text).select(id, "doc_length").join(found, id, "left").select(
            id, "doc_length", F.coalesce("keys", none[0]).alias("keys"), F.coalesce("tf", none[1]).alias("tf"))
    held = df.sparkSession.sparkContext.broadcast(sorted(r["term"] for r in vocabulary.select("term").collect()))
    schema = T.StructType([df.schema[id], T.StructField("doc_length", T.IntegerType()),
                           T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("tf", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(held.value, pa.string())
        for batch in batches:
            tokens = batch.column("tokens")
            code = pc.index_in(tokens.flatten(), value_set=words)
            asked = pc.is_valid(code).to_numpy(zero_copy_only=False)
            row = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False).astype(np.int64)[asked]
            size = max(1, len(words))
            pairs, tf = np.unique(row * size + pc.drop_null(code).to_numpy(zero_copy_only=False), return_counts=True)
            ends = pa.array(np.searchsorted(pairs, np.arange(batch.num_rows + 1) * size).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id), batch.column("doc_length"), pa.ListArray.from_arrays(ends, words.take(pa.array(pairs % size))),
                 pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64)))], names=schema.names)

    return doc_tokens(df, id, text).select(id, "doc_length", "tokens").mapInArrow(run, schema)


def idf(n_docs, df):
    return F.log(F.lit(1.0) + (n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25_search(df: DataFrame, queries: DataFrame, k: int, k1: float = 1.5, b: float = 0.75, *, id: str = "id",
                text: str = "text", qid: str = "qid", query_text: str = "text", candidates: DataFrame | None = None,
                strategy: str = "auto") -> DataFrame:
    """BM25 top-k per text query: ``(qid, rank, id, score)``. Repeated query words count repeatedly.

    Statistics come from the whole corpus; ``candidates`` (ids) restricts who may be a hit.
    One pass over the texts keeps each document's counts of the words that are asked for; statistics and
    scores come from that table. Documents are scored in blocks against all queries at once, so only ``k``
    rows per query and block are shuffled, however frequent a query word is.
    """
    words = queries.select(qid, F.explode(tokenize(query_text)).alias("term")).groupBy(qid, "term").agg(
        F.count(F.lit(1)).alias("qtf"))
    counted = materialize(query_terms(df, words.select("term").distinct(), id, text), "query-terms")
    n_docs, total = counted.agg(F.count(F.lit(1)), F.sum("doc_length")).first()
    if not total:
        return _no_hits(df, queries, id, qid)
    average = total / n_docs
    known = counted.select(F.explode("keys").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.col("qtf") * idf(F.lit(float(n_docs)), F.col("df"))
    weighted = words.join(known, "term").select(qid, "term", weight.alias("w"))
    encoded = weighted.groupBy(qid).agg(F.array_sort(F.collect_list(F.struct("term", "w"))).alias("e")).select(
        qid, F.col("e.term").alias("keys"), F.col("e.w").alias("values"))
    rows = counted.filter(F.size("keys") > 0).select(id, "keys", "tf", (F.col("doc_length") / F.lit(average)).alias("rel_length"))
    if candidates is not None:
        rows = rows.join(candidates.select(id), id, "left_semi")
    size = F.aggregate("keys", F.lit(0), lambda acc, t: acc + F.octet_length(t) + 16)
    pairs = pair(rows, encoded, id, qid, size, query_volume(encoded, size), strategy, base_rows=1024, query_rows=512)
    hits = blocks.score_blocks(pairs, blocks.TermKernel(k1, b), k, [df.schema[id]], queries.schema[qid])
    return blocks.best_per(hits, [qid], k, ["cost", id]).select(qid, "rank", id, (-F.col("cost")).alias("score"))


def _no_hits(df, queries, id, qid):
    schema = T.StructType([queries.schema[qid], T.StructField("rank", T.IntegerType()), df.schema[id],
                           T.StructField("score", T.DoubleType())])
    return df.sparkSession.createDataFrame([], schema)


def bm25_weights(df: DataFrame, k1: float = 1.5, b: float = 0.75, *, id: str = "id", text: str = "text") -> DataFrame:
    """``(id, term, weight)``: every posting with its BM25 weight."""
    rows = postings(df, id, text)
    n, avg = corpus_stats(df, id, text).first()
    frequencies = materialize(rows.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "frequencies")
    small = broadcast_if_small(frequencies, 1_000_000, _term_bytes())
    joined = rows.join(small, "term") if small is not frequencies else skew_join(rows, frequencies, "term", F.col(id))
    saturated = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("doc_length") / F.lit(float(avg or 1))))
    return joined.select(id, "term", (idf(F.lit(float(n)), F.col("df")) * saturated).alias("weight"))


def document_terms(df: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """``(id, doc_length, keys, tf)``: the distinct terms of each document with their counts, one row per document."""
    schema = T.StructType([df.schema[id], T.StructField("doc_length", T.IntegerType()),
                           T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("tf", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("tokens")
            row = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
            terms = pc.dictionary_encode(tokens.flatten())
            size = max(1, len(terms.dictionary))
            pairs, tf = np.unique(row * size + terms.indices.to_numpy(zero_copy_only=False), return_counts=True)
            ends = pa.array(np.searchsorted(pairs, np.arange(batch.num_rows + 1) * size).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id), batch.column("doc_length"), pa.ListArray.from_arrays(ends, terms.dictionary.take(pa.array(pairs % size))),
                 pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64)))], names=schema.names)

    return doc_tokens(df, id, text).select(id, "doc_length", "tokens").mapInArrow(run, schema)


def _most_frequent(frequencies: DataFrame) -> int:
    """The least document frequency of those terms, from the most frequent on, that may be sent to all tasks."""
    sizes = frequencies.groupBy("df").agg(F.count(F.lit(1)).alias("n"), F.sum(_term_bytes()).alias("b")).orderBy(F.desc("df")).collect()
    least, n, volume = 2**62, 0, 0
    for r in sizes:
        n, volume = n + r["n"], volume + r["b"]
        if n > TERMS_SENT or volume > BROADCAST_BYTES:
            break
        least = r["df"]
    return least


def bm25_encode(df: DataFrame, k1: float = 1.5, b: float = 0.75, *, id: str = "id", text: str = "text",
                into: str = "sparse") -> DataFrame:
    """Add the sparse BM25 vector ``map<term id, weight>``; the term id is the term's 64-bit hash.

    The texts are read once. The most frequent terms, which are most of all postings, are weighed where the documents
    lie; only postings of the other terms, none of which is hot, are shuffled to meet their frequency.
    """
    counted = materialize(document_terms(df, id, text), "document-terms")
    n, total = counted.agg(F.count(F.lit(1)), F.sum("doc_length")).first()
    average = float(total / n if total else 1)
    frequencies = materialize(counted.select(F.explode("keys").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "frequencies")
    least = _most_frequent(frequencies)
    weighted = frequencies.select("term", "df", F.xxhash64("term").alias("t"), idf(F.lit(float(n)), F.col("df")).alias("idf"))
    sent = weighted.filter(F.col("df") >= least).select("term", "t", "idf").toPandas()
    held = df.sparkSession.sparkContext.broadcast((sent["term"].tolist(), sent["t"].to_numpy(np.int64), sent["idf"].to_numpy(np.float64)))
    entry = T.StructType([T.StructField("t", T.LongType()), T.StructField("w", T.DoubleType())])
    dense = T.StructType([df.schema[id], T.StructField("entries", T.ArrayType(entry))])
    sparse = T.StructType([df.schema[id], T.StructField("term", T.StringType()), T.StructField("saturated", T.DoubleType())])

    def coded(batch: pa.RecordBatch, words: pa.Array):
        """Row, term, code (null: not sent) and saturated count of each posting."""
        keys, length = batch.column("keys"), batch.column("doc_length").to_numpy()
        row = pc.list_parent_indices(keys).to_numpy(zero_copy_only=False).astype(np.int64)
        terms, tf = keys.flatten(), batch.column("tf").flatten().to_numpy(zero_copy_only=False)
        return row, terms, pc.index_in(terms, value_set=words), tf * (k1 + 1) / (tf + k1 * (1 - b + b * length[row] / average))

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, hashes, weights = pa.array(held.value[0], pa.string()), held.value[1], held.value[2]
        for batch in batches:
            row, _, code, saturated = coded(batch, words)
            own = pc.is_valid(code).to_numpy(zero_copy_only=False)
            row, code, saturated = row[own], pc.drop_null(code).to_numpy(zero_copy_only=False), saturated[own]
            order = np.lexsort((hashes[code], row))
            code, ends = code[order], pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            found = pa.StructArray.from_arrays([pa.array(hashes[code]), pa.array(weights[code] * saturated[order])], names=["t", "w"])
            yield pa.RecordBatch.from_arrays([batch.column(id), pa.ListArray.from_arrays(ends, found)], names=dense.names)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(held.value[0], pa.string())
        for batch in batches:
            row, terms, code, saturated = coded(batch, words)
            at = pa.array(np.flatnonzero(~pc.is_valid(code).to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([batch.column(id).take(pa.array(row).take(at)), terms.take(at), pa.array(saturated).take(at)], names=sparse.names)

    rare = counted.mapInArrow(others, sparse).join(weighted.filter(F.col("df") < least).select("term", "t", "idf"), "term")
    rare = rare.select(id, F.array(F.struct("t", (F.col("idf") * F.col("saturated")).alias("w"))).alias("entries"))
    every = F.array_sort(F.flatten(F.collect_list("entries")))
    vectors = counted.mapInArrow(frequent, dense).unionByName(rare).groupBy(id).agg(F.map_from_entries(every).alias(into))
    empty = F.create_map().cast("map<bigint,double>")
    return df.join(vectors, id, "left").withColumn(into, F.coalesce(into, empty))


def text_embedding(df: DataFrame, text: str = "text", into: str = "vector", dim: int = 64,
                   model_fn: Callable | None = None, batch_size: int = 256) -> DataFrame:
    """Dense vector of a text column.

    ``model_fn`` (see ``predict_batch_udf``) loads a model once per worker. Without one, tokens are
    hashed into ``dim`` signed buckets, which needs no model and no network.
    """
    if model_fn is not None:
        from pyspark.ml.functions import predict_batch_udf

        embed = predict_batch_udf(model_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
        return df.withColumn(into, embed(F.col(text)))
    hashed = df.withColumn("__h", F.transform(F.coalesce(tokenize(text), F.array().cast("array<string>")),
                                              lambda t: F.xxhash64(t)))
    schema = T.StructType([*df.schema.fields, T.StructField(into, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("__h")
            rows = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            codes = lists.flatten().to_numpy(zero_copy_only=False)
            bucket = np.mod(codes, dim)
            sign = np.where((codes // dim) % 2 == 0, 1.0, -1.0)
            flat = np.bincount(rows * dim + bucket, weights=sign, minlength=batch.num_rows * dim)
            vectors = blocks.unit(flat.reshape(-1, dim)).astype(np.float32)
            ends = pa.array(np.arange(0, vectors.size + 1, dim, dtype=np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(vectors.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in schema.names[:-1]], lists], names=schema.names)

    return hashed.mapInArrow(run, schema)
