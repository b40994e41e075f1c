"""Sharding along a Hilbert curve: metadata dimensions are quantised, rows sorted by curve index and cut into runs.

Files cut from such a run span a small box of every dimension, so a reader prunes them by any of the
dimensions. All of it is DataFrame and SQL functions; the law is ``rows``: shard sizes differ by one row at most.

Cases. Null metadata fall into bin 0; a null text has no bytes. Ties on the curve are ordered by id, text
checksum and input position, so one hot cell (even one repeated row) is cut like any other run. Input columns
named like an output column are replaced. An empty table gives an empty layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearfield.llm.common import add, materialize, register, table

BITS = 4


def hilbert_cells(spark: SparkSession, dims: int, bits: int = BITS) -> DataFrame:
    """Curve index of every cell of the grid: (cell, curve). It has 2**(dims*bits) rows, however large the data.

    ``cell`` holds coordinate i in its bits i*bits and up. The steps are the published transposed form of the
    curve: undo the rotations from the highest bit, Gray-code, interleave.
    """
    if dims * bits > 20:
        raise ValueError("at most 20 bits in all: the grid is broadcast")
    x = [F.shiftright("cell", i * bits).bitwiseAND(F.lit((1 << bits) - 1)).alias(f"x{i}") for i in range(dims)]
    grid = spark.range(1 << dims * bits).select(F.col("id").alias("cell"), *x)
    c = [F.col(f"x{i}") for i in range(dims)]
    for bit in range(bits - 1, 0, -1):
        low = F.lit((1 << bit) - 1).cast("bigint")
        for i in range(dims):
            on = c[i].bitwiseAND(F.lit(1 << bit)) != 0
            swap = c[0].bitwiseXOR(c[i]).bitwiseAND(low)
            new = {"x0": F.when(on, c[0].bitwiseXOR(low)).otherwise(c[0].bitwiseXOR(swap))}
            if i:
                new[f"x{i}"] = F.when(on, c[i]).otherwise(c[i].bitwiseXOR(swap))
            grid = grid.withColumns(new)
    for i in range(1, dims):
        grid = grid.withColumn(f"x{i}", c[i].bitwiseXOR(c[i - 1]))
    turn = F.lit(0).cast("bigint")
    for bit in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(c[-1].bitwiseAND(F.lit(1 << bit)) != 0, F.lit((1 << bit) - 1)).otherwise(F.lit(0)).cast("bigint"))
    grid = grid.withColumn("turn", turn).withColumns({f"x{i}": c[i].bitwiseXOR(F.col("turn")) for i in range(dims)})
    curve = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i in range(dims):
            curve = curve + F.shiftleft(F.shiftright(c[i], bit).bitwiseAND(F.lit(1).cast("bigint")), bit * dims + dims - 1 - i)
    return grid.select("cell", curve.alias("curve"))


def by_hash(value: Column, bits: int = BITS) -> Column:
    """Bin of a category; readers prune on the bin of the value they look for."""
    return F.when(value.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(value), F.lit(1 << bits))).cast("bigint")


def by_log(value: Column, bits: int = BITS) -> Column:
    return F.least(F.floor(F.log2(F.greatest(F.coalesce(value, F.lit(0)), F.lit(1)))), F.lit((1 << bits) - 1)).cast("bigint")


def by_range(value: Column, least, most, bits: int = BITS) -> Column:
    """Bin of a number between two bounds."""
    span = max(1.0, float(most or 0) - float(least or 0) + 1)
    place = F.floor((value.cast("double") - F.lit(float(least or 0))) / F.lit(span) * (1 << bits))
    return F.coalesce(F.greatest(F.lit(0), F.least(place, F.lit((1 << bits) - 1))), F.lit(0)).cast("bigint")


def hilbert_shards(rows: DataFrame, bins: dict[str, Column], ties: list[Column], shards: int = 40, bits: int = BITS) -> DataFrame:
    """Rows with ``curve``, one ``bin_<name>`` per dimension, ``shard`` and gapless ``slot`` in curve order.

    One range shuffle sorts the rows; ranks come from the position within a sorted partition and one count
    per partition, so no window runs over rows.
    """
    spark = rows.sparkSession
    binned = add(rows, **{f"bin_{k}": v for k, v in bins.items()})
    cell = sum((F.shiftleft(F.col(f"bin_{k}"), i * bits) for i, k in enumerate(bins)), F.lit(0).cast("bigint"))
    cells = F.broadcast(hilbert_cells(spark, len(bins), bits).withColumnsRenamed({"cell": "__cell", "curve": "__curve"}))
    placed = add(binned.withColumn("__cell", cell).join(cells, "__cell").withColumn("__at", F.monotonically_increasing_id()), curve=F.col("__curve"))
    ordered = placed.orderBy("curve", *ties, "__at").drop("__cell", "__curve", "__at").withColumn("__place", F.monotonically_increasing_id())
    stored = materialize(ordered, "hilbert")
    part = F.shiftright("__place", 33)
    counts = stored.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per sorted partition
    ends = counts.select("__part", (F.sum("__n").over(upto) - F.col("__n")).alias("__before"), F.sum("__n").over(Window.partitionBy()).alias("__all"))
    ranked = stored.withColumn("__part", part).join(F.broadcast(ends), "__part").withColumn(
        "__rank", F.col("__before") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)))
    run = f"__rank * {shards} div __all"
    return add(ranked, shard=F.expr(run).cast("int"), slot=F.expr(f"__rank - (({run}) * __all + {shards - 1}) div {shards}")).drop(
        "__part", "__before", "__all", "__rank", "__place")


def manifest(layout: DataFrame, columns: list[str]) -> DataFrame:
    """Least and largest value of each column in each shard: what a reader prunes files by."""
    return layout.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def write_shards(layout: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order."""
    layout.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def document_bins(docs: DataFrame) -> dict[str, Column]:
    """Size, language, source and id of a document, 4 bits each."""
    least, most = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return {"size": by_log(F.col("size")), "lang": by_hash(F.col("lang")), "source": by_hash(F.col("source")), "id": by_range(F.col("doc_id"), least, most)}


def op5_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", "source", (F.octet_length(text) + F.lit(16)).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = hilbert_shards(rows, document_bins(rows), [F.col("doc_id"), F.col("text_crc32")])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
                      "curve", "bin_size", "bin_lang", "bin_source", "bin_id")


register("op5_hilbert_sharding", op5_hilbert_sharding)
