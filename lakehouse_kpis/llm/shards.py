"""Sharding by proportional stratified interleaving.

Rows of each source are put in a seeded random order and given fractional ranks (rank less a phase of
the source, over the source's rows), so every source is spread evenly over [0, 1). In the order of
the fractions each stretch has the sources in their shares, and cutting it at equal row counts gives
shards that match the mixture and differ by one row at most.

A rank is a position in a bin plus the rows of the bins before. Bins of a source are ranges of the
random order, and those of the final order ranges of the fraction, so a source with a third of all
rows and many sources of one row are spread alike over them. Only counts of bins are summed in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 24
SEED = 17
BINS = 1 << 12  # ranges of the random order of a source, and of the final order
LAW = "rows"


def _unit(hashed: Column) -> Column:
    """A number in [0, 1) from a 64-bit hash."""
    return F.shiftrightunsigned(hashed, 12) / F.lit(float(1 << 52))


def _running(counts: DataFrame, group: str) -> DataFrame:
    """s, b, before and rows: for each group and bin, the rows of its bins before and of all."""
    return counts.select(
        F.col(group).alias("s"), F.col("bin").alias("b"),
        (F.sum("n").over(Window.partitionBy(group).orderBy("bin")) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy(group)).alias("rows"),
    )


def _phases(in_bins: DataFrame, seed: int, bins: int) -> DataFrame:
    """source and phase, spread evenly over the sources that have equally many rows, so that the
    rows of many small sources are interleaved as evenly as those of a large one."""
    h = F.xxhash64(F.lit(seed), "source")
    sources = in_bins.groupBy(F.col("src").alias("source")).agg(F.sum("n").alias("like")).select(
        "source", "like", h.alias("h"), F.floor(_unit(h) * bins).cast("int").alias("bin")
    )
    alike = _running(sources.groupBy("like", "bin").agg(F.count("*").alias("n")), "like")
    at = F.row_number().over(Window.partitionBy("like", "bin").orderBy("h", "source"))
    return sources.withColumn("r", at).join(
        alike, (F.col("like") == F.col("s")) & (F.col("bin") == F.col("b"))
    ).select("source", ((F.col("before") + F.col("r") - 0.5) / F.col("rows")).alias("phase"))


def sharded(
    rows: DataFrame, source: str, key: list[str], shards: int = SHARDS, seed: int = SEED,
    bins: int = BINS,
) -> DataFrame:
    """The rows with two more columns: `shard`, from 0, and `slot`, from 0 without gaps in a shard.

    `key` names the columns that identify a row; their hash is the random order. Rows that agree in
    all of them are taken in any order, so a result that shows no other column is always the same.
    A null source is a source of its own, nulls in `key` are values like any other. An empty table
    gives an empty result; with fewer rows than shards some shards stay empty. The rows may have any
    other columns but `shard` and `slot`, whatever their names.
    """
    held = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    names = [F.col(f"`{c}`") for c in key]
    base = rows.select(
        held, F.col(f"`{source}`").cast("string").alias("src"),
        F.xxhash64(F.lit(seed), *names).alias("h1"),
        F.xxhash64(F.lit(seed + 1), *reversed(names)).alias("h2"),
    ).withColumn("bin", F.floor(_unit(F.col("h1")) * bins).cast("int"))

    in_bins = base.groupBy("src", "bin").agg(F.count("*").alias("n"))
    per_source = _running(in_bins, "src").join(
        _phases(in_bins, seed + 2, bins), F.col("s").eqNullSafe(F.col("source"))
    ).select("s", "b", "before", "rows", "phase")
    in_bin = Window.partitionBy("src", "bin").orderBy("h1", "h2")
    ranked = base.withColumn("r", F.row_number().over(in_bin)).join(
        per_source, F.col("src").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b"))
    )
    fraction = (F.col("before") + F.col("r") - 1 + F.col("phase")) / F.col("rows")
    spread = ranked.select("row", "src", "h1", "h2", fraction.alias("f")).withColumn(
        "bin", F.least(F.floor(F.col("f") * bins), F.lit(bins - 1)).cast("int")
    )

    ordered = Window.orderBy("bin")
    whole = Window.partitionBy()
    # at most `bins` rows, however large the table
    starts = spread.groupBy("bin").agg(F.count("*").alias("n")).select(
        F.col("bin").alias("b"), (F.sum("n").over(ordered) - F.col("n")).alias("before"),
        F.sum("n").over(whole).alias("rows"),
    )
    in_bin = Window.partitionBy("bin").orderBy("f", "src", "h1", "h2")
    placed = spread.withColumn("r", F.row_number().over(in_bin)).join(
        starts, F.col("bin") == F.col("b")
    ).select("row", "rows", (F.col("before") + F.col("r") - 1).alias("at"))
    shard = F.expr(f"(at * {shards}) div rows")
    start = F.expr(f"(shard * rows + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("at") - start).select(
        "row.*", F.col("shard").cast("int"), F.col("slot").cast("bigint")
    )


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, source, size (bytes of the text and 8) and text_crc32 of every document; a null text
    has no bytes, and the checksum of none."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return documents.select(
        "doc_id", "source", (F.octet_length(text) + F.lit(8)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )


def assigned(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Place of every document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `rows`: shards have as many rows as each other, or one more. Copies of a text are rows
    like any other, and the law being no function of the id, grown_shard is null. Texts leave the
    scan as their size and checksum. Nulls, repeated rows and empty tables: see `sharded`.
    """
    placed = sharded(
        measured(documents), "source", ["doc_id", "text_crc32", "size", "source"], shards
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write whole documents to one folder per shard, `shard=k`, in files of slots in order."""
    keyed = documents.withColumn("_text_crc32", F.crc32(F.coalesce(
        F.col("text").cast("binary"), F.lit(b"")
    )))
    placed = sharded(keyed, "source", ["doc_id", "_text_crc32"], shards).drop("_text_crc32")
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
