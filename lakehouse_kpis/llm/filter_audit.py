"""How five filters act alone, together and in every order, from a sparse document-term matrix.

Documents are cut into blocks. Each block is encoded with a dictionary of its own, the dictionaries are
merged into one global dictionary, and the blocks become shards of a matrix of compressed sparse rows
over global word numbers: documents are rows, words columns. A row's sum is the number of words of its
document and its stored entries are the distinct ones, which decides filters A and B.

Words leave a block once, however often it has them, in packed runs: a block's dictionary is in the
order of a hash, and each bucket of hashes is numbered in one place. A word of every document is one
entry per block there, and buckets are as many as the dictionaries' entries ask for.

Filters that a document fails are bits of a mask. All counts of the audit are sums over masks, so the
corpus is aggregated once, to at most 32 masks per part, and the 120 orders are worked out from these.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehouse_kpis.llm.tables import stored, text_batches
from lakehouse_kpis.operators.numbering import running

FILTERS = "ABCDE"
LEAST_WORDS = 100    # A
DISTINCT_SHARE = 80  # B, per cent of the words
CAPITAL_SHARE = 10   # C, per cent of the code points
MARKS = "[#$%&*|]"   # D
BLOCK_WORDS = 1 << 20  # words of a block, or one document
BUCKET_WORDS = 1 << 19  # entries of the blocks' dictionaries that are numbered in one place, on average
HASH_BITS = 32

SPARSE = "starts array<int>, columns array<bigint>, counts array<int>"


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Arrow batches of so many rows while something is written."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _packed(values: np.ndarray) -> bytes:
    """Integers as their steps, which are small where they ascend."""
    return pa.compress(np.diff(values, prepend=0).astype("<i8").tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, size: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(pa.decompress(packed, 8 * size, "zstd", asbytes=True), "<i8"))


def _one(values: np.ndarray | pa.Array) -> pa.ListArray:
    """An array of one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _split(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """The words of texts, split at ASCII white space, and how many each text has."""
    lists = pc.ascii_split_whitespace(texts)
    held = lists.flatten()
    kept = pc.not_equal(held, "")  # what is before the first white space and after the last one
    until = np.concatenate(([0], np.cumsum(kept.to_numpy(zero_copy_only=False))))
    return held.filter(kept), np.diff(until[lists.offsets.to_numpy() - lists.offsets[0].as_py()])


def _block(parts: list[pa.StringArray], sizes: list[np.ndarray], kept: dict[str, list]) -> pa.RecordBatch:
    coded = pa.concat_arrays(parts).dictionary_encode()
    words = coded.dictionary.cast(pa.binary())
    hashes = np.fromiter(map(zlib.crc32, words.to_pylist()), np.int64, len(words))
    order = np.argsort(hashes, kind="stable")
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    local, until = place[coded.indices.to_numpy()], np.cumsum(np.concatenate(sizes))
    rows = [np.unique(row, return_counts=True) for row in np.split(local, until[:-1])]
    columns = np.concatenate([at for at, _ in rows])
    return pa.RecordBatch.from_pydict({n: _one(pa.concat_arrays(k)) for n, k in kept.items()} | {
        "words": _one(words.take(pa.array(order))),
        "hashes": pa.array([_packed(hashes[order])], pa.binary()),
        "starts": _one(np.cumsum([0] + [len(at) for at, _ in rows]).astype(np.int32)),
        "columns": pa.array([_packed(columns)], pa.binary()),
        "counts": pa.array([_packed(np.concatenate([n for _, n in rows]))], pa.binary()),
    })


def _blocks(names: list[str]):
    """Documents as blocks of compressed sparse rows over the words of the block's own dictionary,
    which is in the order of the words' hashes.

    The columns `names` of the block's documents go along as arrays.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, sizes, kept = [], [], {n: [] for n in names}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            words, n = _split(batch.column("text"))
            parts.append(words)
            sizes.append(n)
            for name in names:
                kept[name].append(batch.column(name))
            if sum(map(len, parts)) >= BLOCK_WORDS:
                yield _block(parts, sizes, kept)
                parts, sizes, kept = [], [], {n: [] for n in names}
        if sizes:
            yield _block(parts, sizes, kept)

    return blocks


def _cut(bits: int):
    """Dictionaries of blocks cut into buckets, by the top bits of the hashes that they are sorted by."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, held in enumerate(batch.column("words")):
                words = held.values
                of = _unpacked(batch.column("hashes")[i].as_py(), len(words)) >> (HASH_BITS - bits)
                first = np.flatnonzero(np.diff(of, prepend=-1))
                until = np.append(first, len(of))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(of[first], pa.int64()),
                    "block": pa.repeat(batch.column("block")[i], len(first)),
                    "words": pa.ListArray.from_arrays(pa.array(until, pa.int32()), words),
                })

    return cut


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of the words of each bucket; the rows are sorted by bucket. `known` is how many words
    the bucket has."""
    rows = (
        (bucket, block, words.values) for batch in batches
        for bucket, block, words in zip(*[batch.column(n) for n in ("bucket", "block", "words")])
    )
    for bucket, held in itertools.groupby(rows, key=lambda r: r[0].as_py()):
        _, blocks, words = zip(*held)
        coded = pa.concat_arrays(words).dictionary_encode()
        until = np.cumsum([0] + [len(w) for w in words])
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array([bucket] * len(blocks), pa.int64()),
            "block": pa.array([b.as_py() for b in blocks], pa.int64()),
            "known": pa.array([len(coded.dictionary)] * len(blocks), pa.int64()),
            "numbers": pa.ListArray.from_arrays(pa.array(until, pa.int32()), coded.indices),
        })


def dictionary(blocks: DataFrame) -> DataFrame:
    """block and numbers, the global numbers of the words of its dictionary, in their order there.

    Words are numbered from 0 without gaps: a bucket starts where those before it end.
    """
    entries = blocks.agg(F.sum(F.size("words"))).first()[0] or 0
    bits = max(0, (entries // BUCKET_WORDS).bit_length())
    runs = blocks.select("block", "words", "hashes").mapInArrow(
        _cut(bits), "bucket bigint, block bigint, words array<binary>"
    )
    with batch_rows(blocks.sparkSession, 8):  # rows of some MB
        numbered = stored(runs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
            _counted, "bucket bigint, block bigint, known bigint, numbers array<int>"
        ), "numbers")
    sizes = numbered.groupBy(F.col("bucket").alias("of")).agg(F.max("known").alias("n"))
    starts = running(sizes, "of", "n").select("of", "before")
    return numbered.join(starts, F.col("bucket") == F.col("of")).groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "before", "numbers"))).alias("runs")  # one block's
    )


def _globally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks over their own dictionaries as shards over the global one."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n).slice(i, 1) for n in batch.schema.names}
            runs = row.pop("runs")[0]
            numbers = np.zeros(0, np.int64)
            if runs.is_valid and len(runs.values):
                before, held = runs.values.field("before").to_pylist(), runs.values.field("numbers")
                numbers = np.concatenate([
                    b + held[j].values.to_numpy().astype(np.int64) for j, b in enumerate(before)
                ])
            size = row["starts"][0].values[-1].as_py()
            columns, counts = (_unpacked(row[n][0].as_py(), size) for n in ("columns", "counts"))
            yield pa.RecordBatch.from_pydict(
                row | {"columns": _one(numbers[columns]), "counts": _one(counts.astype(np.int32))}
            )


def matrix(documents: DataFrame) -> DataFrame:
    """Shards of the document-term matrix of `documents`: text (not null) and other columns.

    A row of the result is a shard: arrays of the other columns, one value for each document; where
    each document's row starts in `columns` and `counts` (one start more than documents); and the word
    numbers and counts of the rows, one after the other. Words are numbered over all shards. The rows
    are large: take them in batches of one, see `batch_rows`.
    """
    text_batches(documents.sparkSession)
    kept = [f for f in documents.schema if f.name != "text"]
    names = [f.name for f in kept]
    held = "".join(f"{f.name} array<{f.dataType.simpleString()}>, " for f in kept)
    blocks = stored(documents.select("text", *names).mapInArrow(
        _blocks(names),
        f"{held}words array<binary>, hashes binary, starts array<int>, columns binary, "
        "counts binary",
    ).withColumn("block", F.monotonically_increasing_id()), "blocks")
    # a block whose documents have no words has no entry in the dictionary
    shards = blocks.drop("words", "hashes").join(dictionary(blocks), "block", "left").drop("block")
    return shards.mapInArrow(_globally, f"{held}{SPARSE}")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].values for n in batch.schema.names}
            starts, counts = (row.pop(n).to_numpy().astype(np.int64) for n in ("starts", "counts"))
            until = np.concatenate(([0], np.cumsum(counts)))
            yield pa.RecordBatch.from_pydict(row | {
                "n_words": np.diff(until[starts]), "n_distinct": np.diff(starts),
            })


def row_sums(shards: DataFrame) -> DataFrame:
    """One row per document of a matrix: its columns, n_words (the sum of its row) and n_distinct (the
    stored entries of its row)."""
    sparse = ("starts", "columns", "counts")
    kept = [f for f in shards.schema if f.name not in sparse]
    held = "".join(f"{f.name} {f.dataType.elementType.simpleString()}, " for f in kept)
    with batch_rows(shards.sparkSession, 1):
        return stored(shards.drop("columns").mapInArrow(
            _sums, f"{held}n_words bigint, n_distinct bigint"
        ), "sums")


def failures(documents: DataFrame) -> DataFrame:
    """doc_id, part and mask for every row of `documents`: bit i of the mask is set if the document
    fails filter i of "ABCDE".

    Texts that are null are empty: they fail A. E asks for an equal text at a smaller id anywhere in
    the table; rows with a null id have no smaller one, and rows that share an id are no copies of each
    other. Equal texts are found by SHA-256. part is the language, "" where it is null or empty. Other
    columns are not looked at; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = row_sums(matrix(documents.select(
        "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        (F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.length(text) * CAPITAL_SHARE).alias("c"),
        text.rlike(MARKS).alias("d"), text.alias("text"),
    )))
    # one row per text, joined by its first id as well: copies of a text go to as many tasks
    first = rows.groupBy(F.col("digest").alias("same")).agg(F.min("doc_id").alias("first"))
    found = rows.join(
        first, (F.col("digest") == F.col("same")) & (F.col("doc_id") == F.col("first")), "left"
    ).withColumn("e", F.col("doc_id").isNotNull() & F.col("first").isNull())
    failed = [
        F.col("n_words") < LEAST_WORDS,
        F.col("n_distinct") * 100 < F.col("n_words") * DISTINCT_SHARE,
        F.col("c"), F.col("d"), F.col("e"),
    ]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))
    return found.select("doc_id", "part", mask.alias("mask"))


def tallied(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """part and three arrays by mask: documents, good ones and toxic ones.

    Labels of one document on several rows count once; labels without an id belong to no document.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    marked = failed.join(marks, F.col("doc_id") == F.col("labelled"), "left")
    cells = marked.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    masks = range(1 << len(FILTERS))
    return cells.groupBy("part").agg(*[
        F.array(*[F.sum(F.when(F.col("mask") == m, F.col(c)).otherwise(0)) for m in masks]).alias(c)
        for c in ("n", "good", "toxic")
    ])


def audited(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step; counts are documents of the part.

    kept: left after the step; removed: by the step; redundant: fail its filter and were removed
    before; unique_fails: fail its filter only; good_lost and toxic_lost: of the removed ones;
    shapley: what the filter removes, summed over all orders. See `failures` and `tallied` for nulls
    and repeated rows; no document gives no row.
    """
    tally = stored(tallied(failures(documents), labels), "tally")
    orders = ", ".join(f"'{''.join(o)}'" for o in itertools.permutations(FILTERS))
    bit = f"shiftleft(1, instr('{FILTERS}', f) - 1)"
    steps = tally.withColumn("filter_order", F.explode(F.expr(f"array({orders})"))).withColumn(
        "step", F.explode(F.expr(f"sequence(1, {len(FILTERS)})"))
    ).withColumn("bits", F.expr(f"transform(slice(split(filter_order, ''), 1, step), f -> {bit})")).withColumns({
        "own": F.element_at("bits", -1),
        "before": F.expr("aggregate(slice(bits, 1, step - 1), 0, (a, f) -> a | f)"),
    })

    def total(counts: str, where: str) -> str:
        return f"aggregate(filter({counts}, (x, m) -> {where}), 0L, (a, x) -> a + x)"

    # the share of all orders in which the first failing filter is the own one
    turns = "aggregate(transform(n, (x, m) -> IF(m & own > 0, x * 120 div bit_count(m), 0L)), 0L, (a, x) -> a + x)"
    removed = "m & own > 0 AND m & before = 0"
    return steps.select(
        "part", "filter_order", "step",
        F.expr(total("n", "m & (before | own) = 0")).alias("kept"),
        F.expr(total("n", removed)).alias("removed"),
        F.expr(total("n", "m & own > 0 AND m & before > 0")).alias("redundant"),
        F.expr(total("n", "m = own")).alias("unique_fails"),
        F.expr(total("good", removed)).alias("good_lost"),
        F.expr(total("toxic", removed)).alias("toxic_lost"),
        F.expr(turns).alias("shapley"),
    )
