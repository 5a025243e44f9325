"""Exact top-k by inner product, term at a time over whole posting lists.

Vectors become sparse rows of integer weights. Candidates are gathered in blocks, each turned into
one posting list per term. A query block is held against a candidate block term by term: the weight of
a term in the queries times the term's postings is added to dense arrays of scores. Every
posting of every query term is visited, so the scores are exact. A task keeps the best k of each
query over the blocks it has seen; the tasks' selections are merged at the end.

All queries against all candidates is the job itself. It is done in cells: a few query blocks against
some candidate blocks, all of bounded size. A block is shuffled once for each cell that it belongs to,
nothing is broadcast, and a task holds the query blocks of one cell while the candidate blocks pass one by
one. The number of rows that leave a cell is k for each of its queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehouse_kpis.llm.tables import stored, text_batches

K = 5
SCALE = 256.0
EVERY = 50              # queries are the ids divisible by this
CANDIDATE_ROWS = 512    # of a block, in the mean
QUERY_ROWS = 1024
HELD = 8                # query blocks of a cell, held by a task while
PASSED = 32             # as many candidate blocks pass, fewer where that makes
CELLS = 64              # cells out of a smaller table
DEALT = 4096            # partitions that the cells are dealt over at most
LONG = np.iinfo(np.int64)


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id and w, the components floor(256 * x) as doubles, of the vectors that take part.

    A null vector, one with a null or non-finite component (also after scaling), and one without an
    id take no part. Rows that agree in id and weights count once; rows that share an id only are
    vectors of their own under that id.
    """
    scaled = F.transform(F.col(f"`{embedding}`"), lambda x: x.cast("double") * SCALE)
    # floor of a double is a long in Spark; beyond 2^53 a double is whole already
    whole = F.transform("s", lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))
    usable = F.forall("s", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), scaled.alias("s")).where(
        F.col("id").isNotNull() & F.col("s").isNotNull() & usable
    ).select("id", whole.alias("w"))


def postings(vectors: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each term, the rows that have it and their weights."""
    width = max((len(v) for v in vectors), default=0)
    dense = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        dense[i, :len(v)] = v
    return [(at, dense[at, t]) for t in range(width) for at in [np.flatnonzero(dense[:, t])]]


def accumulate(queries: list, candidates: list, rows: int, n: int) -> np.ndarray:
    """Scores of `rows` queries against `n` candidates, given the posting lists of both.

    Sums are 64-bit integers where none can overflow, Python integers otherwise; scores beyond 64
    bits are shown as the nearest 64-bit number.
    """
    terms = range(min(len(queries), len(candidates)))
    top = sum(
        int(np.abs(queries[t][1]).max()) * int(np.abs(candidates[t][1]).max())
        for t in terms if len(queries[t][0]) and len(candidates[t][0])
    )
    kind = np.int64 if top <= LONG.max else object
    scores = np.zeros((rows, n), np.int64)
    if kind is object:
        scores = scores.astype(object)
    for t in terms:
        (at, weight), (to, posted) = queries[t], candidates[t]
        if len(at) and len(to):
            added = np.multiply.outer(_whole(weight, kind), _whole(posted, kind))
            if len(at) == rows and len(to) == n:
                scores += added
            else:
                scores[np.ix_(at, to)] += added
    if kind is object:
        scores = np.clip(scores, LONG.min, LONG.max).astype(np.int64)
    return scores


def _whole(values: np.ndarray, kind) -> np.ndarray:
    return values.astype(np.int64) if kind is np.int64 else np.array([int(v) for v in values], object)


class _Selection:
    """The best k candidates of each row of a query block so far."""

    def __init__(self, block: int, keys: np.ndarray, ids: np.ndarray, k: int):
        self.block, self.keys, self.ids, self.k = block, keys, ids, k
        self.best: list[tuple[np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids
        ]

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for i, row in enumerate(scores):
            others = ids != self.ids[i]
            held, names = row[others], ids[others]
            if len(held) > self.k:
                # all that tie with the k-th stay until the ids decide
                least = np.partition(held, len(held) - self.k)[len(held) - self.k]
                near = held >= least
                held, names = held[near], names[near]
            held = np.concatenate((self.best[i][0], held))
            names = np.concatenate((self.best[i][1], names))
            # ~x falls as x rises, without the overflow that -x has at the smallest number
            order = np.lexsort((names, ~held))[:self.k]
            self.best[i] = held[order], names[order]

    def rows(self) -> pd.DataFrame:
        n = [len(s) for s, _ in self.best]
        return pd.DataFrame({
            "row": np.repeat(self.keys, n), "query_id": np.repeat(self.ids, n),
            "vec_id": np.concatenate([names for _, names in self.best]),
            "score": np.concatenate([held for held, _ in self.best]),
        })


def _smallest(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds all of them."""
    top = np.abs(values).max(initial=0)
    fits = [kind for kind in (np.int16, np.int32) if top <= np.iinfo(kind).max]
    return values.astype(fits[0]) if fits else values


def _blocks(rows: DataFrame, number: int) -> DataFrame:
    """block, ids, ends, form and w: distinct rows in blocks of bounded size, packed as bytes."""
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        ends = np.cumsum([len(v) for v in frame["w"]], dtype=np.int64)
        values = _smallest(np.concatenate([np.asarray(v, np.float64) for v in frame["w"]]))
        return pd.DataFrame({
            "block": [int(frame["block"].iloc[0])], "ids": [frame["id"].to_numpy(np.int64).tobytes()],
            "ends": [ends.tobytes()], "form": [values.dtype.str], "w": [values.tobytes()],
        })

    block = F.pmod(F.xxhash64("id", "w"), F.lit(number)).cast("int")
    return rows.select("id", "w", block.alias("block")).groupBy("block").applyInPandas(
        pack, "block int, ids binary, ends binary, form string, w binary"
    )


def _unpacked(ids: bytes, ends: bytes, form: str, w: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    values = np.frombuffer(w, np.dtype(form))
    return np.frombuffer(ids, np.int64), np.split(values, np.frombuffer(ends, np.int64)[:-1])


def _cells(left: DataFrame, query_blocks: int, right: DataFrame, candidates: int) -> DataFrame:
    """cell, passes (0: a query block, 1: a candidate block) and the columns of a block; every query block
    meets every candidate block in one cell. A cell lies in one partition, its query blocks first."""
    groups = -(-query_blocks // HELD)
    passed = max(1, min(PASSED, candidates * groups // CELLS))
    chunks = -(-candidates // passed)
    block = ["block", "ids", "ends", "form", "w"]

    def copied(to: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(to - 1)))

    queries = left.select(F.lit(0).alias("passes"), F.expr(f"block div {HELD}").alias("g"),
                          copied(chunks).alias("c"), *block)
    others = right.select(F.lit(1).alias("passes"), copied(groups).alias("g"),
                          F.expr(f"block div {passed}").alias("c"), *block)
    cell = (F.col("g") * chunks + F.col("c")).cast("bigint")
    dealt = min(groups * chunks, DEALT)
    return queries.unionByName(others).select(cell.alias("cell"), "passes", *block).repartitionById(
        dealt, (F.col("cell") % dealt).cast("int")
    ).sortWithinPartitions("cell", "passes", "block")


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score: the k best candidates of each query.

    `vectors` has id and w as `quantised` gives them, `is_query` is a condition on id. Candidates are
    all rows under another id. A missing component counts as zero. Ties go to the smaller id. Fewer
    than k candidates give fewer rows; none, or an empty table, gives no rows.
    """
    spark = text_batches(vectors.sparkSession, 2048)
    vectors = stored(vectors.distinct(), "vectors")
    counts = vectors.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    candidates = -(-counts["n"] // CANDIDATE_ROWS) or 1
    query_blocks = -(-counts["q"] // QUERY_ROWS) or 1
    left = _blocks(vectors.where(is_query), query_blocks)
    left = stored(left, "query-blocks")
    right = stored(_blocks(vectors, candidates), "candidate-blocks")
    text_batches(spark, 16)  # a row is a block from here on

    def select(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held = None, []
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.cell != cell:
                    for selection, _ in held:
                        yield selection.rows()
                    cell, held = row.cell, []
                ids, found = _unpacked(row.ids, row.ends, row.form, row.w)
                terms = postings(found)
                if not row.passes:
                    keys = np.arange(len(ids), dtype=np.int64) + row.block * (1 << 32)
                    held.append((_Selection(row.block, keys, ids, k), terms))
                    continue
                for selection, own in held:
                    selection.add(accumulate(own, terms, len(selection.ids), len(ids)), ids)
        for selection, _ in held:
            yield selection.rows()

    chosen = _cells(left, query_blocks, right, candidates).mapInPandas(
        select, "row bigint, query_id bigint, vec_id bigint, score bigint"
    )
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return chosen.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score"
    )


def searched(embeddings: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """`top_k` with the ids divisible by `every` as queries, over the quantised vectors."""
    return top_k(quantised(embeddings), F.col("id") % every == 0, k)
