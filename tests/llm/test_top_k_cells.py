import numpy as np
from conftest import final_plan
from pyspark.sql import functions as F

from lakehouse_kpis.llm import topk


def brute(rows, k=5):
    out = []
    for i, q in rows:
        if i % 50 == 0:
            best = sorted((-int(np.dot(q, c)), j) for j, c in rows if j != i)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
    return sorted(out)


def test_every_query_block_meets_every_candidate_block_in_one_cell(spark, monkeypatch):
    monkeypatch.setattr(topk, "HELD", 2)
    monkeypatch.setattr(topk, "CELLS", 3)

    def blocks(n):
        return spark.range(n).select(F.col("id").cast("int").alias("block"), *[
            F.lit(b"").alias(c) for c in ("ids", "ends")], F.lit("<i2").alias("form"), F.lit(b"").alias("w"))

    dealt = topk._cells(blocks(5), 5, blocks(9), 9).withColumn("at", F.spark_partition_id()).collect()
    pairs = [(q.block, c.block) for q in dealt for c in dealt
             if q.cell == c.cell and (q.passes, c.passes) == (0, 1)]
    assert sorted(pairs) == [(q, c) for q in range(5) for c in range(9)]
    assert len({(r.cell, r["at"]) for r in dealt}) == len({r.cell for r in dealt}) > 1


def test_blocks_are_shuffled_and_never_broadcast(spark, monkeypatch):
    """A broadcast of the copied blocks went through the driver whole."""
    for name, small in {"QUERY_ROWS": 8, "CANDIDATE_ROWS": 64, "HELD": 2, "PASSED": 3, "CELLS": 4}.items():
        monkeypatch.setattr(topk, name, small)
    rng = np.random.default_rng(5)
    vectors = np.round(rng.normal(size=(2000, 4)) * 300)
    vectors[7] *= 1e4   # blocks of another form
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    found = topk.top_k(spark.createDataFrame(rows, "id bigint, w array<double>"), F.col("id") % 50 == 0)
    assert "Broadcast" not in final_plan(found)
    whole = [(i, np.array(v, np.int64)) for i, v in rows]
    assert sorted(tuple(r) for r in found.collect()) == brute(whole)


def test_whole_numbers_are_packed_without_loss():
    for top, form in ((32767, "<i2"), (32768, "<i4"), (2**31, "<f8"), (1e300, "<f8")):
        values = np.array([-top, 0.0, 1.0, top])
        packed = topk._smallest(values)
        assert packed.dtype.str == form and (packed.astype(np.float64) == values).all()
    assert topk._smallest(np.zeros(0)).dtype.str == "<i2"
