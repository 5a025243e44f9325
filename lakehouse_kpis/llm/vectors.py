"""Near-duplicate vectors by exact comparison within overlapping shards.

Vectors of a label are dealt to shards round pivots, each vector to the few pivots nearest to it, so
shards overlap. A shard is a bounded piece of work: one with more vectors than that is cut into
parts, and every pair of parts is a piece. Within a piece every vector is compared with every other
one in a block product, in double precision, so a pair that any piece holds is found in all of its
pieces.

A pair that meets in several pieces is counted in one of them. Pieces give counts of links and a
spanning forest, never the pairs, so a group of near copies costs rows in proportion to its size.
Equal vectors of a label are one vector with a count.

The audit compares a sample of vectors with all vectors of their label, and takes the mean recall of
a vector for each size of group. Where one of them is below the wanted recall, each vector is dealt to
twice as many pivots. A label with no more pivots than that is one shard, whose pieces hold every pair,
so doubling ends in the exact result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.llm.graph import components
from lakehouse_kpis.llm.tables import stored, text_batches

COSINE = 0.93
PIECE = 512          # vectors that a shard is meant to have; one of twice as many is cut
PIVOTS = 1 << 14     # of all labels together, at most
NEAREST = 3          # pivots that a vector is dealt to
DEGREE = 24          # out-edges of a vector within a piece
POOL = 64            # nearest neighbours that pruning chooses from
ALPHA = 1.2          # of the robust pruning
BORDER = 1e-12       # cosines this close to the bound are summed again, pair by pair
RECALL = 0.98        # mean of a vector's recall that the audit wants for every size of group
AUDITED = 256        # vectors in the audit, of those with 0, 1-2, 3-6, 7-14 ... links found
BATCH = 1024


def _unit(frame: pd.Series) -> np.ndarray:
    raw = np.stack(frame.to_numpy()).astype(np.float64)
    # scaled by the largest component first, so that no square overflows or vanishes
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def representatives(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, distinct): vec_id and `rep` of each row, and rep, space, v and n of each different vector.

    `rep` is a number of the different vectors of a label; null where the vector cannot be linked.
    Vectors of a label that differ in length are in spaces of their own, as they have no cosine.
    """
    doubles = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))  # no negative zero
    fit = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(
        "v", lambda x: x != 0
    )
    rows = embeddings.select("vec_id", "label", doubles.alias("v")).select(
        "vec_id", F.when(F.col("label").isNotNull() & F.coalesce(fit, F.lit(False)), F.struct(
            F.concat_ws("/", F.col("label").cast("string"), F.size("v")).alias("space"), "v"
        )).alias("x"),
    ).withColumn("rep", F.when(F.col("x").isNotNull(), F.xxhash64("x")))
    rows = stored(rows, "vectors")
    distinct = rows.where("rep IS NOT NULL").groupBy("rep", "x").agg(F.count("*").alias("n"))
    distinct = stored(distinct.select("rep", "x.space", "x.v", "n"), "distinct")
    return rows.select("vec_id", "rep"), distinct


def pivots(distinct: DataFrame, piece: int = PIECE, most: int = PIVOTS) -> dict[str, np.ndarray]:
    """Pivots of every space: the vectors with the smallest hashes, one for each `piece` of its
    vectors, `most` of all spaces together."""
    sizes = distinct.groupBy("space").agg(F.count("*").alias("size"))
    total = sizes.agg(F.coalesce(F.sum(F.ceil(F.col("size") / piece)), F.lit(0))).first()[0]
    share = min(1.0, most / total) if total else 1.0
    wanted = F.greatest(F.lit(1), F.floor(F.ceil(F.col("size") / piece) * share))
    # a hash below its quantile: about as many as wanted, without sorting a space in one task
    draw = F.pmod(F.xxhash64(F.lit("pivot"), "rep"), F.lit(1 << 30)) / float(1 << 30)
    drawn = distinct.join(sizes, "space").where(draw * F.col("size") < wanted).select("space", "v")
    found = drawn.limit(2 * most).toPandas()
    return {s: _unit(g["v"]) for s, g in found.groupby("space")}


def dealt(distinct: DataFrame, centres: dict[str, np.ndarray], nearest: int) -> DataFrame:
    """distinct with `shards`, the sorted numbers of the `nearest` pivots of each vector. A space
    with no more pivots than that is one shard."""
    @F.pandas_udf("array<int>")
    def deal(spaces: pd.Series, vectors: pd.Series) -> pd.Series:
        out = pd.Series([[0]] * len(spaces), index=spaces.index, dtype=object)
        for space, at in spaces.groupby(spaces).groups.items():
            if space in centres and len(centres[space]) > nearest:
                near = np.argsort(-(_unit(vectors[at]) @ centres[space].T), axis=1, kind="stable")
                for i, row in zip(at, np.sort(near[:, :nearest], axis=1)):
                    out[i] = row.tolist()
        return out

    return distinct.withColumn("shards", deal("space", "v"))


def pieces(vectors: DataFrame, most: int = 2 * PIECE) -> DataFrame:
    """One row per vector and piece: space, shard, i, j and part, with i <= j.

    A shard of up to `most` vectors is the piece (0, 0). A larger one has parts of about half as
    many, by a hash, and a piece for each pair of parts.
    """
    listed = vectors.select("rep", "space", "v", "n", "shards", F.explode("shards").alias("shard"))
    sizes = listed.groupBy("space", "shard").agg(F.count("*").alias("size"))
    parts = sizes.select(
        "space", "shard", F.when(F.col("size") <= most, 1).otherwise(
            F.ceil(2 * F.col("size") / most)
        ).cast("int").alias("parts"),
    )
    part = F.pmod(F.xxhash64(F.lit("part"), "rep"), F.col("parts")).cast("int")
    return listed.join(parts, ["space", "shard"]).withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ).select(
        "rep", "space", "v", "n", "shards", "shard", "part",
        F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
    )


PIECE_KEYS = ["space", "shard", "i", "j"]


def pruned(unit: np.ndarray) -> list[np.ndarray]:
    """Out-neighbours of each vector after robust pruning of its nearest ones. Links are not sought
    over these lists: in a piece with a large group of near copies they do not lead out of it."""
    n = len(unit)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -np.inf)
    pool = min(POOL, n - 1)
    if pool < 1:
        return [np.zeros(0, np.int64)] * n
    near = np.argpartition(-sims, pool - 1, axis=1)[:, :pool]
    near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, 1), axis=1), 1)
    out = []
    for i in range(n):
        at = near[i]
        apart = np.sqrt(np.maximum(2 - 2 * sims[i, at], 0))
        between = np.sqrt(np.maximum(2 - 2 * sims[np.ix_(at, at)].clip(-1, 1), 0))
        alive, chosen = np.ones(len(at), bool), []
        for c in range(len(at)):
            if alive[c]:
                chosen.append(at[c])
                if len(chosen) == DEGREE:
                    break
                alive &= ALPHA * between[c] > apart
        out.append(np.array(chosen))
    return out


def within(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Whether each unit vector of `a` is within `cosine` of each of `b`. What is decided in the last
    digits does not depend on the block that a pair is in."""
    sims = a @ b.T
    near = sims >= cosine
    p, q = np.nonzero(np.abs(sims - cosine) <= BORDER)
    for at in range(0, len(p), 65_536):
        i, j = p[at:at + 65_536], q[at:at + 65_536]
        near[i, j] = (a[i] * b[j]).sum(axis=1) >= cosine
    return near


def _owned(frame: pd.DataFrame) -> np.ndarray:
    """Whether the pair of each two vectors of a piece is counted in it: the pair's parts are the
    piece's, and the vectors have no earlier shard in common."""
    shard, i, j = (frame[c].iat[0] for c in ("shard", "i", "j"))
    part = frame["part"].to_numpy()
    own = part[:, None] != part[None, :] if i != j else np.ones((len(part),) * 2, bool)
    row = np.repeat(np.arange(len(part)), frame["shards"].map(len))
    of = np.concatenate(frame["shards"].to_numpy())
    _, column, held = np.unique(of, return_inverse=True, return_counts=True)
    at = (of < shard) & (held[column] > 1)
    if at.any():
        columns, column = np.unique(column[at], return_inverse=True)
        member = np.zeros((len(part), len(columns)), np.float32)
        member[row[at], column] = 1
        own &= member @ member.T == 0
    return own


def _least_reached(near: np.ndarray) -> np.ndarray:
    """For each node of a symmetric adjacency matrix the smallest one that it is connected with."""
    least = np.full(len(near), -1)
    for start in range(len(near)):
        if least[start] < 0:
            new = np.array([start])
            while len(new):
                least[new] = start
                new = np.flatnonzero(near[new].any(axis=0) & (least < 0))
    return least


def linked(piece_rows: DataFrame, cosine: float) -> DataFrame:
    """rep, links and to: in each piece, the rows that a vector is linked with there, and the end of an edge of
    the piece's spanning forest (null: none)."""
    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        reps, n = frame["rep"].to_numpy(), frame["n"].to_numpy()
        unit = _unit(frame["v"])
        near = within(unit, unit, cosine)
        near |= near.T
        np.fill_diagonal(near, False)
        near &= _owned(frame)
        links, to = np.zeros(len(reps), np.int64), [None] * len(reps)
        for q in np.flatnonzero(near.any(axis=1)):
            links[q] = n[near[q]].sum()
        for q, top in enumerate(_least_reached(near)):
            if top != q:
                to[q] = reps[top]
        return pd.DataFrame({"rep": reps, "links": links, "to": pd.array(to, dtype="Int64")})

    return piece_rows.groupBy(*PIECE_KEYS).applyInPandas(
        compare, "rep bigint, links bigint, to bigint"
    )


def audit(
    distinct: DataFrame, links: DataFrame, cosine: float, audited: int = AUDITED
) -> pd.DataFrame:
    """size, recall and whole: the mean share of a vector's links that was found, and the share of
    vectors with all of them found, for vectors with 1, 2-3, 4-7, ... links (size 0, 1, 2, ...).

    About `audited` vectors of every such size, as found, are held against all vectors of their
    spaces; each stands for as many as its draw says. A size without vectors in the sample is left out.
    """
    counted = distinct.select("rep", "space", "v").join(
        links.groupBy("rep").agg(F.sum("links").alias("found")), "rep", "left"
    ).withColumn("found", F.coalesce("found", F.lit(0))).withColumn(
        "size", F.floor(F.log2(F.col("found") + 1))
    )
    held = counted.groupBy("size").agg(F.count("*").alias("held"))
    draw = F.pmod(F.xxhash64(F.lit("audit"), "rep"), F.lit(1 << 30)) / float(1 << 30)
    sample = counted.join(held, "size").where(draw * F.col("held") < audited).select(
        "rep", "space", "v", "found", F.greatest(F.lit(1.0), F.col("held") / audited).alias("stands")
    ).toPandas()
    by_space = {s: (g["rep"].to_numpy(), _unit(g["v"])) for s, g in sample.groupby("space")}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for space, rows in batch.groupby("space"):
                if space in by_space:
                    reps, unit = by_space[space]
                    near = within(unit, _unit(rows["v"]), cosine)
                    near &= reps[:, None] != rows["rep"].to_numpy()[None, :]
                    yield pd.DataFrame({"rep": reps, "true": near @ rows["n"].to_numpy()})

    true = distinct.select("rep", "space", "v", "n").mapInPandas(count, "rep bigint, true bigint")
    true = true.groupBy("rep").agg(F.sum("true").alias("true")).where(F.col("true") > 0).toPandas()
    both = sample.merge(true, on="rep")
    both["size"] = np.floor(np.log2(both["true"].to_numpy(np.float64))).astype(np.int64)
    both["recall"] = np.minimum(both["found"], both["true"]) / both["true"] * both["stands"]
    both["whole"] = (both["found"] == both["true"]) * both["stands"]
    sums = both.groupby("size")[["recall", "whole", "stands"]].sum()
    return sums[["recall", "whole"]].div(sums["stands"], axis=0).reset_index()


def near_duplicates(
    embeddings: DataFrame, cosine: float = COSINE, piece: int = PIECE, nearest: int = NEAREST,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of `embeddings` (vec_id, embedding, label).

    Rows of equal label (not null) and length are linked at a cosine of `cosine` or more. n_links is
    the number of other rows linked directly, component_id the smallest vec_id that links reach, kept
    whether that is the row's own. A vector that is null, empty, zero, or has a null or non-finite
    component links with nothing: no links, its own component. Equal vectors of a label are linked.
    Rows that share an id are rows of their own, all in the component of any of them where they are
    linked. A null id has no number to be kept by: kept is false, and it names no component unless
    there is no other id. An empty table gives an empty result.

    Pairs that no shard holds may be missing, as far as the audit allows; see `audit` and RECALL.
    """
    text_batches(embeddings.sparkSession, BATCH)
    rows, distinct = representatives(embeddings)
    centres = pivots(distinct, piece)
    most = max([len(c) for c in centres.values()], default=1)
    while True:
        split = stored(pieces(dealt(distinct, centres, nearest), 2 * piece), "pieces")
        found = stored(linked(split, cosine), "links")
        seen = audit(distinct, found, cosine)
        if (seen["recall"] >= RECALL).all():
            break
        if nearest >= most:
            raise RuntimeError(f"links are missing though every pair was compared:\n{seen}")
        nearest *= 2
    edges = found.where("to IS NOT NULL").select(F.col("rep").alias("a"), F.col("to").alias("b"))
    roots = components(edges).select(F.col("node").alias("rep"), "root")
    counted = distinct.select("rep", "n").join(
        found.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left"
    ).join(roots, "rep", "left").select(
        "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "rep").alias("root"),
    )
    ids = rows.where("rep IS NOT NULL").groupBy("rep").agg(F.min("vec_id").alias("first"))
    least = counted.join(ids, "rep").groupBy("root").agg(F.min("first").alias("least"))
    known = counted.join(least, "root").select("rep", "n_links", "least")
    component = F.when(F.col("rep").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return rows.join(known, "rep", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
