"""Row numbers over a whole table in a given order, without putting the table into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehouse_kpis.session import written

POSITION_BITS = 33  # of monotonically_increasing_id; the bits above name the partition


GROUP_BITS = 12  # of the rows whose counts are added up in one window


def running(sizes: DataFrame, place: str, n: str) -> DataFrame:
    """The rows with `before`, the sum of `n` over the rows with a smaller `place` (0, 1, ..., unique).

    Added up within groups of 4096 places, and over the groups in an array of their sums.
    """
    group = F.shiftright(place, GROUP_BITS)
    within = F.sum(n).over(Window.partitionBy(group).orderBy(place)) - F.col(n)
    sums = sizes.groupBy(group.alias("_group")).agg(F.sum(n).alias("_sum")).agg(
        F.sort_array(F.collect_list(F.struct("_group", "_sum"))).alias("s")
    ).select(F.inline(F.expr(
        "transform(s, (x, i) -> struct(x._group AS _group, "
        "aggregate(slice(s, 1, i), 0L, (a, y) -> a + y._sum) AS _ahead))"
    )))
    inner = sizes.withColumn("_within", within)
    return inner.join(sums, group == F.col("_group")).select(
        *sizes.columns, (F.col("_ahead") + F.col("_within")).alias("before")
    )


def numbered(df: DataFrame, order: list[str | Column], name: str, start: int = 1) -> DataFrame:
    """The rows with one more column `name`: start, start + 1, ... in `order`, without gaps.

    Rows are dealt by ranges of the order and sorted within them; each range counts its rows, and its
    numbers start where those of the ranges before it end. The dealt rows are written to the shared
    folder once, as ranges are sampled and two runs need not cut them alike. Only the counts, one a
    range, are added up in order. Rows alike in `order` lie in one range and are numbered in any order,
    so end it in a unique key. An empty table gives no row; `name` must be a new name.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name!r} already")
    held = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    keys = [F.col(f"`{o}`") if isinstance(o, str) else o for o in order]
    dealt = df.select(held, F.struct(*keys).alias("key"))
    # one struct as the key: nulls first, descending keys are given as expressions
    placed = dealt.repartitionByRange("key").sortWithinPartitions("key").select(
        "row", F.monotonically_increasing_id().alias("at")
    )
    placed = written(placed, "numbered")
    part = F.shiftright("at", POSITION_BITS)
    place = F.col("at").bitwiseAND((1 << POSITION_BITS) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    starts = running(sizes, "part", "n").select("part", "before")
    return placed.join(starts, part == F.col("part")).select(
        "row.*", (F.col("before") + place + start).alias(name)
    )
