"""A Merkle manifest of a dataset: a digest per row, a tree per language, one root, and a proof per row.

Leaf coordinates come from rank queries instead of a sort. The ids of a language are a compressed
bitmap: of 64 words of 64 bits, a container stores those that are not empty, with a word that says
which these are and the rows before each of them. Bitmaps are built per task and merged by OR. The rows
before a container are summed level by level over a directory whose nodes have at most 4096 children, so
that no task sees more than one node's children, whatever the ids look like.

Nodes then go into slot arrays of 512, each reduced in one task; the arrays' top nodes go into the next
arrays, until a language has one node. Paths go back down the same arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehouse_kpis.llm.tables import stored, text_batches
from lakehouse_kpis.operators.numbering import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")  # of a leaf, in this order
WORD, CONTAINER, FAN = 6, 12, 12  # bits of a word, of a container and of a level of the directory
LEVELS = 4  # of the directory, above the containers: 60 bits, so the last has 16 nodes at most
SLOTS = 9  # bits of a slot array: levels that a task reduces


def digest(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of inputs one after the other."""
    return F.sha2(F.concat(*inputs).cast("binary"), 256)


def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 bytes of the value, counted and after a colon."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    return digest(*[field(changed.get(name, F.col(name))) for name in FIELDS])


def _word(column: str) -> Column:
    return F.shiftright(column, WORD)


def bitmaps(rows: DataFrame, group: str) -> DataFrame:
    """Containers of the ids of each group: rows (group, id: bigint, n: how often).

    g and c name a container; top has a bit for each of its words that is not empty; of these, words
    are the bits, before the rows ahead in the container, and extra (bit, more) the ids that come more
    than once; size is the rows of all.
    """
    bit = F.col("id").bitwiseAND(63).cast("int")
    words = rows.groupBy(F.col(group).alias("g"), _word("id").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(id & 63 AS INT))")).alias("bits"), F.sum("n").alias("n"),
        F.collect_list(F.when(F.col("n") > 1, F.struct(bit.alias("bit"), (F.col("n") - 1).alias("more"))))
        .alias("extra"),  # of 64 ids
    )
    return words.groupBy("g", F.shiftright("w", CONTAINER - WORD).alias("c")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(w & 63 AS INT))")).alias("top"), F.sum("n").alias("size"),
        F.sort_array(F.collect_list(F.struct("w", "bits", "n", "extra"))).alias("held"),
    ).select(
        "g", "c", "top", "size", F.col("held.bits").alias("words"), F.col("held.extra").alias("extra"),
        F.expr("transform(held, (x, i) -> aggregate(slice(held, 1, i), 0L, (a, y) -> a + y.n))").alias("before"),
    )


def directory(containers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, c, base: rows of the group before the container), and (g, total) of every group."""
    level, levels = containers.select("g", F.col("c").alias("p"), F.col("size").alias("n")), []
    for _ in range(LEVELS):
        levels.append(_before(level))
        level = level.groupBy("g", F.shiftright("p", FAN).alias("p")).agg(F.sum("n").alias("n"))
    base = _before(level, top=True).select("g", "p", F.col("ahead").alias("base"))
    for lower in reversed(levels):
        above = base.select(F.col("g").alias("ug"), F.col("p").alias("up"), "base")
        base = lower.join(
            above, (F.col("g") == F.col("ug")) & (F.shiftright("p", FAN) == F.col("up"))
        ).select("g", "p", (F.col("base") + F.col("ahead")).alias("base"))
    totals = level.groupBy("g").agg(F.sum("n").alias("total"))
    return base.withColumnRenamed("p", "c"), totals


def _before(level: DataFrame, top: bool = False) -> DataFrame:
    """Rows ahead of each node among the children of its parent, 4096 at most; the top level's nodes
    have no parent, and are negative where ids are."""
    parent = [] if top else [F.shiftright("p", FAN)]
    siblings = Window.partitionBy("g", *parent).orderBy("p")
    return level.withColumn("ahead", F.sum("n").over(siblings) - F.col("n"))


def ranked(rows: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """The rows (group, id, n, ...) with `at`, how many rows of the group have a smaller id, and
    `shared`, true if more than one row has the id; and the size of each group (g, total)."""
    rows = stored(rows, "rows")
    containers = stored(bitmaps(rows.groupBy(group, "id").agg(F.sum("n").alias("n")), group), "bitmaps")
    base, totals = directory(containers)
    # every container has its base; both sides have one row per container
    held = stored(containers.join(base, ["g", "c"]), "directory")
    joined = rows.join(
        held, (F.col(group) == F.col("g")) & (F.shiftright("id", CONTAINER) == F.col("c"))
    )
    below = "~shiftleft(-1L, CAST({0} AS INT))"  # the bits under one
    slot = F.expr(f"bit_count(top & {below.format('shiftright(id, 6) & 63')})")
    placed = joined.withColumn("slot", slot).selectExpr(
        *[f"`{c}`" for c in rows.columns], "base + before[slot] AS ahead", "words[slot] AS bits",
        "extra[slot] AS extra",
    )
    own = "CAST(id & 63 AS INT)"
    at = (
        f"ahead + bit_count(bits & {below.format('id & 63')}) + aggregate(filter(extra, "
        f"e -> e.bit < {own}), 0L, (a, e) -> a + e.more)"
    )
    found = placed.selectExpr(
        *[f"`{c}`" for c in rows.columns], f"{at} AS at", f"exists(extra, e -> e.bit = {own}) AS shared"
    )
    return found, totals


def coordinates(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves (k, doc_id, leaf, ...), k not null, with `at`, their places from 0 within k by
    doc_id, and the leaves of each k (g, total). Rows with a null id come first; rows that share an
    id, or have none, go by their digest, equal ones in any order."""
    same = leaves.columns
    rows = leaves.groupBy(*same).agg(F.count("*").alias("n"))
    without = stored(rows.where("doc_id IS NULL"), "without")
    found, totals = ranked(rows.where("doc_id IS NOT NULL").withColumn("id", F.col("doc_id")), "k")
    found = stored(found, "ranked")
    first = without.groupBy(F.col("k").alias("of")).agg(F.sum("n").alias("first"))
    shift = found.join(first, F.col("k") == F.col("of"), "left").withColumn(
        "at", F.col("at") + F.coalesce("first", F.lit(0))
    ) if not without.isEmpty() else found
    single = shift.where("NOT shared").select(*same, "n", "at")
    tied = shift.where("shared").select(*same, "n", "at").unionByName(
        without.withColumn("at", F.lit(0).cast("bigint"))
    )
    placed = single
    if not tied.isEmpty():
        placed = single.unionByName(_apart(tied, same))
    spread = placed.select(*same, F.explode(F.expr("sequence(at, at + n - 1)")).alias("at"))
    counted = totals.join(first, F.col("g") == F.col("of"), "full").select(
        F.coalesce("g", "of").alias("g"),
        (F.coalesce("total", F.lit(0)) + F.coalesce("first", F.lit(0))).alias("total"),
    )
    return spread, counted


def _apart(tied: DataFrame, same: list[str]) -> DataFrame:
    """Rows of one place (k, at) told apart by rank queries over the first 64 bits of their digests."""
    # signed, so the top bit is turned to keep the order of the digests
    id = F.expr("CAST(conv(substring(leaf, 1, 16), 16, -10) AS BIGINT) ^ shiftleft(1L, 63)")
    keyed = tied.withColumnRenamed("at", "from").withColumn("id", id).withColumn(
        "place", F.concat("k", F.lit("\n"), F.col("from").cast("string"))
    )
    found, _ = ranked(keyed, "place")
    found = stored(found, "apart")
    # digests alike in 64 bits and unlike in the others, if there are any
    rest = Window.partitionBy("place", "at").orderBy("leaf", *[c for c in same if c != "leaf"])
    alike = found.where("shared").withColumn("at", F.col("at") + F.sum("n").over(rest) - F.col("n"))
    return found.where("NOT shared").unionByName(alike).select(
        *same, "n", (F.col("from") + F.col("at")).alias("at")
    )


def _hex(*nodes: str) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _levels(nodes: list[str], height: int) -> list[list[str]]:
    """The nodes of a slot array and of the levels above them."""
    levels = [nodes]
    for _ in range(height):
        level = levels[-1]
        levels.append([_hex(*level[i:i + 2]) for i in range(0, len(level), 2)])
    return levels


def _path(levels: list[list[str]], slot: int) -> list[str]:
    """The sibling of a slot at each level: L or R for its side and its digest, or nothing."""
    path = []
    for level in levels[:-1]:
        other = slot ^ 1
        path.append(("R" if slot & 1 == 0 else "L") + level[other] if other < len(level) else "")
        slot >>= 1
    return path


def _nodes(held: pa.ListScalar) -> tuple[list[str], list[int]]:
    """The nodes of a slot array by slot, and for each slot the entry that has it."""
    slots, nodes = held.values.field("slot").to_pylist(), held.values.field("node").to_pylist()
    entries = [0] * len(slots)
    for entry, slot in enumerate(slots):
        entries[slot] = entry
    return [nodes[entry] for entry in entries], entries


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slot arrays as their top nodes (k, at, node)."""
    for batch in batches:
        arrays = zip(batch.column("height").to_pylist(), batch.column("held"))
        tops = [_levels(_nodes(held)[0], height)[-1][0] for height, held in arrays]
        yield pa.RecordBatch.from_arrays(
            [batch.column("k"), batch.column("block"), pa.array(tops, pa.string())], ["k", "at", "node"]
        )


def _with_paths(kept: list[str], above: list[str]):
    """Slot arrays, and the paths of their top nodes, as one row per slot."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = {n: batch.column(n)[i] for n in batch.schema.names}
                nodes, entries = _nodes(one["held"])
                levels, path = _levels(nodes, one["height"].as_py()), one["path"].as_py()
                first, size = one["block"].as_py() << SLOTS, len(nodes)
                yield pa.RecordBatch.from_pydict({
                    "k": pa.repeat(one["k"], size),
                    "at": pa.array(range(first, first + size), pa.int64()),
                    "node": pa.array(nodes, pa.string()),
                    **{n: one["held"].values.field(n).take(pa.array(entries)) for n in kept},
                    "path": pa.array(
                        [_path(levels, slot) + path for slot in range(size)], pa.list_(pa.string())
                    ),
                    **{n: pa.repeat(one[n], size) for n in above},
                })

    return rows


def _slot_arrays(nodes: DataFrame, sizes: DataFrame, round: int) -> DataFrame:
    """Nodes (k, at, node, ...) in slot arrays, each with the levels it is reduced by."""
    slot = F.expr(f"CAST(at & {(1 << SLOTS) - 1} AS INT)").alias("slot")
    held = F.struct(slot, *[c for c in nodes.columns if c not in ("k", "at")])
    arrays = nodes.groupBy("k", F.shiftright("at", SLOTS).alias("block")).agg(
        F.collect_list(held).alias("held")  # one array's
    )
    height = F.least(F.lit(SLOTS), F.greatest(F.lit(0), F.col("levels") - SLOTS * round))
    return arrays.join(sizes, F.col("k") == F.col("g")).select(
        "k", "block", height.cast("int").alias("height"), "held"
    )


def tree(nodes: DataFrame, sizes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(k, node) of the top of every tree, and the slot arrays of every round, the lowest first.

    nodes: k, at (from 0 without gaps in k), node, and columns to go with it; sizes: g and total, the
    nodes of each k.
    """
    # levels above so many nodes: the bits of the highest place
    levels = F.when(F.col("total") > 1, F.length(F.bin(F.col("total") - 1))).otherwise(0)
    sizes = stored(sizes.select("g", levels.alias("levels")), "levels")
    most = sizes.agg(F.max("levels")).first()[0] or 0
    rounds = []
    for i in range(max(1, -(-most // SLOTS))):
        arrays = stored(_slot_arrays(nodes, sizes, i), "arrays")
        rounds.append(arrays)
        nodes = stored(arrays.mapInArrow(_reduced, "k string, at bigint, node string"), "nodes")
    return nodes.select("k", "node"), rounds


def paths(tops: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """(k, at, node, path, ...) of every lowest node, with the columns that went with it and those
    of `tops`: k, the path above its top, and others."""
    others = [f for f in tops.schema if f.name not in ("k", "path")]
    above = tops.withColumn("block", F.lit(0).cast("bigint"))
    for arrays in reversed(rounds):
        entry = arrays.schema["held"].dataType.elementType
        kept = [f for f in entry if f.name not in ("slot", "node")]
        schema = "k string, at bigint, node string" + "".join(
            f", {f.name} {f.dataType.simpleString()}" for f in kept
        ) + ", path array<string>" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in others)
        steps = _with_paths([f.name for f in kept], [f.name for f in others])
        found = arrays.join(above, ["k", "block"]).mapInArrow(steps, schema)
        above = found.select("k", F.col("at").alias("block"), "path", *[f.name for f in others])
    return found


def manifest(documents: DataFrame) -> DataFrame:
    """lang, doc_id, at, leaf, path, subroot and root of every row of `documents`, and changed_leaf:
    the leaf with one more in n_chars where tampering reaches the row, else null.

    Leaves of a language ascend by doc_id. Null ids come first; rows without an id, or that share one,
    go by their digest, and whole copies of a row by nothing, each with a place of its own. Nulls in
    any column count as `-`; a null language is one of its own, before all others, "" another. Other
    columns are not looked at; an empty table gives an empty result.

    path holds an entry per level, from the leaf to the root: the sibling after L or R, the side it is
    on, or nothing where the node is alone.
    """
    text_batches(documents.sparkSession)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    hashed = documents.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("k"),
        F.col("doc_id").cast("bigint").alias("doc_id"), leaf().alias("leaf"),
        F.when(tampered, leaf(n_chars=F.col("n_chars").cast("bigint") + 1)).alias("changed_leaf"),
    )
    placed, sizes = coordinates(hashed)
    leaves = placed.select("k", "at", F.col("leaf").alias("node"), "doc_id", "changed_leaf")
    subroots, rounds = tree(leaves, stored(sizes, "sizes"))

    ordered = numbered(subroots, ["k"], "at", 0)  # the languages in order, a node each
    places = stored(ordered.select(F.lit("").alias("k"), "at", "node", F.col("k").alias("of")), "places")
    top, upper = tree(places, places.groupBy(F.col("k").alias("g")).agg(F.count("*").alias("total")))
    above = paths(top.select(
        "k", F.array().cast("array<string>").alias("path"), F.col("node").alias("root")
    ), upper)
    tops = stored(above.select(F.col("of").alias("k"), "path", F.col("node").alias("subroot"), "root"), "tops")
    return paths(tops, rounds).select(
        F.when(F.col("k") != "", F.expr("substring(k, 2)")).alias("lang"), "doc_id", "at",
        F.col("node").alias("leaf"), "changed_leaf", "path", "subroot", "root",
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    def step(node: Column, entry: Column) -> Column:
        other = F.substr(entry, F.lit(2))
        pair = F.when(entry == "", node).when(entry.startswith("L"), F.concat(other, node)).otherwise(
            F.concat(node, other)
        )
        return digest(pair)

    return F.aggregate(path, leaf, step)


def proved(rows: DataFrame) -> DataFrame:
    """Rows of `manifest` with the digest of their siblings, and the root that the changed leaf, or
    else the leaf, leads to: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    siblings = F.array_join(F.transform("path", lambda p: F.substr(p, F.lit(2))), "")
    root = folded(F.coalesce("changed_leaf", "leaf"), F.col("path"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
