"""Near-duplicate documents by SimHash fingerprints and Golay-code fuzzy hashing.

Fingerprints of 64 bits are linked when at most two bits differ. They are cut into three segments.
Two differing bits leave one segment i whole and at most one bit wrong in its follower (checked for
all patterns in the tests), so a key made of segment i itself and a fuzzy hash of its follower finds
every pair. The fuzzy hash decodes the segment with the perfect (23, 12) Golay code: a word within
two bits of a codeword gives that codeword; a word three bits away also gives the five codewords at
distance four. Words that differ in up to two bits then share a codeword.

Keys held by few fingerprints give pairs, which are verified. A crowded key is not paired: its
fingerprints are listed under the 65 words within one bit of them. Two fingerprints share such a word
exactly if at most two of their bits differ, and no word has more than 65 of them, so a crowd of any
size costs 65 rows for each of its members and no link is lost.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.llm.graph import components
from lakehouse_kpis.llm.tables import stored, text_batches

SEED = 42
WIDTH = 3                # words of a shingle
BITS = 64
REACH = 2                # differing bits of a link
SEGMENTS = (22, 21, 21)  # from the top bit
CROWDED = 16             # fingerprints of a key up to which pairs are formed

# fixed values: the generator polynomial of the (23, 12) Golay code, and its parameters
GENERATOR = 0b101011100011
CODE_BITS, CHECK_BITS = 23, 11


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """SimHash of one UTF-8 text as an unsigned integer; see `fingerprints`."""
    # bytes.lower and bytes.split know ASCII letters and ASCII white space only
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = np.concatenate(([0], ends[:-1] + 1))
    last = ends[width - 1:].tolist() or [len(line)]
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter(
        (hashed(line[a:b], SEED) for a, b in zip(first.tolist(), last)), np.uint64, len(last)
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 65_536):  # a few MB at a time, however long the text
        block = h[at:at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint of the whole text as a signed 64-bit number.

    Letters A-Z are lower-cased, words are runs without ASCII white space, shingles are three words
    joined by a space, repeats included; a shorter text is one shingle, and one without words (or
    null) has fingerprint 0. A bit is set if it is in over half of the shingles' XXH64 hashes.
    """
    text_batches(documents.sparkSession)

    @F.pandas_udf("bigint")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts))
            yield pd.Series(found.view(np.int64))

    return documents.select("doc_id", hashed(F.col("text").cast("binary")).alias("fp"))


@functools.cache
def _decoder() -> np.ndarray:
    """For each syndrome, six error patterns: the leader of its coset, and where that has weight
    three the five patterns of weight four that lead to further codewords; else the leader again."""
    n = 1 << CHECK_BITS
    unit = np.array([_remainder(1 << i) for i in range(CODE_BITS)])
    leaders = np.zeros(n, np.int64)
    weights = np.full(n, -1)
    further: list[list[int]] = [[] for _ in range(n)]
    patterns = [()]
    for weight in range(5):
        for at in patterns:
            syndrome = int(np.bitwise_xor.reduce(unit[list(at)])) if at else 0
            word = sum(1 << i for i in at)
            if weight < 4:
                leaders[syndrome], weights[syndrome] = word, weight
            elif weights[syndrome] == 3:
                further[syndrome].append(word)
        patterns = [(*at, i) for at in patterns for i in range(at[-1] + 1 if at else 0, CODE_BITS)]
    table = np.repeat(leaders[:, None], 6, axis=1)
    for syndrome, words in enumerate(further):
        if words:
            table[syndrome, 1:] = words
    return table


def _remainder(word: int) -> int:
    for shift in range(CODE_BITS - CHECK_BITS - 1, -1, -1):
        if word >> (shift + CHECK_BITS) & 1:
            word ^= GENERATOR << shift
    return word


@functools.cache
def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and of the high 11 bits of a word; they add up by XOR."""
    low = np.array([_remainder(i) for i in range(1 << 12)])
    high = np.array([_remainder(i << 12) for i in range(1 << 11)])
    return low, high


def golay_indices(words: np.ndarray) -> np.ndarray:
    """The six 12-bit indices of nearby codewords of each 23-bit word; repeated where there are
    fewer. Words that differ in up to two bits have an index in common."""
    low, high = _syndromes()
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    return (words[:, None] ^ _decoder()[syndrome]) >> CHECK_BITS


def fuzzy_keys(fps: np.ndarray) -> np.ndarray:
    """The keys of signed fingerprints, 18 a row (repeated where there are fewer)."""
    bits = fps.view(np.uint64)
    parts, left = [], BITS
    for size in SEGMENTS:
        left -= size
        parts.append(((bits >> np.uint64(left)) & np.uint64((1 << size) - 1)).astype(np.int64))
    keys = []
    for i, whole in enumerate(parts):
        near = golay_indices(parts[(i + 1) % len(parts)])
        keys.append((i << 40) | (whole[:, None] << 12) | near)
    return np.hstack(keys)


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b) of the column fp of `distinct` that connect every two fingerprints at most two
    bits apart: each such pair itself, or within a crowd a path of links through a common third."""
    @F.pandas_udf("array<bigint>")
    def keyed(fps: pd.Series) -> pd.Series:
        found = fuzzy_keys(fps.to_numpy(np.int64))
        return pd.Series([np.unique(row) for row in found])

    keys = stored(distinct.select("fp", F.explode(keyed("fp")).alias("k")), "keys")
    held = keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    near = F.expr(
        "flatten(transform(fps, (a, i) -> transform("
        f"filter(slice(fps, i + 2, size(fps)), b -> bit_count(a ^ b) <= {REACH}), "
        "b -> struct(a AS a, b AS b))))"
    )
    few = keys.join(held.where(F.col("n") <= CROWDED), "k").groupBy("k").agg(
        F.collect_list("fp").alias("fps")  # at most CROWDED
    )
    pairs = few.select(F.explode(near).alias("p")).select("p.a", "p.b")
    many = keys.join(held.where(F.col("n") > CROWDED), "k").select("fp").distinct()
    return pairs.unionByName(_in_crowds(many)).distinct()


def _in_crowds(distinct: DataFrame) -> DataFrame:
    within_one = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    listed = distinct.select("fp", F.explode(within_one).alias("word"))
    shared = listed.groupBy("word").agg(F.collect_set("fp").alias("fps")).where("size(fps) > 1")
    return shared.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where(
        f"a <> b AND bit_count(a ^ b) <= {REACH}"
    )


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of `documents`.

    component_id is the smallest doc_id that links reach, itself included. Texts without words,
    empty and null ones alike, have fingerprint zero and are linked like any other. Repeated rows
    stay, in the same component. Null ids do not name a component unless it has no other id. Other
    columns are not looked at; an empty table gives an empty result.
    """
    hashed = stored(fingerprints(documents), "fingerprints")
    distinct = hashed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    distinct = stored(distinct, "distinct")
    roots = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    joined = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    member = joined.select("fp", "root").join(least, "root").select("fp", "component_id")
    return hashed.join(member, "fp").select(
        "doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id"
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """The rows of `documents`, columns unchanged, without near duplicates."""
    return without_copies(documents, near_duplicates(documents.where("doc_id IS NOT NULL")))


def without_copies(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of `documents`, columns unchanged: of each component of `found` (doc_id, component_id)
    the document with the smallest id stays.

    An id goes if none of its rows is the one that names its component. Where rows share an id that
    stays, whole copies of a row go too. Rows with a null id stay, as they name no document.
    """
    ids = found.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.bool_or(F.expr("doc_id = component_id")).alias("stays")
    )
    ids = stored(ids.where("n > 1 OR NOT stays"), "ids")
    gone = ids.where("NOT stays").select("doc_id")
    kept = documents.join(gone, "doc_id", "left_anti").select(documents.columns)
    repeated = ids.where("stays").select("doc_id")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_anti").select(documents.columns)
    again = kept.join(repeated, "doc_id", "left_semi").select(documents.columns)
    return once.unionByName(again.dropDuplicates())
