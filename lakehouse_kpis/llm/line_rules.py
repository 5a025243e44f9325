"""Quality rules of documents, the frequency of their lines across documents among them.

Base rules look at one text. The method looks at lines: they are normalised and hashed, the distinct
documents that hold a line are counted per host, lines held by too many go, and a document that keeps
too few of its words is rejected. Everything is DataFrame functions; texts do not leave the scan, what
is shuffled are hashes of lines.

A line that a third of all documents hold is one row per map task after partial aggregation, and its
join back is salted. Within a text five-word windows are compared by 64-bit hashes, sorted only where
some window comes twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.llm.tables import stored

WINDOW = 5          # words of a window that is looked for again in its text
LEAST_WORDS = 10    # fewer words fail the base rules
REPEATED = 20       # per cent of words in repeated windows, beyond which the base rules fail
LEAST_DOCUMENTS = 10  # a line goes if more documents of its host hold it than this ...
LINE_SHARE = 0.01     # ... and more than this share of the host's documents
WORDS_LEFT = 0.5      # a document that keeps a smaller share of its words is depleted
SALTS = 16

SPACE = r"[\x09-\x0D ]+"
SYMBOLS = r"[^#*$%&|<>]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Maximal runs without ASCII white space."""
    return F.array_remove(F.split(text, SPACE), "")


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words lie in windows of `width` words found twice or more, the first included."""
    def hashes(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[h[i + k] for k in range(width)])
        )

    def again(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(placed, lambda s: F.filter(s, lambda x, i: (
            F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
        )))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return let(starts, lambda s: F.aggregate(
            F.transform(s, lambda p, i: F.least(F.coalesce(F.get(s, i + 1) - p, F.lit(width)), F.lit(width))),
            F.lit(0), lambda a, b: a + b,
        ))

    per_word = F.transform(words, lambda w: F.xxhash64(w))
    counted = let(per_word, lambda h: let(hashes(h), lambda windows: F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), again(windows)
    ).otherwise(F.lit(0))))
    return F.when(F.size(words) > width, counted).otherwise(F.lit(0)).cast("bigint")


def normalised(line: Column) -> Column:
    """A line in small letters, each number as 0, and what is neither as one space; a line without
    letters and numbers as it is."""
    plain = F.trim(F.regexp_replace(
        F.regexp_replace(F.lower(line), r"[0-9]+", "0"), r"[^\p{L}\p{N}]+", " "
    ))
    return F.when(plain == "", line).otherwise(plain)


def measured(documents: DataFrame, host: str = "source") -> DataFrame:
    """One row per row of `documents`: doc_id, host, the measures of the base rules, base_failed, and
    `lines`, the hash and the number of words of each line with a word. A null text has no words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = documents.select(
        "doc_id", F.col(f"`{host}`").cast("string").alias("host"), text.alias("text"),
        words_of(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x09-\x0D ]")).alias("held"),
    )
    counted = split.select(
        "doc_id", "host",
        F.coalesce("doc_id", F.xxhash64("text")).alias("document"), F.xxhash64("text").alias("hashed"),
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("bigint").alias("n_symbols"),
        (F.size("held") - F.size(F.array_distinct("held"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.transform("held", lambda x: F.struct(
            F.xxhash64(normalised(x)).alias("h"), F.size(words_of(x)).alias("w")
        )).alias("lines"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED)
    return counted.withColumn("base_failed", failed)


def frequent_lines(
    rows: DataFrame, least: int = LEAST_DOCUMENTS, share: float = LINE_SHARE
) -> DataFrame:
    """host, h and documents of the lines above both limits, of the rows of `measured`."""
    sizes = rows.groupBy("host").agg(F.count_distinct("document").alias("of"))
    hashes = F.array_distinct(F.transform("lines", lambda x: x["h"]))
    lines = rows.select("host", "document", F.explode(hashes).alias("h"))
    held = lines.groupBy("host", "h").agg(F.count_distinct("document").alias("documents")).where(
        F.col("documents") > least
    )
    same = held["host"].eqNullSafe(sizes["host"])
    return held.join(sizes, same).where(F.col("documents") > F.col("of") * share).select(
        held["host"], "h", "documents"
    )


def judged(documents: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, the base measures, `gone` (hashes of the lines removed), n_words_left,
    base_failed and kept for every row of `documents`.

    A document is its id, however many rows have it; rows without an id are one document per text.
    Null hosts are one host. Null and empty texts have no words and fail; repeated rows stay and are
    judged alike; other columns are not looked at; an empty table gives an empty result.
    """
    rows = stored(
        measured(documents, host).withColumn("row", F.monotonically_increasing_id()), "measured"
    )
    frequent = stored(frequent_lines(rows), "frequent")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    marked = frequent.select(F.col("host").alias("of"), F.col("h").alias("g"), salts.alias("salt"))
    lines = rows.select("row", "host", F.inline("lines")).withColumn(
        "at", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")
    )
    found = lines.join(
        marked, (F.col("h") == F.col("g")) & F.col("host").eqNullSafe(F.col("of"))
        & (F.col("at") == F.col("salt"))
    )
    lost = found.groupBy(F.col("row").alias("found")).agg(
        F.sum("w").alias("lost"), F.collect_set("h").alias("gone")  # of one document's lines
    )
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    depleted = (left < LEAST_WORDS) | (left < F.col("n_words") * WORDS_LEFT)
    return rows.join(lost, F.col("row") == F.col("found"), "left").select(
        "doc_id", "host", "document", "hashed", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce("gone", F.array().cast("array<bigint>")).alias("gone"),
        left.alias("n_words_left"), "base_failed",
        (~F.col("base_failed") & ~depleted).alias("kept"),
    )


def verdicts(documents: DataFrame, host: str = "source") -> DataFrame:
    """The measures and the verdict of every row of `documents`; see `judged`."""
    return judged(documents, host).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.size("gone").cast("bigint").alias("n_lines_removed"), "n_words_left", "base_failed", "kept",
    )


def cleaned(documents: DataFrame, host: str = "source") -> DataFrame:
    """The rows of `documents` that are kept, columns unchanged, their texts without the lines that
    are too frequent on their host. Documents without such lines keep their text as it is."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        F.coalesce("doc_id", F.xxhash64(text)).alias("d"), F.xxhash64(text).alias("t"),
        F.col(f"`{host}`").cast("string").alias("s"),
    )
    # rows alike in these three have the same lines and the same verdict
    found = judged(documents, host).where("kept").groupBy("document", "hashed", "host").agg(
        F.first("gone").alias("gone")
    )
    joined = rows.join(
        found, (F.col("d") == F.col("document")) & (F.col("t") == F.col("hashed"))
        & F.col("s").eqNullSafe(F.col("host"))
    )
    lines = F.filter(
        F.split(F.col("row")["text"], "\n"),
        lambda x: ~F.array_contains("gone", F.xxhash64(normalised(x))),
    )
    left = F.when(F.size("gone") == 0, F.col("row")["text"]).otherwise(F.array_join(lines, "\n"))
    return joined.select(*[
        (left if c == "text" else F.col("row")[c]).alias(c) for c in documents.columns
    ])
