"""Language of web pages by Bayesian fusion of evidence.

Four kinds of evidence are added as logarithms: how likely the page's main text is in each language,
how likely pages of the language declare what this one declares in its markup, and the prior of the
place the page comes from. The prior is hierarchical: languages of all pages, of the address suffix,
of the registered domain and of the host, each smoothed towards the one above by its own number of
pages. Counts are expected counts from the text likelihoods, summed by grouped aggregation. A page's
own share is taken off them, so that it is no evidence for itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.llm.html_text import main_text
from lakehouse_kpis.llm.tables import stored, text_batches

BUCKETS = 1 << 14      # of hashed character sequences
GRAM = 3               # characters of a sequence
LABELLED = 4096        # labelled documents of each language that the text model is fitted on, about
CHECKED = 0.25         # share of them that is held out to weigh a text's evidence
SMOOTHING = 0.5
STRENGTH = 4.0         # pages that the level above counts for
# weights of a text's evidence that are tried: a factor, and the power of the text's length it grows by
FACTORS = tuple(2.0 ** e for e in range(-8, 3))
GROWTHS = (0.5, 0.75, 1.0)
AT_ONCE = 32           # languages whose counts a task holds before it passes them on
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_HTML_TAG = re.compile(r"<html\b((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.I)
_LANG = re.compile(r"(?:^|\s)(?:xml:)?lang\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def grams(text: str | None) -> np.ndarray:
    """Buckets of the character sequences of a text, words set between spaces, marks left off."""
    line = " " + _NOT_LETTERS.sub(" ", (text or "").lower()).strip() + " "
    raw = line.encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, np.uint32).astype(np.uint64)
    if len(codes) < GRAM:
        return np.zeros(0, np.int64)
    h = np.zeros(len(codes) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        h = (h ^ codes[i:len(codes) - GRAM + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(BUCKETS)).astype(np.int64)


@dataclass(frozen=True)
class Languages:
    """Names of the languages, logarithms of each bucket's share within them, and the weight of a text:
    neighbouring sequences overlap and words come in clusters, so a text of n sequences says less than
    n independent ones, by a factor and a power of n."""

    names: tuple[str, ...]
    logs: np.ndarray  # (BUCKETS, languages)
    factor: float = 1.0
    growth: float = 1.0

    def mean(self, text: str | None) -> tuple[np.ndarray, int]:
        """Mean log-likelihoods of a text's sequences, the best being 0, and their number."""
        found = np.bincount(grams(text), minlength=BUCKETS)
        at = np.flatnonzero(found)
        n = int(found.sum())
        sums = (found[at, None] * self.logs[at]).sum(axis=0) / max(n, 1)
        return sums - sums.max(), n

    def likelihood(self, text: str | None) -> np.ndarray:
        """Log-likelihoods of a whole text, the best being 0; all 0 where there are no letters."""
        mean, n = self.mean(text)
        return self.factor * n ** self.growth * mean


def fit(documents: DataFrame, rows: int = LABELLED) -> Languages:
    """Fit the text model on labelled documents, about `rows` of each language: all of a rare one, and of
    a common one those whose hash lies under a bound that its number of documents gives. Every label
    that occurs is a language. A share of them is held out and sets the weight of a text's evidence.

    The driver gets the number of documents of each language, counts of buckets by language, and the
    loss of each weight; nothing of it grows with the documents. Without labelled documents there is one
    language, `und`.
    """
    text_batches(documents.sparkSession)
    named = documents.select(F.lower(F.trim("lang")).alias("lang"), "doc_id", "text").where(
        F.length("lang") > 0
    )
    sizes = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = tuple(sorted(sizes)) or (UNKNOWN,)
    if not sizes:
        return Languages(names, np.full((BUCKETS, 1), -np.log(BUCKETS)))
    bounds = F.create_map(*[F.lit(v) for k in names for v in (k, min(1.0, rows / sizes[k]))])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32)) / float(1 << 32)
    second = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 32)) / float(1 << 32)
    drawn = named.where(draw < F.element_at(bounds, F.col("lang"))).withColumn(
        "checks", second < CHECKED
    ).select("lang", "text", "checks")

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[str, bool], np.ndarray] = {}

        def passed() -> Iterator[pd.DataFrame]:
            for (name, checks), held in sums.items():
                at = np.flatnonzero(held)
                yield pd.DataFrame({"lang": name, "checks": checks, "bucket": at, "n": held[at]})
            sums.clear()

        for batch in batches:
            for name, checks, text in zip(batch["lang"], batch["checks"], batch["text"]):
                held = sums.setdefault((name, checks), np.zeros(BUCKETS, np.int64))
                held += np.bincount(grams(text), minlength=BUCKETS)
                if len(sums) >= AT_ONCE:
                    yield from passed()
        yield from passed()

    found = drawn.mapInPandas(counts, "lang string, checks boolean, bucket int, n bigint").groupBy(
        "lang", "checks", "bucket"
    ).agg(F.sum("n").alias("n")).toPandas()

    def shares(of: pd.DataFrame) -> np.ndarray:
        sums = np.full((BUCKETS, len(names)), SMOOTHING)
        for k, name in enumerate(names):
            own = of[of["lang"] == name]
            np.add.at(sums[:, k], own["bucket"].to_numpy(np.int64), own["n"].to_numpy())
        return np.log(sums / sums.sum(axis=0))

    factor, growth = _weight(
        drawn.where("checks"), Languages(names, shares(found[~found["checks"].astype(bool)]))
    )
    return Languages(names, shares(found), factor, growth)


def _weight(held_out: DataFrame, model: Languages) -> tuple[float, float]:
    """The weakest weight of a text under which the true languages of the held-out documents are, in
    all, at most e times less likely than under the best one. Without held-out documents, the weakest."""
    tried = [(f, g) for f in FACTORS for g in GROWTHS]
    place = {name: k for k, name in enumerate(model.names)}

    def losses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(len(tried))
        for batch in batches:
            for name, text in zip(batch["lang"], batch["text"]):
                mean, n = model.mean(text)
                for i, (f, g) in enumerate(tried):
                    logs = f * n ** g * mean
                    sums[i] += np.log(np.exp(logs).sum()) - logs[place[name]]
        yield pd.DataFrame({"at": np.arange(len(tried)), "loss": sums})

    found = held_out.select("lang", "text").mapInPandas(losses, "at int, loss double").groupBy("at").agg(
        F.sum("loss").alias("loss")
    ).collect()
    loss = {r["at"]: r["loss"] for r in found} or {0: 0.0}
    best = min(loss.values())
    # of two weights, the one that gives a text of 1,000 sequences less evidence is the weaker
    at = min((i for i in loss if loss[i] <= best + 1), key=lambda i: tried[i][0] * 1000 ** tried[i][1])
    return tried[at]


def declared_language(page: str | None) -> str:
    """Primary subtag that the root element declares, lower-cased, or ""."""
    tag = _HTML_TAG.search(page or "")
    found = _LANG.search(tag[1]) if tag else None
    value = next((g for g in found.groups() if g), "") if found else ""
    return re.split(r"[-_]", value.strip().lower())[0][:8]


def host_of(url: Column) -> Column:
    """Host of an address in lower case without user, port and last dot, or ""."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.lower(found), r"^.*@|:[0-9]*$|\.+$", "")


def evidence(pages: DataFrame, model: Languages) -> DataFrame:
    """page_id, url, host, site (registered domain: the last two labels), suffix (last label),
    declared, and ll, the log-likelihoods of the main text."""
    text_batches(pages.sparkSession)

    @F.pandas_udf("struct<declared string, ll array<double>>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            found = [(h or b"").decode("utf-8", "replace") for h in series]
            yield pd.DataFrame({
                "declared": [declared_language(p) for p in found],
                "ll": [model.likelihood(main_text(p)) for p in found],
            })

    read_pages = pages.select(
        "page_id", "url", host_of(F.col("url")).alias("host"),
        read(F.col("html").cast("binary")).alias("e"),
    )
    return read_pages.select(
        "page_id", "url", "host", F.substring_index("host", ".", -2).alias("site"),
        F.substring_index("host", ".", -1).alias("suffix"), "e.declared", "e.ll",
    )


def _sums(rows: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    """Expected pages of each language by `keys`; combined before the shuffle, so a hot key is one
    row of every map task."""
    return rows.groupBy(*keys).agg(
        F.array(*[F.sum(F.col("own")[i]) for i in range(k)]).alias(name)
    )


def _smoothed(name: str, above: Column | str) -> str:
    """SQL of the shares in `name` without the page's own, smoothed towards `above`."""
    less = f"zip_with({name}, own, (c, o) -> greatest(c - o, 0D))"
    return (
        f"zip_with({less}, {above}, (c, a) -> (c + {STRENGTH}D * a) / "
        f"(aggregate({less}, 0D, (s, x) -> s + x) + {STRENGTH}D))"
    )


def identified(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """page_id, url, lang, confidence, text_lang, declared and posterior (JSON by language) of every
    row of `pages`.

    `documents` gives the labelled texts (text, lang) of the text model. A null or broken address has
    the empty host, which is a place like any other; null html, and a page without letters, has no
    text evidence, and text_lang `und`. A markup without a language declares "". Repeated rows and
    null ids are rows like any other. Equal posteriors go to the language first in the alphabet. An
    empty `pages` gives an empty result, and without labelled documents every language is `und`. Other
    columns are not looked at.
    """
    model = fit(documents)
    names, k = model.names, len(model.names)
    weights = "transform(ll, x -> exp(x))"
    own = F.expr(f"transform({weights}, x -> x / aggregate({weights}, 0D, (s, y) -> s + y))")
    rows = stored(evidence(pages, model).withColumn("own", own), "evidence")

    # one pass by the finest place, then ever coarser sums of the sums
    by_host = stored(_sums(rows, ["host", "site", "suffix"], k, "own"), "hosts")
    by_site = _sums(by_host, ["site", "suffix"], k, "at_site")
    by_suffix = _sums(by_host, ["suffix"], k, "at_suffix")
    in_all = by_host.agg(F.array(*[
        F.coalesce(F.sum(F.col("own")[i]), F.lit(0.0)) for i in range(k)
    ])).first()[0]
    places = by_host.withColumnRenamed("own", "at_host").join(by_site, ["site", "suffix"]).join(
        by_suffix, "suffix"
    ).select("host", "at_host", "at_site", "at_suffix")
    by_declared = _sums(rows, ["declared"], k, "at_declared")

    found = rows.join(places, "host").join(by_declared, "declared").withColumn(
        "at_all", F.array(*[F.lit(v) for v in in_all])
    )
    level = _smoothed("at_all", f"array_repeat({1.0 / k}D, {k})")
    found = found.withColumn("p", F.expr(level))
    for name in ("at_suffix", "at_site", "at_host"):
        found = found.withColumn("p", F.expr(_smoothed(name, "p")))
    # share of the language's pages that declare this
    less = "zip_with(at_declared, own, (c, o) -> greatest(c - o, 0D))"
    whole = "zip_with(at_all, own, (c, o) -> greatest(c - o, 0D))"
    found = found.withColumn("d", F.expr(
        f"zip_with({less}, {whole}, (c, a) -> (c + {SMOOTHING}D) / (a + {STRENGTH}D))"
    ))
    logs = "transform(sequence(0, size(ll) - 1), i -> ll[i] + ln(p[i]) + ln(d[i]))"
    found = found.withColumn("logs", F.expr(logs)).withColumn(
        "raised", F.expr("transform(logs, x -> exp(x - array_max(logs)))")
    ).withColumn("post", F.expr(
        "transform(raised, x -> x / aggregate(raised, 0D, (s, y) -> s + y))"
    ))
    listed = F.array(*[F.lit(n) for n in names])
    best = F.array_position("post", F.array_max("post")).cast("int")
    text_best = F.array_position("ll", F.array_max("ll")).cast("int")
    told = F.array_min("ll") < F.array_max("ll")
    shown = F.concat(F.lit("{"), F.array_join(F.transform(
        F.arrays_zip(F.array(*[F.lit(json.dumps(n)) for n in names]).alias("n"),
                     F.col("post").alias("v")),
        lambda e: F.concat(e["n"], F.lit(": "), F.format_string("%.6f", e["v"])),
    ), ", "), F.lit("}"))
    return found.select(
        "page_id", "url", F.element_at(listed, best).alias("lang"),
        F.array_max("post").alias("confidence"),
        F.when(told, F.element_at(listed, text_best)).otherwise(F.lit(UNKNOWN)).alias("text_lang"),
        "declared", shown.alias("posterior"),
    )
