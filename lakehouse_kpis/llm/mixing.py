"""Mixing documents to target weights of domains that they belong to only in part.

A naive Bayes classifier over hashed words, learnt from a labelled table, gives each document the
probabilities of the domains. Each document then gets a nonnegative rate such that the expected
domain totals of tokens, sum(rate * tokens * probability), are the targets: least squares over the
rates, solved by projected gradient steps from rates of one.

A step needs the totals of all documents at the current rates, one distributed sum of as many numbers
as there are domains. The rates themselves are never stored: a rate follows from the document's
probabilities and the sequence of steps so far, which is a few dozen numbers.
"""

from __future__ import annotations

import json
import math
import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.llm.tables import stored, text_batches

BUCKETS = 1 << 15        # of hashed words
LABELLED = 8192          # labelled documents that the classifier is fitted on, at most, per domain
SAMPLE_CELLS = 1 << 40   # of the hash that draws them
SMOOTHING = 0.5
MAX_STEPS = 40
TOLERANCE = 1e-4         # largest relative error of a domain total at which the steps end
EMPTY = "none"


def hashed_words(text: bytes | None) -> np.ndarray:
    """Bucket of every word of a text: runs without ASCII white space, A-Z lower-cased, the marks
    round a word left off."""
    found = [zlib.crc32(w.strip(_MARKS)) for w in (text or b"").lower().split()]
    return np.array(found, np.int64) % BUCKETS


_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Domains:
    """Names of the domains, logarithms of their shares, and of each bucket's share within them."""

    names: tuple[str, ...]
    prior: np.ndarray
    words: np.ndarray  # (BUCKETS, domains)

    def posterior(self, buckets: np.ndarray) -> np.ndarray:
        logs = self.prior + self.words[buckets].sum(axis=0)
        p = np.exp(logs - logs.max())
        return p / p.sum()


def domain_of(labels: DataFrame) -> DataFrame:
    """doc_id and domain, from the label columns: low, clean or toxic quality of the document.

    A document that has contradicting label rows, or a null among them, belongs to no domain.
    """
    name = F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic").when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), "clean"
    )
    return labels.where("doc_id IS NOT NULL").select("doc_id", name.alias("domain")).groupBy(
        "doc_id"
    ).agg(
        F.min("domain").alias("domain"), F.max("domain").alias("top"),
        F.bool_or(F.col("domain").isNull()).alias("open"),
    ).where("domain = top AND NOT open").select("doc_id", "domain")


def fit(documents: DataFrame, domains: DataFrame, rows: int = LABELLED) -> Domains:
    """Fit the classifier on about `rows` labelled documents of each domain at most.

    The domains are those of all labelled documents at hand, however rare. Ids alone are joined with
    the labels and counted; texts are then read of the ids whose hash lies below the bound that the
    count of their domain gives. A domain with up to `rows` ids is taken whole. Shares of the domains
    come from the counts, not from the sample. Only sums come to the driver: BUCKETS counts per domain.
    """
    text_batches(documents.sparkSession)
    held = documents.groupBy("doc_id").agg(F.count("*").alias("n"))
    ids = stored(held.join(domains, "doc_id"), "labelled")
    found = ids.groupBy("domain").agg(F.sum("n").alias("n"), F.count("*").alias("ids")).collect()
    total = {r["domain"]: r["n"] for r in found}
    names = tuple(sorted(total)) or (EMPTY,)
    bounds = F.lit(0)
    for r in found:
        share = min(rows * SAMPLE_CELLS // r["ids"], SAMPLE_CELLS)
        bounds = F.when(F.col("domain") == r["domain"], share).otherwise(bounds)
    cell = F.pmod(F.xxhash64(F.lit("labelled"), "doc_id"), F.lit(SAMPLE_CELLS))
    sample = ids.where(cell < bounds).select("doc_id", "domain")
    known = documents.select("doc_id", F.col("text").cast("binary").alias("text")).join(
        F.broadcast(sample), "doc_id"  # about `rows` ids per domain, of three domains
    )

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for domain, text in zip(batch["domain"], batch["text"]):
                held = sums.setdefault(domain, np.zeros(BUCKETS, np.int64))
                held += np.bincount(hashed_words(text), minlength=BUCKETS)
        for domain, held in sums.items():
            at = np.flatnonzero(held)
            yield pd.DataFrame({"domain": domain, "bucket": at, "n": held[at]})

    found = known.select("domain", "text").mapInPandas(
        counts, "domain string, bucket int, n bigint"
    ).groupBy("domain", "bucket").agg(F.sum("n").alias("n")).toPandas()
    words = np.full((BUCKETS, len(names)), SMOOTHING)
    docs = np.array([1.0 + total.get(name, 0) for name in names])
    for k, name in enumerate(names):
        held = found[found["domain"] == name]
        words[held["bucket"].to_numpy(np.int64), k] += held["n"].to_numpy()
    return Domains(names, np.log(docs / docs.sum()), np.log(words / words.sum(axis=0)))


def memberships(documents: DataFrame, model: Domains) -> DataFrame:
    """doc_id, n_tokens (words of the whole text) and p, the domains' probabilities, of each row."""
    text_batches(documents.sparkSession)

    @F.pandas_udf("struct<n_tokens bigint, p array<double>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [hashed_words(t) for t in texts]
            yield pd.DataFrame({
                "n_tokens": [len(w) for w in found], "p": [model.posterior(w) for w in found],
            })

    return documents.select("doc_id", of(F.col("text").cast("binary")).alias("m")).select(
        "doc_id", "m.n_tokens", "m.p"
    )


@dataclass(frozen=True)
class Rates:
    """The steps that lead to a document's rate from its domain probabilities."""

    steps: np.ndarray  # (steps, domains)

    def of(self, p: np.ndarray) -> np.ndarray:
        """Rates of rows of probabilities."""
        rate = np.ones(len(p))
        for step in self.steps:
            rate = np.maximum(0.0, rate + p @ step)
        return rate


@dataclass(frozen=True)
class Fit:
    """Rates, the targets in tokens, the totals reached, the totals at rates of one, and error, the
    largest relative error of a domain's total: above TOLERANCE the targets were not reached."""

    rates: Rates
    targets: np.ndarray
    reached: np.ndarray
    before: np.ndarray
    error: float


def targets_for(names: tuple[str, ...], before: np.ndarray, weights: dict[str, float]) -> np.ndarray:
    """Tokens wanted of each domain: the corpus' own total, dealt by weight. A domain without a
    weight, and one without tokens, keeps what it has; with nothing to deal out, all do. Weights that
    no document can meet are told in a warning, and their share goes to the other domains."""
    weighted = np.array([n in weights for n in names]) & (before > 0)
    wanted = np.array([weights.get(n, 0.0) for n in names]) * weighted
    held = {n for n, w in zip(names, weighted) if w}
    unmet = sorted(n for n, w in weights.items() if w > 0 and n not in held)
    if unmet and before.sum() > 0:
        warnings.warn(f"no tokens of the domains {unmet}: their weights are dealt to the others")
    if not wanted.sum():
        return before.copy()
    return np.where(weighted, wanted / wanted.sum() * before[weighted].sum(), before)


def solve(members: DataFrame, names: tuple[str, ...], weights: dict[str, float]) -> Fit:
    """Projected gradient steps over the rows of `memberships`.

    Document i adds rate_i * n_i * p_i to the totals. In the norm that weighs documents by their
    tokens, the gradient of a squared error of totals, measured through the inverse of second moments
    G = sum(n p p'), is p_i' G^-1 (totals - targets). The projection sets negative rates to zero. A
    document at zero does not answer to a small step, so G is taken over the documents with a positive
    rate, found in the same pass as the totals; a step that makes the error larger is halved. Without
    a rate at zero one step reaches the targets. The steps end at TOLERANCE or after MAX_STEPS passes,
    which targets beyond any nonnegative rates need; the best rates stay and `error` says how good.
    """
    k = len(names)
    before, full = _moments(members, None, k)
    targets = targets_for(names, before, weights)
    scale = np.maximum(targets, 1e-6 * max(before.sum(), 1.0))

    def off(totals: np.ndarray) -> float:
        return float(np.abs((totals - targets) / scale).max())

    steps: list[np.ndarray] = []
    totals, gram, error, share = before, full, off(before), 1.0
    for _ in range(MAX_STEPS):
        if error <= TOLERANCE:
            break
        answering = (np.diag(gram) > 1e-6 * np.diag(full)).all()
        inverse = np.linalg.pinv(gram if answering else full, rcond=1e-9, hermitian=True)
        step = share * (inverse @ (targets - totals))
        reached, moments = _moments(members, Rates(np.array([*steps, step])), k)
        if off(reached) < error:
            steps.append(step)
            totals, gram, error, share = reached, moments, off(reached), min(1.0, 2 * share)
        else:
            share /= 2
    return Fit(Rates(np.array(steps).reshape(-1, k)), targets, totals, before, error)


def _moments(members: DataFrame, rates: Rates | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Totals of the domains at the rates (None: all one), and sum(n p p') over the documents with a
    positive rate, from one pass."""
    @F.pandas_udf("double")
    def rate(p: pd.Series) -> pd.Series:
        return pd.Series(rates.of(np.stack(p.to_numpy())) if len(p) else [], dtype=float)

    rated = members.select("n_tokens", "p", (rate("p") if rates else F.lit(1.0)).alias("r"))
    at = [(i, j) for i in range(k) for j in range(i + 1)]
    live = F.when(F.col("r") > 0, F.col("n_tokens"))

    def sums(values: list[Column]) -> Column:
        return F.array(*[F.coalesce(F.sum(v), F.lit(0.0)) for v in values])

    first = rated.agg(
        sums([F.col("r") * F.col("n_tokens") * F.col("p")[i] for i in range(k)]).alias("s"),
        sums([live * F.col("p")[i] * F.col("p")[j] for i, j in at]).alias("g"),
    ).first()
    gram = np.zeros((k, k))
    for (i, j), v in zip(at, first["g"]):
        gram[i, j] = gram[j, i] = v
    return np.array(first["s"]), gram


def copies(rate: Column, doc_id: Column) -> Column:
    """How often a document is taken: its rate, rounded up or down by a hash of its id so that the
    expectation is the rate. The same document is always rounded alike."""
    even = F.pmod(F.xxhash64(F.lit("mixing"), doc_id), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return F.floor(rate + even).cast("int")


def mixture(documents: DataFrame, labels: DataFrame, weights: dict[str, float]) -> DataFrame:
    """doc_id, n_tokens, domain (the likeliest), posterior (JSON by domain), rate, copies and error
    (of the whole mixture: the largest relative error of a domain's expected total) of every row of
    `documents`.

    `weights` are the wanted shares of the domains of `domain_of` in all tokens, which stay as many
    as they are. A null text is an empty one: no tokens, the domains' shares as probabilities.
    Repeated rows are documents of their own. A null id has a rate like any other. Without labelled
    documents there is one domain, and every rate is 1. Other columns of the tables are not looked
    at; an empty table gives an empty result.
    """
    model = fit(documents, domain_of(labels))
    members = stored(memberships(documents, model), "members")
    solved = solve(members, model.names, weights)
    rates, names = solved.rates, model.names

    @F.pandas_udf("struct<domain string, posterior string, rate double>")
    def described(p: pd.Series) -> pd.DataFrame:
        rows = np.stack(p.to_numpy()) if len(p) else np.zeros((0, len(names)))
        return pd.DataFrame({
            "domain": [names[i] for i in rows.argmax(axis=1)],
            "posterior": [
                json.dumps({n: round(float(v), 6) for n, v in zip(names, r)}) for r in rows
            ],
            "rate": rates.of(rows),
        })

    return members.select("doc_id", "n_tokens", described("p").alias("d")).select(
        "doc_id", "n_tokens", "d.domain", "d.posterior", "d.rate",
        copies(F.col("d.rate"), F.col("doc_id")).alias("copies"),
        F.lit(solved.error).alias("error"),
    )


def mixed(documents: DataFrame, labels: DataFrame, weights: dict[str, float]) -> DataFrame:
    """The rows of `documents`, columns unchanged, each as often as `copies` of `mixture` says.

    Rates follow from the texts, so they are found where the texts are read, without a shuffle.
    """
    model = fit(documents, domain_of(labels))
    members = stored(memberships(documents, model), "members")
    rates = solve(members, model.names, weights).rates

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            p = [model.posterior(hashed_words(t)) for t in texts]
            yield pd.Series(rates.of(np.array(p).reshape(-1, len(model.names))))

    times = F.array_repeat(
        F.lit(0), copies(rate(F.col("text").cast("binary")), F.col("doc_id"))
    )
    columns = [F.col(f"`{c}`") for c in documents.columns]
    free = "time"
    while free in documents.columns:
        free += "_"
    return documents.select(*columns, F.explode(times).alias(free)).drop(free)
