"""Language of pages: classes from all labelled rows, evidence that grows with the text, held-out texts."""

import numpy as np
from pyspark.sql import functions as F

from lakehouse_kpis.llm import language
from lakehouse_kpis.llm.tables import table

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string"


def test_a_rare_language_is_a_class(spark):
    rows = [(i, f"the common words number {i} of a text", "en") for i in range(3000)]
    rows += [(9000 + i, f"zyx qwv {i} vwq xyz zzyx", " XX ") for i in range(3)]
    docs = spark.createDataFrame(rows, DOCS).unionByName(
        spark.createDataFrame([(1, "no label", None), (2, None, "en"), (3, "blank", " ")], DOCS))
    model = language.fit(docs, rows=50)
    assert model.names == ("en", "xx")
    assert model.likelihood("zzyx qwv vwq").argmax() == 1 and model.likelihood("the common words").argmax() == 0


def test_evidence_grows_with_the_text(spark):
    model = language.fit(table(spark, SMALL, "documents"))
    text = table(spark, SMALL, "documents").where("lang = 'fr' AND n_chars > 500").first()["text"]
    spans = [-model.likelihood(text * n).min() for n in (1, 4, 16, 64)]
    assert all(b > 1.5 * a for a, b in zip(spans, spans[1:]))
    assert not model.likelihood("").any() and not model.likelihood(None).any()
    assert not model.likelihood("123 !?").any()


def test_likelihood_is_the_weighted_sum(spark):
    model = language.fit(table(spark, SMALL, "documents"))
    text = "Une phrase courte, et encore des mots."
    sums = np.zeros(len(model.names))
    found = language.grams(text)
    for bucket in found:
        sums = sums + model.logs[bucket]
    want = model.factor * len(found) ** model.growth * (sums - sums.max()) / len(found)
    assert np.allclose(model.likelihood(text), want)


def test_held_out_documents(spark):
    """Documents that the model is not fitted on; the posterior of the text alone is no lie."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("lang IS NOT NULL")
    out = F.pmod(F.xxhash64("text"), F.lit(4)) == 0
    model = language.fit(docs.where(~out))
    held = docs.where(out & (F.length("text") > 100)).select("lang", "text").limit(300).collect()
    posts = np.exp([model.likelihood(r["text"]) for r in held])
    posts /= posts.sum(1, keepdims=True)
    right = np.array([model.names[p.argmax()] == r["lang"] for p, r in zip(posts, held)])
    assert right.mean() >= 0.98
    assert posts.max(1).mean() <= right.mean() + 0.02


def test_ties_and_clashing_names(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.example/", "<p>12, 34.</p>", "x", "y"), (1, "http://a.example/", "<p>12, 34.</p>", "x", "y")],
        "page_id bigint, url string, html string, lang string, host string")
    docs = spark.createDataFrame([(1, "ab", "b"), (2, "ab", "a")], DOCS).withColumn("checks", F.lit("z"))
    found = language.identified(pages, docs).collect()
    assert [r["lang"] for r in found] == ["a", "a"] and {r["text_lang"] for r in found} == {"und"}
