"""Every operator against a brute-force version on small frames, edge cases included."""

import hashlib
import json
import math
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from lakehouse_kpis.llm import bpe, html_text, language, mixing, pii, quality, shards, simhash, topk
from lakehouse_kpis.llm import graph, vectors
from lakehouse_kpis.llm.queries import TARGET_WEIGHTS, tokenizer_file
from lakehouse_kpis.llm.tables import table

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, rep int"
VECS = "vec_id bigint, embedding array<float>, label int, rep string, space int"
LONG = "one two three four five " * 40_000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, clashing names."""
    rows = [
        (1, "call +44 20 7946 0958 or a@b.example now", "en", "s", 5, "x", 1), (2, "", "en", "s", 0, None, 1),
        (3, None, None, None, None, None, None), (None, "no id here", "de", "t", 1, "y", 2),
        (None, None, None, None, None, None, None), (4, LONG, "en", "s", 1, "z", 3),
        (5, "same words here", "en", "s", 1, "z", 3), (5, "same words here", "en", "s", 1, "z", 3),
        (6, "SAME words\there", "en", "u", 1, "z", 3), (7, " \n\t ", "en", "u", 1, "z", 3),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SMALL, "labels")


def test_page_text_leaves_out_what_is_no_article(spark):
    article = "<article><h1>Head</h1><p>A first, long &amp; plain\n sentence; it goes on.</p><p>Short.</p></article>"
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav><a href='/'>Home</a></nav>"
        f"<div class=ad>Buy, buy!</div>{article}<aside>Side.</aside><div class=comments><p>Nice, read.</p>"
        "</div><form>Name: <input></form><footer>Foot.</footer><script>var t='<p>x</p>'</script></body></html>"
    )
    rows = [(1, "u", page), (2, None, None), (None, "u", ""), (3, "u", "<p>" * 5000 + "deep")]
    found = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"))
    texts = {r["page_id"]: (r["text"], r["n_chars"]) for r in found.collect()}
    want = "Head A first, long & plain sentence; it goes on. Short."
    assert texts[1] == (want, len(want))
    assert texts[2] == texts[None] == ("", 0)
    assert texts[3] == ("deep", 4)
    assert html_text.extracted(spark.createDataFrame([], found.select(
        "page_id", "url", F.lit("").alias("html")).schema)).count() == 0


def test_shards_interleave_the_sources(spark):
    docs = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("s"), F.col("id") % 7))
        .otherwise(F.concat(F.lit("one"), F.col("id"))).alias("source"),
    )
    rows = docs.join(shards.assigned(docs), "doc_id").toPandas()
    sizes = rows.groupby("shard").size()
    assert len(rows) == 5000 and len(sizes) == 24 and sizes.max() - sizes.min() <= 1
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in rows.groupby("shard"))
    for name in ("hot", "s1", "s2"):
        n = rows[rows["source"] == name].groupby("shard").size().reindex(range(24), fill_value=0)
        assert n.max() - n.min() <= 4
    again = shards.assigned(docs.repartition(7)).toPandas().set_index("doc_id").sort_index()
    first = rows.set_index("doc_id").sort_index()
    assert (again["shard"] == first["shard"]).all() and (again["slot"] == first["slot"]).all()


def test_shards_of_odd_rows(spark, odd):
    rows = shards.assigned(odd).collect()
    assert len(rows) == 10 and len({(r["shard"], r["slot"]) for r in rows}) == 10
    texts = {r["doc_id"]: r["text"] for r in odd.collect() if r["doc_id"]}
    for r in rows:
        if r["doc_id"]:
            raw = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
    assert shards.assigned(odd.limit(0)).count() == 0


def test_shards_are_written_whole(spark, odd, tmp_path):
    plain = odd.drop("shard")
    shards.write_shards(plain, str(tmp_path / "out"), 3)
    read = spark.read.parquet(str(tmp_path / "out"))
    assert read.count() == 10 and {"text", "rep", "slot", "shard"} <= set(read.columns)


def brute_top(rows, k=5, every=50):
    kept = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, q in kept:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in kept if j != i)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(i, [0.0] * 6) for i in range(1500, 1600)] + [(50, rows[50][1])]
    rows += [(1601, None), (1650, [1.0, None]), (1700, [float("nan")]), (1750, []), (None, [1.0] * 6),
             (1800, [1.0]), (1801, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = topk.searched(df)
    assert sorted(tuple(r) for r in found.collect()) == brute_top(rows)
    assert topk.searched(df.limit(0)).count() == 0
    big = [(0, [3e38, 1.0]), (1, [3e38, 1.0]), (2, [-3e38, 0.0])]
    far = topk.searched(spark.createDataFrame(big, df.schema)).collect()
    assert [(r["vec_id"], r["score"]) for r in far] == [(1, 2**63 - 1), (2, -(2**63))]


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 16))
    near = np.repeat(rng.normal(size=(4, 16)), 30, 0) + 0.08 * rng.normal(size=(120, 16))
    every = np.vstack([base, near, np.repeat(base[:1], 40, 0)]).astype(np.float32)
    rows = [(i, v.tolist(), int(i % 2), "x", 1) for i, v in enumerate(every)]
    rows += [(900, None, 1, "x", 1), (901, [0.0] * 16, 1, None, 1), (902, [float("nan")] * 16, 1, "x", 1),
             (903, every[0].tolist(), None, "x", 1), (904, [], 1, "x", 1), (905, [1.0, None], 1, "x", 1)]
    df = spark.createDataFrame(rows, VECS)
    found = {r["vec_id"]: r for r in vectors.near_duplicates(df, piece=32, nearest=2).collect()}
    assert len(found) == len(rows)
    unit = every.astype(float) / np.linalg.norm(every.astype(float), axis=1, keepdims=True)
    same = np.arange(len(every)) % 2
    link = (unit @ unit.T >= 0.93) & (same[:, None] == same[None, :])
    np.fill_diagonal(link, False)
    got = np.array([found[i]["n_links"] for i in range(len(every))])
    assert (got <= link.sum(1)).all() and got.sum() >= 0.95 * link.sum()
    for i in range(len(every)):
        assert found[i]["kept"] == (found[i]["component_id"] == i)
    for i in range(900, 906):
        assert tuple(found[i]) == (i, 0, i, True)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def hot_group_and_pairs(hot, pairs, dim=64, seed=11):
    """Near copies of one vector, then pairs of near copies; and the number of links of each."""
    rng = np.random.default_rng(seed)
    middles = np.vstack([np.repeat(rng.normal(size=(1, dim)), hot, 0),
                         np.repeat(rng.normal(size=(pairs, dim)), 2, 0)])
    every = (middles + 0.12 * rng.normal(size=middles.shape)).astype(np.float32)
    unit = every.astype(float) / np.linalg.norm(every.astype(float), axis=1, keepdims=True)
    link = unit @ unit.T >= 0.93
    np.fill_diagonal(link, False)
    return every, link


@pytest.mark.parametrize("hot, pairs", [(100, 462), (340, 342)])
def test_vectors_links_outside_a_hot_group(spark, hot, pairs):
    every, link = hot_group_and_pairs(hot, pairs)
    assert (link.sum(1)[hot:] == 1).all() and link[:hot].sum(1).min() > vectors.POOL
    rows = [(i, v.tolist(), 1, "x", 1) for i, v in enumerate(every)]
    found = {r["vec_id"]: r for r in vectors.near_duplicates(spark.createDataFrame(rows, VECS)).collect()}
    assert [found[i]["n_links"] for i in range(len(rows))] == link.sum(1).tolist()
    assert all(found[i]["component_id"] == i - (i - hot) % 2 for i in range(hot, len(rows)))


def test_vectors_audit_of_every_size_of_group(spark):
    every, _ = hot_group_and_pairs(0, 100, dim=16, seed=12)
    hot = every[:1] * -1 + 0.001 * np.arange(6)[:, None]  # six vectors, each with 300 copies
    every = np.vstack([every, np.repeat(hot, 300, 0)]).astype(np.float32)
    unit = every.astype(float) / np.linalg.norm(every.astype(float), axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.93).sum(1) - 1
    df = spark.createDataFrame([(i, v.tolist(), 1, "x", 1) for i, v in enumerate(every)], VECS)
    found = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(df, piece=16, nearest=1).collect()}
    linked = np.flatnonzero(true[:200] > 0)
    share = np.array([found[i] / true[i] for i in linked])
    assert len(linked) > 150 and share.max() <= 1 and share.mean() >= vectors.RECALL
    assert all(found[i] == true[i] for i in range(200, len(every)))


def test_vectors_raise_where_links_stay_lost(spark, monkeypatch):
    every, _ = hot_group_and_pairs(200, 30)
    whole = vectors.linked
    few = F.when(F.col("links") > 10, F.col("links")).otherwise(0).alias("links")
    monkeypatch.setattr(vectors, "linked", lambda *a: whole(*a).select("rep", few, "to"))
    df = spark.createDataFrame([(i, v.tolist(), 1, "x", 1) for i, v in enumerate(every)], VECS)
    with pytest.raises(RuntimeError, match="links are missing"):
        vectors.near_duplicates(df)


def test_robust_pruning_keeps_the_nearest():
    unit = np.random.default_rng(3).normal(size=(100, 8))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    sims = unit @ unit.T - 2 * np.eye(100)
    lists = vectors.pruned(unit)
    assert all(sims[i].argmax() in a and len(a) <= vectors.DEGREE for i, a in enumerate(lists))


def test_language(spark):
    docs, pages = table(spark, SMALL, "documents"), table(spark, SMALL, "pages")
    rows = language.identified(pages, docs).toPandas()
    said = rows["url"].str.extract(r"/(en|fr|de|es)/")[0]
    assert len(rows) == pages.count() and (rows["lang"] == said)[said.notna()].mean() > 0.95
    blank = [(None, None, None), (1, "not a url", ""), (1, "not a url", ""), (2, "http://a.b/", "<html lang=fr-FR>")]
    odd_pages = spark.createDataFrame(blank, "page_id bigint, url string, html string")
    found = language.identified(odd_pages, docs).collect()
    assert len(found) == 4 and {r["text_lang"] for r in found} == {"und"}
    assert {r["declared"] for r in found} == {"", "fr"}
    assert language.identified(odd_pages.limit(0), docs).count() == 0
    assert {r["lang"] for r in language.identified(odd_pages, docs.limit(0)).collect()} == {"und"}


def brute_fingerprint(text):
    words = (text or "").lower().split() if (text or "").isascii() else None
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash(spark, odd):
    rows = {}
    for r in simhash.near_duplicates(odd).collect():
        rows.setdefault(r["doc_id"], []).append((r["fingerprint"], r["component_id"]))
    for r in odd.where("doc_id IS NOT NULL").collect():
        assert rows[r["doc_id"]][0][0] == f"{brute_fingerprint(r['text']):016x}"
    assert len(rows[5]) == 2 and rows[5][0] == rows[5][1] == rows[6][0]
    assert rows[2][0] == rows[3][0] == rows[7][0] == ("0" * 16, 2)
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == [1, 2, 4, 5]
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_simhash_finds_every_pair_within_two_bits(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-2**63, 2**63 - 1, 60, dtype=np.int64)
    fps = set(base.tolist())
    for fp in base[:40]:
        for bits in [(a,) for a in rng.integers(0, 64, 3)] + [tuple(rng.integers(0, 64, 2)) for _ in range(4)]:
            mask = np.int64(0)
            for b in bits:
                mask ^= np.uint64(1 << int(b)).astype(np.int64)
            fps.add(int(fp ^ mask))
    all_fps = sorted(fps)
    near = {(a, b) for i, a in enumerate(all_fps) for b in all_fps[i + 1:] if (a ^ b & (2**64 - 1)).bit_count() <= 2
            and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    df = spark.createDataFrame([(f,) for f in all_fps], "fp bigint")
    roots = {r["node"]: r["root"] for r in graph.components(simhash.links(df)).collect()}
    assert near and all(roots[a] == roots[b] for a, b in near)


def test_bpe_matches_the_library(spark, odd):
    from tokenizers import Tokenizer

    docs = odd.unionByName(table(spark, SMALL, "documents").where("doc_id >= 10").select(
        "*", F.lit("x").alias("shard"), F.lit(1).alias("rep")))
    known = Tokenizer.from_file(tokenizer_file())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = [r for r in bpe.round_trip(docs, tokenizer_file()).collect() if r["doc_id"] is not None]
    for r in rows:
        ids = known.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = known.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip(odd.limit(0), tokenizer_file()).count() == 0


def test_quality(spark, odd, labels):
    docs = table(spark, SMALL, "documents")
    rows = quality.classify(docs, labels).join(labels, "doc_id").toPandas()
    test = rows[rows["held_out"]]
    assert (test["predicted"] == test["quality"]).mean() > 0.75
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows.itertuples())
    found = quality.classify(odd, labels).collect()
    assert len(found) == 10 and all(0 <= r["score"] <= 1 for r in found)
    assert quality.classify(odd.limit(0), labels.limit(0)).count() == 0
    assert quality.accepted(odd, labels).columns == odd.columns


def test_mixing(spark, odd, labels):
    docs = table(spark, SMALL, "documents")
    rows = mixing.mixture(docs, labels, TARGET_WEIGHTS).toPandas()
    assert len(rows) == docs.count() and (rows["rate"] >= 0).all()
    assert (abs(rows["copies"] - rows["rate"]) < 1).all()
    assert mixing.mixture(odd, labels.limit(0), TARGET_WEIGHTS).select("rate").distinct().collect() == [(1.0,)]
    assert mixing.mixed(odd, labels, TARGET_WEIGHTS).columns == odd.columns
    assert mixing.mixture(odd.limit(0), labels, TARGET_WEIGHTS).count() == 0
    # the totals that the rows add up to are the targets
    n, p = rows["n_tokens"].to_numpy(), pd.DataFrame([json.loads(x) for x in rows["posterior"]])
    have, got = p.mul(n, axis=0).sum(), p.mul(n * rows["rate"], axis=0).sum()
    wanted = mixing.targets_for(tuple(have.index), have.to_numpy(), TARGET_WEIGHTS)
    assert abs(got / wanted - 1).max() < 1e-3 and (rows["error"] <= mixing.TOLERANCE).all()


def test_mixing_takes_its_sample_from_the_documents_at_hand(spark):
    """A domain of one document stays, however many labels of other documents there are."""
    docs = spark.createDataFrame([(1, "bad bad words"), (2, "fine calm text"), (3, "text")],
                                 "doc_id bigint, text string")
    named = spark.range(100_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") == 1, "toxic").otherwise("clean").alias("domain")
    )
    model = mixing.fit(docs, named, rows=1)
    assert model.names == ("clean", "toxic")
    assert model.posterior(mixing.hashed_words(b"bad words")).argmax() == 1


def test_mixing_reaches_targets_that_need_rates_of_zero(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.3, 0.3], 500)
    rows = [(i, int(n), [float(v) for v in q])
            for i, (n, q) in enumerate(zip(rng.integers(1, 900, 500), p))]
    members = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, p array<double>")
    fit = mixing.solve(members, ("a", "b", "c"), {"a": 0.85, "b": 0.05, "c": 0.1})
    rates = fit.rates.of(p)
    totals = (p * (rates * np.array([n for _, n, _ in rows]))[:, None]).sum(axis=0)
    assert (rates >= 0).all() and (rates == 0).any() and fit.error <= mixing.TOLERANCE
    assert abs(totals / fit.targets - 1).max() <= 2 * mixing.TOLERANCE
    # beyond any rates: every document is half of each, so equal totals are all there is
    even = members.select("doc_id", "n_tokens", F.array(F.lit(0.5), F.lit(0.5)).alias("p"))
    stuck = mixing.solve(even, ("a", "b"), {"a": 0.9, "b": 0.1})
    assert stuck.error > mixing.TOLERANCE and len(stuck.rates.steps) <= mixing.MAX_STEPS


def test_mixing_tells_of_weights_that_nothing_can_meet():
    with pytest.warns(UserWarning, match="toxic"):
        wanted = mixing.targets_for(("clean",), np.array([9.0]), {"clean": 0.5, "toxic": 0.5})
    assert wanted.tolist() == [9.0]


def test_personal_data_the_rules_cannot_see(spark):
    """The network's own spans: planted in texts it was not trained on, in other spellings."""
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    net = pii.fit(docs.where("doc_id % 4 <> 1"))
    held = docs.where("doc_id % 4 = 1").orderBy("doc_id").toPandas()["text"].fillna("")
    plain = pii.find(list(held), net)
    false = sum(len(spans) - len(base) for base, spans in plain)
    rng, wanted, hits, added = np.random.default_rng(5), 0, 0, 0
    for text, (base, _) in zip(held, plain):
        made, at, gold = "", 0, set()
        for a, b, kind in base:
            if a < at:
                continue
            made += text[at:a]
            for piece, inside in pii.spelled(text[a:b], kind, rng):
                if inside:
                    gold.add((len(made), len(made) + len(piece), kind))
                made += piece
            at = b
        made += text[at:]
        ruled, spans = pii.find([made], net)[0]
        assert ruled == pii.rule_spans(made) and set(ruled) <= set(spans)
        gold = {g for g in gold if not any(a < g[1] and g[0] < b for a, b, _ in ruled)}
        new = set(spans) - set(ruled)
        wanted, hits, added = wanted + len(gold), hits + len(gold & new), added + len(new)
    assert wanted >= 100 and hits >= 0.8 * wanted and hits >= 0.8 * added and false <= len(held) / 100


def test_personal_data_cut_by_windows_is_joined():
    # parts: start, end, kind, score, cut on the left, cut on the right
    parts = [(70, 80, 0, 1.0, False, True), (80, 120, 0, 0.5, True, True), (100, 130, 0, 1.0, True, False),
             (10, 20, 1, 1.0, False, True), (20, 40, 2, 1.0, True, False), (300, 310, 0, 1.0, True, False)]
    assert [s[:3] for s in pii._joined(parts)] == [(70, 130, 0)]
    assert pii._joined([]) == []
    many = [p for i in range(20_000) for p in ((i * 100, i * 100 + 20, 3, 1.0, False, True),
                                               (i * 100 + 10, i * 100 + 50, 3, 1.0, True, False))]
    assert len(pii._joined(many)) == 20_000


def test_personal_data_of_an_empty_table(spark, odd):
    assert pii.fit(odd.limit(0)) is None
    assert pii.personal_data(odd.limit(0), None).count() == 0
    assert pii.redacted(odd.limit(0), None).columns == odd.columns


def test_personal_data(spark, odd):
    model = pii.fit(table(spark, SMALL, "documents"))
    rows = {r["doc_id"]: r for r in pii.personal_data(odd, model).collect()}
    one = rows[1]
    assert (one["n_email"], one["n_phone"], one["n_ip"], one["n_card"]) == (1, 1, 0, 0)
    base = "phone:5:21,email:25:36"
    assert one["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert set(base.split(",")) <= set(one["spans"].split(","))
    assert rows[2]["spans"] == "" and rows[3]["n_email"] == 0
    assert pii.redacted(odd, model).columns == odd.columns
