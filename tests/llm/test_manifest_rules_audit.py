"""Filter audit, line rules and manifest against brute force on odd rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakehouse_kpis.llm import filter_audit, line_rules, manifest

DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, block string, words int,"
    " hashed string, row int, k string"
)
LONG = "one two three four five " * 40_000
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, ties, clashing names."""
    menu = "HOME | About 12\n"
    rows = [
        (1, "a b c d e f\n" * 30, "en", "s", 5), (2, "", "en", "s", 0), (3, None, None, None, None),
        (None, "no id here", "de", "t", 1), (None, None, None, None, None), (4, LONG, "en", "s", 1),
        (5, "same words here", "en", "s", 1), (5, "same words here", "en", "s", 1),
        (5, "other words here", "en", "s", 1), (5, "more words", "", "s", None),
        (6, "same words here", "fr", "u", 1), (7, " \n\t ", "en", "u", 1), (-9, "É é £ x", "en", "u", 1),
        (2**62, "x y z", "en", "u", 1), (-2**63, "#", "en", "u", 1), (63, "$a", "en", "u", 1),
        (64, "ONE two", "en", "u", 1), (None, "no id here", "de", "t", 1),
    ]
    rows += [(100 + i, menu.replace("12", str(i)) + " ".join(f"w{i}x{j}" for j in range(12 + 9 * (i % 12))),
              "es", "hot", i) for i in range(40)]
    rows += [(200 + i, menu + menu.upper() + "only a menu and seven more words stay", "es", "hot", i) for i in range(15)]
    return spark.createDataFrame([(*r, "b", 1, "h", 2, "k") for r in rows], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, 1, 1), (2, 0, 1), (None, 1, 1), (5, 1, 0), (101, 1, 1), (200, None, 1), (-9, 1, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_audit_against_brute_force(odd, labels):
    docs = [(r["doc_id"], r["lang"] or "", r["text"] or "") for r in odd.collect()]
    marks = {}
    for r in labels.where("doc_id IS NOT NULL").collect():
        q, t = marks.get(r["doc_id"], (False, False))
        marks[r["doc_id"]] = (q or r["quality"] == 1, t or r["toxic"] == 1)
    cells = Counter()
    for i, part, text in docs:
        words = re.findall(WORD, text)
        failed = [
            len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search("[#$%&*|]", text)),
            i is not None and any(j is not None and j < i and t == text for j, _, t in docs),
        ]
        cells[part, "".join(f for f, bad in zip("ABCDE", failed) if bad), marks.get(i, (False, False))] += 1
    want = []
    for part in {p for p, _, _ in cells}:
        own = [(set(f), q, t, n) for (p, f, (q, t)), n in cells.items() if p == part]
        rows, shapley = [], Counter()
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                gone = [(q, t, n) for held, q, t, n in own if f in held and not held & before]
                shapley[f] += sum(n for *_, n in gone)
                rows.append([
                    part, "".join(order), step, sum(n for held, *_, n in own if not held & (before | {f})),
                    sum(n for *_, n in gone), sum(n for held, *_, n in own if f in held and held & before),
                    sum(n for held, *_, n in own if held == {f}), sum(n for q, _, n in gone if q),
                    sum(n for _, t, n in gone if t), f,
                ])
        want += [(*r[:-1], shapley[r[-1]]) for r in rows]
    assert collected(filter_audit.audited(odd, labels)) == sorted(want, key=repr)


def test_matrix_holds_every_word(odd, spark):
    texts = odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    shards = filter_audit.matrix(texts).collect()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    found = Counter()
    for s in shards:
        for i, doc in enumerate(s["doc_id"]):
            for at in range(s["starts"][i], s["starts"][i + 1]):
                found[doc, s["columns"][at]] += s["counts"][at]
    words = Counter(
        (r["doc_id"], w) for r in texts.collect() for w in re.findall(WORD, r["text"])
    )
    numbers = {c for _, c in found}
    assert numbers == set(range(len({w for _, w in words})))  # a number for each word, without gaps
    assert sorted(found.values()) == sorted(words.values())
    assert Counter(c for _, c in found).values() and sorted(
        Counter(c for _, c in found).values()) == sorted(Counter(w for _, w in words).values())


def test_many_blocks_and_buckets(odd, labels, monkeypatch):
    want = collected(filter_audit.audited(odd, labels))
    monkeypatch.setattr(filter_audit, "BUCKET_WORDS", 50)
    monkeypatch.setattr(filter_audit, "BLOCK_WORDS", 100)
    assert collected(filter_audit.audited(odd.repartition(4), labels)) == want


def judged_by_hand(rows):
    def plain(line):
        p = re.sub(r"[^\w]+|_+", " ", re.sub("[0-9]+", "0", line.lower())).strip(" ")
        return p or line

    def lines(text):
        return [x for x in text.split("\n") if re.search(WORD, x)]

    docs = [(r["doc_id"], r["source"], r["text"] or "") for r in rows]
    key = lambda d: d[0] if d[0] is not None else d[2]
    hosts, held = {}, {}
    for d in docs:
        hosts.setdefault(d[1], set()).add(key(d))
        for line in lines(d[2]):
            held.setdefault((d[1], plain(line)), set()).add(key(d))
    out = []
    for d in docs:
        words = re.findall(WORD, d[2])
        five = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        n, covered = Counter(five), set()
        for i, w in enumerate(five):
            if n[w] > 1:
                covered.update(range(i, i + 5))
        own = lines(d[2])
        gone = [x for x in own if len(held[d[1], plain(x)]) > max(10, 0.01 * len(hosts[d[1]]))]
        left = len(words) - sum(len(re.findall(WORD, x)) for x in gone)
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        out.append((
            d[0], len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", d[2])),
            len(own) - len(set(own)), len(covered), len({plain(x) for x in gone}), left, failed,
            not failed and left >= 10 and left >= 0.5 * len(words),
        ))
    return sorted(out, key=repr)


def test_line_rules_against_brute_force(odd):
    found = collected(line_rules.verdicts(odd))
    assert found == judged_by_hand(odd.collect())
    assert sum(r[-1] for r in found) >= 30 and sum(not r[-1] and not r[-2] for r in found) >= 10


def test_cleaned_texts(odd):
    kept = line_rules.cleaned(odd)
    assert kept.columns == odd.columns
    verdicts = {r["doc_id"]: r["kept"] for r in line_rules.verdicts(odd).collect()}
    rows = kept.collect()
    assert {r["doc_id"] for r in rows} == {i for i, k in verdicts.items() if k}
    assert all("HOME" not in r["text"] for r in rows if r["source"] == "hot")


def test_line_rules_have_no_python(odd):
    plan = line_rules.measured(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def proofs(rows):
    def h(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def levels(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            found.append([h(*found[-1][i:i + 2]) for i in range(0, len(found[-1]), 2)])
        return found

    def path(found, i):
        for level in found[:-1]:
            yield (i ^ 1 < i, level[i ^ 1]) if i ^ 1 < len(level) else None
            i >>= 1

    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    trees = {}
    for lang in sorted(langs, key=lambda x: (x is not None, (x or "").encode())):
        leaves = sorted(
            ((r["doc_id"] is not None, r["doc_id"] or 0, h(*[field(r[c]) for c in manifest.FIELDS]), r)
             for r in langs[lang]), key=lambda x: x[:3])
        trees[lang] = leaves, levels([x[2] for x in leaves])
    top = levels([t[-1][0] for _, t in trees.values()])
    out = []
    for at, (leaves, tree) in enumerate(trees.values()):
        for i, (_, _, leaf, r) in enumerate(leaves):
            entries, x = [*path(tree, i), *path(top, at)], leaf
            if r["doc_id"] is not None and r["n_chars"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0:
                x = h(*[field(r[c] + (c == "n_chars") if c == "n_chars" else r[c]) for c in manifest.FIELDS])
            for e in entries:
                x = h(x) if e is None else h(e[1], x) if e[0] else h(x, e[1])
            out.append((r["doc_id"], leaf, tree[-1][0], top[-1][0], h(*[e[1] for e in entries if e]), x,
                        x == top[-1][0]))
    return sorted(out, key=repr)


def test_manifest_against_brute_force(odd):
    found = collected(manifest.proved(manifest.manifest(odd)))
    assert found == proofs(odd.collect())
    assert any(not r[-1] for r in found) and any(r[-1] for r in found)


def test_manifest_of_several_rounds(spark):
    docs = spark.range(0, 1500).select(
        (F.col("id") * F.col("id") - 1000).alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"),
        F.when(F.col("id") % 50 != 0, F.lit("en")).alias("lang"), F.lit(1).alias("n_chars"),
    )
    assert collected(manifest.proved(manifest.manifest(docs))) == proofs(docs.collect())


def test_empty_tables(odd, labels):
    none = odd.limit(0)
    assert filter_audit.audited(none, labels).count() == 0
    assert line_rules.verdicts(none).count() == line_rules.cleaned(none).count() == 0
    assert manifest.manifest(none).count() == 0
    assert filter_audit.audited(odd, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0
