import random

import corpus_pipeline
from lakehouse_kpis.llm import simhash
from lakehouse_kpis.llm.tables import table

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_tokens_come_last(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "personal_data", "mixture", "tokens"
    ]
    docs = table(spark, SMALL, "documents")
    good = corpus_pipeline.keep_good(spark, docs, SMALL)
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and {"doc_id", "n_tokens"} <= set(rows[0].asDict())
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()}


def test_empty_documents(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(5)
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = [text(120) for _ in range(20)]
    for i in range(20):  # copies, one word changed, or words added
        texts.append(texts[i] if i % 3 == 0 else [*texts[i][:-1], "other"] if i % 3 == 1 else texts[i] + text(3))
    hot = text(600)
    texts += [[*hot[:50 + i], f"x{i}", *hot[51 + i:]] for i in range(60)]
    texts += [[], [], ["a", "b"], ["A", "b"], texts[0]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    prints = [simhash.fingerprint(t.encode()) for _, t in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 2:
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(root)) and len(kept) < len(rows) - 15
