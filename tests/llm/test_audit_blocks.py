"""Blocks of the filter audit stay small: a task holds several copies of the one it works on."""

import pyarrow as pa

from lakehouse_kpis.llm import filter_audit


def test_a_block_ends_at_a_million_words():
    words, texts = 1 << 12, 400
    text = " ".join(f"w{i % 97}" for i in range(words))
    batches = [pa.record_batch({"text": pa.array([text] * 10), "id": pa.array(range(10))})
               for _ in range(texts // 10)]
    held = [len(b.column("id")[0].values) * words for b in filter_audit._blocks(["id"])(iter(batches))]
    assert sum(held) == words * texts
    assert max(held) <= (1 << 20) + 10 * words
