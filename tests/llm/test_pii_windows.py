"""Every window of a text goes through the network, whatever it holds."""

import numpy as np

from lakehouse_kpis.llm import lstm_crf, pii


def test_every_window_is_read(monkeypatch):
    read = []

    def tagged(net, win):
        read.append(win.copy())
        return np.zeros(0, int), win[:0], win[:0]

    monkeypatch.setattr(lstm_crf, "tagged", tagged)
    texts = ["", "plain words and nothing else " * 2000, "x" * 41, "mail me at once"]
    pii.model_spans(None, texts)
    assert all(len(win) <= pii.DECODE_BATCH for win in read)
    whole = np.concatenate(read)
    expected = [
        pii._window(lstm_crf.symbols(t), s) for t in texts for s in range(0, len(t), pii.STRIDE)
    ]
    assert np.array_equal(whole, np.array(expected))


def test_a_spelled_out_address_needs_no_digit_and_no_at_sign():
    text = "write to anna at mail.example.org soon"
    span = (text.index("anna"), text.index(" soon"), 0)
    assert pii.reconcile(text, [], [(*span, 0.95)]) == [span]


def test_windows_with_tags_are_those_that_decode_finds():
    rng = np.random.default_rng(3)
    net = lstm_crf.Network.fresh(6, 9)
    net.bias[0] += 1.2  # some windows without tags, some with
    net.out *= 8
    win = rng.integers(0, lstm_crf.SYMBOLS, (300, 20))
    tags, sure = lstm_crf.decode(net, win)
    rows, found, held = lstm_crf.tagged(net, win)
    expected = np.flatnonzero(tags.any(axis=1))
    assert 0 < len(rows) < len(win) and np.array_equal(rows, expected)
    assert np.array_equal(found, tags[expected])
    assert np.allclose(held, sure[expected], atol=1e-4)


def test_emissions_and_probabilities_are_those_of_the_training_passes():
    rng = np.random.default_rng(5)
    net = lstm_crf.Network.fresh(7, 9)
    net.bias += rng.standard_normal(9).astype(np.float32)
    win = rng.integers(0, lstm_crf.SYMBOLS, (33, 25))
    e = lstm_crf._emissions(net, win)[0]
    assert np.allclose(lstm_crf._inferred(net, win), e, atol=1e-5)
    alpha, beta, total = lstm_crf._forward_backward(net, e)
    assert np.allclose(lstm_crf._marginals(net, e), np.exp(alpha + beta - total[:, None]), atol=1e-5)


def test_the_sample_takes_one_pass(spark, tmp_path):
    texts = [f"write to user{i}@mail{i}.example.org or not" if i % 3 else f"room {i} is free" for i in range(40)]
    documents = spark.createDataFrame([(t,) for t in texts], "text string")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    x, y = pii.sample(documents.mapInPandas(counted, "text string"), 12)
    assert read.value == len(texts)
    assert list(y.any(axis=1)) == [True] * 6 + [False] * 6


def test_windows_of_many_blocks_are_decoded_together(monkeypatch):
    rng = np.random.default_rng(4)
    net = lstm_crf.Network.fresh(6, 9)
    net.bias[0] += 1.2
    net.out *= 8
    win = rng.integers(0, lstm_crf.SYMBOLS, (3 * lstm_crf.BLOCK + 7, 20))
    tags, sure = lstm_crf.decode(net, win)
    best, calls = lstm_crf._best, []
    monkeypatch.setattr(lstm_crf, "_best", lambda net, e: calls.append(e.shape[1]) or best(net, e))
    rows, found, held = lstm_crf.tagged(net, win)
    expected = np.flatnonzero(tags.any(axis=1))
    assert len(calls) == 1 and 0 < calls[0] < len(win)
    assert np.array_equal(rows, expected) and np.array_equal(found, tags[expected])
    assert np.allclose(held, sure[expected], atol=1e-4)


def test_few_windows_leave_a_task_of_the_sample(spark):
    texts = [f"write to user{i}@mail{i}.example.org" if i % 2 else f"room {i} DOT" for i in range(400)]
    documents = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    x, y = pii.sample(documents, 2 * len(texts))  # no bound on the rows
    few_x, few_y = pii.sample(documents, 8)
    spans = y.any(axis=1)
    assert np.array_equal(few_x, np.concatenate([x[spans][:4], x[~spans][:4]]))
    assert np.array_equal(few_y, np.concatenate([y[spans][:4], y[~spans][:4]]))
    numbers = np.random.default_rng(6).integers(0, 500, 3000).tolist()
    least, admitted = pii._Least(20), []
    for n in numbers:
        if least.admits(n):
            admitted.append(n)
    smallest = sorted(set(numbers))[:20]
    # every copy of what is taken leaves the task, and little else
    assert [n for n in admitted if n in smallest] == [n for n in numbers if n in smallest]
    assert len(admitted) < 500 and not pii._Least(0).admits(1)


def test_addresses_of_four_numbers():
    text = "1.2.3.4.5 9.9.9 300.1.1.1 a7.7.7.7b 1.1.1. 2.2.2.2 12345.6.7.8 0001.02.3.4"
    found = [text[a:b] for a, b, kind in pii.rule_spans(text) if kind == 1]
    assert found == ["1.2.3.4", "7.7.7.7", "2.2.2.2", "0001.02.3.4"]
