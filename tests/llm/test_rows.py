"""What Python workers hold: texts of a batch, and tables and caches between tasks."""

import gc
import weakref
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from trailmark.llm import bpe, rows, toxicity


def test_each_text_takes_few_texts_at_once(monkeypatch):
    monkeypatch.setattr(rows, "TEXT_BYTES", 10)
    texts = ["abcd", None, "", "efg", "h" * 30, "ij", "klmnopqrs", None]
    parts = list(rows.each_text(iter([pa.array(texts), pa.array([], pa.string()), pa.array(["t"])]),
                                lambda t: -1 if t is None else len(t), pa.int64()))
    assert pa.chunked_array(parts).to_pylist() == [4, -1, 0, 3, 30, 2, 9, -1, 1]
    assert [len(p) for p in parts] == [4, 1, 1, 2, 1]


def test_a_worker_keeps_what_was_made_for_one_key():
    made = []
    for key in "aabba":
        assert rows.held(key, lambda: made.append(key) or key) == key
    assert made == ["a", "b", "a"]
    rows.let_go()


def test_scoring_keeps_no_tables_of_other_operators():
    words, filters = len(toxicity._function_rows()[0]), toxicity.FILTERS * len(toxicity.WIDTHS)
    net = toxicity.Network(np.arange(words), np.zeros((words + 1, toxicity.DIMENSIONS)),
                           [np.zeros((w, toxicity.DIMENSIONS, toxicity.FILTERS)) for w in toxicity.WIDTHS],
                           np.zeros(filters), np.zeros(filters), 0.0, np.zeros(len(toxicity.LANGUAGES) + 1))
    encoder = weakref.ref(bpe.word_bpe(bpe.default_tokenizer()))
    assert encoder() is bpe.word_bpe(bpe.default_tokenizer())
    parts = rows.each_text(iter([pa.array(["a stone", ""])]), toxicity.scorer(SimpleNamespace(value=net)).score, pa.float64())
    assert encoder() is None
    assert [x for p in parts for x in p.to_pylist()] == [0.5, 0.5]
    gc.collect()
    assert not any(isinstance(x, toxicity.Scorer) and x.network is net for x in gc.get_objects())
