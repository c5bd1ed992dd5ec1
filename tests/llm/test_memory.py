"""What tasks hold in their Python workers: bounded, and freed when they end."""

import gc
import weakref

import numpy as np
import pytest

from viewlens.llm import pieces, wordsums
from viewlens.llm import quality_classifier as qc
from viewlens.llm.batches import add_columns
from viewlens.llm.queries import piece_model

WORDS = np.random.default_rng(0).normal(size=(qc.SLOTS, qc.WIDTH)).astype(np.float32)


@pytest.fixture
def without_collector():
    gc.collect()
    gc.disable()
    yield
    gc.enable()


def test_words_are_freed_at_once(without_collector):
    pooling = qc.Pooling(WORDS)
    pooling.pool("some words")
    sums = weakref.ref(pooling.sums)
    del pooling
    assert sums() is None


def test_parts_are_freed_at_once(without_collector):
    model = pieces.Pieces(piece_model())
    assert model.round_trip("some words")[1] == "some words"
    parts = weakref.ref(model.encoded)
    del model
    assert parts() is None


def test_long_parts_are_not_remembered():
    model = pieces.Pieces(piece_model())
    text = "x" * 5000 + " short"
    assert model.round_trip(text)[1] == text
    assert max(map(len, model.encoded)) < 5000


def test_remembered_vectors_are_bounded(monkeypatch):
    monkeypatch.setattr(wordsums, "REMEMBERED_BYTES", 1 << 20)
    monkeypatch.setattr(wordsums, "WORDS", 100)
    compute = lambda words: np.array([[len(w), 1.0] * 100 for w in words])
    sums = wordsums.WordSums(200, compute)
    texts = [[f"w{i}" for i in range(start, start + 400)] for start in range(0, 8000, 300)]
    # More words than are remembered in one text, some of them twice.
    texts += [[f"v{i % 3000}" for i in range(4000)], [], texts[0], ["w1", "new", "w1"]]
    for words in texts:
        total, numbers = sums.add(words)
        assert np.allclose(total, compute(words or [""])[: len(words)].sum(axis=0))
        assert len(numbers) == len(words) and len(set(numbers)) == len(set(words))
        assert sums.vectors.nbytes <= 2 << 20


def test_kept_text_is_sent_once(documents):
    docs = documents([(1, "ab"), (2, None)])
    length = lambda texts: [[len(t or "") for t in texts]]
    for keep, added in ((None, False), (("doc_id",), True)):
        out = add_columns(docs, "text", "n int", lambda: length, keep)
        assert ("_text_" in out._jdf.queryExecution().optimizedPlan().toString()) == added
        assert {r["doc_id"]: r["n"] for r in out.collect()} == {1: 2, 2: 0}
    numbers = add_columns(docs, "doc_id", "n int", lambda: length, ("doc_id", "text"))
    assert [r["n"] for r in numbers.collect()] == [1, 1]
