"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from trailmark.llm import neighbours

SURE = 1 - 1e-13  # the chi-square test then rules out next to nothing


def _usable(v):
    return v and all(x is not None and np.isfinite(x) for x in v) and any(np.float32(x) for x in v)


def _plain(rows, query_ids, k):
    usable = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and _usable(v)]
    found = []
    for q in sorted({i for i, _ in usable if i in query_ids}):
        asked = np.array(min(tuple(v) for i, v in usable if i == q))
        scores = sorted((-float((v * asked).sum()), i) for i, v in usable if i != q and len(v) == len(asked))
        found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return found


def _run(vectors_of, rows, query_ids, k, **how):
    vectors = neighbours.usable_vectors(vectors_of(rows))
    got = neighbours.nearest(vectors, vectors.where(vectors.id.isin(list(query_ids))), k=k, **how)
    assert got.columns == ["query_id", "rank", "id", "score"]
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "double"]
    return sorted(map(tuple, got.collect()))


@pytest.fixture
def small(monkeypatch):
    for name, value in (("CELL", 40), ("LEAF", 8), ("QUERY_BLOCK", 5), ("QUERIES_AT_ONCE", 3), ("MOST_CELLS", 6)):
        monkeypatch.setattr(neighbours, name, value)


def test_exact_where_the_test_never_holds(vectors_of, small):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-9, 9, 8).astype(float).tolist()) for i in range(400)]  # whole numbers: many ties
    rows += [(400 + i, [1000.0 * x for x in rows[i][1]]) for i in range(30)]  # far longer
    rows += [(500 + i, rows[3][1]) for i in range(60)] + [(600 + i, rows[i][1][:3]) for i in range(20)]
    queries = {*range(0, 640, 25), 3, 503, 559}
    assert _run(vectors_of, rows, queries, 7, confidence=SURE) == _plain(rows, queries, 7)


@pytest.mark.parametrize("shape", ["clusters", "random"])
def test_recall(vectors_of, small, shape):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 32)) * (3 if shape == "clusters" else 0)
    rows = [(i, (centres[i % 30] + rng.normal(size=32)).tolist()) for i in range(1500)]
    queries = set(range(0, 1500, 20))
    got, true = _run(vectors_of, rows, queries, 20), _plain(rows, queries, 20)
    assert len(got) == len(true)
    exact = {(q, i): s for q, _, i, s in true}
    assert len([1 for q, _, i, _ in got if (q, i) in exact]) >= 0.9 * len(true)
    vectors = dict(rows)
    for q, _, i, s in got:
        product = np.array(vectors[q], dtype=np.float32).astype(float) * np.array(vectors[i], dtype=np.float32).astype(float)
        assert s == pytest.approx(product.sum(), abs=1e-12)


def test_defined_cases(vectors_of):
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, []), (5, [1.0, None]), (6, [float("nan"), 1.0]),
            (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [1.0]), (9, [0.0, 0.0]), (10, [1.0, 0.0]), (11, [-0.5, 0.0]),
            (12, [1e-30, 1e-30]), (13, [3e30, 1.0])]
    queries = {1, 3, 8, 9, 13}
    assert _run(vectors_of, rows, queries, 5, confidence=SURE) == _plain(rows, queries, 5)
    assert _run(vectors_of, rows, queries, 2, confidence=SURE) == _plain(rows, queries, 2)
    assert _run(vectors_of, [], {1}, 5) == []
    assert _run(vectors_of, [(1, [1.0])], {1}, 5) == []
    assert _run(vectors_of, [(1, [1.0])], set(), 5) == []


def test_repeated_rows_and_ids(vectors_of):
    rows = [(1, [1.0]), (1, [0.5]), (1, [0.5]), (2, [1.0]), (2, [1.0]), (3, [0.25])] + [(4, [0.75])] * 9
    for k in (3, 5, 30):
        assert _run(vectors_of, rows, {1, 4}, k, confidence=SURE) == _plain(rows, {1, 4}, k)


def test_quantiles():
    rng = np.random.default_rng(3)
    for dims, p in ((2, 0.5), (16, 0.95), (16, 0.05)):
        assert (rng.chisquare(dims, 200_000) <= neighbours.quantile(p, dims)).mean() == pytest.approx(p, abs=0.005)
    with pytest.raises(ValueError):
        neighbours.nearest(None, None, dims=3)
