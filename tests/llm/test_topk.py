"""Exact top-k against brute force."""

import random

import numpy as np

from trailmark.llm import topk


def _plain(rows, query_ids, k):
    usable = [(i, np.floor(np.array(v, dtype=np.float32).astype(float) * 256).astype(int)) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    found = set()
    for q in sorted({i for i, _ in usable if i in query_ids}):
        asked = min(tuple(v) for i, v in usable if i == q)
        scores = sorted((-int(np.dot(v, asked)), i) for i, v in usable if i != q and len(v) == len(asked))
        found |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return found


def _run(vectors_of, rows, query_ids, k=5):
    vectors = topk.integer_vectors(vectors_of(rows))
    got = topk.top_k(vectors, vectors.where(vectors.id.isin(list(query_ids))), k=k).collect()
    assert len(got) == len({tuple(r) for r in got})
    return {(r.query_id, r["rank"], r.id, r.score) for r in got}


def test_random_vectors_in_small_blocks(vectors_of, monkeypatch):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # many ties
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "BINS", 16)
    queries = set(range(0, 460, 20)) | {7}
    assert _run(vectors_of, rows, queries) == _plain(rows, queries, 5)


def test_defined_cases(vectors_of):
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, []), (5, [1.0, None]), (6, [float("nan"), 1.0]),
            (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [1.0]), (9, [0.0, 0.0]), (10, [1.0, 0.0]), (11, [-0.001, 0.0])]
    queries = {1, 3, 8, 9}
    assert _run(vectors_of, rows, queries) == _plain(rows, queries, 5)
    assert _run(vectors_of, rows, queries, k=2) == _plain(rows, queries, 2)
    assert _run(vectors_of, [], {1}) == set()
    assert _run(vectors_of, [(1, [1.0])], {1}) == set()


def test_repeated_rows(vectors_of):
    vectors = topk.integer_vectors(vectors_of([(1, [1.0]), (1, [0.5]), (2, [1.0]), (2, [1.0]), (3, [0.25])]))
    got = topk.top_k(vectors, vectors.where("id = 1"), k=5).collect()
    assert [(r["rank"], r.id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [
        (1, 2, 128 * 256), (2, 2, 128 * 256), (3, 3, 128 * 64)]


def test_large_components(vectors_of):
    rows = [(i, [float(1 << 30) + 4096.0 * i, -3.0]) for i in range(1, 9)]
    vectors = topk.integer_vectors(vectors_of(rows))
    got = topk.top_k(vectors, vectors.where("id = 4"), k=3).collect()
    exact = {i: [int(np.floor(float(np.float32(x)) * 256)) for x in v] for i, v in rows}
    want = sorted(((sum(a * b for a, b in zip(exact[i], exact[4])) + (1 << 63)) % (1 << 64) - (1 << 63), i)
                  for i in exact if i != 4)
    assert {(r.id, r.score) for r in got} <= {(i, s) for s, i in want}
