"""Links and components against brute force, recall on deeper trees."""

import numpy as np
import pyarrow as pa

from trailmark.llm import embedding_dedup


def _plain(rows, threshold=0.95):
    usable = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {k: np.array(rows[k][1], dtype=np.float32).astype(float) for k in usable}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    links, to = [0] * len(rows), list(range(len(rows)))

    def root(k):
        while to[k] != k:
            k = to[k]
        return k
    for n, a in enumerate(usable):
        for b in usable[n + 1:]:
            if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                to[root(b)] = root(a)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [(i, links[k], least.get(root(k)), i is not None and i == least[root(k)]) for k, (i, _) in enumerate(rows)]


def _order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def _clustered(rng, n, dim, spread):
    base = rng.normal(size=(n // 8, dim))
    vectors = base[rng.integers(0, len(base), n)] + rng.normal(size=(n, dim)) * spread
    return [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]


def test_small_table_is_exact(vectors_of):
    rows = _clustered(np.random.default_rng(1), 300, 16, 0.2)
    rows += [(1000 + i, rows[3][1]) for i in range(20)] + [(2000, [2 * x for x in rows[3][1]])]
    got = embedding_dedup.near_duplicates(vectors_of(rows)).collect()
    assert _order(got) == _order(_plain(rows))


def test_defined_cases(vectors_of):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, None), (4, []), (5, [1.0, None]), (6, [float("nan"), 1.0]),
            (7, [float("inf"), 0.0]), (8, [0.0, 0.0]), (9, [1.0]), (10, [3.0]), (None, [1.0, 0.02]), (None, [0.0, -5.0]),
            (2, [1.0, 0.01]), (11, [-1.0, 0.0])]
    assert _order(embedding_dedup.near_duplicates(vectors_of(rows)).collect()) == _order(_plain(rows))
    assert embedding_dedup.near_duplicates(vectors_of([])).count() == 0


def test_recall_of_deep_trees(vectors_of):
    rows = _clustered(np.random.default_rng(2), 1500, 32, 0.14)
    want = {i: (n, c) for i, n, c, _ in _plain(rows)}
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors_of(rows), leaf=64).collect()}
    total = sum(n for n, _ in want.values())
    assert total > 2000 and all(got[i].n_links <= n for i, (n, _) in want.items())
    assert sum(r.n_links for r in got.values()) >= 0.9 * total
    assert sum(got[i].component_id == c for i, (_, c) in want.items()) >= 0.95 * len(rows)


def test_large_leaves_are_cut_further(vectors_of, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SAMPLE", 100)  # so the fitted trees are far too small
    rows = _clustered(np.random.default_rng(3), 1200, 32, 0.14)
    want = {i: n for i, n, _, _ in _plain(rows)}
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(vectors_of(rows), leaf=16, trees=12).collect()}
    assert all(got[i] <= n for i, n in want.items())
    assert sum(got.values()) >= 0.8 * sum(want.values())


def test_group_larger_than_a_leaf_is_compared_whole(vectors_of):
    rng = np.random.default_rng(4)
    copies = rng.normal(size=64) + rng.normal(size=(1500, 64)) * 0.14  # cosines of about 0.98
    vectors = np.concatenate([copies, rng.normal(size=(900, 64))])[rng.permutation(2400)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    unit = vectors.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    want = near.sum(axis=1) - 1
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors_of(rows), leaf=64).collect()}
    assert want.sum() > 2_000_000 and all(got[i].n_links <= n for i, n in enumerate(want))
    assert sum(r.n_links for r in got.values()) >= 0.99 * want.sum()
    group = np.nonzero(want)[0]
    assert all(got[i].component_id == group.min() for i in group.tolist())


def test_blocks_of_a_leaf_count_each_pair_once():
    rng = np.random.default_rng(5)
    n = 1400
    vectors, block = rng.normal(size=8) + rng.normal(size=(n, 8)) * 0.3, rng.integers(0, 2, n)
    leaves = [sorted({5, *rng.choice([1, 2, 9], rng.integers(0, 3)).tolist()}) for _ in range(n)]
    links = np.zeros(n, dtype=int)
    for low, high in ((0, 0), (0, 1), (1, 1)):
        at = np.nonzero((block == low) | (block == high))[0]
        table = pa.table({"leaf_dim": [8] * len(at), "leaf": [5] * len(at), "low": [low] * len(at), "high": [high] * len(at),
                          "block": block[at], "node": at, "copies": at % 3 + 1, "vector": vectors[at].tolist(),
                          "leaves": [leaves[i] for i in at]})
        found = embedding_dedup._compare(0.95)(table)
        np.add.at(links, found.column("node").to_numpy(), found.column("links").to_numpy())
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    held = np.array([[x in y for x in (1, 2)] for y in leaves])
    new = (unit @ unit.T >= 0.95) & ~(held[:, None] & held[None]).any(axis=2) & ~np.eye(n, dtype=bool)
    assert new.sum() > 4 * embedding_dedup.PAIRS_AT_ONCE and (links == new @ (np.arange(n) % 3 + 1)).all()
