"""Fingerprints and components against brute force."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from trailmark.llm import simhash
from trailmark.llm.components import connected_components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    rows = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, nodes):
    to = {n: n for n in nodes}

    def root(n):
        while to[n] != n:
            n = to[n]
        return n
    for a, b in pairs:
        x, y = root(a), root(b)
        to[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_fingerprints():
    for text in ("", " \t\n", "one", "One two", "a b c", "A b C d\x0be\x1cf", "É é " * 50, "x y z " * 70000):
        assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def _family(rng, base, bits):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


def test_links_of_random_fingerprints(spark, monkeypatch):
    rng = random.Random(9)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        prints |= {_family(rng, base, rng.randint(0, 4)) for _ in range(25)}
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    values = np.array(prints, dtype=np.int64).view(np.uint64)
    for bits in (0, 1, 2):
        near = np.argwhere(np.triu(np.bitwise_count(values[:, None] ^ values[None]) <= bits, 1))
        want = plain_components([(prints[a], prints[b]) for a, b in near], prints)
        for hot in (64, 3, 0):  # with 0 every shared bucket goes the way of hot ones
            monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
            links = [tuple(r) for r in simhash.near_links(df, bits).distinct().collect()]
            assert all((a ^ b) % (1 << 64) and ((a ^ b) % (1 << 64)).bit_count() <= bits for a, b in links)
            assert plain_components(links, prints) == want


def test_operator(docs_of):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(40):
        text = rng.choices(words, k=120)
        texts.append(" ".join(text))
        text[rng.randrange(120)] = "changed"
        texts.append(" ".join(text))
    texts += [texts[0], texts[0].upper(), None, "", "  ", "short text"]
    rows = list(zip(range(10, 10 + len(texts)), texts)) + [(10, texts[0]), (None, texts[0]), (None, "alone")]
    got = simhash.near_duplicates(docs_of(rows)).collect()
    prints = {t: plain_fingerprint(t or "") for _, t in rows}
    named = [(i, prints[t]) for i, t in rows if i is not None]
    pairs = [(a, b) for a, x in named for b, y in named if a < b and (x ^ y).bit_count() <= 2]
    want = plain_components(pairs, {i for i, _ in named})
    assert len(got) == len(rows)
    assert all(r.component_id == want[r.doc_id] for r in got if r.doc_id is not None)
    assert {(r.fingerprint % (1 << 64), r.component_id) for r in got if r.doc_id is None} == {
        (prints[texts[0]], want[10]), (plain_fingerprint("alone"), None)}
    assert simhash.near_duplicates(docs_of([])).count() == 0


def test_keep_one(docs_of):
    rows = [(5, "one two three four"), (3, "one two three four"), (3, "one two three four"), (9, "other words here now"),
            (None, "one two three four"), (7, None), (8, "")]
    kept = simhash.keep_one(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [
        (0, "one two three four"), (3, "one two three four"), (7, ""), (9, "other words here now")]


def test_keep_one_of_repeated_ids(docs_of):
    rows = [(7, "one two three four"), (7, "five six seven eight"), (7, "five six seven eight"), (2, "one two three four"),
            (9, "five six seven eight"), (4, None), (4, "nine ten eleven twelve")]
    kept = simhash.keep_one(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [
        (2, "one two three four"), (4, ""), (4, "nine ten eleven twelve"), (7, "five six seven eight")]
    for rows in ([(4, ""), (4, None)], [(4, None), (4, "")]):  # one name: the null text is the least row
        assert [tuple(r) for r in simhash.keep_one(docs_of(rows)).select("doc_id", "text").collect()] == [(4, None)]


def test_components_of_shapes(spark):
    rng = random.Random(8)
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    loose = [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)]
    edges = chain + star + loose + [(5, 5), (None, 4)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == plain_components(real, {n for e in real for n in e})
    words = spark.createDataFrame(edges, "a long, b long").select(F.col("a").cast("string"), F.col("b").cast("string"))
    assert connected_components(words).select("component").distinct().count() == len(set(got.values()))
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
