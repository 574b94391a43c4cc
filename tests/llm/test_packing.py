"""Packing plans against a walk over every piece, and whole packings."""

import random
import struct
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from trailmark.llm import bpe, packing


def _walk(histogram, capacity):
    plan = packing.Plan(dict(histogram), capacity)
    bins = defaultdict(list)
    for length, n in histogram.items():
        if n:
            where, offset = plan.place(np.full(n, length, dtype=np.int64), np.arange(n))
            for b, o in zip(where.tolist(), offset.tolist()):
                bins[b].append((o, length))
    assert len(bins) == plan.bins
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in held) <= 2
    return plan.bins


def test_random_plans():
    rng = random.Random(2)
    for _ in range(400):
        capacity = rng.choice([10, 12, 30, 64])
        lengths = rng.sample(range(1, capacity + 1), rng.randint(0, min(capacity, 12)))
        histogram = {n: rng.choice([0, 1, 2, 3, 7, 50]) for n in lengths}
        bins = _walk(histogram, capacity)
        assert bins >= -(-sum(n * c for n, c in histogram.items()) // capacity)


def test_known_plans():
    assert _walk({60: 3, 40: 3}, 100) == 3
    assert _walk({51: 4}, 100) == 4
    assert _walk({50: 5}, 100) == 3
    assert _walk({20: 6, 70: 2, 10: 2}, 100) == 3
    assert _walk({}, 100) == 0


def _check(rows, texts, capacity):
    tokenizer = Tokenizer.from_file(bpe.default_tokenizer())
    want = defaultdict(int)
    for i, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for number, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[i, number, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    got, bins = defaultdict(int), defaultdict(list)
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        bins[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_operator(docs_of):
    rng = random.Random(4)
    texts = [(i, " ".join(rng.choices(["one", "two", "elephants", "x,"], k=rng.randint(0, 60)))) for i in range(150)]
    texts += [(500, None), (501, ""), (502, "word " * 900), (503, "same text"), (503, "same text"), (None, "no id")]
    bins = _check(packing.pack(docs_of(texts), capacity=128).collect(), texts, 128)
    total = sum(len(Tokenizer.from_file(bpe.default_tokenizer()).encode(t or "", add_special_tokens=False).ids) + 1
                for _, t in texts)
    assert bins <= 1.03 * total / 128 + 1


def test_one_length_over_many_salts(docs_of, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 10)
    texts = [(i, "three word text") for i in range(300)]
    assert _check(packing.pack(docs_of(texts), capacity=32).collect(), texts, 32) == -(-300 // 8)


def test_empty_table_and_ids(docs_of):
    assert packing.pack(docs_of([])).count() == 0
    row = packing.pack(docs_of([(1, "hello")]), with_ids=True).first()
    assert bytes(row.ids)[-4:] == struct.pack("<I", 1) and len(row.ids) == 4 * row.length
