"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from trailmark.llm import importance


def _words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def _features(words):
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return [crc32(x.encode()) % 10000 for x in runs]


def _plain(rows, target, percent=25, least_words=20, seed=7):
    docs = [(i, _words(t)) for i, t in rows]
    s, t = Counter(), Counter()
    for _, w in docs:
        s.update(_features(w))
    for _, text in target:
        t.update(_features(_words(text)))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000))))
            for b in range(10000)]
    out = []
    for i, words in docs:
        f = _features(words)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(f), weight, score, len(words) >= least_words))
    able = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is not None, x[0] or 0, x[1], x[2]))
    drawn = [x[:4] + (n + 1,) for n, x in enumerate(able[:len(able) * percent // 100])]
    rest = able[len(drawn):] + [x for x in out if not x[4]]
    return Counter(drawn + [x[:4] + (None,) for x in rest])


@pytest.fixture(scope="module")
def target_of(spark):
    return lambda rows: spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, id int")


def _run(docs, target, **how):
    found = importance.resample(docs, target, **how)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert [t for _, t in found.dtypes] == ["bigint"] * 5
    return Counter(tuple(r) for r in found.collect())


VOCABULARY = ["der", "The", "x1", "42", "Öl", "straße", "K", "don't", "a-b", "日本", "é", "İ", "foo_bar"]


def _text(rng, n):
    return "".join(rng.choice(VOCABULARY) + rng.choice([" ", "  ", "\n", ", ", "\x00", "\xa0", "_", "."]) for _ in range(n))


def test_random_texts(docs_of, target_of):
    rng = random.Random(3)
    rows = [(i, _text(rng, rng.randrange(60))) for i in range(300)]
    target = [(i, _text(rng, 40)) for i in range(9)]
    assert _run(docs_of(rows), target_of(target)) == _plain(rows, target)
    assert _run(docs_of(rows), target_of(target), percent=70, least_words=3, seed=1) == _plain(rows, target, 70, 3, 1)


def test_defined_cases(docs_of, target_of):
    long_ = "Ein langes Wort " * 30000  # counted by bucket
    rows = [(1, None), (2, ""), (3, " .,;\n"), (None, "a b " * 20), (None, "c d " * 20), (5, long_), (6, "x" * 300_000),
            (7, "one")] + [(8, "same words again and " * 9)] * 40 + [(9, "b " * 25)]
    target = [(1, None), (2, "the same words again"), (2, "the same words again"), (None, "")]
    assert _run(docs_of(rows), target_of(target), percent=60) == _plain(rows, target, 60)
    assert _run(docs_of(rows), target_of([])) == _plain(rows, [])
    assert _run(docs_of(rows), target_of(target), percent=100) == _plain(rows, target, 100)
    assert _run(docs_of(rows), target_of(target), percent=0) == _plain(rows, target, 0)
    assert _run(docs_of([]), target_of(target)) == Counter()


def test_many_copies_in_pieces(docs_of, target_of, monkeypatch):
    monkeypatch.setattr(importance, "COPIES_AT_ONCE", 7)
    rows = [(1, "a b c " * 8)] * 50 + [(2, "d e f " * 8)] * 7 + [(3, "a b " * 11)]
    assert _run(docs_of(rows), target_of([(1, "a b")]), percent=80) == _plain(rows, [(1, "a b")], 80)


def test_spans_are_words_runs():
    patterns = importance.span_patterns(3)
    plain = b"ab c def"
    assert [[m.span() for m in p.finditer(plain, overlapped=True)] for p in patterns] == [
        [(0, 2), (3, 4), (5, 8)], [(0, 4), (3, 8)], [(0, 8)]]


@pytest.mark.parametrize("buckets", [0, 70000])
def test_buckets_fit_two_bytes(docs_of, buckets):
    with pytest.raises(ValueError):
        importance.scan(docs_of([(1, "a")]), buckets=buckets)
