"""Mergeable pane states against enumeration of windows and rows."""

import random

import pytest
from pyspark.sql import functions as F

from trailmark.operators import panes, windows


def _aggs():
    return {"n": panes.count_of(), "known": panes.count_of("v"), "total": panes.sum_of("v"),
            "least": panes.min_of("v"), "most": panes.max_of("v"), "mean": panes.avg_of("v")}


def _model(rows, size, slide):
    held = {}
    for k, t, v in rows:
        if t is None:
            continue
        start = t // slide * slide
        while start > t - size:
            held.setdefault((k, (start + size) * 1000), []).append(v)
            start -= slide
    out = {}
    for at, vs in held.items():
        known = [v for v in vs if v is not None]
        out[at] = (len(vs), len(known), sum(known) if known else None, min(known, default=None),
                   max(known, default=None), sum(known) / len(known) if known else None)
    return out


@pytest.mark.parametrize("size,slide", [(60, 60), (60, 5), (60, 7), (20, 30), (10, 30), (45, 30), (120, 1), (7, 14)])
@pytest.mark.parametrize("span", [30, 700])
def test_states_equal_enumeration(spark, size, slide, span):
    rnd = random.Random(size * 1000 + slide + span)
    rows = [(rnd.choice([1, 2, None]), rnd.randrange(-span, span), rnd.choice([None, *range(-9, 10)])) for _ in range(90)]
    rows += [(1, None, 3), (7, 5 * span, None)] + rows[:5]
    df = spark.createDataFrame(rows, "k long, t long, v long")
    got = windows.window_aggregate(df, keys="k", ts="t", size=f"{size} seconds", slide=f"{slide} seconds", aggs=_aggs())
    assert got.columns == ["k", "window_end", *_aggs()]
    found = [tuple(r) for r in got.collect()]
    want = _model(rows, size, slide)
    assert len(found) == len(want)
    assert {r[:2]: r[2:] for r in found} == want


def test_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([(1, 10, 2), (2, 70, 5)], "k long, t long, v long")
    got = windows.window_aggregate(df, keys=[], ts="t", size="1 minute", slide="30 seconds", aggs={"most": panes.max_of("v")})
    assert sorted(map(tuple, got.collect())) == [(30_000, 2), (60_000, 2), (90_000, 5), (120_000, 5)]
    assert windows.window_aggregate(df.where("k > 5"), keys="k", ts="t", size="1 minute", slide="30 seconds",
                                    aggs=_aggs()).collect() == []


def test_sketches_merge(spark):
    df = spark.range(0, 2000).select((F.col("id") % 400).alias("t"), (F.col("id") % 37).alias("v"))
    got = windows.window_aggregate(df, keys=[], ts="t", size="2 minutes", slide="1 minute",
                                   aggs={"about": panes.approx_distinct_of("v")})
    counts = [r.about for r in got.collect()]
    assert len(counts) == 8 and all(c in (36, 37, 38) for c in counts)


def test_a_users_own_aggregate(spark):
    """Geometric mean: logarithms and their number as the state."""
    logs = panes.Field(F.sum(F.log("v")), F.sum, lambda a, b: F.coalesce(a + b, a, b))
    number = panes.count_of("v").fields[0]
    mean = panes.Mergeable((logs, number), lambda total, n: F.round(F.exp(total / n), 9))
    df = spark.createDataFrame([(0, 2.0), (20, 8.0), (70, 4.0)], "t long, v double")
    got = windows.window_aggregate(df, keys=[], ts="t", size="1 minute", slide="30 seconds", aggs={"g": mean})
    assert sorted(map(tuple, got.collect())) == [(30_000, 4.0), (60_000, 4.0), (90_000, 4.0), (120_000, 4.0)]


def test_mixed_kinds_are_refused(spark):
    df = spark.createDataFrame([(0, 2.0)], "t long, v double")
    with pytest.raises(ValueError):
        windows.window_aggregate(df, keys=[], ts="t", size="1 minute", aggs={"a": panes.count_of(), "b": F.max("v")})
