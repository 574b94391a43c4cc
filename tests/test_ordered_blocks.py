"""Block-partitioned ordered scans against a brute-force Python model, on
random events dense enough that matches straddle block boundaries."""

import random

import pytest
from pyspark.sql import functions as F

from trailmark.operators import patterns, uniques


def _events(n=400, keys=3, span=120, seed=7):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(keys), rnd.choice(["a", "b", "c"]), rnd.randrange(span), i)
            for i in range(n)]
    return rows


def _by_key(rows):
    out = {}
    for k, kind, t, seq in sorted(rows, key=lambda r: (r[0], r[2], r[3])):
        out.setdefault(k, []).append((kind, t, seq))
    return out


def _model_strict(rows, within):
    got = []
    for k, evs in _by_key(rows).items():
        for (k1, t1, s1), (k2, t2, s2) in zip(evs, evs[1:]):
            if k1 == "a" and k2 == "a" and t2 - t1 < within:
                got.append((k, s1, s2))
    return sorted(got)


def _model_followed(rows, within):
    got = []
    for k, evs in _by_key(rows).items():
        for i, (kind, t, s) in enumerate(evs):
            if kind != "a":
                continue
            nxt = next(((t2, s2) for kind2, t2, s2 in evs[i + 1:] if kind2 == "b"), None)
            ok = nxt is not None and nxt[0] - t < within
            got.append((k, s, nxt[1] if ok else None))
    return sorted(got, key=lambda x: (x[0], x[1]))


@pytest.mark.parametrize("block_factor", [0.25, 0.5, 1, 2, 4])
@pytest.mark.parametrize("within", [3, 10])
def test_strict_next_blocks(spark, block_factor, within):
    rows = _events()
    df = spark.createDataFrame(rows, "k long, kind string, t long, seq long")
    out = patterns.strict_next(df, key="k", ts="t", seq="seq", first=F.col("kind") == "a",
                               second=F.col("kind") == "a", within=f"{within} seconds",
                               carry=["seq"], block_factor=block_factor)
    got = sorted((r.k, r.first_seq, r.second_seq) for r in out.collect())
    assert got == _model_strict(rows, within)


@pytest.mark.parametrize("block_factor", [0.25, 0.5, 1, 2, 4])
@pytest.mark.parametrize("within", [3, 10])
def test_followed_by_blocks(spark, block_factor, within):
    rows = _events(seed=11)
    df = spark.createDataFrame(rows, "k long, kind string, t long, seq long")
    out = patterns.followed_by(df, key="k", ts="t", seq="seq", first=F.col("kind") == "a",
                               second=F.col("kind") == "b", within=f"{within} seconds",
                               carry=["seq"], block_factor=block_factor)
    got = sorted(((r.k, r.first_seq, r.second_seq) for r in out.collect()),
                 key=lambda x: (x[0], x[1]))
    assert got == _model_followed(rows, within)


@pytest.mark.parametrize("stretch", [1, 2, 5, 16])
@pytest.mark.parametrize("block_factor", [0.25, 0.5, 2])
def test_followed_by_over_stretches_of_blocks(spark, monkeypatch, stretch, block_factor):
    """Sparse events: starts whose event lies several empty blocks and a
    stretch further on."""
    monkeypatch.setattr(patterns, "STRETCH", stretch)
    rows = _events(n=150, keys=2, span=900, seed=5) + [(0, "a", 2000, 900), (0, "b", 2011, 901), (1, "a", -30, 902), (1, "b", -19, 903)]
    df = spark.createDataFrame(rows, "k long, kind string, t long, seq long")
    out = patterns.followed_by(df, key="k", ts="t", seq="seq", first=F.col("kind") == "a",
                               second=F.col("kind") == "b", within="12 seconds",
                               carry=["seq"], block_factor=block_factor)
    got = sorted(((r.k, r.first_seq, r.second_seq) for r in out.collect()), key=lambda x: (x[0], x[1]))
    assert got == _model_followed(rows, 12)


def test_followed_by_keeps_a_keys_blocks_apart(spark):
    """A minute's bound over a year of one key: no group of the summary holds
    more than a stretch and its look-ahead."""
    df = spark.range(0, 365 * 24 * 3600, 600).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("t"), "id")
    out = patterns.followed_by(df, key="k", ts="t", seq="id", first=F.lit(True), second=F.lit(True), within="1 minute",
                               carry=["id"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # no window over a key alone: both windows are within a (key, block or stretch)
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and all("_blk" in line.rsplit("], [", 2)[1] for line in windows)
    assert out.where("status = 'timeout'").count() == out.count() == 365 * 24 * 6


def _burst(rnd, n=300):
    """Two thirds of the rows in one second."""
    return [(rnd.randrange(60), 4000 if i % 3 else rnd.randrange(7200), i) for i in range(n)]


def test_a_burst_is_cut_by_rank(spark):
    """Half of all events in one second of one window: no (window, place) holds
    above 5 % of them."""
    rows = spark.range(0, 60000).select((F.col("id") % 997).alias("u"), F.col("id").alias("seq"), F.when(
        F.col("id") < 30000, F.lit(4000)).otherwise(F.col("id") % 36000).cast("long").alias("t"))
    offsets = uniques.event_offsets(rows, user="u", ts="t", size_us=3_600_000_000, seq="seq")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        placed, extra = uniques._with_places(offsets, 3_600_000_000, 60, 100)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    shares = placed.groupBy("window_end", "_place").count().agg(F.max("count"), F.sum("count")).first()
    assert shares[1] == 60000 and shares[0] <= 0.05 * 60000
    assert extra.count() <= 2 * 128


@pytest.mark.parametrize("rows_per_range", [1, 4, 40, 100_000])
@pytest.mark.parametrize("shape", ["even", "burst"])
@pytest.mark.parametrize("sub_blocks", [1, 7, 60])
def test_running_unique_slices(spark, sub_blocks, shape, rows_per_range):
    rnd = random.Random(3)
    rows = [(rnd.randrange(12), rnd.randrange(7200), i) for i in range(300)] if shape == "even" else _burst(rnd)
    df = spark.createDataFrame(rows, "u long, t long, seq long")
    out = uniques.running_unique_count(df, user="u", ts="t", size="1 hour", seq="seq",
                                       keep=["seq"], sub_blocks=sub_blocks, rows_per_range=rows_per_range)
    got = sorted((r.seq, r.uv_count) for r in out.collect())
    want, seen = [], {}
    for u, t, s in sorted(rows, key=lambda r: (r[1], r[2])):
        w = t // 3600
        seen.setdefault(w, set()).add(u)
        want.append((s, len(seen[w])))
    assert got == sorted(want)
