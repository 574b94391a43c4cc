"""Property test: sliding-window counts (sweep plan) equal a brute-force
enumeration of windows for random rows, sizes and slides."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trailmark.operators import windows


def _brute(rows, size, slide):
    out = {}
    for k, t in rows:
        # window starts m * slide with start <= t < start + size
        m = (t - size) // slide + 1
        while m * slide <= t:
            end = m * slide + size
            out[(k, end * 1000)] = out.get((k, end * 1000), 0) + 1
            m += 1
    return sorted((k, e, c) for (k, e), c in out.items())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(-200, 400)), min_size=1,
                     max_size=60),
       size=st.integers(1, 40), slide=st.integers(1, 40), block=st.integers(1, 3))
def test_sweep_matches_brute_force(spark, rows, size, slide, block):
    df = spark.createDataFrame(rows, "k long, t long")
    got = windows.window_counts(df, keys="k", ts="t", unit="s", size=f"{size} seconds",
                                slide=f"{slide} seconds", block_factor=block)
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows, size, slide)
