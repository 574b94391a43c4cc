import random

import pytest
from pyspark.sql import functions as F

from trailmark.operators import matching
from trailmark.operators.one_to_one import reconcile_one_to_one
from trailmark.plans import jobs


def test_interval_join_golden(logs):
    got = sorted((r.tx_id, r.pay_ts_s, r.receipt_ts_s)
                 for r in jobs.tx_interval_join(logs["order"], logs["receipt"]).collect())
    assert got == sorted([("sd76f87d6", 1558430844, 1558430847),
                          ("3hu3k2432", 1558430845, 1558430848),
                          ("435kjb45d", 1558430863, 1558430859),
                          ("3243hr9h9", 1558430895, 1558430892),
                          ("329d09f9f", 1558430893, 1558430893)])


def test_reconcile_golden(logs):
    rec = jobs.tx_match(logs["order"], logs["receipt"]).cache()
    m, up, ur = matching.split_reconciled(rec)
    assert (m.count(), up.count(), ur.count()) == (5, 35, 35)
    pays_only = {r.tx_id for r in up.collect()}
    receipts_only = {r.tx_id for r in ur.collect()}
    assert {"35jue34we", "88snrn932"} <= pays_only
    assert {"8fdsfae83", "ewr342as4"} <= receipts_only
    assert rec.where(F.col("tx_id") == "").count() == 0


def test_band_boundaries(spark):
    pays = spark.createDataFrame([("a", 100), ("b", 100), ("c", 100), ("d", 100), ("e", 7), ("", 1)],
                                 "tx_id string, ts_s long")
    rec = spark.createDataFrame([("a", 95), ("b", 105), ("c", 94), ("d", 106), ("f", 3), ("", 1)],
                                "tx_id string, ts_s long")
    pays = pays.where(F.col("tx_id") != "")
    out = matching.reconcile(pays, rec, left_key="tx_id", right_key="tx_id", left_ts="ts_s",
                             right_ts="ts_s", left_carry=["ts_s"], right_carry=["ts_s"],
                             key_out="tx_id")
    got = sorted((r.tx_id, r.status) for r in out.collect())
    assert ("a", "matched") in got and ("b", "matched") in got
    assert ("c", "unmatched_pay") in got and ("c", "unmatched_receipt") in got
    assert ("d", "unmatched_pay") in got and ("d", "unmatched_receipt") in got
    assert ("e", "unmatched_pay") in got and ("f", "unmatched_receipt") in got
    assert ("", "unmatched_receipt") in got  # the filter is the caller's (P2)
    assert len(got) == 9


def test_interval_join_many_pairs_and_wide_band(spark):
    left = spark.createDataFrame([(1, t) for t in range(0, 100, 7)], "k long, t long")
    right = spark.createDataFrame([(1, t) for t in range(0, 100, 3)], "k long, t long")
    out = matching.interval_join(left, right, left_key="k", right_key="k", left_ts="t",
                                 right_ts="t", lower="-10 seconds", upper="4 seconds",
                                 left_carry=["t"], right_carry=["t"], key_out="k")
    got = sorted((r.pay_t, r.receipt_t) for r in out.collect())
    want = sorted((a, b) for a in range(0, 100, 7) for b in range(0, 100, 3) if -10 <= b - a <= 4)
    assert got == want


def test_unmatched_sides_equal_reconcile_split(logs):
    kw = dict(left_key="tx_id", right_key="tx_id", left_ts="ts_s", right_ts="ts_s",
              left_carry=["order_id", "ts_s"], right_carry=["pay_channel", "ts_s"],
              key_out="tx_id")
    pays = logs["order"].where(F.col("tx_id") != "")
    rec = matching.reconcile(pays, logs["receipt"], **kw)
    _, up, ur = matching.split_reconciled(rec)
    lp = matching.unmatched(pays, logs["receipt"], side="left", **kw)
    rp = matching.unmatched(pays, logs["receipt"], side="right", **kw)
    assert lp.exceptAll(up).count() == 0 and up.exceptAll(lp).count() == 0
    assert rp.exceptAll(ur).count() == 0 and ur.exceptAll(rp).count() == 0


def test_reconcile_with_null_keys_and_times(spark):
    pays = spark.createDataFrame([("a", 10, 1), (None, 10, 2), ("b", None, 3), ("c", 10, 4)], "k string, t long, i long")
    receipts = spark.createDataFrame([("a", 12, 5), (None, 10, 6), ("b", None, 7), ("d", 10, 8)], "k string, t long, i long")
    args = dict(left_key="k", right_key="k", left_ts="t", right_ts="t", left_carry=["i"], right_carry=["i"])
    got = matching.reconcile(pays, receipts, **args)
    assert {(r.status, r.pay_i, r.receipt_i) for r in got.collect()} == {
        ("matched", 1, 5), *(("unmatched_pay", i, None) for i in (2, 3, 4)),
        *(("unmatched_receipt", None, i) for i in (6, 7, 8))}
    whole = (matching.interval_join(pays, receipts, **args).count()
             + matching.unmatched(pays, receipts, side="left", **args).count()
             + matching.unmatched(pays, receipts, side="right", **args).count())
    assert whole == got.count() == 7


def _two_pointers(pays, receipts, bound):
    out, i, j = [], 0, 0
    while i < len(pays) or j < len(receipts):
        if i < len(pays) and j < len(receipts) and abs(pays[i][0] - receipts[j][0]) <= bound:
            out.append((pays[i][1], receipts[j][1], "matched"))
            i, j = i + 1, j + 1
        elif j >= len(receipts) or (i < len(pays) and pays[i][0] < receipts[j][0]):
            out.append((pays[i][1], None, "unmatched_pay"))
            i += 1
        else:
            out.append((None, receipts[j][1], "unmatched_receipt"))
            j += 1
    return out


_ONE = dict(left_key="k", right_key="k", left_ts="t", right_ts="t", left_seq="id", right_seq="id",
            left_carry=["id"], right_carry=["id"])


@pytest.mark.parametrize("bound, factor", [(5, 1), (5, 4), (0, 4), (60, 2)])
def test_one_to_one_against_a_walk_of_each_key(spark, bound, factor):
    rng = random.Random(bound + factor)
    # keys from sparse to dense, one with many pays per receipt, one with equal times
    sides = {0: [], 1: []}
    for key, span, counts in ((1, 900, (60, 60)), (2, 300, (200, 200)), (3, 2000, (400, 20)), (4, 40, (90, 90)), (5, 90000, (30, 30)),
                              (6, 10, (0, 9)), (7, 3000, (700, 690))):
        for side, n in enumerate(counts):
            sides[side] += [(key, rng.randrange(-span, span), f"{key}-{side}-{i:04d}") for i in range(n)]
    left, right = (spark.createDataFrame(rows, "k long, t long, id string").repartition(5) for rows in sides.values())
    got = reconcile_one_to_one(left, right, bound=f"{bound} seconds", block_factor=factor, **_ONE)
    want = [x for key in range(1, 8) for x in _two_pointers(
        *(sorted((t, i) for k, t, i in sides[s] if k == key) for s in (0, 1)), bound)]
    assert sorted(map(repr, ((r.pay_id, r.receipt_id, r.status) for r in got.collect()))) == sorted(map(repr, want))


def test_one_to_one_golden_and_nulls(spark, logs):
    rec = jobs.tx_match(logs["order"], logs["receipt"], one_to_one=True)
    assert {r["status"]: r["count"] for r in rec.groupBy("status").count().collect()} == {
        "matched": 5, "unmatched_pay": 35, "unmatched_receipt": 35}
    assert rec.columns == jobs.tx_match(logs["order"], logs["receipt"]).columns
    schema = "k string, t long, id long"
    pays = spark.createDataFrame([("a", 10, 1), ("a", 11, 2), (None, 10, 3), ("b", None, 4), ("a", 99, 5)], schema)
    receipts = spark.createDataFrame([("a", 12, 6), (None, 10, 7), ("c", 1, 8)], schema)
    got = reconcile_one_to_one(pays, receipts, **_ONE)
    assert sorted((r.status, r.pay_id or 0, r.receipt_id or 0) for r in got.collect()) == [
        ("matched", 1, 6), ("unmatched_pay", 2, 0), ("unmatched_pay", 3, 0), ("unmatched_pay", 4, 0), ("unmatched_pay", 5, 0),
        ("unmatched_receipt", 0, 7), ("unmatched_receipt", 0, 8)]
    assert reconcile_one_to_one(pays.limit(0), receipts.limit(0), **_ONE).count() == 0
    with pytest.raises(ValueError):
        jobs.tx_match(logs["order"], logs["receipt"], upper="6 seconds", one_to_one=True)
