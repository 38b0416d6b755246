"""Counts per run of columns against the per-site form; membership bits; runs against a walk."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.operators import coding, intervals as I, membership, sites


@pytest.mark.parametrize("seed", range(30))
def test_column_runs(seed):
    rng = random.Random(seed)
    seq = "".join(rng.choice("ACG-") for _ in range(rng.randrange(0, 40)))
    start, at, begs, ends = 50, 40, [], []
    while at < 100 and rng.random() < 0.8:
        at += rng.randrange(0, 9)
        begs.append(at)
        at += rng.randrange(1, 12)
        ends.append(at)
        at += 1
    got = coding.column_runs(seq, start, np.array(begs, np.int64), np.array(ends, np.int64)).reshape(-1, 3)
    flags = [0] * len(seq)
    for lo, hi, flag in got:
        flags[lo:hi] = [flag] * (hi - lo)
    assert [r[0] for r in got[1:]] == [r[1] for r in got[:-1]] and (not seq or (got[0][0], got[-1][1]) == (0, len(seq)))
    pos = start - 1
    for k, c in enumerate(seq):
        pos += c != "-"
        if c != "-":
            assert flags[k] == any(b <= pos < e for b, e in zip(begs, ends))


def blocks(spark, rng, n):
    rows = []
    for i in range(n):
        size = rng.choice([0, 2, 3, 30, 200])
        a = "".join(rng.choice("ACGTacgt-N") for _ in range(size))
        near = lambda: "".join(x if rng.random() < 0.8 else rng.choice("ACGT-") for x in a)
        rows.append((i, "k" + str(i % 2), f"c{i % 3}", 1000 * (i % 7) + rng.randrange(500), rng.choice("+-"), 9000, a,
                     "b", 10, "+", 9000, near(), "c", 10, "-", 9000, near()))
    place = lambda s: f"chr_{s} string, start_{s} long, strand_{s} string, len_{s} long, seq_{s} string"
    return spark.createDataFrame(rows, f"block_id long, k string, {place('a')}, {place('b')}, {place('c')}")


def test_split_of_blocks_equals_split_of_sites(spark):
    rng = random.Random(3)
    aln = blocks(spark, rng, 90)
    features = spark.createDataFrame([(f"c{rng.randrange(4)}", s := rng.randrange(9000), s + rng.randrange(1, 90)) for _ in range(160)], "chr string, start long, end long")
    for keys in ([], ["k"]):
        want = I.coding_split(sites.counted_sites(aln, keys), features, keys)
        got = coding.coding_split_of_blocks(aln, features, keys)
        assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert got.selectExpr("sum(cds)", "sum(ncds)").head()[0] > 100
    none = coding.coding_split_of_blocks(aln, features.where("false"))
    assert none.selectExpr("sum(cds)").head()[0] == 0 and none.selectExpr("sum(ncds)").head()[0] > 100
    assert coding.coding_split_of_blocks(aln.where("false"), features).count() == 0


def test_blocks_without_features_stay_where_they_are(spark):
    """Their only join is with the bit table, which is broadcast: no exchange lies on the side of the blocks."""
    aln = blocks(spark, random.Random(4), 30)
    features = spark.createDataFrame([("c1", 0, 50)], "chr string, start long, end long")
    near, far = membership.split_by(aln, coding.block_ranges(aln, features).select("block_id"), "block_id")
    assert near.count() + far.count() == 30 and near.count() < 30
    plan = far._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0]


def test_membership_has_no_false_no(spark):
    keys = spark.range(0, 5000).select((F.col("id") * 7919 - 10 ** 6).alias("k"))
    rows = spark.range(-10 ** 6, 60000 - 10 ** 6).select(F.col("id").alias("k"))
    seen = {r["k"] for r in membership.flagged(rows, keys, "k").where("_maybe").collect()}
    true = {r["k"] for r in keys.collect()} & set(range(-10 ** 6, 60000 - 10 ** 6))
    assert true <= seen and len(seen) < len(true) + 200
    text = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert {r["k"] for r in membership.flagged(text, text.where("k = 'a'"), "k").where("_maybe").collect()} >= {"a"}


@pytest.mark.parametrize("chunk", [1, 3, 1 << 20])
def test_base_codes_against_a_walk(monkeypatch, chunk):
    monkeypatch.setattr(coding, "CHUNK", chunk)
    rng = random.Random(chunk)
    made = [["".join(rng.choice("ACGTacgt-N") for _ in range(n))] * 3 for n in (0, 1, 2, 40, 0, 90)]
    made = [[q[0], *("".join(x if rng.random() < 0.8 else rng.choice("ACGT-") for x in q[0]) for _ in "bc")] for q in made]
    want = []
    for a, b, c in (map(str.upper, q) for q in made):
        for i, x in enumerate(a):
            wins = [q[i - 1:i + 2] if 0 < i < len(a) - 1 else "" for q in (a, b, c)]
            good = all(len(w) == 3 and set(w) <= set("ACGT") for w in wins) and len({w[0] + w[2] for w in wins}) == 1 and wins[0][1] in (wins[1][1], wins[2][1])
            want += [tuple(wins) if good else None] * (x != "-")
    seqs = [np.frombuffer("".join(q[k] for q in made).encode(), np.uint8) for k in range(3)]
    codes, bases = coding.base_codes(seqs, np.array([len(q[0]) for q in made]))
    assert [None if k < 0 else tuple(w[int(k)].as_py() for w in coding._WINDOWS) for k in codes] == want
    assert bases.tolist() == [len(q[0].replace("-", "")) for q in made] and sum(w is not None for w in want) > 5


def test_no_window_is_a_row(spark):
    """Sequences don't go through the exchange, and the plan makes no rows of positions."""
    aln = blocks(spark, random.Random(5), 30)
    features = spark.createDataFrame([("c1", 0, 50)], "chr string, start long, end long")
    plan = coding.coding_window_counts(aln, features)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "explode" not in plan
