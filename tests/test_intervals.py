"""Interval operators against plain loops on small random inputs."""

import random

import pytest
from pyspark.sql import functions as F

from lociweave.operators import intervals as I
from lociweave.operators import synteny as Y
from lociweave.operators.scans import scan


def frame(spark, rows, names="chr string, start long, end long, id long"):
    return spark.createDataFrame(rows, names).repartition(3)


def random_intervals(seed, n=120, span=400, length=40):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        # a third of all rows share one place
        s = 77 if i % 3 == 0 else rng.randrange(span)
        out.append(("c1" if i % 3 == 0 else rng.choice(["c1", "c2"]), s, s + rng.randrange(1, length), i))
    return out


def merged(rows, touching=True):
    out = []
    for c, s, e, *_ in sorted(rows):
        if out and out[-1][0] == c and (s <= out[-1][2] if touching else s < out[-1][2]):
            out[-1] = (c, out[-1][1], max(out[-1][2], e))
        else:
            out.append((c, s, e))
    return sorted(out)


@pytest.mark.parametrize("width", [7, 64, 1 << 20])
def test_merge_over_bucket_borders(spark, width):
    rows = random_intervals(1)
    got = sorted(tuple(r) for r in I.merge_intervals(frame(spark, rows), width=width).collect())
    assert got == merged(rows)


def test_shrink_rules(spark):
    m = frame(spark, [("c", 5, 6, 0), ("c", 10, 12, 1), ("c", 20, 30, 2)])
    ranges = lambda rule: sorted((r["start"], r["end"]) for r in I.shrink(m, rule).collect())
    assert ranges("empty") == [(6, 6), (11, 11), (21, 29)]
    assert ranges("one") == [(5, 6), (11, 12), (21, 29)]
    assert ranges(None) == [(5, 6), (10, 12), (20, 30)]


@pytest.mark.parametrize("bin_size,salt", [(16, None), (1 << 14, None), (16, 10)])
def test_overlap_join_count_clip(spark, bin_size, salt):
    a, b = random_intervals(2), random_intervals(3)
    want = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    j = I.overlap_join(frame(spark, a), frame(spark, b), bin_size=bin_size, salt_above=salt)
    assert sorted((r["id"], r["b_id"]) for r in j.collect()) == want
    counts = {r["id"]: r["count"] for r in I.overlap_count(frame(spark, a), frame(spark, b), width=bin_size).collect()}
    assert counts == {x[3]: sum(1 for i, _ in want if i == x[3]) for x in a}
    clip = {(r["id"], r["b_id"]): (r["start"], r["end"]) for r in I.overlap_clip(frame(spark, a), frame(spark, b)).collect()}
    assert all(clip[(x[3], y[3])] == (max(x[1], y[1]), min(x[2], y[2])) for x in a for y in b if (x[3], y[3]) in clip)
    outer = I.overlap_outer(frame(spark, a), frame(spark, b), ["id"], bin_size=bin_size)
    assert outer.where("b_id is null").count() == sum(1 for x in a if counts[x[3]] == 0)


@pytest.mark.parametrize("width", [5, 1 << 20])
def test_scan_equals_plain_window(spark, width):
    from pyspark.sql import Window
    rows = random_intervals(4)
    df = frame(spark, rows)
    w = Window.partitionBy("chr").orderBy("start", "end", "id")
    v = F.col("end")
    plain = df.select("id", F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"), F.lag(v).over(w).alias("g"),
                      F.lead(v).over(w).alias("d"), F.max(v).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("b"),
                      F.max(v).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("t"))
    fast = scan(df, ["chr"], "start", ["end", "id"], width, sums={"s": v}, lags={"g": v}, leads={"d": v},
                max_before={"b": v}, max_through={"t": v}).select(plain.columns)
    assert sorted(map(str, plain.collect())) == sorted(map(str, fast.collect()))


@pytest.mark.parametrize("width", [9, 1 << 20])
def test_close_and_overlap_groups(spark, width):
    rows = random_intervals(6, n=90, span=900, length=12)
    groups, run = [], []
    for c, s, e, i in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3])):
        if run and run[-1][0] == c and 0 <= s - run[-1][2] <= 9:
            run.append((c, s, e, i))
        else:
            groups.append(run)
            run = [(c, s, e, i)]
    groups.append(run)
    want = sorted((g[0][0], g[0][1], x[3]) for g in groups if len(g) > 1 for x in g)
    got = Y.close_groups(frame(spark, rows), 9, "id", width)
    assert sorted((r["chr"], r["group"], r["id"]) for r in got.collect()) == want
    island = {(m[0], m[1], m[2]): [x[3] for x in rows if x[0] == m[0] and m[1] <= x[1] < m[2]] for m in merged(rows, touching=False)}
    want = sorted((m[0], m[1], i) for m, ids in island.items() if len(ids) > 1 for i in ids)
    got = Y.overlap_groups(frame(spark, rows), "id", width)
    assert sorted((r["chr"], r["group"], r["id"]) for r in got.collect()) == want


def test_unstable_inputs_are_errors(spark):
    sites = frame(spark, [("c", 5, 7, 0)])
    with pytest.raises(Exception, match="single-base"):
        I.mark_coding(sites, frame(spark, [("c", 1, 9, 0)])).collect()


@pytest.mark.parametrize("closed", [False, True])
def test_overlap_join_of_very_different_lengths(spark, closed):
    rng = random.Random(21)
    def rows(n):  # noqa: E301
        return [("c" + str(rng.randrange(2)), s := rng.randrange(10 ** 6), s + rng.choice([0, 1, 30, 3000, 70000, 900000]), i) for i in range(n)]
    a, b = rows(120), rows(90)
    hit = lambda x, y: x[0] == y[0] and (x[1] < y[2] and y[1] < x[2])
    touch = F.col("start").between(F.col("b_start"), F.col("b_end")) if closed else None
    want = sorted((x[3], y[3]) for x in a for y in b if (x[0] == y[0] and y[1] <= x[1] <= y[2] if closed else hit(x, y)))
    for bin_size in (1, 64, 1 << 14):
        got = I.overlap_join(frame(spark, a), frame(spark, b), bin_size=bin_size, condition=touch, closed=closed)
        assert sorted((r["id"], r["b_id"]) for r in got.collect()) == want


def test_an_interval_over_everything_is_listed_a_few_times(spark):
    """Listings grow with the rows and the levels, not with a long interval's length."""
    n = 400
    a = [("c", 1000 * i, 1000 * i + 10, i) for i in range(n)]
    b = [("c", 0, 10 ** 9, 0), ("c", 5000, 5010, 1)]
    left, right = frame(spark, a), frame(spark, b)
    levels = lambda df: I._levels(df, 16, "start", "end", False)
    assert I._listed(right, 16, "start", "end", False, levels(left)).count() <= 2 * 2 * I.MOST
    assert I._listed(left, 16, "start", "end", False, levels(right)).count() <= 3 * I.MOST * n
    assert I.overlap_join(left, right, bin_size=16).count() == n + 1
