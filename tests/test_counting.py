"""Counts by subtraction against lists of pairs."""

import random

import pytest

from lociweave.operators import counting, reads as R


def table(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def spread(rng, n, top):
    """Intervals of very different lengths, some of them repeated."""
    rows = []
    for _ in range(n):
        a = rng.choice([rng.randrange(top), rng.randrange(20), top - 1])
        rows.append((f"c{rng.randrange(2)}", a, a + rng.choice([1, 2, 10, top // 3, top])))
    return rows + rows[:5]


@pytest.mark.parametrize("top,width", [(60, 16), (70000, 1 << 12), (3 * 10 ** 9, 1 << 20)])
def test_count_around(spark, top, width):
    rng = random.Random(top)
    spans, queries = spread(rng, 150, top), spread(rng, 120, top)
    got = counting.count_around(table(spark, queries, "chr string, start long, end long"), table(spark, spans, "chr string, x long, y long"), "n", width)
    want = {q: n for q in queries if (n := sum(c == q[0] and x <= q[1] and q[2] <= y for c, x, y in spans))}
    assert {(r["chr"], r["start"], r["end"]): r["n"] for r in got.collect() if r["n"]} == want and want


def test_count_around_refuses_what_it_cannot_place(spark):
    with pytest.raises(Exception, match="out of range"):
        counting.count_around(table(spark, [("c", 1, 2)], "chr string, start long, end long"), table(spark, [("c", -5, 9)], "chr string, x long, y long")).collect()


@pytest.mark.parametrize("top,width", [(60, 16), (5000, 512)])
def test_count_owners(spark, top, width):
    rng = random.Random(top + 1)
    parts = [(rng.choice([None, *"abcdefgh"]), *p) for p in spread(rng, 160, top)]
    queries = spread(rng, 80, top)
    got = counting.count_owners(table(spark, queries, "chr string, start long, end long"), table(spark, parts, "owner string, chr string, start long, end long"), "owner", "n", width)
    want = {q: len({o for o, c, a, b in parts if o and c == q[0] and a < q[2] and q[1] < b}) for q in queries}
    assert {(r["chr"], r["start"], r["end"]): r["n"] for r in got.collect()} == want and len(set(want.values())) > 4


def test_count_covering(spark):
    rng = random.Random(5)
    spans, points = spread(rng, 90, 50), [(f"c{rng.randrange(3)}", rng.randrange(60)) for _ in range(60)]
    got = counting.count_covering(table(spark, points, "chr string, pos long"), table(spark, spans, "chr string, start long, end long"), "n", 8)
    assert {(r["chr"], r["pos"]): r["n"] for r in got.collect()} == {p: sum(c == p[0] and a < p[1] < b for c, a, b in spans) for p in points}


def test_alternative_support(spark):
    """Introns, junctions and reads placed at random, so that an intron's own parts also come to lie over it."""
    rng = random.Random(6)
    alns = [(i, f"r{rng.randrange(25)}", f"c{rng.randrange(2)}", s := 50 + rng.randrange(300), s + rng.choice([3, 20, 120]), 1) for i in range(90)]
    introns = [(f"k{i}", ("c0" if i % 2 else "c1", s := 100 + rng.randrange(300), "+"), ("c0" if i % 2 else "c1", s + rng.choice([-40, 0, 5, 60, 200]), "+"), i, i == 7) for i in range(30)]
    junctions = [(f"k{rng.randrange(30)}", r, a, b) for _ in range(70) for a, r in [rng.choice([x[:2] for x in alns])] for b in [rng.choice([x[0] for x in alns if x[1] == r])]]
    place = "struct<chr: string, pos: bigint, strand: string>"
    i = table(spark, introns, f"key string, start {place}, end {place}, reads long, trans boolean")
    j = table(spark, junctions, "key string, r_id string, aln1_id long, aln2_id long")
    r = table(spark, [(*a[:5], "+", 1000, 0, 10, "+", 50, None, None) for a in alns],
              "aln_id long, r_id string, g_chr string, g_start long, g_end long, g_strand string, g_len long, r_start long, r_end long, r_strand string, r_len long, don string, acc string")
    by_id = {a[0]: a for a in alns}
    alone = [a for a in alns if sum(b[1] == a[1] for b in alns) == 1]
    parts = [(k, q, by_id[x]) for k, q, a, b in junctions for x in (a, b)]
    want = {}
    for key, (c, don, _), (_, acc, _), n, trans in introns:
        if trans:
            continue
        lo, hi = min(don, acc), max(don, acc)
        met = [(k, q) for k, q, a in parts if lo < hi and a[2] == c and a[3] < hi and lo < a[4] and k != key]
        over = lambda pos: sum(lo < hi and a[2] == c and a[3] < pos < a[4] for a in alone)  # noqa: B023, E731
        want[key] = (n, len({k for k, _ in met}), len({q for _, q in met}), over(don), over(acc))
    got = R.alternative_support(i, j, r, width=64).select("key", "reads", "other_introns", "other_reads", "don_side_reads", "acc_side_reads").collect()
    assert {x[0]: tuple(x[1:]) for x in got} == want
    assert len({v[2] for v in want.values()}) > 3
