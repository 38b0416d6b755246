from collections import Counter
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.functions import rates
from lociweave.operators import pairs as A
from lociweave.operators import reads as R
from lociweave.operators import synteny as Y
from lociweave.plans.fusions import feature_fusions

READ = ("aln_id long, r_id string, score long, mismap double, sense double, don string, acc string, g_chr string, g_start long, g_end long, "
        "g_strand string, g_len long, r_start long, r_end long, r_strand string, r_len long")


def read(i, rid, don, acc, chr_, gs, ge, rs, re_, strand, length=100):
    return (i, rid, 10, 0.1, 0.0, don, acc, chr_, gs, ge, "+", 10000, rs, re_, strand, length)


ROWS = [
    read(1, "r1", "GT", None, "c1", 100, 150, 0, 50, "+"), read(2, "r1", None, "AG", "c1", 300, 350, 50, 100, "+"),
    # read on the other strand: the last alignment has the donor
    read(3, "r2", None, "AG", "c1", 300, 340, 0, 40, "+"), read(4, "r2", "gt", None, "c1", 100, 160, 40, 100, "+"),
    read(5, "r3", "GT", None, "c1", 100, 150, 0, 50, "+"), read(6, "r3", None, "AG", "c2", 300, 350, 55, 100, "+"),  # inexact
    read(7, "r4", None, None, "c1", 90, 120, 0, 30, "+"),
    read(8, "r5", "GT", None, "c1", 100, 150, 0, 50, "+"), read(9, "r5", None, "AC", "c1", 300, 350, 50, 100, "+"),
    read(10, "r6", "GT", None, "c1", 100, 150, 0, 50, "+"), read(11, "r6", None, "AG", "c2", 300, 350, 0, 50, "-"),
]


@pytest.fixture(scope="module")
def reads(spark):
    return spark.createDataFrame(ROWS, READ).repartition(3).cache()


def test_junctions(reads):
    rows = {r["r_id"]: r for r in R.junctions(reads).collect()}
    assert set(rows) == {"r1", "r2", "r5", "r6"}
    assert rows["r1"]["key"] == "c1_150_+_c1_300_+" and not rows["r1"]["trans"]
    assert (rows["r2"]["read_strand"], rows["r2"]["key"]) == ("-", "c1_100_-_c1_340_-")
    assert rows["r6"]["trans"] and rows["r6"]["end"]["strand"] == "-"


def test_junctions_of_repeated_ids(spark):
    # id 1 stands for two alignments of one read: both take part wherever the id does, as in the check SQL
    rows = [read(1, "r1", "GT", None, "c1", 100, 150, 0, 50, "+"), read(1, "r1", "GT", None, "c2", 100, 150, 0, 50, "+"),
            read(2, "r1", None, "AG", "c1", 300, 350, 50, 100, "+"), read(1, "r2", "GT", None, "c9", 100, 150, 0, 50, "+")]
    j = R.junctions(spark.createDataFrame(rows, READ).repartition(2))
    assert sorted((r["aln1_id"], r["aln2_id"], r["key"]) for r in j.collect()) == [(1, 2, "c1_150_+_c1_300_+"), (1, 2, "c2_150_+_c1_300_+")]
    again = spark.createDataFrame(rows[:1] * 2 + rows[2:3] * 2, READ)
    assert R.intron_table(R.junctions(again)).select("reads").collect()[0][0] == 4


def test_joined_blocks_of_repeated_ids(spark):
    block = lambda i, s: (i, "a", "+", s, s + 10, "b", "+", s, s + 10)
    rows = spark.createDataFrame([block(1, 0), block(2, 15), block(2, 15), block(3, 30)], "block_id long, chr_a string, strand_a string, start_a long, "
                                 "end_a long, chr_b string, strand_b string, start_b long, end_b long")
    got = Y.joined_blocks(rows, 20, width=16).select("block_id", "joined").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 2), (2, 2), (3, 2)]


def test_intron_facts(reads):
    j = R.junctions(reads)
    table = {r["key"]: r for r in R.intron_table(j).collect()}
    top = table["c1_150_+_c1_300_+"]
    assert (top["reads"], top["length"], top["don"], top["acc"]) == (2, 150, "GT", "AG")
    assert [r["key"] for r in R.conflicting_sites(j).collect()] == ["c1_150_+_c1_300_+"]
    c = R.canonical_counts(j).head()
    assert (c["canonical"], c["non_canonical"], c["conflicts"]) == (2, 0, 1)
    parts = R.intron_reads(j, per_row=1).select(F.explode("support")).count()
    assert parts == 4
    g = {r["r_id"]: r for r in R.read_groups(reads).collect()}
    assert g["r3"]["has_inexact"] and not g["r1"]["has_inexact"] and g["r4"]["alignments"] == 1
    assert {r["r_id"] for r in R.drop_chromosome(reads, "c2").collect()} == {"r1", "r2", "r4", "r5"}


def test_fusions(spark, reads):
    f = spark.createDataFrame([("c1", 120, 150, "+", 1, "CDS"), ("c1", 300, 320, "+", 2, "TE"), ("c1", 290, 300, "+", 3, "TE")],
                              "chr string, start long, end long, strand string, feature_id long, kind string")
    got = feature_fusions(reads, f, minimum_reads=2, major_signals=False).collect()
    assert [(r["f1_feature_id"], r["f2_feature_id"], r["reads"]) for r in got] == [(1, 2, 2)]


@pytest.mark.parametrize("width", [11, None])
def test_anchor_clusters(spark, width):
    rng = random.Random(9)
    rows = [("c" + str(i % 2), s := (50 if i % 3 == 0 else rng.randrange(300)), s + rng.randrange(2, 40), f"k{i:03}") for i in range(90)]
    want, by_chr = [], {}
    for r in sorted(rows):
        by_chr.setdefault(r[0], []).append(r)
    for items in by_chr.values():
        items.sort(key=lambda r: (r[1], r[2], r[3]))
        i = 0
        while i < len(items):
            k = i + 1
            while k < len(items) and items[k][1] < items[i][2]:
                k += 1
            if k - i > 1:
                want += [(items[i][3], x[3]) for x in items[i:k]]
            i = k
    df = spark.createDataFrame(rows, "chr string, left long, right long, key string").repartition(4)
    assert sorted(tuple(r) for r in R.anchor_clusters(df, width=width).collect()) == sorted(want)


def test_anchor_clusters_of_one_island(spark):
    """Everything overlaps: one island over many buckets, with introns that reach over whole buckets."""
    rng = random.Random(10)
    heads = sorted({rng.randrange(20000) for _ in range(1500)})
    rows = [("c", s, s + rng.choice([1, 3, 30, 30, 700, 5000]), f"k{s:05}") for s in heads] + [("c", 0, 25000, "z0")] * (0 not in heads)
    rows.append(("d", 5, 9, "d0"))
    rows[1] = ("c", rows[1][1], 30000, rows[1][3])
    want, reach, name = {}, None, None
    for c, left, right, key in sorted(rows):
        if c == "d":
            continue
        if reach is None or left >= reach:
            reach, name = right, key
        want.setdefault(name, []).append(key)
    want = sorted((n, k) for n, ks in want.items() if len(ks) > 1 for k in ks)
    df = spark.createDataFrame([r for r in rows if r[3] != "z0"], "chr string, left long, right long, key string").repartition(5)
    lone, reach, name = {}, None, None
    for c, left, right, key in sorted(r for r in rows if r[3] != "z0" and r[0] == "c"):
        if reach is None or left >= reach:
            reach, name = right, key
        lone.setdefault(name, []).append(key)
    lone = sorted((n, k) for n, ks in lone.items() if len(ks) > 1 for k in ks)
    for width in (37, 1000, None):
        assert sorted(map(tuple, R.anchor_clusters(df, width=width).collect())) == lone
    assert sorted(map(tuple, R.anchor_clusters(spark.createDataFrame(rows, df.schema), width=500).collect())) == want


@pytest.mark.parametrize("seed", range(20))
def test_last_anchors(seed):
    rng = random.Random(seed)
    left = np.array(sorted({rng.randrange(200) for _ in range(60)}))
    right = left + np.array([rng.choice([0, 1, 5, 50, 500]) for _ in left])
    following = R.next_anchors(left, right)
    for i, last in enumerate(R.last_anchors(following)):
        at = i
        while (nxt := next((j for j in range(at + 1, len(left)) if left[j] >= right[at]), None)) is not None:
            at = nxt
        assert last == at


def test_runs(spark):
    rows = [read(1, "q/1", "GT", None, "c1", 10, 20, 0, 10, "+", 40), read(2, "q/1", None, "AG", "c1", 50, 60, 10, 20, "+", 40),
            read(3, "q/1", None, None, "c1", 80, 90, 25, 35, "+", 40), read(4, "q/1", None, None, "c2", 5, 9, 35, 39, "+", 40)]
    rec = R.run_records(R.run_groups(spark.createDataFrame(rows, READ))).orderBy("run").collect()
    assert [(r["linear"], r["run"], r["flag"], r["parts"], r["skipped"], r["pos"], r["clip_before"], r["clip_after"]) for r in rec] == [
        (0, 0, 99, 2, 30, 11, 0, 20), (0, 1, 99, 1, 0, 81, 25, 5), (1, 2, 99 + 2048, 1, 0, 6, 35, 1)]


def test_describe():
    assert A.describe("ACG-TTN", "AGGCT-A") == ("1=1X1=1I1=1D1X", 7, 3, 2, 1, 1, 4, 2, 3)


def test_mapq(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (0.01,), (1e-30,), (None,), (float("nan"),)], "p double")
    assert [r[0] for r in df.select(rates.mapq("p")).collect()] == [254, 0, 20, 254, 255, 255]


def test_deletions(spark):
    df = spark.createDataFrame([("10H5=3D2=40D1I", ), ("3D",)], "cigar string")
    assert {r["length"]: r["count"] for r in R.deletion_lengths(df).collect()} == {3: 2, 40: 1}


@pytest.mark.parametrize("stranded", [True, False])
def test_flank_join_in_short_lists(spark, stranded):
    """Lists of a few features each give every pair once: ties in start, equal rows and both chromosomes."""
    rng = random.Random(31)
    features = [(f"g{rng.randrange(2)}", s := rng.randrange(30), s + rng.choice([8, 8, 15]), rng.choice("+-"), k, rng.randrange(3)) for k in range(90)]
    points = [(c, p, st) for c in ("g0", "g1") for p in (12, 20, 27) for st in "+-"]
    ends = [(a, b) for a in points for b in points if a <= b]
    place = "struct<chr string, pos long, strand string>"
    introns = spark.createDataFrame(ends + ends[:9], f"left {place}, right {place}")
    table = spark.createDataFrame(features, "chr string, start long, end long, strand string, feature_id long, gene long")
    want = Counter((a, b, x[4], y[4]) for a, b in ends for x in features for y in features
                   if x[0] == a[0] and x[1] < a[1] <= x[2] and y[0] == b[0] and y[1] <= b[1] < y[2] and x[5] != y[5]
                   and x[:5] < y[:5] and (not stranded or x[3] == a[2] and y[3] == b[2]))
    for listed in (1, 4, 1 << 10):
        got = R.flank_join(introns, table, differ="gene", stranded=stranded, listed=listed)
        assert got.columns[:3] == ["left", "right", "f1_start"] and "f2_gene" in got.columns
        assert Counter((tuple(r.left), tuple(r.right), r.f1_feature_id, r.f2_feature_id) for r in got.collect()) == want and len(want) > 500


def test_junctions_move_an_alignment_once(spark, folder):
    """Reads are dealt once: what is behind is one row for each bucket of a read. Buckets and repeated ids change nothing."""
    rng = random.Random(41)
    rows = []
    for read in range(60):
        at = 0
        for k in range(rng.randint(1, 6)):
            size = rng.choice([50, 90_000])
            aln = read * 10 + (k if rng.random() < 0.8 else max(0, k - 1))
            rows.append((aln, f"r{read}", 1, 0.0, 1.0, rng.choice(["GT", None]), rng.choice(["AG", None]), "g0", 100 * k, 100 * k + 50, "+", 10_000, at, at + size, "+", 1_000_000))
            at += size
    reads = spark.createDataFrame(rows, READ)
    facts = {r.r_id: (r.alignments, r.read_strand) for r in R.read_facts(reads).collect()}
    want = Counter()
    for read in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == read), key=lambda r: (r[12], r[0]))
        n, strand = facts[read]
        if n > 1 and strand:
            for x, y in zip(own, own[1:]):
                first, second = (x[0], y[0]) if strand == "+" else (y[0], x[0])
                want.update((read, strand, first, second) for a in own if a[0] == first for b in own if b[0] == second)
    got = R.junctions(reads, exact=False, parts=True)
    assert Counter((r.r_id, r.read_strand, r.aln1_id, r.aln2_id) for r in got.collect()) == want and len(want) > 30
    assert "REPARTITION_BY_COL" in got._jdf.queryExecution().executedPlan().toString()
