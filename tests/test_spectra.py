"""Expected counts of small hand-checked alignments, read from MAF text."""

import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lociweave.operators import sites, spectra
from lociweave.operators import spectra as S
from lociweave.operators import windows as W
from lociweave.sources import flatten_trio, read_maf


def block(*seqs, strands="+-+", starts=(70397, 14565352, 3874), lens=(3310157, 17092476, 544986), plines=()):
    names = ("SC1", "PAR", "SH1")
    rows = [f"s {n} {s} {len(q.replace('-', ''))} {st} {l} {q}" for n, s, st, l, q in zip(names, starts, strands, lens, seqs)]
    return "a\n" + "\n".join(rows) + "".join(f"\np {p}" for p in plines) + "\n"


def trio(spark, folder, text, plines=False):
    path = os.path.join(folder, "x.maf")
    with open(path, "w") as f:
        f.write(text)
    return flatten_trio(read_maf(spark, path, with_plines=plines))


def nonzero(df, column="mutNum"):
    return {(r["species"], r["mutType"]): r[column] for r in df.collect() if r[column]}


@pytest.mark.parametrize("seqs", [("CAG", "AAC", "CAG"), ("CTC", "CAC", "CAC"), ("CAG", "CAG", "C-G"), ("CA", "CA", "CA"), ("CNG", "CNG", "CAG")])
def test_nothing_counts(spark, folder, seqs):
    out = spectra.tri_spectrum(trio(spark, folder, "# comment\n" + block(*seqs)))
    rows = out.collect()
    assert len(rows) == 192
    assert all(r["mutNum"] == 0 and r["totalRootNum"] == 0 for r in rows)


@pytest.mark.parametrize("seqs,species", [(("CAG", "CGG", "CAG"), "B"), (("cag", "CAG", "cgg"), "C")])
def test_one_change_is_folded_and_counts_originals_for_both(spark, folder, seqs, species):
    out = spectra.tri_spectrum(trio(spark, folder, block(*seqs))).cache()
    assert nonzero(out) == {(species, "C[T>C]G"): 1}
    assert nonzero(out, "totalRootNum") == {(s, f"C[T>{v}]G"): 1 for s in "BC" for v in "ACG"}


def test_real_block(spark, folder):
    a = "CAGGAGT--------------------------------------------CCAGCGCGTCCCCGCATGCTT"
    b = "AACTCGTCTTAATTTGTGGTTAAAGATTTGAATTGAAAAAGAGGAGTTTACCCATGGCATCTCCGCAAGTAG"
    c = "CAGGAGT--------------------------------------------CTAGGGAGTCTCCACAGGCTT"
    out = spectra.tri_spectrum(trio(spark, folder, block(a, b, c))).cache()
    assert nonzero(out) == {("C", "C[C>T]A"): 1, ("C", "G[C>T]G"): 1}
    totals = nonzero(out, "totalRootNum")
    assert {k[1][0] + k[1][2] + k[1][6] for k in totals} == {"CCA", "GCG"} and set(totals.values()) == {1}


def test_low_error_columns(spark, folder):
    seqs = ("AACGCTCTCTGG---AACGAGACCGTGAGTCACGTGACCTGTATCGCT", "AACGCTCGCGTG---ACCTTGACCGTGAATCACGCGACTTGTAGCGGG",
            "ACCGCTCTCTCGGTGACCTTGACCTCGAATCTCTTGATTTATATCttt")
    p = ("$*.134444557~~~77888:;<>@CDEEKSXYXUXYWTVWURMMJFE", "$(,/12223334~~~55667:;<AEILOPTX\\_bcgjlmpqrssssst",
         "$(,/12223334~~~55667:;<AEILOPTX\\_bcgjlmpqrssssst", "NHFE?=;94.&#'%#()+,-:;<112358:;;;;;81/--,,+(&%$#", "~" * 48, "~" * 48)
    aln = trio(spark, folder, block(*seqs, plines=p), plines=True)
    out = spectra.tri_spectrum_low_error(aln).cache()
    assert nonzero(out) == {("C", "G[T>A]G"): 1}
    totals = nonzero(out, "totalRootNum")
    assert {k[1][0] + k[1][2] + k[1][6] for k in totals} == {"GTC", "GTG"} and set(totals.values()) == {1}
    assert len(nonzero(spectra.tri_spectrum(aln), "totalRootNum")) > len(totals)


def test_substitution_ratio(spark, folder):
    text = block("CAGGAGT-TTAGTTTG", "AACTCGTCTTAATT-G", "CAGGAGTGTAGAT-TC") + "\n" + block("GGAGT-TTAGTTTGTG", "AACTCGTCTTAATT-G", "CAGGAGTGTAGAT-TC")
    rows = {r["species"]: r for r in spectra.sbst_ratio(trio(spark, folder, text)).collect()}
    assert (rows["B"]["sbst"], rows["B"]["unchanged"], rows["C"]["sbst"], rows["C"]["unchanged"]) == (5, 11, 4, 12)


SITES = block("TCTTACCAGAGATCGTCGGACACTTTCTCGTCGGATGTATCGAC-GG", "TCTTACCATTGGTTGTCGTTTTCTTTTTCGTCAGAAGCATCAACTGG",
              "TCTTACCATAAATCGTCCGATAATTTTTCTTCGGTACCGTCTACTGG", strands="++-", starts=(34877, 649989, 171827))


def test_sites_in_older_coordinates(spark, folder):
    rows = sites.sbst_sites(trio(spark, folder, SITES), coords="column").orderBy("startA").collect()
    got = [(r["startA"], r["endA"], r["trinucA"], r["startB"], r["trinucB"], r["startC"], r["endC"], r["strandC"], r["trinucC"]) for r in rows]
    assert got == [(34890, 34891, "TCG", 650002, "TTG", 373172, 373173, "-", "TCG"), (34906, 34907, "CGT", 650018, "CGT", 373188, 373189, "-", "CTT"),
                   (34909, 34910, "CGG", 650021, "CAG", 373191, 373192, "-", "CGG")]


def test_sites_point_at_their_bases(spark, folder):
    rows = sites.sbst_sites(trio(spark, folder, SITES)).collect()
    assert {r["startC"] for r in rows} == {544986 - (171827 + i) - 1 for i in (13, 29, 32)}
    split = sites.split_sites(sites.sbst_sites(trio(spark, folder, SITES))).groupBy("species").count().collect()
    assert {r["species"]: r["count"] for r in split} == {"B": 2, "C": 1}


def test_split_refuses_other_sites(spark):
    bad = spark.createDataFrame([("x", 1, 2, "+", "CTC") * 3], ", ".join(f"chr{u} string, start{u} long, end{u} long, strand{u} string, trinuc{u} string" for u in "ABC"))
    with pytest.raises(Exception, match="one-species"):
        sites.split_sites(bad).collect()


def reverse_complement(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_strand_flip_and_weights(spark, folder):
    import random
    rng = random.Random(5)
    a = "".join(rng.choice("ACGT") for _ in range(600))
    b = "".join(rng.choice("ACGT-") if rng.random() < .1 else x for x in a)
    c = "".join(rng.choice("ACGTN") if rng.random() < .1 else x for x in a)
    fwd = trio(spark, folder, block(a, b, c))
    os.mkdir(folder + "/r")
    rev = trio(spark, folder + "/r", block(*map(reverse_complement, (a, b, c))))
    for fn in (spectra.tri_spectrum, spectra.di_spectrum):
        assert sorted(fn(fwd).collect()) == sorted(fn(rev).collect())
    w = spectra.tri_spectrum_weighted(fwd).cache()
    assert sorted(w.collect()) == sorted(spectra.tri_spectrum_weighted(rev).collect())
    assert len(spectra.di_spectrum(fwd).collect()) == 156
    muts = spectra.tri_spectrum(fwd).agg(F.sum("mutNum")).head()[0]
    assert w.agg(F.sum("mutNum")).head()[0] >= muts
    # cutting a block into overlapping parts changes nothing
    from lociweave.operators.windows import split_long_blocks
    parts = split_long_blocks(fwd, 50, 2)
    assert sorted(spectra.tri_spectrum(parts).collect()) == sorted(spectra.tri_spectrum(fwd).collect())


def test_lengths_must_agree(spark, folder):
    with pytest.raises(Exception, match="differ in length"):
        spectra.tri_spectrum(trio(spark, folder, block("CAG", "CAGT", "CAG"))).collect()


def test_long_blocks_with_error_lines(spark):
    import random

    from lociweave.operators import spectra as S
    from lociweave.operators.windows import split_long_blocks
    rng = random.Random(3)
    text = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    rows = []
    for k, n in enumerate((7, 300, 1001)):
        a = text(n, "ACGTACGT-")
        b = "".join(c if rng.random() < 0.8 else rng.choice("ACGT-") for c in a)
        c = "".join(x if rng.random() < 0.8 else rng.choice("ACGT-") for x in a)
        size = [len(x.replace("-", "")) for x in (a, b, c)]
        rows.append((k, "x", 10, 10 + size[0], "+", 9999, a, "y", 20, 20 + size[1], "-", 9999, b, "z", 30, 30 + size[2], "+", 9999, c, [text(n, "456789"), text(n, "5678")]))
    kinds = " ".join(f"chr_{s} string, start_{s} long, end_{s} long, strand_{s} string, len_{s} long, seq_{s} string," for s in "abc")
    whole = spark.createDataFrame(rows, f"block_id long, {kinds} plines array<string>")
    parts = split_long_blocks(whole, 64, 2)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(S.tri_spectrum_low_error(parts)) == key(S.tri_spectrum_low_error(whole))
    for r in parts.collect():
        assert all(len(p) == len(r.seq_a) for p in r.plines) and len(r.seq_a) <= 66
        for s in "abc":
            assert r[f"end_{s}"] - r[f"start_{s}"] == len(r[f"seq_{s}"].replace("-", ""))
    one = sorted((r._part, r.start_b, r.seq_b) for r in parts.where("block_id = 2").collect())
    for (k, start, seq), (_, after, _) in zip(one, one[1:]):
        assert after - start == len(seq[:64].replace("-", ""))


def test_one_pass_for_all_widths(spark):
    """Every narrower count comes from the widest one, also at the ends of short blocks."""
    rng = random.Random(31)
    rows = [("t" + str(i % 2), *["".join(rng.choice("ACGTacgt-N") for _ in range(n)) for _ in range(3)]) for i, n in enumerate([0, 1, 2, 3, 4, 5, 60, 200])]
    aln = spark.createDataFrame(rows, "trio string, seq_a string, seq_b string, seq_c string")
    four = W.marginal_counts(aln, 4, keys=["trio"])
    for width in (1, 2, 3, 4):
        got = W.narrower(four, width, keys=["trio"]).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, W.window_counts(aln, width, keys=["trio"]).collect()))


def test_trio_plan_equals_its_parts(spark):
    from lociweave.plans.trio import trio_metrics, trio_spectra
    rng = random.Random(32)
    def near(a):  # noqa: E301
        return "".join(x if rng.random() < 0.85 else rng.choice("ACGT-N") for x in a)
    rows = []
    for i in range(12):
        a = "".join(rng.choice("ACGT-") for _ in range(150))
        rows.append((i, "t" + str(i % 2), "c1", 1000 * i, "+", 10 ** 6, a, 0, near(a), 0, near(a)))
    aln = spark.createDataFrame(rows, "block_id long, trio string, chr_a string, start_a long, strand_a string, len_a long, seq_a string, start_b long, seq_b string, start_c long, seq_c string")
    cds = spark.createDataFrame([("c1", 20, 60), ("c1", 3030, 3090), ("c1", 5000, 5200)], "chr string, start long, end long")
    out = trio_spectra(aln, ["trio"], cds)
    from lociweave.operators.blocks import cut_features
    for variant, blocks in (("all", aln), ("ncds", cut_features(aln, cds))):
        for kind, fn in (("tri", S.tri_spectrum), ("di", S.di_spectrum)):
            want = fn(blocks, ["trio"]).select("trio", "species", "mutType", "mutNum", "totalRootNum")
            got = out.where(f"variant = '{variant}' and kind = '{kind}'").select(want.columns)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    m = trio_metrics(aln, ["trio"])
    ident = {(r[0], r[1]): r[2] for r in m["identity"].collect()}
    gc = {(r[0], r[1]): r[2] for r in m["gc"].collect()}
    for s in "bc":
        for r in S.percent_identity(aln.select("trio", "seq_a", F.col(f"seq_{s}").alias("seq_b")), ["trio"]).collect():
            assert ident[r["trio"], s.upper()] == r["identity"]
        for r in S.gc_content(aln.select("trio", F.col(f"seq_{s}").alias("seq")), ["trio"]).collect():
            assert gc[r["trio"], s.upper()] == r["gc_pct"]


@pytest.mark.parametrize("width", [3, 4])
def test_site_windows_are_the_informative_ones(width):
    rng = random.Random(width)
    for n in (0, 2, 400):
        a = [rng.choice("ACGTacgt-N") for _ in range(n)]
        b, c = ([rng.choice("ACGT-") if rng.random() < 0.15 else x for x in a] for _ in "bc")
        seqs, want = ["".join(s) for s in (a, b, c)], {True: [], False: []}
        for i in range(n - width + 1):
            x, y, z = (s[i:i + width].upper() for s in seqs)
            if set(x + y + z) <= set("ACGT") and x[0] == y[0] == z[0] and x[-1] == y[-1] == z[-1] and x in (y, z):
                row = [i, *(i - s[:i].count("-") for s in seqs)]
                want[False].append(row)
                if y != z:
                    want[True].append(row)
        assert n < 400 or want[True]
        for changed in (True, False):
            assert sites.site_windows(seqs, width, changed).reshape(-1, 4).tolist() == want[changed]


@pytest.mark.parametrize("width", [3, 4])
def test_site_batches_are_bounded(width, monkeypatch):
    """Windows of many and of long blocks come in small batches, with the places that whole blocks give."""
    rng = random.Random(21)
    seqs = [tuple("".join(rng.choices("ACGTacgtN-", k=n)) for _ in range(3)) for n in [0, 1, 2, 3, 500, 64, 4, 129, 130, 131] * 3]
    shared = [(a, "".join(x if rng.random() < 0.8 else y for x, y in zip(a, b)), "".join(x if rng.random() < 0.8 else y for x, y in zip(a, c))) for a, b, c in seqs]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(shared))), *(pa.array(c, pa.string()) for c in zip(*shared))], ["block", "seq_a", "seq_b", "seq_c"])
    monkeypatch.setattr(sites, "LONG", 64)
    monkeypatch.setattr(sites, "AT_ONCE", 300)
    for changed in (False, True):
        got = {}
        for part in sites._site_batches(batch, ["block"], width, changed):
            assert sum(len(s) for s in part.column("_s_a").to_pylist()) <= 300 + 64 + width + part.num_rows
            for r in part.to_pylist():
                for k in range(0, len(r["_w"]), 4):
                    col, *off = r["_w"][k:k + 4]
                    whole = shared[r["block"]]
                    assert [r[f"_s_{s}"][col:col + width].decode() for s in "abc"] == [q[r["_col"] + col:r["_col"] + col + width].upper() for q in whole]
                    got.setdefault(r["block"], []).append((r["_col"] + col, *(o + b for o, b in zip(off, r["_off"]))))
        want = {i: list(map(tuple, sites.site_windows(q, width, changed).reshape(-1, 4).tolist())) for i, q in enumerate(shared)}
        assert got == {i: w for i, w in want.items() if w} and any(len(w) > 20 for w in got.values())
