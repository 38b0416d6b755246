"""Readers and writers."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from lociweave import sinks
from lociweave import sources as S
from lociweave.functions.coords import natural_key
from lociweave.operators import multispecies as M
from lociweave.operators import reads as R
from lociweave.sources import alignments as AL
from lociweave.sources import sequences as Q


def put(folder, name, text):
    path = os.path.join(folder, name)
    (gzip.open(path, "wt") if name.endswith(".gz") else open(path, "w")).write(text)
    return path


PAIRS = """# last
a score=12 mismap=1e-05 sense=-4.8 don=GT
s c1 10 4 + 100 ACGT
s r1 0 4 - 50 ACGA
\t
a score=7 mismap=0.5
s c2 1 3 + 100 A-CG
s r2 2 4 + 50 ATCG
"""


def test_maf_pairs_and_gzip(spark, folder):
    path = put(folder, "p.maf.gz", PAIRS)
    rows = {r["r_id"]: r for r in S.read_maf_pairs(spark, path).collect()}
    r = rows["r1"]
    assert (r["score"], r["mismap"], r["sense"], r["don"], r["acc"]) == (12, 1e-05, -4.8, "GT", None)
    assert (r["g_start"], r["g_end"], r["r_strand"], r["r_len"]) == (10, 14, "-", 50)
    assert rows["r2"]["sense"] is None and rows["r2"]["g_seq"] == "A-CG"
    with pytest.raises(Exception, match="without score"):
        S.read_maf_pairs(spark, put(folder, "bad.maf", "a mismap=1\ns c 1 1 + 9 A\ns r 1 1 + 9 A\n")).collect()
    with pytest.raises(Exception, match="exactly 2"):
        S.read_maf_pairs(spark, put(folder, "one.maf", "a score=1 mismap=1\ns c 1 1 + 9 A\n")).collect()


def test_maf_round_trip(spark, folder):
    text = "a\ns x 5 3 + 90 AC-T\ns y 6 4 - 80 ACGT\ns z 7 2 + 70 A--T\n\na\ns x 50 2 + 90 AC\ns y 60 2 - 80 AC\ns z 70 2 + 70 AC\n"
    aln = S.flatten_trio(S.read_maf(spark, put(folder, "t.maf", text)))
    sinks.write_maf(aln, folder + "/out")
    back = S.flatten_trio(S.read_maf(spark, folder + "/out"))
    assert sorted(map(str, back.drop("block_id").collect())) == sorted(map(str, aln.drop("block_id").collect()))


def test_line_ends_of_windows(spark, folder):
    text = "".join(f"a score={k} mismap=0.5 don=G=T\ns c{k} 1 3 + 100 A-CG\ns r{k} 2 4 + 50 ATCG\n\n" for k in range(2000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        df = S.read_maf_pairs(spark, put(folder, "w.maf", text.replace("\n", "\r\n")))
        assert df.select("aln_id").distinct().count() == 2000 and df.selectExpr("sum(score)").head()[0] == 1999 * 1000
        assert df.where("don = 'G=T' and r_seq = 'ATCG'").count() == 2000
        assert AL.maf_parts(spark, folder + "/w.maf").count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gff(spark, folder):
    path = put(folder, "g.gff", "##gff-version 3\nc1\tx\tCDS\t11\t20\t.\t+\t0\tID=a;gene=G1;gene=G2;\nc1\tx\tgene\t1\t30\t.\t-\t.\tID=g\n")
    rows = S.read_gff(spark, path, ["CDS"]).collect()
    assert len(rows) == 1 and (rows[0]["start"], rows[0]["end"], rows[0]["attrs"]["gene"]) == (10, 20, "G2")
    assert S.read_gff(spark, path).count() == 2
    with pytest.raises(Exception, match="bad range"):
        S.read_gff(spark, put(folder, "b.gff", "c1\tx\tCDS\t30\t20\t.\t+\t0\tID=a\n")).collect()


def test_repeats(spark, folder):
    text = "   SW  perc\nscore  div.\n\n  463   1.3  0.6  1.7  c1   10468  11447 (248944975) C  TAR1   Satellite/telo 712 1\n 1 2 3 4 c2 5 9 (1) + L1 LINE 1\n"
    rows = S.read_repeatmasker(spark, put(folder, "r.out", text), base=1).orderBy("chr").collect()
    assert [(r["chr"], r["start"], r["end"], r["strand"], r["class"]) for r in rows] == [("c1", 10467, 11447, "-", "Satellite/telo"), ("c2", 4, 9, "+", "LINE")]
    t = S.read_tandem_repeats(spark, put(folder, "t.tsv", "c1\t3\t9\tACG\t2\n")).head()
    assert (t["chr"], t["start"], t["end"], t["rest"]) == ("c1", 3, 9, ["ACG", "2"])


def test_sequences(spark, folder):
    fa = S.read_fasta(spark, put(folder, "x.fa", ">s1 first\nACGT\nAC\n>s2\nGG\n"))
    assert {r["name"]: r["seq"] for r in fa.collect()} == {"s1": "ACGTAC", "s2": "GG"}
    assert S.subsequence(fa, "s1", 2, 5).head()["seq"] == "GTA"
    text = "".join(f"@r{i} d\nACGT\n+\n{'@@II' if i % 2 else 'IIII'}\n" for i in range(50))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")  # force many splits
    try:
        fq = S.read_fastq(spark, put(folder, "x.fq", text)).cache()
        got = sorted((r["id"], r["seq"], r["qual"]) for r in fq.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted((f"r{i}", "ACGT", "@@II" if i % 2 else "IIII") for i in range(50))
    assert Q.good_quality(fq, 35, 70).count() == 25
    assert Q.with_mate_suffix(fq, 2).where("id like '%/2'").count() == 50


def test_psl(spark, folder):
    line = "\t".join(["9", "1", "0", "0", "0", "0", "0", "0", "-", "q", "100", "10", "20", "t", "500", "30", "40", "1", "10,", "10,", "30,"])
    psl = S.read_psl(spark, put(folder, "x.psl", line + "\n"))
    seg = AL.ref_first(AL.psl_segments(psl, "chr_")).head()
    assert (seg["r_chr"], seg["r_start"], seg["q_chr"], seg["q_end"]) == ("chr_t", 30, "chr_q", 20)
    c = AL.strand_coordinates(psl).head()
    assert (c["r_start"], c["r_end"]) == (80, 90)


def test_tables(spark, folder):
    put(folder, "GCA_1.1_homSap_20250101.tsv", "mutType\tmutNum\ttotalRootNum\nA[C>T]G\t3\t10\n")
    r = S.read_spectra(spark, folder + "/*.tsv").head()
    assert (r["accession"], r["short_name"], r["date"], r["mutNum"]) == ("GCA_1.1", "homSap", "20250101", 3)
    put(folder, "GCA_1.1.json", json.dumps({"reports": [{"organism": {"organism_name": "Homo sapiens"}}]}, indent=1))
    m = S.read_metadata(spark, folder + "/GCA_1.1.json")
    got = M.with_metadata(spark.createDataFrame([("GCA_1.1",), ("GCA_9",)], "accession string"), m).orderBy("accession").collect()
    assert [(x["genus"], x["organism"]) for x in got] == [("Homo", "Homo sapiens"), ("Unknown", "GCA_9")]
    trio = put(folder, "kelp.txt", "GCA_1 One strain\nGCA_2 Two 1\n# substitution percent identity: 87.25\n\n\nGCA_3 X\nGCA_4 Y 1\n# substitution percent identity: 79.5\n")
    t = S.read_trios(spark, trio).orderBy("acc1").collect()
    assert [(x["taxon"], x["acc1"], x["acc2"], x["identity"]) for x in t] == [("kelp", "GCA_1", "GCA_2", 87.25), ("kelp", "GCA_3", "GCA_4", 79.5)]


def test_intron_json(spark, folder):
    doc = {"c_1_+_c_9_+": {"intronStart": {"chr": "c", "pos": 1, "strand": "+"}, "intronEnd": {"chr": "c", "pos": 9, "strand": "+"},
                           "intronLength": 8, "splicingSignal": ["GT", "AG"], "readIDs": ["a", "b"]}}
    df = S.read_introns_json(spark, put(folder, "i.json", json.dumps(doc)))
    row = df.head()
    assert (row["key"], row["start"]["pos"], row["length"], row["don"], row["reads"]) == ("c_1_+_c_9_+", 1, 8, "GT", ["a", "b"])
    sinks.write_introns(df, folder + "/o")
    assert json.loads(spark.read.text(folder + "/o").head()[0]) == doc
    assert S.read_introns_json(spark, folder + "/o").collect() == [row]


def test_partitioned_writers(spark, folder):
    df = spark.range(100).selectExpr("id", "case when id % 3 = 0 then 'hot' else cast(id as string) end as gene")
    sinks.write_partitioned(df, "gene", folder + "/p", files_per_value=2)
    assert spark.read.parquet(folder + "/p").count() == 100
    spec = spark.createDataFrame([("B", "T[T>A]A", 1, 2), ("B", "A[C>A]A", 1, 2), ("C", "A[C>A]A", 1, 2)], "species string, mutType string, mutNum long, totalRootNum long")
    sinks.write_spectrum(spec, folder + "/s", ["species"])
    back = spark.read.csv(folder + "/s/species=B", sep="\t", header=True).collect()
    assert [r["mutType"] for r in back] == ["A[C>A]A", "T[T>A]A"]
    sinks.write_sites(spec, folder + "/c", "csv")
    assert spark.read.csv(folder + "/c", sep="\t", header=True).count() == 3


def test_natural_order(spark):
    df = spark.createDataFrame([(c,) for c in ("chr10", "chr2", "chrX", "chr1b3", "chr1b12")], "c string")
    assert [r[0] for r in df.orderBy(natural_key("c")).collect()] == ["chr1b3", "chr1b12", "chr2", "chr10", "chrX"]


# ---- layouts that lie together ---------------------------------------------

def place(chr_, pos, strand="+"):
    return {"chr": chr_, "pos": pos, "strand": strand}


def intron(k, reads=("r1",), **more):
    return {"intronStart": place("c1", k), "intronEnd": place("c1", k + 50), "intronLength": 50, "splicingSignal": ["GT", "AG"], "readIDs": list(reads), **more}


def test_intron_layouts_in_one_folder(spark, folder):
    """A map over many lines, maps in lines, one map in one line, and a blank line; alignments where a file has them."""
    lines = [["s c1 1 2", "s r1 1 2"], ["s c1 9 2", "s r1 4 2"]]
    put(folder, "whole.json", json.dumps({"a": intron(1, alignments=[lines]), "b": intron(2)}, indent=2))
    put(folder, "lines.json", json.dumps({"c": intron(3)}) + "\n\n" + json.dumps({"d": intron(4), "e": intron(5)}) + "\n")
    put(folder, "single.json", json.dumps({"f": intron(6, ("r1", "r2"))}))
    rows = {r["key"]: r for r in S.read_introns_json(spark, folder).collect()}
    assert sorted(rows) == list("abcdef") and rows["f"]["reads"] == ["r1", "r2"] and rows["e"]["start"]["pos"] == 5
    assert rows["a"]["alignments"] == [lines] and rows["b"]["alignments"] is None
    back = folder + "/back"
    sinks.write_introns(S.read_introns_json(spark, folder), back)
    assert {r["key"]: r["alignments"] for r in S.read_introns_json(spark, back).collect()}["a"] == [lines]


def test_text_that_is_no_intron_map_is_an_error(spark, folder):
    put(folder, "good.json", json.dumps({"a": intron(1)}))
    put(folder, "bad.json", "{\"a\": {\n\"intronStart\": \n")
    with pytest.raises(Exception, match="not a map of introns"):
        S.read_introns_json(spark, folder).collect()


def test_cluster_json(spark):
    from lociweave.sources import tables
    p = lambda pos: ("c1", pos, "+")
    rows = [("k1", p(30), p(60), 30, "GT", None, 4), ("k1", p(10), p(50), 40, "GT", "AG", 2), ("k9", p(1), p(2), 1, None, None, 1)]
    end = "struct<chr: string, pos: bigint, strand: string>"
    df = spark.createDataFrame(rows, f"cluster string, start {end}, end {end}, length bigint, don string, acc string, reads bigint")
    text = sinks.cluster_json(df)
    one = {k: v for r in text.collect() for k, v in json.loads(r["value"]).items()}
    assert [x["intronStart"]["pos"] for x in one["k1"]] == [10, 30] and one["k1"][0]["reads"] == 2 and one["k1"][0]["splicingSignal"] == ["GT", "AG"]
    assert sorted(map(str, tables.parse_clusters(text).collect())) == sorted(map(str, df.collect()))


def test_spectra_of_two_layouts(spark, folder):
    put(folder, "GCA_1_Abc_20250101.tsv", "mutType\tmutNum\ttotalRootNum\nA[C>A]A\t3\t9\n")
    put(folder, "GCA_2_Def_20250101.tsv", "oriType\tmutType\ttotalRootNum\tmutNum\ts_cds\r\nACA\tA[C>A]A\t8\t2\t1\r\n")
    rows = {r["accession"]: r for r in S.read_spectra(spark, folder).collect()}
    assert (rows["GCA_1"]["mutNum"], rows["GCA_1"]["totalRootNum"], rows["GCA_1"]["oriType"], rows["GCA_1"]["s_cds"]) == (3, 9, None, None)
    assert (rows["GCA_2"]["mutNum"], rows["GCA_2"]["totalRootNum"], rows["GCA_2"]["oriType"], rows["GCA_2"]["s_cds"]) == (2, 8, "ACA", 1)
    put(folder, "GCA_3_Ghi_20250101.tsv", "A[C>A]A\t3\t9\n")
    with pytest.raises(Exception, match="no header line"):
        S.read_spectra(spark, folder).collect()


def test_clips_of_alignments(spark):
    from lociweave.operators import pairs
    rows = [(1, "ACG-T", "AC-GT", 0, 4, 4), (2, "ACGT", "ACTT", 3, 7, 9)]
    df = spark.createDataFrame(rows, "aln_id long, seq_a string, seq_b string, r_start long, r_end long, r_len long")
    got = {r["aln_id"]: r["cigar"] for r in pairs.with_clips(pairs.alignment_stats(df, ["aln_id", "r_start", "r_end", "r_len"])).collect()}
    assert got == {1: "2=1D1I1=", 2: "3H2=1X1=2H"}


def test_attributes_are_split_once(spark):
    from lociweave.sources.features import parse_attributes

    df = spark.createDataFrame([("ID=a; ID=b;note=x=y;z",), ("",), (None,)], "t string").select(parse_attributes("t").alias("m"))
    assert [r["m"] for r in df.collect()] == [{"ID": "b", "note": "x=y"}, {}, None]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
