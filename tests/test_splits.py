"""Readers that finish records inside a split, for every split size."""

import os
import random

import pytest

from lociweave import sources as S
from lociweave.sources import sequences as Q, splits


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


@pytest.fixture(params=[40, 333, 5000, 1 << 27])
def split_size(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_fastq(spark, folder, split_size):
    rng, want, n = random.Random(1), [], 0
    for k, end in enumerate(["\n", "\r\n"]):
        text = ""
        for i in range(60):
            size = rng.choice([0, 1, 4, 30, 150])
            seq, qual = "".join(rng.choice("ACGT") for _ in range(size)), "".join(rng.choice("@+I!") for _ in range(size))
            text += end.join([f"@f{k}r{i} some @ thing", seq, rng.choice(["+", f"+f{k}r{i}"]), qual, ""]) + (end if rng.random() < 0.1 and i == 59 else "")
            want.append((f"f{k}r{i}", f"f{k}r{i} some @ thing", seq, qual))
        put(folder, f"{k}.fq", text)
    got = S.read_fastq(spark, folder).select("id", "description", "seq", "qual").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_fastq_errors(spark, folder):
    with pytest.raises(Exception, match="not a four-line record"):
        S.read_fastq(spark, put(folder, "a.fq", "@r\nAC\n+\nII\nAC\n+\nII\n")).collect()
    with pytest.raises(Exception, match="unfinished"):
        S.read_fastq(spark, put(folder, "b.fq", "@r\nAC\n+\nII\n@s\nAC\n")).collect()


def test_fasta_pieces(spark, folder, split_size):
    rng, want = random.Random(2), {}
    for k in range(2):
        text = ""
        for i in range(12):
            seq = "".join(rng.choice("ACGTacgtN") for _ in range(rng.choice([0, 1, 70, 900])))
            want[f"f{k}s{i}"] = (f"f{k}s{i} chromosome {i}", seq)
            text += f">f{k}s{i} chromosome {i}\r\n" + "".join(seq[j:j + 60] + rng.choice(["\n", "\r\n", " \n\n"]) for j in range(0, len(seq), 60))
        put(folder, f"{k}.fa", text)
    rows = S.read_fasta_pieces(spark, folder, 100).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r["name"], r["start"])):
        text = found.setdefault(r["name"], [r["description"], ""])
        assert r["start"] == len(text[1]) and len(r["seq"]) < 160
        text[1] += r["seq"]
    assert {k: tuple(v) for k, v in found.items()} == want
    grid = S.on_grid(S.read_fasta_pieces(spark, folder, 100), 64).collect()
    assert all(r["start"] // 64 == r["piece"] == (r["start"] + len(r["seq"]) - 1) // 64 for r in grid)
    asked = [(i, rng.choice(list(want)), s := rng.randrange(900), s + rng.randrange(1, 300)) for i in range(80)]
    iv = spark.createDataFrame(asked, "id long, chr string, start long, end long")
    got = {r["id"]: r["seq"] for r in S.subsequences_of_pieces(S.on_grid(S.read_fasta_pieces(spark, folder, 100), 64), iv, "id", 64).collect()}
    assert got == {i: t for i, c, s, e in asked if (t := want[c][1][s:e])}


def test_fasta_without_header(spark, folder):
    with pytest.raises(Exception, match="before the first header"):
        S.read_fasta_pieces(spark, put(folder, "x.fa", "ACGT\n>s\nAC\n")).collect()


def test_block_ids(spark, folder, split_size):
    """One number a block, the same however splits are dealt to tasks, in the order of files and places."""
    text = "".join(f"a\ns x{k} {k} 3 + 90 AC-T\ns y 6 4 - 80 ACGT\n" + ("\n \n" if k % 3 else "\n") for k in range(80))
    put(folder, "b c%1.maf", text)
    put(folder, "a.maf", text)
    first = {r["block_id"]: (r["seqs"][0]["chr"]) for r in S.read_maf(spark, folder).collect()}
    again = {r["block_id"]: (r["seqs"][0]["chr"]) for r in S.read_maf(spark, folder).where("size(seqs) > 1").coalesce(1).collect()}
    assert len(first) == 160 and first == again
    assert [int(first[i][1:]) for i in sorted(first)] == [*range(80), *range(80)]
    assert {i >> splits.PLACE_BITS for i in first} == {0, 1}


def test_a_long_chromosome_is_many_tasks(spark, folder):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 16))
    try:
        rng = random.Random(3)
        line = "".join(rng.choices("ACGT", k=60))
        path = put(folder, "big.fa", ">chr1\n" + (line + "\n") * 20000)
        pieces = S.read_fasta_pieces(spark, path, 1 << 12)
        lines = splits.split_lines(spark, path)
        assert lines.rdd.getNumPartitions() >= 15
        grid = S.on_grid(pieces, Q.PIECE)
        assert grid.selectExpr("sum(length(seq))", "max(length(seq))").head()[0] == 1_200_000
        iv = spark.createDataFrame([(1, "chr1", 600_000, 600_120), (2, "chr1", 0, 60), (3, "chr1", 1_199_990, 1_300_000)], "id long, chr string, start long, end long")
        got = {r["id"]: r["seq"] for r in Q.subsequences_of_pieces(grid, iv, "id").collect()}
        assert got == {1: line * 2, 2: line, 3: line[-10:]}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
