"""Result tables and metadata files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

_END = "struct<chr:string,pos:bigint,strand:string>"
_INTRON = f"intronStart:{_END},intronEnd:{_END},intronLength:bigint,splicingSignal:array<string>"
#: `alignments` are pairs of texts, each a list of lines; files may leave them out.
INTRON_SCHEMA = f"map<string,struct<{_INTRON},readIDs:array<string>,alignments:array<array<array<string>>>>>"
CLUSTER_SCHEMA = f"map<string,array<struct<{_INTRON},reads:bigint>>>"
METADATA_SCHEMA = ("reports array<struct<accession:string,organism:struct<organism_name:string,"
                   "infraspecific_names:map<string,string>>>>")


def read_spectra(spark: SparkSession, path) -> DataFrame:
    """Spectrum TSVs, each read by the columns that its own first line names; files of several layouts may lie together.

    The columns are those that any file has (annotated tables add oriType, s_cds, ...); a file without one leaves it null. A file whose rows come with no
    header in it is an error.
    """
    lines = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("value"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("path"))
    is_head = F.col("value").rlike(_HEADER)
    heads = lines.where(is_head).groupBy("path").agg(F.min("value").alias("_head"))  # one row a file
    layouts = [r["_head"].split("\t") for r in heads.select("_head").distinct().collect()]  # a handful of layouts
    columns = list(dict.fromkeys(c for layout in layouts for c in layout)) or ["mutType", "mutNum", "totalRootNum"]
    rows = lines.where(~is_head & (F.length(F.trim("value")) > 0)).join(heads, "path", "left")
    names = F.split(F.coalesce("_head", F.raise_error(F.concat(F.lit("no header line in "), F.col("path")))), "\t")
    cells = F.split("value", "\t")
    ordered = F.array_join(F.array(*[F.coalesce(F.get(cells, (F.array_position(names, c) - 1).cast("int")), F.lit("")) for c in columns]), "\t")
    # a cell of a column that the file doesn't have is at place -1: empty
    return parse_spectra(rows.select(ordered.alias("value"), "file"), columns)


_HEADER = r"(^|\t)mutType(\t|$)"


def parse_spectra(lines: DataFrame, columns: Sequence[str] = ("mutType", "mutNum", "totalRootNum")) -> DataFrame:
    """accession, short_name and date from the `file` name ACC_NNN_short_date.tsv, and the columns of its `value` lines; header lines are left out."""
    stem = F.regexp_extract("file", r"^(.*?)\.[^.]*$", 1)
    kinds = {"mutType": "string", "oriType": "string"}
    f = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    rows = lines.where((F.length(F.trim("value")) > 0) & ~F.col("value").rlike(_HEADER)).select(
        *[F.nullif(F.get(f, F.lit(i)), F.lit("")).cast(kinds.get(c, "bigint")).alias(c) for i, c in enumerate(columns)], "file")
    p = F.split(stem, "_")
    named = rows.select("*", p.alias("_p"), stem.alias("_stem"))
    acc = F.when(F.size("_p") >= 3, F.concat_ws("_", F.slice("_p", 1, 2))).otherwise(
        F.raise_error(F.concat(F.lit("unexpected file name: "), F.col("_stem"))))
    return named.select(acc.alias("accession"), F.get("_p", F.lit(2)).alias("short_name"),
                        F.coalesce(F.get("_p", F.lit(3)), F.lit("")).alias("date"), *columns)


def read_metadata(spark: SparkSession, path) -> DataFrame:
    """accession (file name) and organism name of genome metadata JSON files."""
    return parse_metadata(spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file")))  # small files, one genome each


def parse_metadata(documents: DataFrame) -> DataFrame:
    raw = documents.select(F.from_json("value", METADATA_SCHEMA).alias("j"), "file").select("j.*", "file")
    return raw.select(F.regexp_extract("file", r"^(.*)\.json", 1).alias("accession"),
                      F.get("reports", F.lit(0))["organism"]["organism_name"].alias("organism"),
                      F.map_values(F.get("reports", F.lit(0))["organism"]["infraspecific_names"]).alias("infraspecific"))


def read_introns_json(spark: SparkSession, path) -> DataFrame:
    """Intron JSON as rows. Each file is either one map (key -> intron) laid out over any number of lines, or, as `write_introns` leaves it, one map in each line.

    The layout is that of the file, so both may lie in one folder. Files that are one text are read whole; their paths alone pass the driver.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.length(F.trim("value")) > 0)
    by_line = F.from_json("value", INTRON_SCHEMA).isNotNull() & F.trim("value").startswith("{") & F.trim("value").endswith("}")
    layout = lines.groupBy("file").agg(F.bool_and(by_line).alias("by_line"))
    texts = [r["file"] for r in layout.where("not by_line").select("file").collect()]
    # the layout is part of the value, so that no line of another file is parsed (and refused) before the join
    found = parse_introns(lines.join(layout, "file").select(F.when(F.col("by_line"), F.col("value")).alias("value")))
    return found.unionByName(parse_introns(spark.read.text(texts, wholetext=True))) if texts else found


def parse_introns(maps: DataFrame) -> DataFrame:
    """key, start, end, length, don, acc, reads, alignments of `value` rows that map keys to introns; a row that isn't such a map is an error."""
    m = maps.select(_parsed(INTRON_SCHEMA).alias("m"))
    sig = lambda i: F.get("v.splicingSignal", F.lit(i))
    return m.select(F.explode("m").alias("key", "v")).select(
        "key", F.col("v.intronStart").alias("start"), F.col("v.intronEnd").alias("end"), F.col("v.intronLength").alias("length"),
        sig(0).alias("don"), sig(1).alias("acc"), F.col("v.readIDs").alias("reads"), F.col("v.alignments").alias("alignments"))


def _parsed(schema: str):
    """The map in a row; null and blank rows are null, other text that isn't one raises an error."""
    m = F.from_json("value", schema)
    return F.when(m.isNotNull() | F.col("value").isNull() | (F.length(F.trim("value")) == 0), m).otherwise(
        F.raise_error(F.concat(F.lit("not a map of introns: "), F.left("value", F.lit(80)))))


def parse_clusters(maps: DataFrame) -> DataFrame:
    """cluster, start, end, length, don, acc, reads (their number) of `value` rows that map clusters to their introns."""
    m = maps.select(_parsed(CLUSTER_SCHEMA).alias("m")).select(F.explode("m").alias("cluster", "members"))
    sig = lambda i: F.get("v.splicingSignal", F.lit(i))
    return m.select("cluster", F.explode("members").alias("v")).select(
        "cluster", F.col("v.intronStart").alias("start"), F.col("v.intronEnd").alias("end"), F.col("v.intronLength").alias("length"),
        sig(0).alias("don"), sig(1).alias("acc"), "v.reads")


def read_trios(spark: SparkSession, path) -> DataFrame:
    # a list of pairs is small; with other line ends its blank lines aren't found, and it is one text
    return parse_trios(spark.read.option("lineSep", "\n\n").text(path).select("value", F.col("_metadata.file_name").alias("file")))


def parse_trios(entries: DataFrame) -> DataFrame:
    """Candidate pairs: taxon (file name), acc1, acc2, their descriptions and percent identity; a `value` holds one entry or several."""
    one = entries.select("file", F.explode(F.split(F.regexp_replace("value", "\r", ""), r"\n[ \t]*\n")).alias("value"))
    raw = one.select(
        F.regexp_extract("file", r"^(.*?)(\.[^.]*)?$", 1).alias("taxon"),
        F.filter(F.split("value", "\n"), lambda l: F.length(F.trim(l)) > 0).alias("l"))
    line = lambda i: F.get("l", F.lit(i))
    ident = F.regexp_extract(line(2), r"percent identity:\s*([0-9.]+)", 1)
    return raw.where((F.size("l") >= 3) & (ident != "")).select(
        "taxon", F.split_part(line(0), F.lit(" "), F.lit(1)).alias("acc1"), F.split_part(line(1), F.lit(" "), F.lit(1)).alias("acc2"),
        line(0).alias("name1"), line(1).alias("name2"), ident.cast("double").alias("identity"))
