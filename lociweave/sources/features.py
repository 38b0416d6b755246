"""Annotation files. Coordinates become 0-based half open here and nowhere else."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

def after_equals(item: Column) -> Column:
    """The text after the first `=`."""
    return F.substr(item, F.locate("=", item) + 1)


def parse_attributes(text: str | Column) -> Column:
    """`k=v;k=v` -> map; of a repeated key the last value stays."""
    c = F.col(text) if isinstance(text, str) else text
    items = F.filter(F.transform(F.split(c, ";"), lambda p: F.trim(p)), lambda p: p.contains("="))
    pairs = F.transform(items, lambda p: F.struct(F.split_part(p, F.lit("="), F.lit(1)).alias("key"), after_equals(p).alias("value")))
    # as a lambda's variable the pairs are made once, not again for each of them
    last = F.transform(F.array(pairs), lambda all_: F.filter(
        all_, lambda p, i: ~F.exists(F.slice(all_, i + 2, F.size(all_)), lambda q: q["key"] == p["key"])))
    return F.map_from_entries(F.get(last, F.lit(0)))


def read_gff(spark: SparkSession, path, types: Sequence[str] | None = None) -> DataFrame:
    return parse_gff(spark.read.text(path), types)


def parse_gff(lines: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """chr, start, end, strand, type, source, phase, attrs MAP of `value` rows; an empty or inverted range is an error."""
    f = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    text = lines.where(~F.col("value").startswith("#")).select(f.alias("f")).where(F.size("f") >= 3)
    at = lambda i: F.nullif(F.get("f", F.lit(i)), F.lit(""))
    rows = text.select(at(0).alias("chr"), at(1).alias("source"), at(2).alias("type"), at(3).cast("bigint").alias("start"), at(4).cast("bigint").alias("end"),
                       at(6).alias("strand"), at(7).alias("phase"), F.coalesce(at(8), F.lit("")).alias("attributes")).where("type is not null")
    if types:
        rows = rows.where(F.col("type").isin(*types))
    begin = F.when(F.col("start") - 1 < F.col("end"), F.col("start") - 1).otherwise(
        F.raise_error(F.concat(F.lit("bad range: "), F.concat_ws(" ", "chr", "start", "end"))).cast("bigint"))
    return rows.select("chr", begin.alias("start"), "end", "strand", "type", "source", "phase",
                       parse_attributes("attributes").alias("attrs"))


def with_attributes(features: DataFrame, *names: str) -> DataFrame:
    """Attribute map entries as columns."""
    return features.select("*", *[F.col("attrs")[n].alias(n) for n in names])


def read_repeatmasker(spark: SparkSession, path, base: int = 0) -> DataFrame:
    return parse_repeatmasker(spark.read.text(path), base)


def parse_repeatmasker(lines: DataFrame, base: int = 0) -> DataFrame:
    """chr, start, end, strand, name, class. base=1 turns 1-based starts into 0-based ones."""
    if base not in (0, 1):
        raise ValueError("base is 0 or 1")
    f = lines.select(F.split(F.trim(F.regexp_replace("value", r"\s+$", "")), r"\s+").alias("f")).where(
        (F.size("f") >= 11) & F.get("f", F.lit(0)).rlike(r"^\d+$"))
    at = lambda i: F.get("f", F.lit(i))
    return f.select(at(4).alias("chr"), (at(5).cast("bigint") - base).alias("start"), at(6).cast("bigint").alias("end"),
                    F.when(at(8) == "C", F.lit("-")).otherwise(at(8)).alias("strand"), at(9).alias("name"), at(10).alias("class"))


def read_tandem_repeats(spark: SparkSession, path) -> DataFrame:
    return parse_tandem_repeats(spark.read.text(path))


def parse_tandem_repeats(lines: DataFrame) -> DataFrame:
    """chr, start, end, and the remaining fields as one array."""
    f = lines.select(F.split(F.regexp_replace("value", "\r$", ""), "\t").alias("f")).where((F.size("f") >= 3) & ~F.get("f", F.lit(0)).startswith("#"))
    return f.select(F.get("f", F.lit(0)).alias("chr"), F.get("f", F.lit(1)).cast("bigint").alias("start"),
                    F.get("f", F.lit(2)).cast("bigint").alias("end"), F.slice("f", 4, F.size("f")).alias("rest"))
