"""Reading text records where they lie: what a task can finish inside its split of a file stays there.

Spark hands a task the lines of its split in order. A reader keeps its state from line to line (`mapInArrow`), finishes all records that lie inside the split,
and hands on only what hangs over the edges: a few lines, or a few numbers, for each split. Files are opened by Spark alone, so any store it reads will do.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Bits of a block id that tell places within a file apart (8 TB); the rest numbers the files.
PLACE_BITS = 43


def split_lines(spark: SparkSession, path, sep: str | None = None) -> DataFrame:
    """value, file, at: lines (or texts between marks `sep`) with the split they were read from."""
    reader = spark.read.option("lineSep", sep) if sep else spark.read
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))


def by_split(batches: Iterator[pa.RecordBatch], column: str = "value") -> Iterator[tuple[tuple[str, int], Iterator[list]]]:
    """((file, at), its values in lists) for each run of rows from one split; rows of a task come split after split."""
    def parts() -> Iterator[tuple[tuple[str, int], list]]:
        for batch in batches:
            files, places, values = (batch.column(c).to_pylist() for c in ("file", "at", column))
            start = 0
            for i in range(1, len(values) + 1):
                if i == len(values) or (files[i], places[i]) != (files[start], places[start]):
                    yield (files[start], places[start]), values[start:i]
                    start = i

    some = parts()
    ahead = next(some, None)
    while ahead is not None:
        key = ahead[0]

        def own() -> Iterator[list]:
            nonlocal ahead
            while ahead is not None and ahead[0] == key:
                values = ahead[1]
                ahead = next(some, None)
                yield values

        values = own()
        yield key, values
        for _ in values:  # what the caller left
            pass


def _plain(path: str) -> str:
    """One spelling of a path: Spark lists some with escapes and with three slashes."""
    return re.sub("^([a-z]+):/+", r"\1:/", unquote(path))


def place_ids(rows: DataFrame, files: list[str], name: str = "block_id") -> DataFrame:
    """Numbers rows (value, file, at) by where they lie: the file's place in the sorted list, then split start and place in the split.

    Depends on the files and the session's split size only, not on how splits are dealt to tasks. `files` are the paths as Spark lists them.
    A row needs at least four bytes of its file, so that the numbers of one split end before the next one's.
    """
    spark = rows.sparkSession
    if len(files) >= 1 << 63 - PLACE_BITS:
        raise ValueError("too many files for one numbering")
    order = spark.sparkContext.broadcast({f: k for k, f in enumerate(sorted(set(map(_plain, files))))})  # at most 2^20 paths
    kept = [c for c in rows.columns if c not in ("file", "at")]
    schema = f"{name} bigint, {', '.join(f'`{c}` {t}' for c, t in rows.select(*kept).dtypes)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, n = None, 0
        for batch in batches:
            ids = []
            for key in zip(batch.column("file").to_pylist(), batch.column("at").to_pylist()):
                if key != current:
                    current, n = key, (order.value[_plain(key[0])] << PLACE_BITS) + key[1]
                ids.append(n)
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(batch.column(c) for c in kept)], [name, *kept])

    return rows.mapInArrow(run, schema)


def mapped(lines: DataFrame, step: Callable[[tuple[str, int], Iterator[list]], Iterator[tuple]], schema: str, types: list[pa.DataType], rows: int = 4096) -> DataFrame:
    """Rows that `step` makes of each split's lines."""
    names = [f.strip().split()[0] for f in schema.replace("array<string>", "array").split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def taken() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for key, values in by_split(batches):
            for row in step(key, values):
                out.append(row)
                if len(out) >= rows:
                    yield taken()
        if out:
            yield taken()

    return lines.mapInArrow(run, schema)
