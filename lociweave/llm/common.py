"""Helpers of the text operators: tables, lineage cuts, Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage as cut  # noqa: F401

HELD_OUT_REMAINDER = 1
#: Binary logarithm of the bits of a bit map: 2 MB, whatever the data.
BITS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 1 when divided by 3. A null id isn't one."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == HELD_OUT_REMAINDER, F.lit(False))


_kept: dict = {}
_asked: list = []


def kept(key: str, build: Callable[[], object]) -> object:
    """What a Python worker keeps for later tasks of one operator: one thing at a time. To be asked for where a task's state is made."""
    _asked.append(key)
    if key not in _kept:
        _kept.clear()
        _kept[key] = build()
    return _kept[key]


def begun(make: Callable[[], Callable]) -> Callable:
    """A task's state. A worker serves the tasks of many operators: what another one kept goes, so that memory doesn't add up."""
    _asked.clear()
    step = make()
    if not _asked:
        _kept.clear()
    return step


def let_go() -> None:
    """Gives a worker's free memory back: workers stay for later tasks, and several of them share an executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library on Linux
    if trim is not None:
        trim(0)


#: Bytes that an operator which works row by row takes of a batch at a time, about; what it makes of them is often several times as large.
AT_ONCE = 1 << 22


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about `size` bytes."""
    rows = max(1, batch.num_rows * size // max(batch.nbytes, size))
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], schema: str | StructType,
                at_once: int | None = None) -> DataFrame:
    """mapInArrow with state made once for each task; with `at_once`, batches come in slices of about that many bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = begun(make)
        for batch in batches:
            large = batch.nbytes > AT_ONCE
            for part in slices(batch, at_once or max(batch.nbytes, 1)):
                yield from step(part)
            batch = part = None  # gone before the next one is read
            if large:
                let_go()
        step = None
        let_go()
    return df.mapInArrow(run, schema)


def extended(df: DataFrame, keep: tuple[str, ...], ddl: str) -> StructType:
    """The columns `keep` of a table, and more."""
    return StructType([*df.select(*keep).schema.fields, *StructType.fromDDL(ddl).fields])


def shuffle_width(spark: SparkSession) -> int:
    """Partitions that a shuffle of the session has; it is set in proportion to the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bit_map(hashes: DataFrame, column: str) -> np.ndarray:
    """2^BITS bits, set at the highest bits of the 64-bit hashes. Its size is fixed, however many rows there are."""
    place = F.shiftrightunsigned(column, 64 - BITS)
    maps = hashes.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m")).collect()
    bits = np.zeros(1 << BITS - 3, np.uint8)
    for r in maps:  # bucket numbers start at 1 for positive places; place 0 is in bucket 0
        first = (r["b"] - 1) * 32768 + 1 if r["b"] > 0 else 0
        at = first + np.flatnonzero(np.unpackbits(np.frombuffer(bytes(r["m"]), np.uint8), bitorder="little"))
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return bits
