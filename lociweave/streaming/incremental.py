"""Spectra over a growing folder of alignments: finished files are not read again.

An optional extra on top of the batch operators. Each run takes the files that have
appeared since the last one; raw spectra are additive, so batches are kept apart and
summed on read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def update_spectra(spark: SparkSession, folder: str, table: str, checkpoint: str, to_blocks: Callable[[DataFrame], DataFrame],
                   spectrum: Callable[[DataFrame], DataFrame], schema: str) -> None:
    """Read new parquet block files in `folder`, add their counts under `table`.

    A batch that is retried after a failure overwrites its own folder, so counts are
    never added twice.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        spectrum(to_blocks(batch)).write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    stream = spark.readStream.schema(schema).parquet(folder)
    query = (stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def current_spectra(spark: SparkSession, table: str, keys: list[str]) -> DataFrame:
    """Counts summed over all batches."""
    return spark.read.parquet(table).groupBy(*keys, "species", "mutType").agg(
        F.sum("mutNum").alias("mutNum"), F.sum("totalRootNum").alias("totalRootNum"))
