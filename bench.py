"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: tables to read (default /root/testdata/sf0.1); BENCH_CPUS: local cores.
Every query runs in full into the no-op sink, so the time holds no fetch to the driver. The tables are
first stored with as many parts as there are cores, outside the timing: given as one row group each, a
table is one task, and its expansion would be timed on one core.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lociweave.catalog import inputs, registry  # noqa: E402
from lociweave.operators import spectra  # noqa: E402
from lociweave.session import build_session  # noqa: E402

HEADLINE = [
    "tri_spectrum", "tri_spectrum_low_error", "di_spectrum", "substitution_ratio", "substitution_sites", "coding_split",
    "cut_features", "join3", "merge_intervals", "overlap_join", "overlap_count", "close_groups", "junctions", "intron_table",
    "fusions_te_gene",
]


def run(query) -> float:
    """Seconds of a query from building it (checkpoints run then) to its last row."""
    start = time.time()
    query().write.format("noop").mode("overwrite").save()
    return round(time.time() - start, 3)


def dealt(spark, sf_dir: str, parts: int) -> str:
    """The tables of a folder in a new one, each in `parts` files."""
    folder = tempfile.mkdtemp(prefix="spark-bench-")
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            spark.read.parquet(f"{sf_dir}/{name}").repartition(parts).write.parquet(f"{folder}/{name}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    given, sf_dir = sf_dir, dealt(spark, sf_dir, int(cpus))
    run(lambda: queries["tri_spectrum"](spark, sf_dir))  # warm the JVM once
    times = {name: run(lambda: queries[name](spark, sf_dir)) for name in HEADLINE}
    stored = tempfile.mkdtemp(prefix="spark-") + "/aln3"
    inputs.load(spark, sf_dir, "aln3").write.parquet(stored)
    times["tri_spectrum_stored"] = run(lambda: spectra.tri_spectrum(spark.read.parquet(stored), ["trio"]))
    columns = inputs.load(spark, sf_dir, "aln3").selectExpr("sum(length(seq_a))").head()[0]
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times[q] for q in HEADLINE), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(given.rstrip("/")).removeprefix("sf"), "alignment_columns": columns,
        "tri_spectrum_columns_per_sec": round(columns / times["tri_spectrum"])}))
    spark.stop()


if __name__ == "__main__":
    main()
