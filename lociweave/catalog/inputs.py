"""Genomic inputs derived from the driver's tables.

Each input is a list of (name, expression) over one table, in SQL both engines
read, so a query and its check start from the same rows. `{g}` stands for the
"replace all" flag that one engine needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ALPHABET = "abcdefghijklmnopqrstuvwxyz ."
_BASE = "".join("acgt"[i % 4] for i in range(26)) + "t-"


def _remap(changes: dict[str, str]) -> str:
    return "".join(changes.get(letter, base) for letter, base in zip(ALPHABET, _BASE))


SEQ_A = _remap({"q": "n"})
SEQ_B = _remap({"m": "c", "l": "c", "y": "g", "v": "t", "k": "a", "j": "-", ".": "g", "q": "n"})
SEQ_C = _remap({"u": "t", "o": "a", "w": "a", "v": "t", "k": "t", "b": "-", "z": "n", "q": "n"})
ERR_1 = "".join({"z": "3", "j": "2", "x": "4", " ": "5"}.get(c, "8") for c in ALPHABET)
ERR_2 = "".join({"k": "4", "w": "0"}.get(c, "9") for c in ALPHABET)

CLEAN = "lower(regexp_replace(text, '[^A-Za-z .]+', ' '{g}))"


def _tr(to: str) -> str:
    return f"translate(clean, '{ALPHABET}', '{to}')"


# name -> (table, prepared columns, final columns, row condition)
_INPUTS: dict[str, tuple[str, list[tuple[str, str]], list[tuple[str, str]], str]] = {
    # three-way alignment blocks: A forward, B and C on either strand
    "aln3": (
        "documents",
        [("doc_id", "doc_id"), ("lang", "lang"), ("source", "source"), ("clean", CLEAN)],
        [("block_id", "doc_id"), ("trio", "lang"),
         ("chr_a", "source"), ("start_a", "doc_id * 200000"), ("strand_a", "'+'"), ("len_a", "100000000000"), ("seq_a", _tr(SEQ_A)),
         ("chr_b", "'b_' || lang"), ("start_b", "doc_id * 200000 + 7"),
         ("strand_b", "case when doc_id % 2 = 0 then '+' else '-' end"), ("len_b", "200000000000"), ("seq_b", _tr(SEQ_B)),
         ("chr_c", "'c_' || source"), ("start_c", "doc_id * 200000 + 11"),
         ("strand_c", "case when doc_id % 3 = 0 then '-' else '+' end"), ("len_c", "300000000000"), ("seq_c", _tr(SEQ_C)),
         ("p1", _tr(ERR_1)), ("p2", _tr(ERR_2))],
        "",
    ),
}


def register(name: str, table: str, final: list[tuple[str, str]], prepared: list[tuple[str, str]] | None = None,
             where: str = "") -> None:
    _INPUTS[name] = (table, prepared or [], final, where)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, prepared, final, where = _INPUTS[name]
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if prepared:
        df = df.selectExpr(*[f"{e.replace('{g}', '')} as {n}" for n, e in prepared])
    if where:
        df = df.where(where)
    return df.selectExpr(*[f"{e.replace('{g}', '')} as {n.strip(chr(34))}" for n, e in final])


def cte(*names: str) -> str:
    """`a as (select ...), b as (select ...)` for the check engine."""
    parts = []
    for name in names:
        table, prepared, final, where = _INPUTS[name]
        src = table
        if prepared:
            inner = ", ".join(f"{e.replace('{g}', ', ' + chr(39) + 'g' + chr(39))} as {n}" for n, e in prepared)
            src = f"(select {inner} from {table})"
        body = ", ".join(f"{e.replace('{g}', ', ' + chr(39) + 'g' + chr(39))} as {n}" for n, e in final)
        parts.append(f"{name} as materialized (select {body} from {src} t{' where ' + where if where else ''})")
    return ",\n".join(parts)
