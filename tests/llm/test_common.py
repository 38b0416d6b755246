"""What a Python worker keeps from task to task."""

import public_tokenizers
import pyarrow as pa

import corpus_pipeline
from lociweave.llm import bpe, common, minmax


class Shared:
    value = (bpe.read_ranks(str(public_tokenizers.path("byte_bpe_50k.tiktoken"))), public_tokenizers.PATTERN, "v")


def test_a_worker_keeps_the_state_of_one_operator():
    made = []
    task = lambda: made.append(bpe._codec(Shared)) or (lambda batch: [])
    common.begun(task), common.begun(task)
    assert made[0] is made[1] and list(common._kept) == ["v"]
    common.begun(lambda: lambda batch: [])  # a task of an operator that keeps nothing
    assert not common._kept
    common.begun(task), common.begun(lambda: common.kept("w", dict))
    assert made[2] is not made[0] and list(common._kept) == ["w"]
    common._kept.clear()


def test_operators_on_rows_take_a_batch_in_slices():
    """What an operator makes of a slice is in memory at a time, not what it makes of a batch."""
    texts = ["word " * (k % 7 * 20_000) for k in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array(texts)], ["doc_id", "_text"])
    parts = list(common.slices(batch, 1 << 20))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and len(parts) > 20
    assert [p.num_rows for p in common.slices(batch.slice(0, 0), 1 << 20)] == []
    assert len(list(common.slices(batch, batch.nbytes))) == 1


def test_signatures_are_made_of_slices(spark, monkeypatch):
    monkeypatch.setattr(minmax, "AT_ONCE", 1)
    df = spark.createDataFrame([(k, f"one two three four five {k} six") for k in range(30)], "doc_id long, text string").coalesce(1)
    got = minmax.signatures(df, 5)
    assert got.select("doc_id").distinct().count() == 30


def test_documents_that_stay_are_not_moved(spark, tmp_path):
    """Neither near_duplicates nor decontamination exchanges the texts of rows that surely stay: a bit table alone is joined to them."""
    df = spark.createDataFrame([(k, f"text number {k} of its own {k * k}", "en", "s", 9) for k in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a passage that no text holds")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.decontamination):
        out = stage(spark, docs, str(tmp_path))
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
        node = out._jdf.queryExecution().optimizedPlan()
        while node.nodeName() != "Union":
            node = node.children().head()
        assert "LeftOuter" in node.children().head().toString() and "LeftAnti" not in node.children().head().toString()


def test_a_task_gives_its_memory_back(monkeypatch):
    class Held:
        def mapInArrow(self, run, schema):
            return run

    given = []
    monkeypatch.setattr(common, "let_go", lambda: given.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2])], ["a"])
    run = common.map_batches(Held(), lambda: lambda b: [b], "a long")
    assert list(run(iter([batch, batch.slice(0, 0)]))) == [batch] and given == [1]
    assert list(run(iter([]))) == [] and given == [1, 1]
