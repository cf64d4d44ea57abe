from __future__ import annotations

from collections import Counter

from foliant.llm.decontam import leaks


def test_stages_keep_what_they_should(spark, sf_dir):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["toxicity", "line dedup", "MinHash near-dedup", "benchmark decontamination", "best-fit packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    n = docs.count()
    kept = cp.toxicity(spark, docs, sf_dir)
    assert kept.columns == columns and 0 < kept.count() <= n
    lines = cp.line_dedup(spark, kept, sf_dir)
    assert lines.columns == columns and lines.count() == kept.count()
    assert lines.where("n_chars != length(text)").count() == 0
    near = cp.near_dedup(spark, lines, sf_dir)
    clean = cp.decontamination(spark, near, sf_dir)
    assert near.columns == columns and clean.columns == columns and clean.count() < near.count() <= lines.count()
    assert leaks(clean, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).count() == 0
    packed = cp.packing(spark, clean, sf_dir)
    assert packed.select("doc_id").distinct().count() == clean.count()


def test_run_gives_the_last_stage(spark, sf_dir):
    import corpus_pipeline as cp

    out = cp.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_stages_leave_little_in_the_python_workers(spark, sf_dir):
    import corpus_pipeline as cp
    from foliant.llm.common import process_memory
    from foliant.llm.packing import _placed

    process_memory("word ids of an earlier stage")["encode"] = len
    assert list(_placed(iter([]), {})) == [] and not process_memory("word ids of an earlier stage")
    kept = cp.toxicity(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    assert "MapInArrow" not in kept._jdf.queryExecution().executedPlan().toString()  # staged in bounded batches


def test_toxicity_takes_little_memory(spark, monkeypatch):
    from pyspark import SparkContext

    from foliant.llm import toxicity as tox

    docs = spark.sql("SELECT id AS doc_id, concat('good words and dumbfool', id % 7) AS text FROM range(60)")
    labels = spark.sql("SELECT id AS doc_id, int(id % 2) AS toxic FROM range(60)")
    monkeypatch.setattr(SparkContext, "parallelize", None)  # it starts Python workers besides those of the scores
    assert tox.train(docs, labels).landmarks
    kernel, texts = tox.Kernel(["dumb", "fool"]), [{f"dumb{i}", f"fool{i % 9}", f"word{i}"} for i in range(400)]
    whole = tox.pooled(kernel, texts, {})
    monkeypatch.setattr(tox, "KNOWN", 60)
    known: dict = {}
    parts = []
    for at in range(0, 400, 10):
        parts += list(tox.pooled(kernel, texts[at : at + 10], known))
        assert len(known) <= 60 + 30
    assert abs(whole - parts).max() < 1e-6
    # Strings that hold a letter group of one row only aren't counted.
    counted: list[int] = []
    monkeypatch.setattr(tox, "Counter", lambda *a: counted.append(len(c := Counter(*a))) or c)
    rare = [{f"abcd{chr(97 + i)}{chr(98 + i)}{chr(99 + i)}wxyz"} for i in range(12)]
    assert tox.choose_landmarks(rare, [{"plain"}] * 40, 4) and counted[1] <= 10
