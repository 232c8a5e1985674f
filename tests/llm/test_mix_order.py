"""Operator 6 as a query goes through the training order itself."""

from pyspark.sql import functions as F

from sitelens.llm import mixing, queries


def test_documents_come_from_the_training_order(spark, make, monkeypatch, tmp_path):
    """Repeated, null and empty rows, several passes: what a document's copies
    take in the sorted order is what the query returns."""
    rows = [(i % 9 if i % 7 else None, "w " * (i % 5), ("a", "b", None)[i % 3] if i < 40 else "c") for i in range(60)]
    make(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    seen, real = [], mixing.training_order
    monkeypatch.setattr(mixing, "training_order", lambda plan: seen.append(real(plan)) or seen[-1])
    got = queries.REGISTRY["op6_curriculum_mix"][0](spark, str(tmp_path)).collect()
    assert len(seen) == 1 and len(got) == len(rows)
    order = seen[0].collect()
    assert [r["position"] for r in order] == sorted(r["position"] for r in order) and {r["pass"] for r in order} >= {0, 1}
    assert sum(r["taken"] for r in got) == sum(r["words"] for r in order)
    plan = mixing.schedule(spark.read.parquet(f"{tmp_path}/documents.parquet")).select(
        "key", "size", "source_size", F.round("target", 6), "taken",
        F.round(F.when(F.col("taken") > 0, mixing.position(F.col("before"), F.col("target"), F.col("slope"))), 6))
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, plan.collect()), key=str)
