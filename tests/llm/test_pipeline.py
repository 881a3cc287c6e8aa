from collections import Counter

import corpus_pipeline as pipeline
from pyspark.sql import functions as F
from quarry.llm import labels, mixing, toxicity

from . import brute

SF = "/root/testdata/sf0.001"


def test_stages_and_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact dedup", "n-gram Jaccard join", "mixing sources", "byte-level BPE"]
    kept = stages["toxicity"](spark, docs, SF)
    assert kept.schema == docs.schema
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, lab, labels.fold(F.col("doc_id"), 5) == 0)
    bad = {r.doc_id for r in toxicity.score(docs, model).where("score >= 0.5").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in bad]
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in rows)
    keep = {i for i, k, _, _ in brute.exact(rows) if i == k}
    rows = [r for r in rows if r[0] in keep]
    near = {i for i, _, c in brute.jaccard(rows) if i == c}
    rows = [r for r in rows if r[0] in near]
    left = docs.where(F.col("doc_id").isin([i for i, _ in rows]))
    copies = {r.doc_id: (2 * r.taken + r.size) // (2 * r.size) if r.size else 0 for r in mixing.mix(left).collect()}
    out = pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in out) == Counter({i: n for i, n in copies.items() if n})
    text = dict(rows)
    assert all(r.decoded_sha256 == brute.sha(text[r.doc_id]) for r in out)


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_take_odd_rows(spark, docs):
    """Nulls, repeated rows and clashing columns go through every stage."""
    out = docs
    for name, stage in pipeline.STAGES:
        out = stage(spark, out, SF)
        if name != "byte-level BPE":
            assert out.columns == docs.columns
    assert out.count() > 0
