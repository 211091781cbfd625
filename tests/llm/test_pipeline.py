import corpus_pipeline
import __spark_entry__ as entry
from tilewright.llm import order_minhash, quality_rules, secret_scan
from tests.llm.test_filters import brute

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdicts = {r["doc_id"]: r["kept"] for r in quality_rules.quality_verdicts(docs, ["doc_id"]).collect()}
    good = corpus_pipeline.quality(spark, docs, SF)
    assert good.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert {i for i, _ in rows} == {i for i, k in verdicts.items() if k}
    one = corpus_pipeline.near_dedup(spark, good, SF)
    classes = brute(rows, order_minhash.Near())
    assert {r["doc_id"] for r in one.collect()} == {i for i, c in classes.items() if i == c}
    clean = corpus_pipeline.secrets(spark, one, SF)
    assert clean.columns == docs.columns
    texts = dict(rows)
    for r in clean.collect():
        assert r["text"] == secret_scan.redact(texts[r["doc_id"]], secret_scan.all_spans(texts[r["doc_id"]]))
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()}
    assert packed == {i for i, c in classes.items() if i == c}


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
