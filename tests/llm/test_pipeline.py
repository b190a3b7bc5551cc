"""The stages one after the other against plain versions of their decisions."""

import re

import corpus_pipeline
import test_minhash
import test_secrets
from pyspark.sql import functions as F

from formflow.llm import quality
from formflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "MinHash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept[-1], SF)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(i)))
        kept.append(spark.read.parquet(str(tmp_path / str(i))))
    raw, good, single, clean, masked, packed = ([r.asDict() for r in k.collect()] for k in kept)
    judged = quality.judge_documents(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r["doc_id"] for r in good} == {r.doc_id for r in judged.where("kept").collect()}
    good.sort(key=lambda r: r["doc_id"])
    _, component = test_minhash.brute([r["text"] for r in good], 5)
    assert {r["doc_id"] for r in single} == {good[i]["doc_id"] for i in set(component)}
    tokens = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    runs = {tuple(w[k : k + 12]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for w in [tokens(r.text)] for k in range(len(w) - 11)}
    leak = lambda t: any(tuple(w[k : k + 12]) in runs for w in [tokens(t)] for k in range(len(w) - 11))
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in single if not leak(r["text"])}
    texts = {r["doc_id"]: r["text"] for r in masked}
    assert texts.keys() == {r["doc_id"] for r in clean}
    for r in clean:
        want = list(r["text"])
        for a, _, b in test_secrets.base(r["text"]):
            want[a:b] = "*" * (b - a)
        assert texts[r["doc_id"]] == "".join(want)
    pieces = {}
    for r in packed:
        pieces.setdefault(r["doc_id"], set()).add(r["piece"])
    assert pieces.keys() == texts.keys() and all(p == set(range(len(p))) for p in pieces.values())


def test_run_equals_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.where(F.col("length") > 4096).isEmpty() and out.count() > 0
