"""The pipeline's stages, each on what its predecessor kept."""

import re

import corpus_pipeline
from delaywright.llm import packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark, sf_dir, tmp_path):
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "substring_dedup", "secrets", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == COLUMNS
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    gone = {r.doc_id for r in before.collect()} - set(kept["toxicity"])
    assert gone and sum(labels.get(i) == 0 for i in gone) <= 0.05 * len(gone)
    assert set(kept["near_dedup"]) < set(kept["toxicity"])
    texts = [" ".join(r.text.split()).lower() for r in kept["near_dedup"].values() if len(r.text.split()) > 5]
    assert len(texts) == len(set(texts))
    assert set(kept["substring_dedup"]) == set(kept["near_dedup"]) == set(kept["secrets"])
    seen = set()
    for i in sorted(kept["substring_dedup"]):
        words = kept["near_dedup"][i].text.split()
        windows = {tuple(words[k : k + 13]) for k in range(len(words) - 12)}
        if kept["substring_dedup"][i].text != kept["near_dedup"][i].text:
            assert windows & seen
        else:
            assert not windows & seen
        seen |= windows
    assert not any(re.search(r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}", r.text) for r in kept["secrets"].values())
    assert all(len(r.text) == r.n_chars for i, r in kept["secrets"].items() if r.text != kept["near_dedup"][i].text)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {p.doc_id for p in pieces} == set(kept["secrets"])
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())
    assert all(p.offset + p.length <= packing.WINDOW for p in pieces)
