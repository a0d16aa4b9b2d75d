"""The pipeline against a chain of plain decisions, and on odd tables."""

from collections import Counter

import corpus_pipeline
from corpus_fixtures import write_tables

from palate.llm import bpe, quality_rules, simhash

FOLDER = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], FOLDER).write.parquet(f"{tmp_path}/{n}")
        seen.append(spark.read.parquet(f"{tmp_path}/{n}"))
    rules, classed, single, mixed, tokens = (x.collect() for x in seen[1:])
    assert all(x.columns == columns for x in seen[1:-1])
    judged = {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}
    assert {r.doc_id for r in rules} == judged
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in classed}
    assert kept <= judged and sum(good.get(i) == 1 for i in judged - kept) <= 0.02 * len(judged)
    fps = {r.doc_id: simhash.fingerprint(r.text or "") for r in classed}
    left = {r.doc_id for r in single}
    assert left <= kept and len(left) == len(single)
    close = lambda a, b: ((fps[a] ^ fps[b]) & (2**64 - 1)).bit_count() <= 4
    assert not any(close(a, b) for a in left for b in left if a < b)
    assert all(any(close(a, b) for b in kept if b < a) for a in kept - left)
    times = Counter(r.doc_id for r in mixed)
    assert times.keys() <= left and set(times.values()) <= {1, 2}
    size = {r.doc_id: len((r.text or "").split()) for r in single}
    budget = int(1.5 * sum(size.values()))
    assert budget - max(size.values()) < sum(size[i] * n for i, n in times.items()) <= budget
    assert Counter(r.doc_id for r in tokens) == times
    codec = bpe.Codec(bpe.vocabulary())
    text = {r.doc_id: r.text for r in mixed}
    assert all(r.n_tokens * 4 == len(codec.encode([text[r.doc_id]])[0]) for r in tokens)


def test_odd_and_empty_tables(spark, odd, none, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, None), (10, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int")
    for name, docs in (("odd", odd), ("none", none)):
        folder = write_tables(spark, tmp_path / name, documents=docs, labels=labels)
        out = corpus_pipeline.run(spark, folder)
        assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert (out.count() > 0) == (name == "odd")
