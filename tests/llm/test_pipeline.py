"""The pipeline's stages against brute force, stage by stage, on a driver table."""

from __future__ import annotations

import corpus_pipeline
from kerbstone.llm.common import documents
from test_llm import bench_words, shingles, without_earlier

SF_DIR = "/root/testdata/sf0.001"


def test_each_stage_on_what_the_one_before_kept(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = documents(spark, SF_DIR)
    columns = docs.columns
    given = {r["doc_id"]: r["text"] for r in docs.collect()}

    known = stages["language"](spark, docs, SF_DIR)
    assert known.columns == columns and known.count() == len(given)  # all are in known languages

    unique = stages["near_duplicates"](spark, known, SF_DIR)
    kept = {r["doc_id"]: r["text"] for r in unique.collect()}
    sets = {i: shingles(t) for i, t in given.items()}
    for i, s in sets.items():
        alike = [j for j in kept if j <= i and s and 100 * len(s & sets[j]) >= 80 * len(s | sets[j])]
        assert (i in kept) or min(kept) <= i
        if i in kept:
            assert [j for j in alike if j != i] == []

    cut = stages["repeated_passages"](spark, unique, SF_DIR)
    expected = {i: e[3].decode("utf-8", "ignore") for i, e in without_earlier(sorted(kept.items())).items()}
    rest = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert cut.columns == columns
    assert rest == {i: t for i, t in expected.items() if t.split()}

    clean = stages["benchmark_free"](spark, cut, SF_DIR)
    items = [bench_words(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    left = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == columns
    for i, text in rest.items():
        words, hit = bench_words(text), set()
        for w in items:
            n = min(13, len(w))
            windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
            hit |= {p for k in range(len(words) - n + 1) if tuple(words[k : k + n]) in windows for p in range(k, k + n)}
        assert (i in left) == (not (hit and 20 * len(hit) >= len(words))), i

    mixed = stages["mixed"](spark, clean, SF_DIR).collect()
    assert {r["doc_id"] for r in mixed} == left
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, mixed))
