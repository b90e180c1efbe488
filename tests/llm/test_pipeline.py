"""The pipeline's stages, each against its operator's brute force on what the stage before kept."""

import hashlib

import pytest

import corpus_pipeline
from tests.llm import test_line_dedup, test_near_duplicates, test_quality
from vectable.llm.quality import quality
from vectable.sources.tables import settle


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], sf_dir)))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_dedup", "decontamination", "byte_bpe"]
    for before, after in zip(stages, stages[1:-1]):
        assert after.columns == before.columns and after.dtypes == before.dtypes
        assert after.count() <= before.count()


def test_quality_stage(stages):
    kept = {r["doc_id"] for r in quality(stages[0]).filter("kept").collect()}
    assert texts(stages[1]) == {k: t for k, t in texts(stages[0]).items() if k in kept}
    assert not any(test_quality.plain(t)[-1] for t in texts(stages[1]).values())


def test_line_stage(stages):
    before, after = texts(stages[1]), texts(stages[2])
    left = [(k, after.get(k, "")) for k in before]  # a document that lost all its lines is gone
    hit, want, wrong = test_line_dedup.measure(list(before.items()), left)
    assert want > 0 and hit >= 0.97 * want and wrong == 0
    assert all(t.strip() or t == before[k] for k, t in after.items())
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_simhash_stage(stages):
    found = test_near_duplicates.plain_classes(list(texts(stages[2]).items()))
    assert set(texts(stages[3])) == {int(k) for k, _, first in found if k == first}


def test_decontamination_stage(spark, sf_dir, stages):
    before, after = texts(stages[3]), texts(stages[4])
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for k, t in before.items():
        leaked = any(f" {i} " in f" {' '.join(t.lower().split())} " for i in items)
        assert not (leaked and k in after)
    assert len(after) > 0.9 * len(before)


def test_last_stage_and_run(spark, sf_dir, stages):
    want = {k: hashlib.sha256(t.encode()).hexdigest() for k, t in texts(stages[4]).items()}
    assert {r["doc_id"]: r["decoded_sha256"] for r in stages[5].collect()} == want
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()} == set(want)


def test_empty_documents(spark, sf_dir, stages):
    docs = stages[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
