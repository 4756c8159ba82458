from __future__ import annotations

import zlib

import corpus_pipeline
import numpy as np
import pytest

from claimscope.llm import jaccard_join, mixing, substring_dedup
from claimscope.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage of one run gets, and the last one's result."""
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        kept.append(docs)
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*kept, docs]


def test_stages_keep_the_columns(stages):
    assert [df.columns for df in stages[:-1]] == [list(corpus_pipeline.COLUMNS)] * 5
    assert len(corpus_pipeline.STAGES) == 5 and all(df.count() for df in stages)


def test_classifier_keeps_good_documents(spark, stages):
    kept = {r.doc_id for r in stages[1].collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    assert np.mean([(i in kept) == bool(q) for i, q in labels]) >= 0.9


def test_one_of_each_component_and_no_repeats_stay(stages):
    left = jaccard_join.join_components(stages[2]).collect()
    assert all(r.component_id == r.doc_id for r in left) and len(left) <= stages[1].count()
    spans = {r.doc_id: r.n_removed for r in substring_dedup.dedup_digest(stages[2]).collect()}
    for r in stages[3].collect():
        before = next(x for x in stages[2].where(f"doc_id = {r.doc_id}").collect()) if spans[r.doc_id] else None
        if before:
            assert len(r.text.split()) < len(before.text.split()) and r.n_chars == len(r.text)


def test_mix_and_packs(stages):
    copies = {r.doc_id: r.copies for r in mixing.mix_report(stages[3]).collect()}
    assert stages[4].count() == sum(copies.values())
    encode = Encoder()
    ids = sorted(zlib.crc32(encode(r.text).astype("<u4").tobytes()) for r in stages[4].collect())
    pieces = stages[5].collect()
    assert sum(r.length for r in pieces) == sum(len(encode(r.text)) for r in stages[4].collect())
    assert {r.ids_crc32 for r in pieces if r.length == r.doc_tokens} <= set(ids)


def test_run_gives_the_last_stage(spark, stages):
    assert corpus_pipeline.run(spark, SF).agg({"length": "sum"}).first() == stages[5].agg({"length": "sum"}).first()
