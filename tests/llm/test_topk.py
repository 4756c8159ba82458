from __future__ import annotations

import math
import random

import pytest

from claimscope.llm.topk import search

SCHEMA = "vec_id long, embedding array<double>, label int, chunk int"


def brute(rows, k, every=20, scale=64):
    fine = [(i, [math.floor(scale * x) for x in v]) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in fine:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in fine if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("group, block, chunk", [(8192, 64, 256), (40, 4, 3), (7, 1, 1)])
def test_against_brute_force(spark, group, block, chunk):
    rng = random.Random(group)
    rows = [(rng.randrange(-300, 900) if i % 9 else i, [rng.gauss(0, 0.3) for _ in range(rng.choice([6, 6, 6, 3]))], 0, 1) for i in range(300)]
    rows = list({r[0]: r for r in rows}.values())
    rows += [(1000, rows[3][1], 0, 1), (1001, rows[3][1], 0, 1), (1020, [0.0] * 6, 0, 1), (1040, None, 0, 1), (1060, [], 0, 1), (1080, [1.0, None], 0, 1), (1100, [float("nan")] * 6, 0, 1), (1120, [1.0, float("inf")], 0, 1), (None, [1.0], 0, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(search(df, 20, group=group, block=block, chunk=chunk)) == brute(rows, 20)


def test_smoke_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert got(search(df)) == brute([(r.vec_id, r.embedding) for r in df.collect()], 20)


def test_few_rows_and_large_components(spark):
    rows = [(0, [1e7, 1e7], 0, 1), (1, [1e7, 3.1e6], 0, 1), (2, [1e7, 3.1e6 + 1 / 64], 0, 1), (20, [-1e7, 0.0], 0, 1)]
    assert got(search(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 20)
    assert search(spark.createDataFrame([], SCHEMA)).collect() == []
    assert got(search(spark.createDataFrame([(0, [1.0], 0, 1)], SCHEMA))) == []
    twice = [(20, [1.0], 0, 1), (20, [1.0], 0, 1), (3, [2.0], 0, 1)]
    assert got(search(spark.createDataFrame(twice, SCHEMA))) == [(20, 1, 3, 64 * 128)] * 2


def test_vectors_too_long_for_scores_are_refused(spark):
    with pytest.raises(Exception, match="too long for 64-bit scores"):
        search(spark.createDataFrame([(0, [1e18], 0, 1), (1, [1.0], 0, 1)], SCHEMA)).collect()
