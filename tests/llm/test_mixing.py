from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest
from conftest_llm import ODD_TEXTS, make_docs  # noqa: F401

from claimscope.llm.mixing import ORACLE, mix_report, mixed, source_targets


def levels(sizes, weights=(1, 2, 3)):
    """Targets by resharing the excess round after round."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        if not free:
            return fixed
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 1, "c": 5, None: 3}, {"a": 0, "b": 10}, {"x": 7}, {"a": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(levels(sizes))


def sample(n=4000, seed=1):
    rng = random.Random(seed)
    return [(i, "w " * int(rng.paretovariate(0.9)) if rng.random() < 0.98 else None, "en", rng.choice(["a", "a", "a", "a", "b", "c", None, "z"])) for i in range(n)]


def test_words_taken_come_near_the_targets(make_docs):
    docs = make_docs(sample())
    rows = mix_report(docs).collect()
    assert len(rows) == 4000
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        assert sum(r.size for r in mine) == mine[0].source_size
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine) / 2 + 1
    assert all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mix_report(docs.repartition(7)).collect()))


def test_mixed_repeats_rows(spark, make_docs):
    docs = make_docs(sample(500))
    copies = {r.doc_id: r.copies for r in mix_report(docs).collect()}
    assert Counter(r.doc_id for r in mixed(docs).collect()) == Counter({k: v for k, v in copies.items() if v})
    clash = spark.createDataFrame([(1, "a b", "s", 1, 2)], "doc_id long, text string, source string, size int, rate int")
    assert mixed(clash).collect() == clash.collect()


def test_odd_rows(make_docs):
    rows = [(i, t, "en", None) for i, t in enumerate(ODD_TEXTS)] + [(None, "x y", "en", "q"), (None, "x y", "en", "q"), (7, "x", "en", "q"), (7, "x", "en", "q")]
    out = mix_report(make_docs(rows)).collect()
    assert len(out) == len(rows) and len({r.taken for r in out if r.doc_id == 7}) == 1
    assert mix_report(make_docs([])).collect() == [] and mixed(make_docs([])).collect() == []


def test_oracle(make_docs):
    rows = sample(1500, 3)
    docs = make_docs(rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    want = sorted(con.execute(ORACLE).fetchall())
    assert sorted(tuple(r) for r in mix_report(docs).select("doc_id", "size", "source_size", "target", "taken").collect()) == want
