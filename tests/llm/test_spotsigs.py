from __future__ import annotations

import base64
import hashlib
import random
import re

import numpy as np
import pytest
from conftest_llm import ODD_TEXTS, make_docs  # noqa: F401

from claimscope.llm.spotsigs import ANCHORS, CHAIN, edited, encoded, fingerprint_documents, fingerprints, length_class, likeness


def spots(text):
    """Anchor and chain of each spot, as word tuples."""
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text or "")]
    stop = set(ANCHORS.split())
    places = [i for i, w in enumerate(words) if w in stop] or range(len(words))
    return {(words[i], *[w for w in words[i + 1 :] if w not in stop][:CHAIN]) for i in places} or ({(text,)} if text else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        e = edited(t, following)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), len(spots(t)), len(spots(e)), jaccard(spots(t), spots(e)), jaccard(spots(t), spots(following))))
    return out


def got(df):
    count = lambda f: len(base64.b64decode(f)) // 4
    return [(r.doc_id, r.n_chars, r.edited_sha256, count(r.fingerprint), count(r.edited_fingerprint), r.near_edited, r.near_next) for r in df.collect()]


def same(a, b):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:3])
    a, b = sorted(a, key=key), sorted(b, key=key)
    assert [r[:5] for r in a] == [r[:5] for r in b]
    assert [x for r in a for x in r[5:]] == pytest.approx([x for r in b for x in r[5:]], abs=1e-9)


def test_against_brute_force(make_docs):
    rng = random.Random(4)
    vocabulary = ["the", "Of", "und", "à", "house", "Éa", "ox", "run.", "x-ray", "zwölf", "nine9"]
    rows = [(3 * i - 40, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 50)))) for i in range(150)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD_TEXTS[:-2])] + [(None, "the last one"), (None, None), (5, "b"), (5, "a")]
    rng.shuffle(rows)
    rows = [(i, t) for i, t in rows if not (t and "\x00" in t)]
    same(got(fingerprint_documents(make_docs(rows).repartition(5))), brute(rows))


def test_smoke_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same(got(fingerprint_documents(docs)), brute([(r.doc_id, r.text) for r in docs.collect()]))


@pytest.mark.parametrize("rows", [[(1, "the only one here")], [(1, "the a b c"), (2, "the d e f")], [(7, None)]])
def test_few_rows(make_docs, rows):
    same(got(fingerprint_documents(make_docs(rows))), brute(rows))


def test_equal_texts_have_equal_fingerprints(make_docs):
    texts = [*ODD_TEXTS, "!!", "??", "The end of it"]
    out = fingerprint_documents(make_docs([(2 * i + k, t) for i, t in enumerate(texts) for k in (0, 1)])).collect()
    assert all(r.near_next == 1 for r in out if r.doc_id % 2 == 0)
    assert len({r.fingerprint for r in out}) == len({t or "" for t in texts})
    assert fingerprint_documents(make_docs([])).collect() == []


def test_pruning_keeps_likely_pairs():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = np.unique(rng.integers(0, 60, rng.integers(1, 60)).astype(np.uint32))
        b = np.unique(rng.integers(0, 60, rng.integers(1, 60)).astype(np.uint32))
        exact = jaccard(set(a.tolist()), set(b.tolist()))
        assert likeness(a, b) == exact and likeness(a, b, 0.5) == (exact if exact >= 0.5 else 0)
        if exact >= 0.8:
            assert abs(length_class(len(a), 0.8) - length_class(len(b), 0.8)) <= 1
    assert encoded(fingerprints(["the cat sat"])[0]) == encoded(fingerprints(["The  cat, sat!"])[0])
