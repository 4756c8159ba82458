from __future__ import annotations

import hashlib
import random
from collections import Counter

import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from claimscope.llm import alignment
from conftest_llm import ODD_TEXTS, make_docs  # noqa: F401

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
LETTER = {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}


def ranges(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def sides(text):
    """(ids, byte ranges) of both sides, from the libraries; none where the bytes differ."""
    whole = (" " + text).encode() if text else b""
    a, b = (A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)) if text else ([], [])
    bytes_a = [bytes(LETTER[c] for c in A.id_to_token(i)) for i in a]
    pieces = [B.id_to_piece(i) for i in b]
    bytes_b = [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        a, b, bytes_a, bytes_b = [], [], [], []
    return a, b, ranges(bytes_a), ranges(bytes_b)


def brute(rows):
    """Every pair of tokens compared."""
    made = []
    for doc_id, text in rows:
        a, b, ra, rb = sides(text)
        links = [(x, y) for x, (_, ex) in zip(a, ra, strict=True) for y, (_, ey) in zip(b, rb, strict=True) if ex == ey]
        ends = sorted({e for _, e in ra} & {e for _, e in rb})
        groups = [",".join(str(x) for x, (_, e) in zip(a, ra, strict=True) if s < e <= t) + "|" + ",".join(str(y) for y, (_, e) in zip(b, rb, strict=True) if s < e <= t) for s, t in zip([0, *ends], ends, strict=False)]
        made.append((doc_id, a, b, links, groups))
    counts = Counter(p for m in made for p in m[3])
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(
        ((d, len(a), len(b), len(g), len(k), sum(counts[p] == best[p[1]] for p in k), sum(counts[p] for p in k), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for d, a, b, k, g in made),
        key=str,
    )


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_overlaps_are_all_pairs_that_overlap():
    rng = random.Random(1)

    def side(text_lengths):
        rows = []
        for text, size in enumerate(text_lengths):
            cuts = [0, *sorted(rng.sample(range(1, size), rng.randrange(0, size - 1))), size] if size > 1 else [0, size][: size + 1]
            rows += [(text, s, e) for s, e in zip(cuts[:-1], cuts[1:], strict=True) if e > s]
        return pd.DataFrame({"text": [r[0] for r in rows], "id": 0, "start": [base[r[0]] + r[1] for r in rows], "end": [base[r[0]] + r[2] for r in rows], "token": range(len(rows))})

    lengths = [rng.randrange(1, 30) for _ in range(40)]
    base = [sum(lengths[:i]) for i in range(len(lengths))]
    a, b = side(lengths), side(lengths)
    want = [(x.token, y.token) for x in a.itertuples() for y in b.itertuples() if x.text == y.text and x.start < y.end and y.start < x.end]
    found = alignment.overlaps(a, b)
    assert list(zip(found["a"], found["b"], strict=True)) == want
    assert found["a_end"].tolist() == [a["end"][x] for x, _ in want] and found["b_end"].tolist() == [b["end"][y] for _, y in want]


def test_odd_texts_repeated_rows_and_other_columns(spark, make_docs):
    texts = [t if t is None or len(t) < 1000 else t[:3000] for t in ODD_TEXTS]
    texts += ["<|endoftext|> <s> </s> <unk> <0x41>", "▁ mapped", "ﬁ ①", "unfathomable 北京 naïve\r\n\ttab  two   three", "ᄀ́́", " lead", "trail ", "'s don't 12345", "Ωmega ½"]
    rng = random.Random(3)
    texts += ["".join(rng.choice("aest ion\n'é中 1.") for _ in range(200)) for _ in range(20)]
    rows = list(enumerate(texts)) + [(3, "one"), (3, "one"), (None, "no id here")]
    df = make_docs(rows).selectExpr("*", "1 AS links", "'x' AS n_a", "2 AS a")
    assert got(alignment.alignment_digest(df.repartition(3))) == brute(rows)


def test_empty_table_and_no_tokens(spark, make_docs):
    assert alignment.alignment_digest(make_docs([])).collect() == []
    assert got(alignment.alignment_digest(make_docs([(1, None), (2, "")]))) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_long_text_in_a_row_of_its_own(spark, make_docs):
    rows = [(0, "long word " * 4000), (1, "x" * 3000 + "é" * 500)]
    found = got(alignment.alignment_digest(make_docs(rows)))
    assert [r[1:3] for r in found] == [tuple(map(len, sides(t)[:2])) for _, t in rows]


def test_pairs_are_bounded_by_the_vocabularies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = alignment.pair_counts(alignment.align(docs)).collect()
    a, b = alignment._sides(alignment.PATH_A, alignment.PATH_B)[:2]
    assert len(counts) < alignment.most_pairs() < 2_000_000
    assert all(a.bytes[r.a].endswith(b.bytes[r.b]) or b.bytes[r.b].endswith(a.bytes[r.a]) for r in counts)


def test_smoke_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text) < 2500]
    from pyspark.sql import functions as F

    assert got(alignment.alignment_digest(docs.where(F.length("text") < 2500))) == brute(rows)


@pytest.mark.parametrize("text", ["plain words", "  two  ", "<|endoftext|>x"])
def test_plain_ids_are_those_of_the_file(text):
    from claimscope.llm import tokens

    assert tokens.plain_encoder()(text).tolist() == A.encode(text, add_special_tokens=False).ids
