from __future__ import annotations

import zlib

import numpy as np
from conftest_llm import ODD_TEXTS, make_docs  # noqa: F401
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from claimscope.llm import packing
from claimscope.llm.packing import assign, cost, pack
from claimscope.llm.tokens import END, PATH, Encoder

WHITE = ["  a  b", "a \n b", "x\n\n y", "a  b   c", "\x1c a\x1f b", "don't 's 12 34", "é   ü", "   ", "a\t b", "　 a", "\x85 a b", "😀 😀  x", "we'll, I'd!"]


def reference():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_tokenizers_file(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    encode, t = Encoder(), reference()
    for text in texts + WHITE + ODD_TEXTS[1:]:
        assert encode(text).tolist() == [*t.encode(text, add_special_tokens=False).ids, END]
    assert encode(None).tolist() == [END]


@given(st.lists(st.integers(1, 64), max_size=60))
def test_assign_places_every_token_once(lengths):
    lengths = np.array(lengths, dtype=np.int64)
    pieces = assign(lengths, 64)
    count = -(-int(lengths.sum()) // 64)
    for item, n in enumerate(lengths):
        mine = sorted((s, k) for i, s, k, _, _ in pieces if i == item)
        assert [s for s, _ in mine] == [sum(k for _, k in mine[:j]) for j in range(len(mine))] and sum(k for _, k in mine) == n
    for sequence in range(count):
        mine = sorted((o, k) for _, _, k, s, o in pieces if s == sequence)
        assert [o for o, _ in mine] == [sum(k for _, k in mine[:j]) for j in range(len(mine))] and 0 < sum(k for _, k in mine) <= 64
    assert {s for *_, s, _ in pieces} == set(range(count))


def test_costs_are_balanced():
    lengths = np.random.default_rng(1).integers(1, 1500, 2000)
    totals: dict = {}
    for _, _, length, sequence, _ in assign(lengths):
        totals[sequence] = totals.get(sequence, 0) + cost(length)
    in_order: dict = {}
    room, sequence = packing.CAPACITY, 0
    for n in lengths:
        if n > room:
            room, sequence = packing.CAPACITY, sequence + 1
        room -= n
        in_order[sequence] = in_order.get(sequence, 0) + cost(n)
    assert np.std([*totals.values()]) < np.std([*in_order.values()])


def check(docs, rows, limit_padding):
    t = reference()
    by_doc, by_sequence = {}, {}
    for r in docs:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {i for i, _ in rows}
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048
        padding += 2048 - at
    assert padding <= limit_padding


def test_pack_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], 2047)


def test_blocks(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).repartition(3)
    check(pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], 3 * 2047)


def test_odd_rows(make_docs):
    rows = list(enumerate(ODD_TEXTS + WHITE))
    check(pack(make_docs(rows).coalesce(1)).collect(), rows, 2047)
    out = pack(make_docs([(1, "a"), (1, "a"), (None, None)]).coalesce(1)).collect()
    assert sorted(((r.doc_id, r.length, r.offset) for r in out), key=str) == [(1, 2, 0), (1, 2, 2), (None, 1, 4)]
    assert pack(make_docs([])).collect() == []


#: Texts that hold the string of the file's added token, or nearly.
ADDED = ["<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|>  b", "<|endoftext|><|endoftext|>\n\n x", "x<|endoftext|>'s 12", "<|endoftext|", "<|ENDOFTEXT|> <|end", "\n <|endoftext|>\t\t", "é  ü<|endoftext|>中文 😀"]


def test_added_tokens_are_those_of_the_tokenizers_file(make_docs):
    encode, t = Encoder(), reference()
    assert encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275, END]
    for text in ADDED:
        assert encode(text).tolist() == [*t.encode(text, add_special_tokens=False).ids, END]
    rows = list(enumerate(ADDED))
    check(pack(make_docs(rows).coalesce(1)).collect(), rows, 2048)


def test_many_short_documents_are_packed_in_blocks_of_rows(spark, make_docs):
    """Blocks are bounded by rows too; every document stays whole and in one place."""
    df = make_docs([(i, "" if i % 2 else "a b") for i in range(500)]).coalesce(1)
    out = packing.pack(df, block_rows=60).collect()
    assert sorted(r.doc_id for r in out) == list(range(500))
    assert len({r.sequence_id for r in out}) == -(-500 // 60)
