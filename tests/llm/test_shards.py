from __future__ import annotations

import pathlib
import subprocess
import sys
import zlib

import numpy as np
import pytest
from conftest_llm import ODD_TEXTS, make_docs  # noqa: F401
from tokenizers import Tokenizer

from claimscope.llm import shards
from claimscope.llm.shards import materialised, permuted, shard_index, write_shards
from claimscope.llm.tokens import PATH


@pytest.mark.parametrize("count", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(count):
    slots = permuted(np.arange(count), count)
    assert sorted(slots) == list(range(count))
    assert (permuted(np.arange(count)[::-1], count)[::-1] == slots).all()
    if count > 100:
        assert not (permuted(np.arange(count), count, "another key") == slots).all()
        assert abs(np.corrcoef(slots, np.arange(count))[0, 1]) < 0.2


def ids_of(texts):
    t = Tokenizer.from_file(PATH)
    return np.array([i for x in texts for i in [*t.encode(x or "", add_special_tokens=False).ids, 1]], dtype="<u4")


def test_every_token_once(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    ids = ids_of([r.text for r in docs.collect()])
    path = str(tmp_path / "out")
    total = write_shards(docs, path, records=16)
    rows = shard_index(spark, path, 16).collect()
    assert total == len(rows) == -(-len(ids) // 2048)
    assert sorted(r.slot for r in rows) == list(range(total))
    for r in rows:
        own = ids[r.sequence * 2048 : (r.sequence + 1) * 2048]
        assert r.n_tokens == len(own) and r.ids_crc32 == zlib.crc32(own.tobytes())
        assert (r.shard, r.record) == divmod(r.slot, 16) and r.slot == permuted(np.array([r.sequence]), total)[0]
    for shard in {r.shard for r in rows}:
        (file,) = (tmp_path / "out" / f"shard={shard}").glob("part-*")
        wanted = [r for r in rows if r.shard == shard]
        assert file.stat().st_size == len(wanted) * shards.STRIDE
        r = max(wanted, key=lambda r: r.record)  # one seek to any record
        raw = file.read_bytes()[r.record * shards.STRIDE :]
        assert (np.frombuffer(raw, "<u2", r.n_tokens, 12) == ids[r.sequence * 2048 :][: r.n_tokens]).all()


def test_odd_rows(make_docs):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(1, "a"), (1, "a"), (None, None)]
    out = materialised(make_docs(rows).coalesce(1)).orderBy("sequence").collect()
    ids = ids_of([t for _, t in rows])
    assert sum(r.n_tokens for r in out) == len(ids)
    assert [r.ids_crc32 for r in out] == [zlib.crc32(ids[i : i + 2048].tobytes()) for i in range(0, len(ids), 2048)]
    assert len(materialised(make_docs(rows).repartition(4)).collect()) >= len(out)
    assert materialised(make_docs([])).collect() == []


def test_added_token_strings(make_docs):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>\n\n"]
    (row,) = materialised(make_docs(list(enumerate(texts))).coalesce(1)).collect()
    ids = ids_of(texts)
    assert (row.n_tokens, row.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


SPILL = """
import sys
sys.path.insert(0, sys.argv[1])
import numpy as np
from pyspark.sql import SparkSession
from claimscope.llm.shards import permuted, shard_index, write_shards
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.shuffle.spill.numElementsForceSpillThreshold", "20").getOrCreate()
total = write_shards(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), sys.argv[2])
rows = shard_index(spark, sys.argv[2]).collect()
right = permuted(np.array([r.sequence for r in rows]), total) == np.array([r.slot for r in rows])
print("RIGHT", len(rows) == total, int((~right).sum()))
"""


def test_slots_in_order_when_the_writer_spills(tmp_path):
    """Memory pressure (forced here) must not disturb the order of a shard's records."""
    root = str(pathlib.Path(__file__).parents[2])
    said = subprocess.run([sys.executable, "-c", SPILL, root, str(tmp_path / "out")], capture_output=True, text=True, timeout=300)
    assert "RIGHT True 0" in said.stdout, said.stdout + said.stderr[-2000:]


def test_wrong_slots_are_noticed(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    total = write_shards(docs, str(tmp_path / "out"), key="one")
    with pytest.raises(Exception, match="wrong slot"):
        shard_index(spark, str(tmp_path / "out"), total=total, key="two").collect()
