from __future__ import annotations

import zlib

import numpy as np
import pytest
import zstandard

from airq.llm import binary_output
from airq.session import scratch_path

ROWS = [(i, f"word{i} " * (i % 37 * 40 + 1)) for i in range(400)] + [(500, None), (501, ""), (-3, "first of all"), (None, "no id"), (502, "x" * 300_000)]


@pytest.fixture(scope="module")
def encode():
    import public_tokenizers
    import tokenizers

    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


def test_round_trip_in_order(docs, encode):
    got = {r["doc_id"]: r for r in binary_output.encode_to_files(docs(ROWS)).collect()}
    at = 0
    for i, t in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(encode(t), dtype="<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_single_documents_and_damage(spark, docs, encode, monkeypatch):
    folder = scratch_path(spark, "ids-test")
    index = binary_output.write_ids(docs(ROWS), folder, "word_bpe_49k.json", 2)
    want = spark.createDataFrame([(7,), (399,)], "doc_id long")
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in binary_output.open_documents(spark, index, folder, want).collect()}
    assert got == {7: encode(ROWS[7][1]), 399: encode(ROWS[399][1])}
    import pyarrow.fs as pfs

    fs, root = pfs.FileSystem.from_uri(folder)
    files = [f.path for f in fs.get_file_info(pfs.FileSelector(root)) if f.path.endswith(".zst")]
    with fs.open_input_file(files[0]) as f:
        raw = f.readall()
    plain = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(raw)
    reader = binary_output.Reader(pfs_file(raw))
    assert plain == b"".join(reader.frame(k) for k in range(len(reader.entries)))
    broken = bytearray(raw)
    broken[-13] ^= 1  # the last frame's checksum in the seek table
    with pytest.raises(ValueError, match="damaged"):
        r = binary_output.Reader(pfs_file(bytes(broken)))
        r.frame(len(r.entries) - 1)


def pfs_file(data):
    import pyarrow as pa

    return pa.BufferReader(data)


def test_empty_table(docs):
    assert binary_output.encode_to_files(docs([])).collect() == []
