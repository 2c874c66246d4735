import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def test_pieces_are_powers_of_two_and_cover():
    for n in [*range(0, 300), 1023, 1024, 1025, 4097]:
        cut = packing.pieces_of(n, 64)
        at = 0
        for start, length in cut:
            assert start == at and length & (length - 1) == 0 and length <= 64
            at += length
        assert at == n
        assert len({x for _, x in cut if x < 64}) == len([x for _, x in cut if x < 64])


def test_encoder_equals_library(library):
    encode = packing.encoder(FILE)
    texts = ["", " ", "a<|endoftext|>b", "don't  we'll\n\n x", "日本語 é😀", "\t" * 40, "x" * 3000, "123 4567 !?..", "\x85 a"]
    for text in texts:
        assert list(encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_rows(spark, library):
    data = [(1, "the cat sat", 5), (None, None, None), (2, "", 5), (2, "", 5), (3, "long words here " * 20_000, 5)]
    df = spark.createDataFrame(data, "doc_id long, text string, length int")
    out = packing.pack(df, FILE, 256).collect()
    assert len({r.sequence_id for r in out}) == len(out)
    assert {r.offset for r in out} == {0}
    got = sorted((repr(r.doc_id), r.start, r.length, bytes(r.ids), r.doc_tokens) for r in out)
    wanted = []
    for i, text, _ in data:
        ids = np.array(ids_of(library, text), "<u4")
        for start, length in packing.pieces_of(len(ids), 256):
            wanted.append((repr(i), start, length, ids[start : start + length].tobytes(), len(ids)))
    assert got == sorted(wanted)
    assert packing.pack(df.filter(F.lit(False)), FILE).count() == 0


def test_buckets(spark, tmp_path):
    df = spark.createDataFrame([(1, "one two three four five six seven")], "doc_id long, text string")
    packing.write_buckets(packing.pack(df, FILE, 4), str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert sorted(r.length for r in back.collect()) == [4, 4]


def test_query(spark, library):
    from tidemark.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = {}
    for r in QUERIES["op6_packing"](spark, folder).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert found.keys() == texts.keys()
    for i, pieces in found.items():
        ids = np.array(ids_of(library, texts[i]), "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length <= 1024
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
