import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidemark.llm.sentencepiece_codec import PieceCodec, encode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return PieceCodec(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def agree(both, text):
    own, library = both
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert own.encode(text) == ids
    assert own.encode_packed(text)[1] == own.decode(ids) == library.decode(ids)


def test_edge_texts(both):
    for text in ["", " ", "\n", "a", "▁", " ▁ a", "<s>hi</s>", "<0x0A>", "日本語 😀\x00", " " * 700 + "x", "th" * 4000,
                 "the  the\n\n  the", "\t tab", "é" * 50, "0123456789", "word word"]:
        agree(both, text)


def test_random_texts(both):
    own, _ = both
    rnd = random.Random(3)
    chars = " ▁\nabthe éß日本😀<0>s/\t\x00   the and ing er on"
    words = [p.replace("▁", " ") for p in own.pieces[259:]]
    for _ in range(1500):
        agree(both, "".join(rnd.choice(chars) for _ in range(rnd.randrange(40))))
        agree(both, "".join(rnd.choice(words) for _ in range(rnd.randrange(12))))


def test_ids_that_no_text_gives_decode_alike(both):
    own, library = both
    rnd = random.Random(5)
    for k in range(1000):
        ids = [rnd.randrange(32_000 if k % 2 else 300) for _ in range(12)]
        assert own.decode(ids) == library.decode(ids)


def test_rows(spark, both):
    _, library = both
    data = [(1, "the cat", "x"), (None, None, None), (2, "", "x"), (2, "", "x"), (3, "long words " * 20_000, "x")]
    df = spark.createDataFrame(data, "doc_id long, text string, ids string")
    found = sorted(map(tuple, encode(df, MODEL).collect()), key=repr)
    wanted = []
    for i, text, _ in data:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        wanted.append((i, len(ids), bytearray(struct.pack(f"<{len(ids)}I", *ids)), library.decode(ids)))
    assert found == sorted(wanted, key=repr)
    assert encode(df.filter(F.lit(False)), MODEL).count() == 0


def test_query_digests(spark):
    from tidemark.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op10_sentencepiece"](spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
