"""Packing by power-of-two decomposition.

Each document is tokenised, closed with one end id, and cut into pieces whose
lengths are powers of two: as many of the greatest length as fit, then one for
each set bit of the rest, longest first. A piece is a sequence of its own, so no
sequence crosses documents and none needs padding. Sequences of one length form
a bucket, from which batches of a fixed number of tokens are drawn.

A NULL text counts as empty and gives one piece, the end id. Ids may be NULL or
repeat; each row is a document of its own. Other columns are not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

END_ID = 0
#: Tokens in an output batch of a Python task, about.
BATCH_TOKENS = 500_000

#: Fixed value: how byte-level pre-tokenisers cut text.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = "start long, length long, ids binary, doc_tokens long"


def pieces_of(tokens: int, greatest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; ``greatest`` is a power of two."""
    whole, rest = divmod(tokens, greatest)
    out = [(i * greatest, greatest) for i in range(whole)]
    start = whole * greatest
    for bit in reversed(range(greatest.bit_length() - 1)):
        if rest >> bit & 1:
            out.append((start, 1 << bit))
            start += 1 << bit
    return out


_encoders: dict[str, Callable[[str], np.ndarray]] = {}


def encoder(tokenizer_file: str) -> Callable[[str], np.ndarray]:
    """Ids of a text as the ``tokenizers`` library gives them for a byte-level BPE file.

    The file's vocabulary and merges are run by ``tiktoken``, several times
    faster and with equal ids, where the file is of the kind it can express and
    the text holds none of the file's added tokens; else by ``tokenizers``.
    """
    if tokenizer_file not in _encoders:
        _encoders[tokenizer_file] = _make_encoder(tokenizer_file)
    return _encoders[tokenizer_file]


def _make_encoder(tokenizer_file: str) -> Callable[[str], np.ndarray]:
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(tokenizer_file)

    def by_library(text: str) -> np.ndarray:
        return np.array(exact.encode(text, add_special_tokens=False).ids, dtype="<u4")

    with open(tokenizer_file) as f:
        spec = json.load(f)
    fast = _rank_encoder(spec)
    if fast is None:
        return by_library
    added = [t["content"] for t in spec.get("added_tokens") or []]

    def by_ranks(text: str) -> np.ndarray:
        if any(t in text for t in added):
            return by_library(text)
        return np.array(fast(text), dtype="<u4")

    return by_ranks


def _byte_symbols() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _rank_encoder(spec: dict):
    """A rank-based encoder, or None where ids do not follow the merge order."""
    import tiktoken

    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    simple = (
        model.get("type") == "BPE" and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
        and split.get("use_regex", True) and not spec.get("normalizer") and not model.get("dropout")
        and not model.get("ignore_merges") and not model.get("continuing_subword_prefix")
        and not model.get("end_of_word_suffix")
    )
    if not simple:
        return None
    symbols = _byte_symbols()
    added = {t["content"] for t in spec.get("added_tokens") or []}
    to_bytes = lambda text: bytes(symbols[c] for c in text)
    ranks = {to_bytes(text): i for text, i in model["vocab"].items() if text not in added}
    merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    order = [ranks.get(to_bytes(m.replace(" ", "", 1)), -1) for m in merged]
    if order != sorted(order) or -1 in order or len(merged) + 256 != len(ranks):
        return None
    own = tiktoken.Encoding(
        "byte-bpe", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return own.encode_ordinary


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    greatest: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` are little-endian unsigned 32-bit integers. ``length`` names the
    bucket. ``sequence_id`` is unique in one run and not dense. The tokenizer
    file must exist under this path on every executor.
    """
    if greatest < 1 or greatest & (greatest - 1):
        raise ValueError("the greatest length must be a power of two")
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_file)
        for batch in batches:
            ids, rows, waiting = batch.column(0), [], 0
            for i, text in enumerate(batch.column(1)):
                tokens = np.append(encode(text.as_py() or ""), np.array([END_ID], "<u4")).astype("<u4", copy=False)
                raw, n = memoryview(tokens.tobytes()), len(tokens)
                for start, length in pieces_of(n, greatest):
                    rows.append((i, start, length, raw[4 * start : 4 * (start + length)], n))
                waiting += n
                if waiting >= BATCH_TOKENS:
                    yield _batch(ids, rows)
                    rows, waiting = [], 0
            if rows:
                yield _batch(ids, rows)

    cut_rows = source.mapInArrow(cut, f"doc_id {id_type}, {PIECES}")
    return cut_rows.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn(
        "offset", F.lit(0).cast("long")
    ).withColumnRenamed("doc_id", id_column)


def _batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    which, starts, lengths, raw, totals = zip(*rows)
    columns = [
        ids.take(pa.array(which, pa.int32())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
        pa.array([bytes(r) for r in raw], pa.binary()), pa.array(totals, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "doc_tokens"])


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write sequences so that each directory holds those of one length."""
    pieces.write.partitionBy("length").parquet(path)
