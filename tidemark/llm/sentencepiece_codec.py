"""Exact merge-type (BPE) SentencePiece encoding by backtracking, and decoding.

A sequence of pieces is what merging by score gives if, and only if, every two
neighbours are what merging gives for their joint text. So no merge queue over
the text is needed: an Aho-Corasick pass lists the pieces that begin at each
character, the longest is taken, and it is kept if re-merging it with its left
neighbour gives the same two pieces back. Where nothing fits, the last piece is
given up for its next shorter prefix, and the position is marked as failed, so no position is tried twice.

Text is cut before a run of spaces and at characters that no piece of several
characters holds: no merge crosses there (checked when the model is loaded).
The ids of a segment are kept in a bounded table, as words repeat.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"
CACHE_SEGMENTS = 300_000

NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class PieceCodec:
    """Encoder and decoder of one BPE model file with byte fallback."""

    def __init__(self, model_file: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        rules, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if model.trainer_spec.model_type != 2 or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models of normal, control and byte pieces are supported")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
            raise ValueError("only identity normalisation with a leading space is supported")
        self.pieces = [p.piece for p in model.pieces]
        self.bos, self.eos = model.trainer_spec.bos_id, model.trainer_spec.eos_id
        self.bytes_at = {i: int(p.piece[3:5], 16) for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_ids = {b: i for i, b in self.bytes_at.items()}
        self.silent = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        #: Surfaces of all ids but bytes.
        self.plain = {i: p.piece.replace(SPACE, " ") for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.plain |= dict.fromkeys(self.silent, "") | {self.unknown: model.trainer_spec.unk_surface}
        self.ids = {p.piece.replace(SPACE, " "): i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {text: model.pieces[i].score for text, i in self.ids.items()}
        inner = {c for text in self.ids if len(text) > 1 for c in text}
        if any(re.search(r"[^ ] ", text) for text in self.ids):
            raise ValueError("a piece crosses the start of a space run")
        self.newline_alone = "\n" not in inner
        self.cut = re.compile(r" *[^ \n]+| +|\n" if self.newline_alone else r" *[^ ]+| +")
        #: Pieces that merging can reach; no encoding holds any other.
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            if len(text) == 1 or self.merge(text) == [text]:
                self.automaton.add_word(text, (len(text), i))
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.known: dict[str, tuple[bytes, str]] = {}

    def merge(self, text: str) -> list[str]:
        """Merging by score, then from the left; only ever used on two pieces."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, key: int) -> bool:
        """Whether the two pieces of ``left << 20 | right`` come back from re-merging their joint text."""
        a, b = self.plain[key >> 20], self.plain[key & 0xFFFFF]
        if len(self.fits) > 1_000_000:
            self.fits.clear()
        self.fits[key] = found = self.merge(a + b) == [a, b]
        return found

    def fallback(self, char: str) -> list[int]:
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in char.encode("utf-8", "replace")]

    def segment(self, text: str) -> list[int]:
        """Ids of one segment: pieces by backtracking, bytes where no piece begins."""
        whole = self.ids.get(text)
        if whole is not None and text in self.automaton:
            return [whole]
        starts: list[list[tuple[int, int]]] = [[] for _ in text]
        for end, match in self.automaton.iter(text):
            starts[end + 1 - match[0]].append(match)
        out, at, size = [], 0, len(text)
        while at < size:
            if not starts[at]:
                out += self.fallback(text[at])
                at += 1
                continue
            stop = at  # characters without a piece take part in no merge
            while stop < size and starts[stop]:
                stop += 1
            out += self.backtrack(starts, at, stop)
            at = stop
        return out

    def backtrack(self, starts: list[list[tuple[int, int]]], begin: int, stop: int) -> list[int]:
        failed = bytearray(stop - begin + 1)  # positions from which the rest has no encoding
        tokens: list[int] = []
        tried: list[tuple[int, int]] = []  # of each token, its start and its place in the start's list
        at, choice = begin, len(starts[begin]) - 1
        fits = self.fits
        while at < stop:
            options = starts[at]
            while choice >= 0:
                length, token = options[choice]
                if not failed[at + length - begin]:
                    if not tokens:
                        break
                    key = tokens[-1] << 20 | token
                    if fits[key] if key in fits else self.compatible(key):
                        break
                choice -= 1
            if choice >= 0:
                tokens.append(token)
                tried.append((at, choice))
                at += length
                choice = len(starts[at]) - 1 if at < stop else -1
            else:
                if not tokens:
                    raise ValueError("no encoding; the model's merges do not cover the text")
                failed[at - begin] = 1
                tokens.pop()
                at, choice = tried.pop()
        return tokens

    def encode(self, text: str, ends: bool = True) -> list[int]:
        packed = self.encode_packed(text, ends)[0]
        return list(struct.unpack(f"<{len(packed) // 4}I", packed))

    def encode_packed(self, text: str, ends: bool = True) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers, their decoded text)."""
        known, out, back = self.known, [], []
        if text:
            for part in self.cut.findall(" " + text.replace(SPACE, " ")):
                found = known.get(part)
                if found is None:
                    ids = self.segment(part)
                    found = struct.pack(f"<{len(ids)}I", *ids), self.surface(ids)
                    if len(part) <= 64:
                        if len(known) >= CACHE_SEGMENTS:
                            known.clear()
                        known[part] = found
                out.append(found[0])
                back.append(found[1])
        packed = b"".join(out)
        if ends:
            packed = struct.pack("<I", self.bos) + packed + struct.pack("<I", self.eos)
        decoded = "".join(back)
        return packed, decoded[1:] if decoded.startswith(" ") else decoded

    def surface(self, ids: list[int]) -> str:
        """Text of ids, the leading space kept."""
        try:
            return "".join([self.plain[i] for i in ids])
        except KeyError:
            pass
        out: list[str] = []
        run = bytearray()
        for i in [*ids, None]:
            if i in self.bytes_at:
                run.append(self.bytes_at[i])
                continue
            if run:
                out.append(decode_bytes(bytes(run)))
                run.clear()
            if i is not None:
                out.append(self.plain[i])
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.surface(ids)
        first = next((i for i in ids if i not in self.silent), None)
        return text[1:] if first is not None and self.pieces[first].startswith(SPACE) else text


def decode_bytes(run: bytes) -> str:
    """UTF-8 with one replacement character for each byte that is not part of a character."""
    out, at = [], 0
    while at < len(run):
        for length in (1, 2, 3, 4):
            try:
                out.append(run[at : at + length].decode("utf-8"))
                at += length
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


RESULT = "n_tokens long, ids binary, decoded string"
_codecs: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """One codec for each model file and Python process."""
    if model_file not in _codecs:
        _codecs[model_file] = PieceCodec(model_file)
    return _codecs[model_file]


def encode(docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``decoded``.

    Begin and end ids are included. A NULL text counts as empty and gives just
    these two. Ids may be NULL or repeat; other columns are not looked at. The
    model file must exist under this path on every executor.
    """
    kind = pa.schema([("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = codec(model_file)
        for texts in batches:
            found = [model.encode_packed(t or "") for t in (x.as_py() for x in texts)]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([len(ids) // 4 for ids, _ in found], pa.int64()),
                    pa.array([ids for ids, _ in found], pa.binary()),
                    pa.array([text for _, text in found], pa.string()),
                ],
                fields=list(kind),
            )

    encoded = docs.select(F.col(id_column), run(F.col(text_column)).alias("_r"))
    return encoded.select(id_column, "_r.n_tokens", "_r.ids", "_r.decoded")
