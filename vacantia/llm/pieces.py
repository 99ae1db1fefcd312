"""SentencePiece encoding and decoding.

The pieces of a model form an Aho-Corasick automaton.  One pass over a text
walks the automaton; at each position the pieces that end there (the state's
output links, longest first) relax the best score of that position, so the
best segmentation by the sum of scores needs no second look at the text.
Characters that no piece covers become their bytes' pieces.

A piece never goes on after a space that follows other characters (checked
when the model is read), so a text is encoded word by word and each task keeps
the result of words it has seen, up to a fixed number.

Defined cases: a null or empty text has no pieces and decodes to the empty
text; very long words take time in proportion to their length; equal scores go
to the longer last piece; rows that repeat an id are encoded each for itself;
other columns are ignored.  A text that holds the space mark itself (U+2581)
decodes to a space there, as the model's own alphabet cannot tell them apart.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# Fixed values of the model format.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
WORDS_KEPT = 300_000


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.automaton = ahocorasick.Automaton()
        self.raw: list[bytes] = []
        self.byte_ids = [0] * 256
        whole, scores, singles = [], [], set()
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.raw.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                self.raw.append(piece.encode())
                score = model.get_score(i)
                self.automaton.add_word(piece, (len(piece), i, score))
                whole.append(piece)
                scores.append(score)
                if len(piece) == 1:
                    singles.add(piece)
        self.automaton.make_automaton()
        self.singles = singles
        self.unknown_score = min(scores) - UNKNOWN_PENALTY
        ends_before_space = all(SPACE not in p.lstrip(SPACE) for p in whole)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if ends_before_space else "(?s).+")
        self.seen: dict[str, tuple[int, ...]] = {}

    def segment(self, word: str) -> tuple[int, ...]:
        """Best segmentation of one word by a single pass of the automaton."""
        n = len(word)
        score = [0.0] + [float("-inf")] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        if self.singles.issuperset(word):
            for end, (length, piece, value) in self.automaton.iter(word):
                end += 1
                found = score[end - length] + value
                if found > score[end]:
                    score[end], back[end] = found, (length, piece)
        else:
            # A character without a piece is an edge of its own, after the longer pieces that end with it.
            ending: list[list] = [[] for _ in word]
            for end, found in self.automaton.iter(word):
                ending[end].append(found)
            for at, char in enumerate(word):
                edges = ending[at] if char in self.singles else [*ending[at], (1, -1, self.unknown_score)]
                for length, piece, value in edges:
                    found = score[at + 1 - length] + value
                    if found > score[at + 1]:
                        score[at + 1], back[at + 1] = found, (length, piece)
        out: list[int] = []
        end = n
        while end:
            length, piece = back[end]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.byte_ids[b] for b in reversed(word[end - 1].encode()))
            end -= length
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        seen = self.seen
        for word in self.words.findall(SPACE + text.replace(" ", SPACE)):
            ids = seen.get(word)
            if ids is None:
                ids = self.segment(word)
                if len(word) <= 64:
                    if len(seen) >= WORDS_KEPT:
                        seen.clear()
                    seen[word] = ids
            out += ids
        return out

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids)).replace(SPACE.encode(), b" ")[1:]

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def codec(model: str) -> Codec:
    """The codec of a public model's name or a file's path; one per worker process."""
    if model not in _CODECS:
        import os

        import public_tokenizers

        _CODECS[model] = Codec(model if os.path.isabs(model) else public_tokenizers.path(model))
    return _CODECS[model]


_CODECS: dict[str, Codec] = {}
MODEL = "piece_bpe_32k.model"


def encode(text: Column, model: str = MODEL) -> Column:
    """Piece ids of a text."""
    @arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([codec(model).encode(t or "") for t in column.to_pylist()], pa.list_(pa.int32()))
    return run(text)


def decode(ids: Column, model: str = MODEL) -> Column:
    """The text of piece ids."""
    @arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([codec(model).decode(i or []) for i in column.to_pylist()], pa.string())
    return run(ids)


def digest(docs: DataFrame, model: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_pieces, n_bytes_pieces, ids_crc32 and whether decoding gives the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model)
        single = np.zeros(len(tool.raw), dtype=np.int64)
        single[tool.byte_ids] = 1
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for t in batch.column(1).to_pylist():
                ids = tool.encode(t or "")
                numbers = np.array(ids, dtype="<u4")
                for column, value in zip(rows, (len(ids), int(single[numbers].sum()), zlib.crc32(numbers.tobytes()),
                                                tool.decode_bytes(ids) == (t or "").encode())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(x, pa.int64()) for x in rows[:3]), pa.array(rows[3], pa.bool_())],
                ["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "round_trip"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, round_trip boolean")
