"""SentencePiece encoding and decoding by Aho-Corasick and Viterbi (operator 7).

An Aho-Corasick automaton over the model's pieces reads a text once; at every
position its output links list all pieces that end there, the longest first,
and each relaxes the best score of that position (Viterbi).  A character that
no piece covers falls back to its bytes.  The best path is unique: equal scores
go to the longer last piece.

No piece holds the space mark behind another character (checked when the model
is loaded), so a path always breaks in front of the mark that follows a
non-mark; the stretches between such places are encoded one by one and kept in
a bounded cache.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from earworm.llm.chunks import CACHED_CHARS
from earworm.llm.store import documents
from earworm.llm.token_counts import tokenizer_path

#: Stands for a space in pieces.
MARK = "▁"
STRETCH = re.compile(r" +[^ ]*")
SCHEMA = "doc_id bigint, ids array<int>, n_ids bigint, ids_crc32 bigint, decoded_equal boolean"


class StretchCache(dict):
    """``part -> encode(" " + part)``, emptied when it holds ``limit`` parts;
    those of over ``CACHED_CHARS`` characters are not kept."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, part: str) -> bytes:
        value = self.encode(" " + part)
        if len(part) <= CACHED_CHARS:
            if len(self) >= self.limit:
                self.clear()
            self[part] = value
        return value


class PieceModel:
    """Pieces and scores of a SentencePiece model file; encodes and decodes.

    A text is prefixed with one space (unless empty), spaces become marks, and
    a mark character of the text itself is spelled in bytes, so decoding gives
    back exactly the text.
    """

    def __init__(self, data: bytes, cache_parts: int = 500_000):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.bytes_id, self.decoded, scores = {}, [], []
        self.automaton = ahocorasick.Automaton()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_id[int(piece[3:-1], 16)] = i
                self.decoded.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.decoded.append(b"")
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {i} has the space mark inside")
                scores.append(model.get_score(i))
                self.automaton.add_word(piece, (len(piece), scores[-1], i))
                self.decoded.append(piece.replace(MARK, " ").encode())
        self.automaton.make_automaton()
        if len(self.bytes_id) != 256:
            raise ValueError("the model has no byte fallback")
        #: Of a character spelled in bytes: below every piece.
        self.fallback = min(scores) - 10.0
        self.cache = StretchCache(self._encode_stretch, cache_parts)

    def viterbi(self, stretch: str) -> list[int]:
        """Ids of the best path through a string in which spaces are marks."""
        n = len(stretch)
        best, came = [0.0] * (n + 1), [None] * (n + 1)
        matches = self.automaton.iter(stretch)
        upcoming = next(matches, None)
        for end in range(1, n + 1):
            top = best[end - 1] + self.fallback  # the character in bytes
            link = None
            while upcoming is not None and upcoming[0] == end - 1:
                length, score, i = upcoming[1]
                total = best[end - length] + score
                if total > top or (total == top and link is None):
                    top, link = total, (length, i)
                upcoming = next(matches, None)
            best[end], came[end] = top, link
        ids, at = [], n
        while at:
            if came[at] is None:
                ids += [self.bytes_id[b] for b in reversed(stretch[at - 1].encode())]
                at -= 1
            else:
                length, i = came[at]
                ids.append(i)
                at -= length
        return ids[::-1]

    def _encode_stretch(self, stretch: str) -> bytes:
        if MARK in stretch:  # the text's own mark characters: bytes, around which no piece reaches
            spelled = array("i", [self.bytes_id[b] for b in MARK.encode()]).tobytes()
            return spelled.join(self._encode_stretch(s) if s else b"" for s in stretch.split(MARK))
        return array("i", self.viterbi(stretch.replace(" ", MARK))).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as 32-bit integers."""
        if not text:
            return b""
        parts = text.split(" ")
        if "" in parts:  # runs of spaces, or a space at an end
            return b"".join(map(self._encode_stretch, STRETCH.findall(" " + text)))
        return b"".join(map(self.cache.__getitem__, parts))

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.decoded.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:]


@lru_cache(maxsize=2)  # a worker process keeps model and cache over its tasks
def loaded(model_file: bytes, cache_parts: int = 500_000) -> PieceModel:
    return PieceModel(model_file, cache_parts)


def encode_pieces(docs: DataFrame, model_file: bytes, doc_id: str = "doc_id", text: str = "text",
                  cache_parts: int = 500_000) -> DataFrame:
    """(doc_id, ids, n_ids, ids_crc32, decoded_equal) of every row.

    A map without shuffle; the model file (its size is the vocabulary's) is
    broadcast.  Texts are encoded whole.  ``decoded_equal`` tells that decoding
    the ids gives the text back.  Null or empty text: no ids, equal to the
    empty text.  Null ids and repeated rows pass through.
    """
    file = docs.sparkSession.sparkContext.broadcast(model_file)

    def encode(batches):
        model = loaded(file.value, cache_parts)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # bounds what is held at once
                rows = batch.slice(at, 256)
                texts = [t or "" for t in rows.column(1).to_pylist()]
                coded = [model.encode(t) for t in texts]
                sizes = np.array([len(c) // 4 for c in coded], np.int64)
                flat = np.frombuffer(b"".join(coded), np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                equal = [model.decode(array("i", c).tolist()) == t for c, t in zip(coded, texts)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(sizes),
                     pa.array([zlib.crc32(c) for c in coded], pa.int64()), pa.array(equal, pa.bool_())],
                    names=["doc_id", "ids", "n_ids", "ids_crc32", "decoded_equal"])

    return docs.select(docs[doc_id].cast("bigint"), docs[text].cast("string")).mapInArrow(encode, SCHEMA)


def decode_pieces(encoded: DataFrame, model_file: bytes, ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids; null ids: null."""
    file = encoded.sparkSession.sparkContext.broadcast(model_file)
    kept = [c for c in encoded.columns if c != out]

    def decode(batches):
        model = loaded(file.value)
        for batch in batches:
            texts = [None if i is None else model.decode(i) for i in batch.column(kept.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, out])

    frame = encoded.select(*kept)
    return frame.mapInArrow(decode, StructType([*frame.schema.fields, StructField(out, StringType())]))


def piece_model() -> bytes:
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def op7_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents under piece_bpe_32k.model's pieces, and back."""
    return encode_pieces(documents(spark, sf_dir), piece_model())
