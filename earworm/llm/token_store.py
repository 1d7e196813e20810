"""Token ids on disk: a concatenated id array with Elias-Fano boundaries (operator 8).

File format, one Parquet row per shard (Spark's committed writer, so a lost
executor leaves no half-written shard, and any store Spark writes to will do):

  part      ordinal of the range of doc ids the shard belongs to
  first     ids of the same part before this shard
  doc_ids   the documents of the shard, ascending
  n_ids     ids in the shard
  low_bits  width of the low parts of the boundaries
  low       low parts, ``low_bits`` bits each, little bit order
  high      high parts in unary: bit (end_i >> low_bits) + i is set
  samples   little-endian u32: place in ``high`` of every 64th set bit
  ids       little-endian unsigned 16-bit ids (32-bit beyond 65,536 tokens)

The boundaries are the documents' end offsets, at most 2 + log2(n_ids/n_docs)
bits each plus the samples.
"""

from __future__ import annotations

import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earworm.llm.chunks import INNER_CUT, SURE_CUT, PartCache, encode_parts
from earworm.llm.store import documents, shared_path
from earworm.llm.token_counts import SPACE_MARK, load_tokenizer, lone_words, tokenizer_path

SHARD = ("part int, first bigint, doc_ids array<bigint>, n_ids bigint, low_bits int, low binary, high binary, "
         "samples binary, ids binary, id_bytes int")
READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
SAMPLE = 64
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.int64)


class EliasFano:
    """A non-decreasing sequence of integers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        places = (values >> low_bits) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1, np.uint8)
        unary[places] = 1
        return cls(n, low_bits, low.tobytes(), np.packbits(unary, bitorder="little").tobytes(),
                   places[::SAMPLE].astype("<u4").tobytes())

    def select(self, i: int) -> int:
        """The i-th value: from the nearest sample, bytes of ``high`` are
        skipped by their counts of set bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(self.samples[i // SAMPLE])
        need = i - i // SAMPLE * SAMPLE  # set bits to pass behind the sample's
        byte = place // 8
        bits = int(self.high[byte]) & ~((1 << (place % 8)) - 1)
        while (here := int(_POPCOUNT[bits])) <= need:
            need -= here
            byte += 1
            bits = int(self.high[byte])
        for _ in range(need):
            bits &= bits - 1
        place = byte * 8 + (bits & -bits).bit_length() - 1
        at = np.arange(i * self.low_bits, (i + 1) * self.low_bits)
        low = (self.low[at // 8] >> (at % 8)) & 1
        return ((place - i) << self.low_bits) | int((low.astype(np.int64) << np.arange(self.low_bits)).sum())

    def all(self) -> np.ndarray:
        """Every value, decoded at once."""
        if not self.n:
            return np.zeros(0, np.int64)
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return ((places - np.arange(self.n)) << self.low_bits) | low


@lru_cache(maxsize=2)  # a worker process keeps tokenizer and cache over its tasks
def text_encoder(tokenizer_json: bytes, cache_parts: int = 500_000):
    """(``text -> ids``, dtype): ids of whole texts as bytes.  The library
    encodes the pieces between sure cuts, each once while the cache holds it.
    Special strings hold no sure cut, so the library sees them whole."""
    tokenizer = load_tokenizer(tokenizer_json)
    kind = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    if any(SURE_CUT.search(t) or len(INNER_CUT.split(t)) > 1 for t in special):
        raise ValueError("a special string could be cut")
    lone_word, tokenize = lone_words(tokenizer), tokenizer.model.tokenize
    code = {"<u2": "H", "<u4": "I"}[kind]

    def encode(piece: str) -> bytes:
        word = lone_word(piece)
        if word is None:
            return array(code, tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        return array(code, [t.id for t in tokenize(word)]).tobytes()

    def encode_word(part: str) -> bytes:
        return array(code, [t.id for t in tokenize(SPACE_MARK + part)]).tobytes()

    cache = PartCache(encode, b"".join, encode_word, cache_parts)
    return (lambda text: b"".join(encode_parts(text, cache))), kind


def _pack(part: int, first: int, doc_ids: list, pieces: list[bytes], width: int) -> dict:
    ends = np.cumsum([len(b) // width for b in pieces])
    ef = EliasFano.of(ends)
    return {"part": part, "first": first, "doc_ids": doc_ids, "n_ids": int(ends[-1]), "low_bits": ef.low_bits,
            "low": ef.low.tobytes(), "high": ef.high.tobytes(), "samples": ef.samples.tobytes(),
            "ids": b"".join(pieces), "id_bytes": width}


_ARROW = pa.schema([
    ("part", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.int64()),
    ("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary()),
    ("ids", pa.binary()), ("id_bytes", pa.int32())])


def write_tokens(docs: DataFrame, path: str, tokenizer_json: bytes, end_id: int | None = 0, doc_id: str = "doc_id",
                 text: str = "text", shard_ids: int = 1 << 21, partitions: int | None = None) -> None:
    """Encode every row's whole text, append ``end_id``, write shards to ``path``.

    One shuffle: rows are range-partitioned by ``doc_id`` (equal ids by a hash
    of the text, so that rows of one id, or of none, are many tasks' too),
    then each task encodes its range in order and closes a shard at
    ``shard_ids`` ids, so its memory holds one shard.  Null text: empty; null
    ids come first; repeated rows are stored once each.  An empty table writes
    no shard.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    file = spark.sparkContext.broadcast(tokenizer_json)

    def pack(batches):
        from pyspark import TaskContext

        encode, kind = text_encoder(file.value)
        width = int(kind[-1])
        tail = b"" if end_id is None else np.array([end_id], kind).tobytes()
        part, first, held = TaskContext.get().partitionId(), 0, 0
        ids, pieces = [], []
        for batch in batches:
            for row_id, text_value in zip(batch.column(0), batch.column(1)):
                ids.append(row_id.as_py())
                pieces.append(encode(text_value.as_py() or "") + tail)
                held += len(pieces[-1]) // width
                if held >= shard_ids:
                    yield pa.RecordBatch.from_pylist([_pack(part, first, ids, pieces, width)], _ARROW)
                    first, held, ids, pieces = first + held, 0, [], []
        if ids:
            yield pa.RecordBatch.from_pylist([_pack(part, first, ids, pieces, width)], _ARROW)

    rows = docs.select(docs[doc_id].cast("bigint").alias("_id"), docs[text].cast("string").alias("_text"))
    (rows.withColumn("_hash", F.xxhash64("_text")).repartitionByRange(n, "_id", "_hash")
     .sortWithinPartitions("_id", "_hash", "_text").select("_id", "_text").mapInArrow(pack, SHARD).write.parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document.

    The ids before a part come from one row per part (their number is that of
    the writer's partitions), broadcast; the boundaries come from the
    Elias-Fano columns alone.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    offsets = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)).alias("before"))

    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ends = EliasFano(len(row["doc_ids"]), row["low_bits"], row["low"], row["high"], row["samples"]).all()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").astype("<u4")
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["before"] + row["first"] + starts),
                     pa.array(ends - starts), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.join(F.broadcast(offsets), "part").mapInArrow(unpack, READ)


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written with byte_bpe_50k.json and end id 0, and read back."""
    with open(tokenizer_path("byte_bpe_50k.json"), "rb") as f:
        data = f.read()
    path = shared_path(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path, data)
    return read_tokens(spark, path)
