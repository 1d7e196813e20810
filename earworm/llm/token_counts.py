"""Token counts by the whole-token shortcut (operator 10).

Offline, every string of the vocabulary is put through the BPE model by
itself; those that come back as one token are proven whole.  A pre-token in
that set counts 1 without merging; only the rest is merged.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from earworm.llm.chunks import LETTERS, PartCache, encode_parts
from earworm.llm.store import documents

#: The space in a byte-level vocabulary (``byte_alphabet()[32]``).
SPACE_MARK = "\u0120"
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(data: bytes):
    # one thread: the task's core; read when the library first encodes
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(data.decode())


def whole_tokens(tokenizer) -> frozenset[str]:
    """Vocabulary strings (in the model's own alphabet) that encode alone as
    one token.  Strings that no merge sequence reaches are left out."""
    model = tokenizer.model
    return frozenset(s for s in tokenizer.get_vocab(with_added_tokens=False) if len(model.tokenize(s)) == 1)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself where it is printable Latin-1, else the next code point
    from 256 up."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def lone_words(tokenizer):
    """``piece -> its pre-token`` for a piece that is one run of letters, with
    or without a space in front, which is one pre-token; else None."""
    if tokenizer.normalizer is not None:
        raise ValueError("needs a tokenizer without normalizer")
    alphabet = byte_alphabet()
    table = {c: "".join(alphabet[b] for b in chr(c).encode()) for c in [32, *range(128, 256)]}
    word = re.compile(f" ?[{LETTERS}]+").fullmatch
    return lambda piece: piece.translate(table) if word(piece) else None


def piece_counter(tokenizer, whole: frozenset[str]):
    """``text -> number of tokens`` of one piece of a text."""
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    pre, model = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model
    lone_word = lone_words(tokenizer)

    def count(piece: str) -> int:
        if (word := lone_word(piece)) is not None:
            pre_tokens = [word]
        elif any(s in piece for s in special):
            return len(tokenizer.encode(piece, add_special_tokens=False).ids)
        else:
            pre_tokens = [p for p, _ in pre(piece)]
        return sum(1 if p in whole else len(model.tokenize(p)) for p in pre_tokens)

    return count


@lru_cache(maxsize=2)  # a worker process keeps tokenizer and cache over its tasks
def part_counts(tokenizer_json: bytes, cache_parts: int) -> PartCache:
    tokenizer = load_tokenizer(tokenizer_json)
    whole, tokenize = whole_tokens(tokenizer), tokenizer.model.tokenize

    def count_word(part: str) -> int:
        word = SPACE_MARK + part
        return 1 if word in whole else len(tokenize(word))

    return PartCache(piece_counter(tokenizer, whole), sum, count_word, cache_parts)


def token_counts(docs: DataFrame, tokenizer_json: bytes, limit: int = 1024, doc_id: str = "doc_id",
                 text: str = "text", cache_parts: int = 500_000) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    A map without shuffle.  The tokenizer file (its size is the vocabulary's,
    not the data's) is broadcast; each worker process proves the whole tokens
    once and keeps a cache of at most ``cache_parts`` parts (and as many
    pieces of parts).  Special strings inside
    texts count as their special token, the library's default.  Null or empty
    text: 0 bytes, 0 tokens, not over the limit.  Null ids and repeated rows
    pass through, one result row each; other columns are not read.
    """
    file = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def count(batches):
        cache = part_counts(file.value, cache_parts)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            n = pa.array([sum(encode_parts(t.as_py(), cache)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), n, pc.greater(n, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(docs[doc_id].cast("bigint"), docs[text].cast("string")).mapInArrow(count, SCHEMA)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents under byte_bpe_50k.json."""
    with open(tokenizer_path("byte_bpe_50k.json"), "rb") as f:
        return token_counts(documents(spark, sf_dir), f.read())
