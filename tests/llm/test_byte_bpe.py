"""op11: the library on whole texts is the measure."""

import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken

from earworm.llm import byte_bpe
from llm_corpus import frame, rows

ALPHABET = ["a", "e", " ", "th", "er", "\n", "é", "日", "😀", "'s", "1", "  ", "xx", "\x1c", "​", "ß", "aaaa", "\x85"]


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def ranks(request):
    with open(public_tokenizers.path(request.param), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(ranks),
                             special_tokens={})


@pytest.fixture(scope="module")
def merges(ranks):
    return byte_bpe.Merges(byte_bpe.read_ranks(ranks))


def hard_texts(n=3000, seed=4):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_ids_equal_the_library(merges, library):
    encode, split = byte_bpe.Encoder(merges), regex.compile(public_tokenizers.PATTERN).findall
    for t in hard_texts():
        assert [i for part in split(t) for i in encode(part.encode())] == library.encode_ordinary(t)


def test_any_bytes_and_long_runs(merges, library):
    encode = byte_bpe.Encoder(merges)
    rng = random.Random(2)
    words = [bytes(rng.choice(b"ab the\xc3\xa9\x80 1.") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    for word in [*words, b"a" * 5000, b" " * 3000, b"ab" * 2000, bytes(range(256)) * 4]:
        assert encode(word) == library._encode_single_piece(word)


def test_few_states_are_made_anew(merges, library):
    encode = byte_bpe.Encoder(merges, max_states=50)
    for word in (f"w{i * 7919}xyz éa the{i}".encode() for i in range(500)):
        assert encode(word) == library._encode_single_piece(word)
        assert len(encode.states) <= 50


def test_lookahead_is_bounded_by_the_longest_token(merges):
    """What has not been emitted is never more than a longest token and a bit."""
    encode = byte_bpe.Encoder(merges)
    longest = max(map(len, merges.bytes.values()))
    state, read, out = encode.start, 0, 0
    for byte in ("the other thing is " * 200 + "a" * 2000).encode():
        state, emitted = state.get(byte) or encode._step(state, byte)
        read, out = read + 1, out + sum(len(merges.bytes[i]) for i in emitted)
        assert read - out <= 2 * longest


def test_neighbours_against_merging(merges):
    rng, tokens = random.Random(3), [i for i, half in enumerate(merges.first_half) if half >= 0]
    ends = len(merges.bytes) + 1
    for _ in range(3000):
        left, right = rng.choice(tokens[:3000]), rng.choice(tokens[:3000])
        a, b = merges.bytes[left], merges.bytes[right]
        assert merges.neighbours(left, right) == (merges.merge(a + b, ends) == [a, b])


def test_streaming_decoder(merges):
    """Fed one id at a time: each character as soon as it is whole, the same
    text as the codec's with replacement, whatever the bytes."""
    rng = random.Random(5)
    single = {b: merges.ranks[bytes([b])] for b in range(256)}
    samples = [t.encode() for t in hard_texts(300)] + [
        bytes(rng.choice(b"a\x80\xbf\xc3\xa9\xe0\xa0\xed\x9f\xb0\xf0\x90\xf4\x8f\xff\xc0") for _ in range(rng.randint(0, 12)))
        for _ in range(5000)]
    for data in samples:
        decoder = byte_bpe.Decoder(merges.bytes)
        out = [decoder.feed([single[b]]) for b in data] + [decoder.end()]
        assert "".join(out) == data.decode(errors="replace")
    decoder = byte_bpe.Decoder(merges.bytes)
    assert [decoder.feed([single[b]]) for b in "é😀".encode()] == ["", "é", "", "", "", "😀"]
    with pytest.raises(KeyError):
        decoder.feed([10**6])


def test_words_are_kept_in_two_generations(merges):
    cache = byte_bpe.WordCache(byte_bpe.Encoder(merges), 10)
    want = {w: byte_bpe.Encoder(merges)(w.encode()) for w in (f"word{i}" for i in range(100))}
    for _ in range(2):
        for w, ids in want.items():
            assert list(memoryview(cache[w]).cast("i")) == ids
    cache["x" * 100]
    assert "x" * 100 not in cache and len(cache) <= 10 and len(cache.old) <= 10


def test_tables(spark, ranks, library):
    """Null and empty texts, repeated rows, null ids, long texts, columns named
    like the operator's own."""
    data = rows() + [(9000 + i, t, "en", "a", 0, 0, "", 0, "", "") for i, t in enumerate(hard_texts(200))]
    docs = frame(spark, data).withColumnRenamed("fp", "ids").withColumnRenamed("_row", "column 0")
    encoded = byte_bpe.encode_ids(docs, ranks, public_tokenizers.PATTERN, ids="tokens")
    assert encoded.columns == [c for c in docs.columns if c != "text"] + ["tokens"]
    want = sorted((str(d[0]), d[5], library.encode_ordinary(d[1] or "")) for d in data)
    assert sorted((str(r.doc_id), r["ids"], r.tokens) for r in encoded.collect()) == want
    both = byte_bpe.encode_ids(docs, ranks, public_tokenizers.PATTERN, ids="tokens", decoded="decoded")
    assert sorted((str(r.doc_id), r.decoded) for r in both.collect()) == sorted((str(d[0]), d[1] or "") for d in data)
    back = byte_bpe.decode_ids(encoded, ranks, "tokens")
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(d[0]), d[1] or "") for d in data)
    assert byte_bpe.encode_ids(frame(spark, []), ranks, public_tokenizers.PATTERN).count() == 0


def test_query(spark, tmp_path):
    frame(spark, rows()).write.parquet(f"{tmp_path}/documents.parquet")
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                    mergeable_ranks=byte_bpe.read_ranks(f.read()))
    want = []
    for d in rows():
        ids = library.encode_ordinary(d[1] or "")
        want.append((str(d[0]), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((d[1] or "").encode()).hexdigest()))
    got = byte_bpe.op11_byte_bpe(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == sorted(want)
