"""op8, op10: the library on whole texts is the measure.  op7: brute force."""

import random
import zlib

import numpy as np
import pytest

from earworm.llm import pieces, token_counts, token_store
from earworm.session import checkpoint_dir
from llm_corpus import frame, rows, text


@pytest.fixture(scope="module")
def bpe():
    with open(token_counts.tokenizer_path("byte_bpe_50k.json"), "rb") as f:
        return f.read()


HARD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\n\nb c", "it's we'll 'tis ''s", "x<|endoftext|>y <|endoftext|> z",
    "<|endoftext|>", "end <|endoftext", "one.\nTwo,\nthree;four\n five", "tab\tand\x0bothers here x y",
    "12 345 ,.!? ...\n...", "日本語 テキスト emoji 😀😀 ñandú", "́combining á ǅ ª", "\x1cx \x85y", "A" * 300, "the, the. the! the",
]


def test_token_counts_equal_the_library(spark, bpe):
    tokenizer = token_counts.load_tokenizer(bpe)
    rng = random.Random(5)
    hard = HARD + ["".join(rng.choice(["a", "é", " ", "\n", ".", "'s", "1", "<|endoftext|>", "the", "\t"])
                           for _ in range(rng.randint(1, 30))) for _ in range(400)]
    data = rows() + [(9000 + i, t, "en", "a", 0, 0, "", 0, "", "") for i, t in enumerate(hard)]
    got = token_counts.token_counts(frame(spark, data), bpe, limit=20).collect()
    want = sorted((str(d[0]), len((d[1] or "").encode()), n := len(tokenizer.encode(d[1] or "", add_special_tokens=False).ids),
                   n > 20) for d in data)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_whole_tokens_are_proven(bpe):
    tokenizer = token_counts.load_tokenizer(bpe)
    whole = token_counts.whole_tokens(tokenizer)
    rng = random.Random(1)
    for s in rng.sample(sorted(whole), 300):
        assert len(tokenizer.model.tokenize(s)) == 1
    assert len(whole) > 50_000 - 300


def test_token_store_round_trip(spark, bpe):
    tokenizer = token_counts.load_tokenizer(bpe)
    data = rows() + [(9000 + i, t, "en", "a", 0, 0, "", 0, "", "") for i, t in enumerate(HARD)]
    path = f"{checkpoint_dir(spark)}/store-test"
    token_store.write_tokens(frame(spark, data), path, bpe, shard_ids=500, partitions=4)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_store.read_tokens(spark, path).collect())
    at, want = 0, []
    for d in sorted(data, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or "")):
        ids = np.array(tokenizer.encode(d[1] or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((at, d[0], len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    shards = spark.read.parquet(path)
    assert shards.count() > 4


def test_token_store_of_an_empty_table(spark, bpe):
    path = f"{checkpoint_dir(spark)}/store-empty"
    token_store.write_tokens(frame(spark, []), path, bpe)
    assert token_store.read_tokens(spark, path).count() == 0
    assert token_counts.token_counts(frame(spark, []), bpe).count() == 0


def test_elias_fano_select_and_size():
    rng = np.random.default_rng(3)
    for n, top in ((1, 0), (1, 10**6), (5, 3), (1000, 1000), (1000, 10**9), (70, 64), (300, 0)):
        values = np.sort(rng.integers(0, top + 1, n))
        ef = token_store.EliasFano.of(values)
        assert ef.all().tolist() == values.tolist()
        assert [ef.select(i) for i in range(n)] == values.tolist()
        bits = 8 * (len(ef.low) + len(ef.high))
        assert bits <= n * (2 + max(1, np.log2((values[-1] + 1) / n + 1))) + 32
    with pytest.raises(IndexError):
        token_store.EliasFano.of([1, 2]).select(2)
    assert token_store.EliasFano.of([]).all().tolist() == []


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(pieces.piece_model())


def brute_viterbi(model, table, t):
    s = (" " + t).replace(" ", pieces.MARK)
    best = [(0.0, ())]
    for end in range(1, len(s) + 1):
        score = best[end - 1][0] + model.fallback
        path, linked = best[end - 1][1] + tuple(model.bytes_id[b] for b in s[end - 1].encode()), False
        for k in range(min(end, 16), 0, -1):
            if s[end - k:end] in table:
                value, i = table[s[end - k:end]]
                total = best[end - k][0] + value
                if total > score or (total == score and not linked):
                    score, path, linked = total, best[end - k][1] + (i,), True
        best.append((score, path))
    return list(best[-1][1]) if t else []


def test_viterbi_equals_brute_force(model):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=pieces.piece_model())
    table = {sp.id_to_piece(i): (sp.get_score(i), i) for i in range(sp.get_piece_size())
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    rng = random.Random(2)
    for _ in range(800):
        t = "".join(rng.choice(["the", "er", "in", " ", "  ", "é", "\n", "x", "ß", "😀", "1", " of", "tion", "."])
                    for _ in range(rng.randint(0, 14)))
        ids = np.frombuffer(model.encode(t), np.int32).tolist()
        assert ids == brute_viterbi(model, table, t)
        assert model.decode(ids) == t and (not t or sp.decode(ids) == t)


def test_pieces_round_trip_on_a_table(spark, model):
    data = rows() + [(9000 + i, t, "en", "a", 0, 0, "", 0, "", "") for i, t in enumerate([*HARD, "▁", "a▁▁b ▁"])]
    file = pieces.piece_model()
    coded = pieces.encode_pieces(frame(spark, data), file)
    got = coded.collect()
    assert all(r.decoded_equal and r.n_ids == len(r.ids) for r in got) and len(got) == len(data)
    back = pieces.decode_pieces(coded.select("doc_id", "ids"), file).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(d[0]), d[1] or "") for d in data)
    assert pieces.encode_pieces(frame(spark, []), file).count() == 0


def test_cache_bounds_change_nothing(bpe):
    encode, kind = token_store.text_encoder(bpe, 500_000)
    small, _ = token_store.text_encoder(bpe, 3)
    rng = random.Random(9)
    for _ in range(50):
        t = text(rng, 80)
        assert encode(t) == small(t)
