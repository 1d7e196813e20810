"""Byte-level BPE as a lazily determinised transducer, and streaming decoding (operator 11).

Encoding.  A sequence of tokens is the one that merging by rank gives if and
only if each two neighbours are: merging the bytes of ``left + right`` gives
``left, right`` again.  So the merges compile into a non-deterministic
transducer whose states are (last token, place in the trie of tokens) and which
may close a token wherever its neighbour allows it; a place in the trie from
which no token goes on that the last one allows is left at once.  Every prefix of the input
has exactly one such sequence; the deterministic machine therefore keeps, for
the input read so far, the tree of the boundaries that some longer token may
still start from.  Where all of them agree on a token, it is emitted, so the
machine looks ahead no further than the longest token.  States and transitions
are made when they are first met and are kept until ``max_states`` of them are
held; then they are made anew, so memory is bounded for any text.

Decoding.  A machine over the bytes of the tokens keeps the unfinished UTF-8
sequence (3 bytes at most) from token to token and gives out whole characters;
its transitions by (unfinished bytes, token) are kept as well.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from earworm.llm.chunks import CACHED_CHARS
from earworm.llm.store import documents, neutral

REPLACEMENT = "�"


class Merges:
    """A rank file compiled: trie, the last merge of each token, and which
    tokens may stand side by side."""

    #: Answers of ``alive`` that are kept.
    MAX_ALIVE = 300_000

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {i: t for t, i in ranks.items()}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("needs a token for every byte")
        ids = max(self.bytes) + 1
        # of a token's last merge; -1: a single byte, or a token never made
        self.first_half, self.last_half = [-1] * ids, [-1] * ids
        self.joined: dict[int, int] = {}  # left << 32 | right -> the token that both make
        self.child: dict[int, int] = {}  # node * 256 + byte -> node; the root is 0
        self.token = [-1]  # the token that ends at a node
        for text, token in ranks.items():
            for cut in range(1, len(text)):
                left, right = ranks.get(text[:cut]), ranks.get(text[cut:])
                if left is not None and right is not None:
                    self.joined[left << 32 | right] = token
            if len(text) > 1:
                parts = self.merge(text, token)
                if len(parts) != 2:
                    continue  # merging never makes this token
                self.first_half[token], self.last_half[token] = ranks[parts[0]], ranks[parts[1]]
            node = 0
            for b in text:
                key = node << 8 | b
                node = self.child.get(key, -1)
                if node < 0:
                    node = self.child[key] = len(self.token)
                    self.token.append(-1)
            self.token[node] = token
        self.children: dict[int, list[int]] = {}
        for key, node in self.child.items():
            self.children.setdefault(key >> 8, []).append(node)
        self._longer: dict[int, list[int]] = {}
        self._alive: dict[int, bool] = {}

    def merge(self, text: bytes, below: int) -> list[bytes]:
        """Parts of ``text`` after all merges of ranks under ``below``, least
        rank first, leftmost first among equals."""
        ranks, parts = self.ranks, [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, i = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def neighbours(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives ``left, right`` again.

        The merges are undone from the last one back; nothing may ever have
        joined the two parts that then meet at the boundary before the undone
        merge came (of equal ranks, the one further left comes first).
        """
        joined, first_half, last_half = self.joined, self.first_half, self.last_half
        a, b, before = left, right, len(first_half) + 1
        while True:
            if joined.get(a << 32 | b, before) < before:
                return False
            tail, head = last_half[a], first_half[b]
            if head < 0 and tail < 0:
                return True
            if head < 0 or (tail >= 0 and a > b):
                before, a = a, tail
            else:
                before, b = b + 1, head

    def longer(self, node: int) -> list[int]:
        """Tokens that go on from a node of the trie, short ones first."""
        known = self._longer.get(node)
        if known is None:
            known, nodes = [], [node]
            while nodes:
                nodes = [below for n in nodes for below in self.children.get(n, ())]
                known += [self.token[n] for n in nodes if self.token[n] >= 0]
            self._longer[node] = known
        return known

    def alive(self, last: int, node: int) -> bool:
        """Whether a token that goes on from ``node`` may stand behind ``last``
        (-1: at the start)."""
        key = (last + 1) << 32 | node
        known = self._alive.get(key)
        if known is None:
            if len(self._alive) >= self.MAX_ALIVE:
                self._alive.clear()
            longer = self.longer(node)
            known = bool(longer) if last < 0 else any(self.neighbours(last, t) for t in longer)
            self._alive[key] = known
        return known


class State(dict):
    """``byte -> (state, tokens emitted)``.  ``tree`` holds, three numbers a
    boundary, parent, last token and trie node (or -1) of the open boundaries
    in reading order."""

    __slots__ = ("tree",)

    def __init__(self, tree: tuple[int, ...]):
        self.tree = tree

    def final(self) -> list[int]:
        """The tokens that are still to emit if the input ends here."""
        tree, out = self.tree, []
        at = len(tree) - 3
        while at > 0:
            out.append(tree[at + 1])
            at = 3 * tree[at]
        return out[::-1]


class Encoder:
    """The deterministic machine over the bytes of one pre-token."""

    def __init__(self, merges: Merges, max_states: int = 200_000):
        self.merges, self.max_states = merges, max_states
        self._forget()

    def _forget(self) -> None:
        self.states: dict[tuple[int, ...], State] = {}
        self.start = self._state((-1, -1, 0))

    def _state(self, tree: tuple[int, ...]) -> State:
        state = self.states.get(tree)
        if state is None:
            state = self.states[tree] = State(tree)
        return state

    def _step(self, state: State, byte: int) -> tuple[State, tuple]:
        merges = self.merges
        child, token_at, inner, alive = merges.child, merges.token, merges.children, merges.alive
        parents, lasts, nodes = [], [], []
        closed = shut = -1
        numbers = iter(state.tree)
        for parent, last, node in zip(numbers, numbers, numbers):
            if node >= 0:
                node = child.get(node << 8 | byte, -1)
                if node >= 0:
                    if shut < 0:
                        token = token_at[node]
                        if token >= 0 and (last < 0 or merges.neighbours(last, token)):
                            closed, shut = len(nodes), token  # no other boundary can close here too
                    if node not in inner or not alive(last, node):
                        node = -1
            parents.append(parent)
            lasts.append(last)
            nodes.append(node)
        parents.append(closed)
        lasts.append(shut)
        nodes.append(0)
        below = [0] * len(nodes)  # children that are open or have such children
        for i in range(len(nodes) - 1, 0, -1):
            if nodes[i] >= 0 or below[i]:
                below[parents[i]] += 1
        root, emitted = 0, []
        while nodes[root] < 0 and below[root] == 1:
            only = root + 1
            while parents[only] != root or (nodes[only] < 0 and not below[only]):
                only += 1
            root = only
            emitted.append(lasts[root])
        place = {root: 0}
        tree = [-1, lasts[root] if nodes[root] >= 0 else -1, nodes[root]]
        for i in range(root + 1, len(nodes)):
            if (nodes[i] >= 0 or below[i]) and parents[i] in place:
                tree += (place[parents[i]], lasts[i], nodes[i])
                place[i] = len(place)
        if len(self.states) >= self.max_states:
            self._forget()  # the state in hand lives on until it is left
        step = state[byte] = (self._state(tuple(tree)), tuple(emitted))
        return step

    def __call__(self, word: bytes) -> list[int]:
        state, out = self.start, []
        for byte in word:
            step = state.get(byte)
            if step is None:
                step = self._step(state, byte)
            state, emitted = step
            if emitted:
                out += emitted
        out += state.final()
        return out


class WordCache(dict):
    """``pre-token -> its ids as 32-bit integers``, of two generations of at
    most ``limit`` words; words of over ``CACHED_CHARS`` characters are not kept."""

    def __init__(self, encode: Encoder, limit: int):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = array("i", self.encode(word.encode())).tobytes()
        if len(word) <= CACHED_CHARS:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Decoder:
    """Token ids in, whole characters out; what is unfinished waits.

    A byte that cannot go on makes what waits one U+FFFD and is then read as a
    first byte; one that cannot be first is a U+FFFD itself.
    """

    def __init__(self, token_bytes: dict[int, bytes]):
        self.token_bytes = token_bytes
        self.steps: dict[bytes, dict[int, tuple[bytes, str]]] = {b"": {}}
        self.waiting = b""

    @staticmethod
    def _follow(lead: int) -> tuple[int, int, int]:
        """Bytes that a first byte still needs (-1: none can begin with it),
        and the range of the next one: no overlong forms, no surrogates,
        nothing beyond U+10FFFF."""
        if lead < 0x80:
            return 0, 0, 0
        if 0xC2 <= lead <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= lead <= 0xEF:
            return 2, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF
        if 0xF0 <= lead <= 0xF4:
            return 3, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF
        return -1, 0, 0

    def _step(self, waiting: bytes, token: int) -> tuple[bytes, str]:
        out = []
        for b in self.token_bytes[token]:
            if waiting:
                need, low, high = self._follow(waiting[0])
                if len(waiting) > 1:
                    low, high = 0x80, 0xBF
                if low <= b <= high:
                    waiting += bytes([b])
                    if len(waiting) == need + 1:
                        out.append(waiting.decode())
                        waiting = b""
                    continue
                out.append(REPLACEMENT)
                waiting = b""
            need = self._follow(b)[0]
            if need > 0:
                waiting = bytes([b])
            else:
                out.append(chr(b) if need == 0 else REPLACEMENT)
        return waiting, "".join(out)

    def feed(self, ids) -> str:
        """The characters that ``ids`` complete.  Unknown ids raise KeyError."""
        waiting, steps, out = self.waiting, self.steps, []
        row = steps.setdefault(waiting, {})
        for i in ids:
            step = row.get(i)
            if step is None:
                step = row[i] = self._step(waiting, i)
            if step[0] != waiting:
                waiting = step[0]
                if len(steps) > 10_000:
                    steps.clear()
                row = steps.setdefault(waiting, {})
            out.append(step[1])
        self.waiting = waiting
        return "".join(out)

    def end(self) -> str:
        """What waits at the end is one U+FFFD."""
        rest, self.waiting = (REPLACEMENT if self.waiting else ""), b""
        return rest


def read_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank on every line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


@lru_cache(maxsize=2)  # a worker process keeps machine and cache over its tasks
def word_ids(data: bytes, cache_words: int, max_states: int) -> WordCache:
    return WordCache(Encoder(Merges(read_ranks(data)), max_states), cache_words)


@lru_cache(maxsize=2)
def token_decoder(data: bytes) -> Decoder:
    return Decoder({rank: token for token, rank in read_ranks(data).items()})


def encode_ids(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", ids: str = "ids",
               decoded: str | None = None, cache_words: int = 250_000, max_states: int = 200_000) -> DataFrame:
    """``docs`` with the token ids of each row's whole text in ``ids`` (array
    of int) in place of ``text``, and, if asked for, what the ids decode to in
    ``decoded``.

    ``ranks`` is the content of a rank file (its size is the vocabulary's, not
    the data's; it is broadcast), ``pattern`` splits a text into the parts
    that merges never leave.  A map without shuffle; a worker process keeps at
    most ``2 * cache_words`` words and ``max_states`` states.  Null or empty
    text: no ids.  Null ids, repeated rows and columns of any name pass
    through.
    """
    import regex

    regex.compile(pattern)  # a wrong pattern is told here, not in a task
    names = [c for c in docs.columns if c != text] + [ids] + ([decoded] if decoded else [])
    plain, (text_column,) = neutral(docs, text)
    kept = [c for c in plain.columns if c != text_column]
    file = docs.sparkSession.sparkContext.broadcast(ranks)

    def encode(batches):
        words = word_ids(file.value, cache_words, max_states)
        decoder = Decoder(words.encode.merges.bytes)
        split, look = regex.compile(pattern).findall, words.__getitem__
        for batch in batches:
            parts = [b"".join(map(look, split(t))) for t in pc.fill_null(batch.column(0), "").to_pylist()]
            ends = np.cumsum([0] + [len(p) // 4 for p in parts])
            flat = pa.array(np.frombuffer(b"".join(parts), np.int32))
            made = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
            if decoded:
                made.append(pa.array([decoder.feed(memoryview(p).cast("i")) + decoder.end() for p in parts], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], schema.names)

    slim = plain.select(F.col(text_column).cast("string"), *kept)
    schema = slim.select(*kept).schema.add("ids", ArrayType(IntegerType()))
    if decoded:
        schema = schema.add("decoded", "string")
    return slim.mapInArrow(encode, schema).toDF(*names)


def decode_ids(df: DataFrame, ranks: bytes, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the decoded text of ``ids`` in ``text``, in its place.

    Ids of no token raise; bytes that are no UTF-8 become U+FFFD; null ids:
    empty text.  A map without shuffle.
    """
    names = [c for c in df.columns if c != ids] + [text]
    plain, (ids_column,) = neutral(df, ids)
    kept = [c for c in plain.columns if c != ids_column]
    file = df.sparkSession.sparkContext.broadcast(ranks)

    def decode(batches):
        decoder = token_decoder(file.value)
        for batch in batches:
            texts = [decoder.feed(row or ()) + decoder.end() for row in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], names=[*kept, "text"])

    slim = plain.select(F.col(ids_column).cast("array<int>"), *kept)
    return slim.mapInArrow(decode, slim.select(*kept).schema.add("text", "string")).toDF(*names)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents under byte_bpe_50k.tiktoken, and the digests of the
    ids and of what they decode to."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    encoded = encode_ids(documents(spark, sf_dir).select("doc_id", "text"), ranks, public_tokenizers.PATTERN,
                         decoded="decoded")
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
