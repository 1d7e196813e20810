"""Explicit ALS where the items are few: no factor of a user is ever sent.

Spark ML's ALS sends the factors of both sides to the other's blocks in every
half iteration and solves a system of rank x rank for every user.  Where the
item factors and the items' normal equations are small enough for a task
(``few``), the users' ratings stay where they are, in ``Block``s that each
belong to one partition: an iteration sends the item factors to the blocks,
solves the users there and sums the items' normal equations, which are all that
is shuffled.  A user with fewer ratings than the rank needs a system of that
many rows only (A'(AA' + cI)^-1 = (A'A + cI)^-1 A').

The model is Spark ML's: its regularization (by the number of ratings), its first
user factors, its order (items first), factors of 32 bits and sums of 64.
Non-negative factors are the exact solution of the constrained problem, found by
changing the set of positive coordinates until it fits (block pivoting), from the
set that the user had an iteration before; where that runs in a circle, by adding
one coordinate at a time (Lawson and Hanson).

A ``Block`` (plain arrays in a namespace, so that executors need no class of this
package) has ``users``; ``row``, ``item`` and ``value`` of their ratings in the
users' order, by places of users and items; ``by_item``, the ratings in the
items' order; ``held``, those not trained on; ``factors`` of the users and, of
non-negative ones, which coordinates are ``positive`` (bits).
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable
from types import SimpleNamespace as Block
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Numbers of the items' normal equations that a task may hold, and items.
FEW_VALUES, FEW_ITEMS = 1 << 24, 1 << 16
#: Ratings, and numbers of user factors, of a block.
BLOCK_RATINGS, BLOCK_VALUES = 1 << 18, 1 << 23
#: Numbers of the vectors that are solved at a time; changes of a set of
#: coordinates before they are added one at a time; what counts as zero.
BATCH, PIVOTS, ZERO = 1 << 17, 30, 1e-13
#: Tasks that sum and solve the items, and numbers of their equations for one.
GROUPS, GROUP_VALUES = 8, 1 << 18
#: Rows of a batch that is given back to Spark; where blocks are kept.
ROWS, LEVEL = 4096, StorageLevel.MEMORY_AND_DISK


def few(n_items: int, rank: int) -> bool:
    """Whether the items' factors and normal equations fit a task."""
    return n_items <= FEW_ITEMS and n_items * rank * (rank + 3) // 2 <= FEW_VALUES


def n_blocks(n_ratings: int, n_users: int, rank: int) -> int:
    return max(1, -(-n_ratings // BLOCK_RATINGS), -(-n_users * rank // BLOCK_VALUES))


def _nnls_one(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """min x'hx / 2 - c'x over x >= 0, coordinate after coordinate."""
    x, on = np.zeros(len(c)), np.zeros(len(c), bool)
    least = ZERO * max(np.abs(c).max(initial=0.0), 1e-300)
    for _ in range(10 * len(c) + 10):
        slope = np.where(on, -np.inf, c - h @ x)
        if slope.max() <= least:
            break
        on[slope.argmax()] = True
        while on.any():
            s = np.zeros(len(c))
            s[on] = np.linalg.solve(h[np.ix_(on, on)], c[on])
            if (s[on] > 0).all():
                x = s
                break
            out = on & (s <= 0)
            x = x + np.min(x[out] / (x[out] - s[out])) * (s - x)
            on &= ~(out & (x <= least * 1e-3)) & (x > 0)
            x[~on] = 0.0
    return x


def _nnls(h: np.ndarray, c: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(x, coordinates above zero) of each system, from a guess of the latter."""
    x, left = np.zeros(c.shape), np.arange(len(c))
    positive, diagonal = positive.copy(), np.arange(c.shape[1])
    least = ZERO * np.abs(c).max(axis=1, initial=0.0)[:, None]
    for _ in range(PIVOTS):
        on, hs, cs = positive[left], h[left], c[left]
        masked = hs * (on[:, :, None] & on[:, None, :])
        masked[:, diagonal, diagonal] += ~on
        s = np.linalg.solve(masked, np.where(on, cs, 0.0)[..., None])[..., 0]
        new = np.where(on, s > 0, cs - (hs @ s[..., None])[..., 0] > least[left])
        fits = (new == on).all(axis=1)
        x[left[fits]] = s[fits]
        positive[left] = new
        left = left[~fits]
        if not len(left):
            return x, positive
    for i in left:
        x[i] = _nnls_one(h[i], c[i])
        positive[i] = x[i] > 0
    return x, positive


def _nnls_by_rows(a: np.ndarray, b: np.ndarray, reg: float, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_nnls`` of h = a'a + reg I and c = a'b by systems of as many rows as ``a``."""
    x, left, final = np.zeros((len(a), a.shape[2])), np.arange(len(a)), positive.copy()
    diagonal, on, kept, rest = np.arange(a.shape[1]), positive, a, b
    for _ in range(PIVOTS):
        across = kept.transpose(0, 2, 1)
        k = (kept * on[:, None, :]) @ across
        k[:, diagonal, diagonal] += reg
        z = (across @ np.linalg.solve(k, rest[..., None]))[..., 0]
        new = z > ZERO * np.abs(z).max(axis=1, initial=0.0)[:, None]
        differs = (new != on).any(axis=1)
        fits = ~differs
        x[left[fits]], final[left[fits]] = np.where(on[fits], z[fits], 0.0), on[fits]
        left, kept, rest, on = left[differs], kept[differs], rest[differs], new[differs]
        if not len(left):
            return x, final
    h = kept.transpose(0, 2, 1) @ kept + reg * np.eye(a.shape[2])
    x[left], final[left] = _nnls(h, (kept.transpose(0, 2, 1) @ rest[..., None])[..., 0], on)
    return x, final


def solve_users(block: Block, v: np.ndarray, reg: float, nonnegative: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """(factors, positive coordinates as bits) of a block's users for the item
    factors ``v``; users of equally many ratings are solved together."""
    rank, n = v.shape[1], len(block.users)
    u, v = np.zeros((n, rank), np.float32), v.astype(np.float64)
    bits = np.zeros((n, -(-rank // 8)), np.uint8) if nonnegative else None
    counts = np.bincount(block.row, minlength=n)
    starts = np.cumsum(counts) - counts
    by_count = np.argsort(counts, kind="stable")
    edges = np.flatnonzero(np.diff(counts[by_count], prepend=-1, append=-1))
    for start, stop in zip(edges[:-1], edges[1:]):
        m = int(counts[by_count[start]])
        step = max(1, BATCH // max(1, m * rank))
        for at in range(start, stop if m else start, step):
            rows = by_count[at: min(at + step, stop)]
            places = starts[rows][:, None] + np.arange(m)
            a, b, c = v[block.item[places]], block.value[places].astype(np.float64), reg * m
            if nonnegative:
                guess = (np.unpackbits(block.positive[rows], axis=1, count=rank).astype(bool)
                         if block.positive is not None else np.ones((len(rows), rank), bool))
            if m < rank:
                if nonnegative:
                    x, on = _nnls_by_rows(a, b, c, guess)
                else:
                    k = a @ a.transpose(0, 2, 1)
                    k[:, np.arange(m), np.arange(m)] += c
                    x = (a.transpose(0, 2, 1) @ np.linalg.solve(k, b[..., None]))[..., 0]
            else:
                h = a.transpose(0, 2, 1) @ a
                h[:, np.arange(rank), np.arange(rank)] += c
                ab = (a.transpose(0, 2, 1) @ b[..., None])[..., 0]
                x, on = _nnls(h, ab, guess) if nonnegative else (np.linalg.solve(h, ab[..., None])[..., 0], None)
            u[rows] = x
            if nonnegative:
                bits[rows] = np.packbits(on, axis=1)
    return u, bits


def item_sums(block: Block, u: np.ndarray, n_items: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(upper triangles of u'u, u'value, ratings) of each item over a block."""
    rank = u.shape[1]
    upper = np.triu_indices(rank)
    h, c = np.zeros((n_items, len(upper[0]))), np.zeros((n_items, rank))
    counts = np.bincount(block.item, minlength=n_items)
    stops = np.cumsum(counts)
    for i in np.flatnonzero(counts):
        at = block.by_item[stops[i] - counts[i]: stops[i]]
        x = u[block.row[at]].astype(np.float64)
        h[i], c[i] = (x.T @ x)[upper], block.value[at].astype(np.float64) @ x
    return h, c, counts


def solve_items(h: np.ndarray, c: np.ndarray, counts: np.ndarray, reg: float, nonnegative: bool) -> np.ndarray:
    """Item factors from the sums over all blocks."""
    rank = c.shape[1]
    upper, v = np.triu_indices(rank), np.zeros(c.shape, np.float32)
    step = max(1, (1 << 22) // (rank * rank))
    for at in range(0, len(c), step):
        part = slice(at, at + step)
        whole = np.zeros((len(c[part]), rank, rank))
        whole[:, upper[0], upper[1]] = h[part]
        whole[:, upper[1], upper[0]] = h[part]
        whole[:, np.arange(rank), np.arange(rank)] += (reg * counts[part])[:, None]
        if nonnegative:
            v[part] = _nnls(whole, c[part], np.ones((len(whole), rank), bool))[0]
        else:
            v[part] = np.linalg.solve(whole, c[part][..., None])[..., 0]
    return v


def _in_blocks(ratings: DataFrame, first: DataFrame, held_out: DataFrame | None,
               n: int, user: str, item: str, value: str) -> RDD:
    """One ``Block`` a partition, with the first factors of its users and with
    items by their ids."""
    block = F.pmod(F.hash(user), F.lit(n))
    cols = [F.col(user).cast("int").alias("u"), F.col(item).cast("int").alias("i"),
            F.col(value).cast("float").alias("v"), block.alias("b")]
    rows = ratings.select(*cols, F.lit(False).alias("held"))
    if held_out is not None:
        rows = rows.unionByName(held_out.select(*cols, F.lit(True).alias("held")))
    first = first.select(F.col("id").alias("u"), "features", F.pmod(F.hash("id"), F.lit(n)).alias("b"))

    def pack(rated: pa.Table, factors: pa.Table) -> pa.Table:
        out = {"b": pa.array([], pa.int32()), "data": pa.array([], pa.binary())}
        if factors.num_rows:
            users = factors.column("u").to_numpy()
            flat = factors.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            order = np.argsort(users)
            users, first = users[order], flat.astype(np.float32).reshape(len(users), -1)[order]
            u, i, v, held = (rated.column(c).to_numpy() for c in ("u", "i", "v", "held"))
            order = np.lexsort((v, i, u))
            u, i, v, held = u[order], i[order], v[order], held[order].astype(bool)
            row = np.minimum(np.searchsorted(users, u), len(users) - 1).astype(np.int32)
            test = held & (users[row] == u)  # users that are not trained on have no prediction
            block = dict(users=users.astype(np.int32), row=row[~held], item=i[~held], value=v[~held],
                         held=(row[test], i[test], v[test]), factors=first, positive=None)
            out = {"b": rated.column("b").slice(0, 1).combine_chunks(), "data": pa.array([pickle.dumps(block)])}
        return pa.table(out)

    packed = rows.repartition(n, "b").groupBy("b").cogroup(first.repartition(n, "b").groupBy("b")).applyInArrow(
        pack, "b int, data binary")
    return packed.rdd.map(lambda r: (r.b, bytes(r.data))).partitionBy(n, lambda b: b).values().map(
        lambda data: Block(**pickle.loads(data)))


def _placed(known: np.ndarray):
    """Puts places in ``known`` for the items of a block; held-out rows of other
    items have no prediction."""
    def place(block: Block) -> Block:
        item = np.searchsorted(known, block.item).astype(np.int32)
        row, asked, value = block.held
        at = np.minimum(np.searchsorted(known, asked), len(known) - 1).astype(np.int32)
        test = known[at] == asked
        return Block(**{**vars(block), "item": item, "by_item": np.argsort(item, kind="stable").astype(np.int32),
                        "held": (row[test], at[test], value[test])})
    return place


def fit(ratings: DataFrame, first: DataFrame, n: int, stops: list[int], reg: float,
        nonnegative: bool, user: str, item: str, value: str, held_out: DataFrame | None = None,
        keep: Callable[[RDD, np.ndarray, np.ndarray], Any] | None = None) -> list:
    """Runs as many iterations as the last of ``stops`` (ascending); when called.

    ``first`` are the first factors (id, features) of all users of ``ratings``,
    ``n`` the blocks.  With ``held_out`` the result is (rows with a prediction,
    sum of their squared errors) after each stop's iterations; else what ``keep``
    makes of the user factors (an RDD of users and factors by blocks), the items
    and their factors, in one list.
    """
    sc = ratings.sparkSession.sparkContext

    def sums(block: Block):
        parts = item_sums(block, block.factors, n_items)
        for g in range(groups):
            yield g, tuple(p[g::groups] for p in parts)

    def solved(part: tuple) -> np.ndarray:
        return solve_items(*part, reg, nonnegative)

    def stepped(v):
        def step(block: Block) -> Block:
            u, positive = solve_users(block, v.value, reg, nonnegative)
            return Block(**{**vars(block), "factors": u, "positive": positive})
        return step

    def tested(v):
        def test(block: Block) -> tuple[int, float]:
            row, place, value = block.held
            predicted = np.einsum("ij,ij->i", block.factors[row], v.value[place])
            error = predicted.astype(np.float64) - value
            return len(row), float(error @ error)
        return test

    found, sent, before = [], [], None
    packed = blocks = _in_blocks(ratings, first, held_out, n, user, item, value).persist(LEVEL)
    try:
        each = blocks.map(lambda b: (np.unique(b.item), b.factors.shape[1])).collect()  # items are few
        known, rank = np.unique(np.concatenate([ids for ids, _ in each])), each[0][1]
        n_items = len(known)
        groups = min(n_items, GROUPS, 1 + n_items * rank * (rank + 3) // 2 // GROUP_VALUES)
        blocks = blocks.map(_placed(known)).persist(LEVEL)
        for done in range(1, stops[-1] + 1):
            parts = blocks.flatMap(sums).reduceByKey(
                lambda x, y: tuple(p + q for p, q in zip(x, y)), groups).mapValues(solved).collect()
            v = np.zeros((n_items, rank), np.float32)
            for g, part in parts:
                v[g::groups] = part
            (before or packed).unpersist()
            sent.append(sc.broadcast(v))
            before, blocks = blocks, blocks.map(stepped(sent[-1])).persist(LEVEL)
            if held_out is not None and done in stops:
                each = blocks.map(tested(sent[-1])).collect()  # two numbers a block
                found.append((sum(rows for rows, _ in each), sum(squares for _, squares in each)))
        return found if held_out is not None else [keep(blocks.map(lambda b: (b.users, b.factors)), known, v)]
    finally:
        for held in (packed, before or packed, blocks, *sent):
            held.unpersist()


def user_table(spark: SparkSession, factors: RDD) -> DataFrame:
    """(id, features) of an RDD of (users, factors) by blocks."""
    def rows(batches):
        for batch in batches:
            for users, flat in zip(*(batch.column(c).to_pylist() for c in (0, 1))):
                users, flat = np.frombuffer(users, np.int32), np.frombuffer(flat, np.float32)
                for at in range(0, len(users), ROWS):
                    part = users[at: at + ROWS]
                    rank = len(flat) // len(users)
                    starts = np.arange(len(part) + 1, dtype=np.int32) * rank
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), pa.ListArray.from_arrays(starts, flat[at * rank: (at + len(part)) * rank])],
                        names=["id", "features"])

    packed = spark.createDataFrame(factors.map(lambda b: (b[0].tobytes(), b[1].tobytes())), "users binary, factors binary")
    return packed.mapInArrow(rows, "id int, features array<float>")


def item_table(spark: SparkSession, items: np.ndarray, factors: np.ndarray) -> DataFrame:
    return spark.createDataFrame(list(zip(items.tolist(), factors.tolist())), "id int, features array<float>")
