"""Top-k inner-product retrieval over factor vectors.

Both searches score on executors only, block against block.  A block of one
side is copied to those of the other, so blocks are as large as a task may hold
(``block_sizes``: some hundred MB with all that belongs to them, whatever the
tables hold) and are scored ``TILE`` queries by ``CHUNK`` items at a time.  No
row of a pair is emitted: each block gives its best k per query, and a per-query
top-k merges the blocks.

Scores are sums in the order of the coordinates.  A matrix product finds what
can enter a query's best k so far, with a margin for its rounding; that is then
summed in order, so a pair has the same score in every block and equal scores
are equal.  Ties go to the smaller item id, whatever their number.

Exact search (``mips_exact``) holds every query block against every item block.

Approximate search (``mips_lsh``) splits the items by the power of two of their
norm, reduces each class to nearest neighbours on the unit sphere (items are
divided by the class's bound and get the coordinate that completes them to norm
1, queries are normalised: the order of inner products does not depend on the
query's norm), hashes with Spark ML's BucketedRandomProjectionLSH and scores a
query against the items of its buckets.  A query with fewer than k candidates
is searched exactly.
"""

from __future__ import annotations

import sys
import time

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from earworm.session import write_once

# The scoring functions below run in Python workers; ship them by value so
# executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Queries of a block that are scored at a time, items that they are held
#: against at a time, and pairs summed at a time.
TILE, CHUNK, PAIRS = 256, 2048, 1 << 16
#: Numbers that the items, and the queries, of a block hold, and rows of its
#: result: what a task keeps is bounded by these.
ITEM_VALUES, QUERY_VALUES, FOUND = 1 << 23, 1 << 21, 1 << 22
#: Numbers of items that are still one block where each query comes once: its
#: best k of the block are the result, so no k rows a block are shuffled and merged.
ONE_BLOCK = 1 << 25
#: Beyond what the rounding of two lengths can amount to.
LENGTH_MARGIN = 1e-9
#: Blocks of queries of fewer rows are not made smaller to get more tasks.
LEAST, TASKS = 2048, 48
#: Partitions a block, and of all blocks where that is more: blocks are few and
#: heavy, so few of them may share a task.
SPREAD, MOST_PARTS = 2, 512


def block_sizes(rank: int | None, k: int) -> tuple[int, int]:
    """(items, queries) that a block holds at most, by the length of vectors."""
    rank = max(1, rank or 1)
    return max(LEAST, ITEM_VALUES // rank), max(LEAST, min(QUERY_VALUES // rank, FOUND // max(1, k)))


def query_blocks(n_queries: int, size: int, n_item_blocks: int) -> int:
    """Blocks of queries: of ``size`` at most, and enough for ``TASKS`` tasks
    where there are the queries for it."""
    return max(1, -(-n_queries // size), min(-(-n_queries // LEAST), -(-TASKS // max(1, n_item_blocks))))


def _values(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    """A column of vectors of one length as a matrix, 32-bit ones as such."""
    flat = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float32 if flat.dtype == np.float32 else np.float64).reshape(table.num_rows, -1)


def _in_order(q: np.ndarray, x: np.ndarray, rows: np.ndarray, cols: np.ndarray, single: bool = False) -> np.ndarray:
    """Inner products of the given pairs, summed in the order of coordinates;
    ``q`` and ``x`` hold a vector a column.  ``single``: in 32 bits, as Spark
    ML's models score."""
    out = np.empty(len(rows))
    for at in range(0, len(rows), PAIRS):
        r, c = rows[at: at + PAIRS], cols[at: at + PAIRS]
        kind = np.float32 if single else np.float64
        total = np.zeros(len(r), kind)
        for j in range(len(q)):
            total += q[j].take(r).astype(kind, copy=False) * x[j].take(c)
        out[at: at + PAIRS] = total
    return out


def _lengths(x: np.ndarray) -> np.ndarray:
    """Lengths of the vectors (columns)."""
    return np.sqrt(np.einsum("ij,ij->j", x, x, dtype=np.float64))


def _few_equal(x: np.ndarray, k: int) -> np.ndarray:
    """Places of the vectors (columns, by ascending id) that can be among the
    best k of a query: one that equals k vectors of smaller ids cannot, so ties
    of equal vectors stay few, whatever their number."""
    n = x.shape[1]
    if n <= k:
        return np.arange(n)
    key = np.zeros(n)
    for j, weight in enumerate(np.random.default_rng(0).standard_normal(len(x))):
        key += x[j] * weight
    order = np.argsort(key, kind="stable")
    if not (key[order[k:]] == key[order[:-k]]).any():
        return np.arange(n)
    same = np.concatenate([[False], (x[:, order[1:]] == x[:, order[:-1]]).all(axis=0)])
    first = np.flatnonzero(~same)
    place = np.arange(n) - first[np.cumsum(~same) - 1]
    return np.sort(order[place < k])


def _places(flags: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of flags few of which are set: eight at a time."""
    if flags.size % 8:
        return np.flatnonzero(flags)
    words = np.flatnonzero(flags.reshape(-1).view(np.uint64))
    row, col = np.nonzero(flags.reshape(-1, 8)[words])
    return words[row] * 8 + col


class _Best:
    """The best k of each query of a tile so far: scores and ranks of ids."""

    def __init__(self, n: int, k: int):
        self.scores, self.ranks = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)

    def take(self, rows: np.ndarray, ranks: np.ndarray, scores: np.ndarray) -> None:
        last, rank = self.scores[rows, -1], self.ranks[rows, -1]
        enters = (scores > last) | ((scores == last) & (ranks < rank))
        rows, ranks, scores = rows[enters], ranks[enters], scores[enters]
        if not len(rows):
            return
        order = np.argsort(rows, kind="stable")
        rows, ranks, scores = rows[order], ranks[order], scores[order]
        at, place, counts = np.unique(rows, return_inverse=True, return_counts=True)
        k, starts = self.scores.shape[1], np.cumsum(counts) - counts
        s = np.full((len(at), k + counts.max()), -np.inf)
        r = np.full(s.shape, np.iinfo(np.int64).max)
        s[:, :k], r[:, :k] = self.scores[at], self.ranks[at]
        col = k + np.arange(len(rows)) - starts[place]
        s[place, col], r[place, col] = scores, ranks
        best = np.lexsort((r, -s), axis=-1)[:, :k]
        self.scores[at], self.ranks[at] = np.take_along_axis(s, best, axis=1), np.take_along_axis(r, best, axis=1)


class _Items:
    """Items of a block, a vector a column, in the order in which they are
    scored; ``ranks`` are the places of their ids."""

    def __init__(self, x: np.ndarray, ranks: np.ndarray, single: bool = False):
        self.x, self.ranks, self.single = np.ascontiguousarray(x), ranks, single
        self.reach = float(np.abs(x).sum(axis=0, dtype=np.float64).max()) if x.size else 0.0

    def rounding(self, q: np.ndarray) -> tuple[type, np.ndarray]:
        """(kind of the matrix product, more than the rounding of a sum of
        products can amount to) of the queries ``q``."""
        most = np.abs(q).max(axis=1, initial=0.0).astype(np.float64)
        kind = np.float64
        if q.dtype == self.x.dtype == np.float32 and self.reach * most.max(initial=0.0) < 1e36:
            kind = np.float32
        eps = np.finfo(np.float32 if self.single else kind).eps
        return kind, 4 * len(self.x) * (eps * self.reach * most + (1e-37 if kind == np.float32 else 0.0))

    def scan(self, tile: np.ndarray, best: _Best, rows: np.ndarray, start: int, stop: int) -> None:
        """Hold the given rows of ``tile`` against the items start .. stop.

        A matrix product, of 32 bits where the vectors are, finds what can enter
        the best so far, with a margin for its rounding; only that is summed in
        order."""
        k, q = best.scores.shape[1], tile[rows]
        kind, margin = self.rounding(q)
        q, by_column, at, held, n_held = q.astype(kind, copy=False), np.ascontiguousarray(q.T), start, [], 0
        due = start + CHUNK

        def enter() -> None:
            r, c = (np.concatenate(part) for part in zip(*held))
            best.take(rows[r], self.ranks[c], _in_order(by_column, self.x, r, c, self.single))

        while at < stop:
            end = min(at + CHUNK, stop)
            scores = q @ self.x[:, at:end].astype(kind, copy=False)
            floor = best.scores[rows, -1] - margin
            if end - at > k and np.isneginf(floor).any():
                floor = np.maximum(floor, np.partition(scores, end - at - k, axis=1)[:, end - at - k] - 2 * margin)
            floor = np.nextafter(floor.astype(kind), kind(-np.inf))
            flat = _places(scores >= floor[:, None])
            if len(flat):
                r, c = np.divmod(flat, end - at)
                held.append((r, c + at))
                n_held += len(flat)
            at = end
            if held and (at >= due or at == stop or n_held > 2 * k * len(rows)):
                enter()
                held, n_held, due = [], 0, at + max(CHUNK, at - start)


def top_k_of_block(qids: np.ndarray, q: np.ndarray, iids: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """The best k items of a block per query, ties by smaller item id."""
    places, ids, scores, _ = _best_of_block(q, iids, x, k)
    return pd.DataFrame({"query_id": qids[places], "item_id": ids, "score": scores})


def _best_of_block(q: np.ndarray, iids: np.ndarray, x: np.ndarray, k: int, single: bool = False
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query place, item id, score, position) of the best k items of a block
    per query, ties by smaller item id (``single``: by larger).

    Long items come first, so few later ones enter a query's best k; a query is
    done when its length times the longest item left is below its k-th score."""
    by_id = np.argsort(iids, kind="stable")
    by_id = by_id[::-1] if single else by_id
    iids, x = iids[by_id], x[by_id].T
    few = _few_equal(x, k)
    length = _lengths(x[:, few])
    longest_first = np.argsort(-length, kind="stable")
    few, length = few[longest_first], length[longest_first]
    items, found = _Items(x[:, few], few, single), []
    for at in range(0, len(q), TILE):
        tile = q[at: at + TILE]
        best = _Best(len(tile), min(k, len(iids)))
        asked, beyond = _lengths(tile.T) * (1 + LENGTH_MARGIN), items.rounding(tile)[1]
        rows, start, width = np.arange(len(tile)), 0, CHUNK
        while len(rows) and start < len(few):
            stop = min(start + width, len(few))
            items.scan(tile, best, rows, start, stop)
            start, width = stop, 2 * width
            if start < len(few):  # one that cannot be compared stays
                with np.errstate(invalid="ignore", over="ignore"):
                    rows = rows[~(asked[rows] * length[start] + beyond[rows] < best.scores[rows, -1])]
        found.append(_found(best, at))
    rows, ranks, scores, pos = (np.concatenate(column) for column in zip(*found))
    return rows, iids[ranks], scores, pos


def _found(best: _Best, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query place, rank, score, position) of what a tile at place ``at`` has."""
    rows, cols = np.nonzero(best.ranks < np.iinfo(np.int64).max)
    return at + rows, best.ranks[rows, cols], best.scores[rows, cols], (cols + 1).astype(np.int32)


def _dealt(blocks: DataFrame, keys: list[str], n_blocks: int) -> DataFrame:
    """Blocks in partitions of a fixed number: by their bytes, which tell
    nothing of their work, several would be put into one task."""
    return blocks.repartition(max(n_blocks, min(SPREAD * n_blocks, MOST_PARTS)), *keys)


def _score_blocks(queries: DataFrame, items: DataFrame, keys: list[str], k: int, single: bool = False) -> DataFrame:
    """Best k per (query, block) of blocks that share ``keys``, with their
    positions; queries hold query_id and _qv, items item_id and _iv, ids of any
    type."""
    q_field, i_field = queries.schema["query_id"], items.schema["item_id"]
    q_type, i_type = to_arrow_type(q_field.dataType), to_arrow_type(i_field.dataType)

    def score(q: pa.Table, i: pa.Table) -> pa.Table:
        places, ids, scores, pos = np.zeros(0, np.int64), [], np.zeros(0), np.zeros(0, np.int32)
        if q.num_rows and i.num_rows:
            places, ids, scores, pos = _best_of_block(
                _matrix(q, "_qv"), _values(i, "item_id"), _matrix(i, "_iv"), k, single)
        return pa.table([q.column("query_id").combine_chunks().take(pa.array(places)).cast(q_type), pa.array(pos),
                         pa.array(ids, i_type), pa.array(scores)], names=["query_id", "pos", "item_id", "score"])

    # Both sides must carry identical key types, or cogroup hashes them apart.
    return queries.groupBy(*keys).cogroup(items.groupBy(*keys)).applyInArrow(
        score, f"query_id {q_field.dataType.simpleString()}, pos int, "
               f"item_id {i_field.dataType.simpleString()}, score double")


def _rank(cands: DataFrame, k: int, larger: bool = False) -> DataFrame:
    """Merge candidates: per-query top-k by (score desc, item asc or, with
    ``larger``, desc), positions 1..k.  Each query has at most k rows per block."""
    w = Window.partitionBy("query_id").orderBy(
        F.col("score").desc(), F.col("item_id").desc() if larger else F.col("item_id").asc())
    return cands.select("query_id", F.row_number().over(w).alias("pos"), "item_id", "score") \
        .where(F.col("pos") <= k)


def _sides(queries: DataFrame, items: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows with an id and a vector of both sides."""
    q = queries.select(F.col(id_col).alias("query_id"), F.col(vec_col).alias("_qv")).dropna()
    i = items.select(F.col(id_col).alias("item_id"), F.col(vec_col).alias("_iv")).dropna()
    return q, i


def _blocks(df: DataFrame, key: str, n: int, mine: str, other: str, n_other: int) -> DataFrame:
    """Each row in one block of its side, copied to every block of the other."""
    return df.withColumn(mine, F.pmod(F.xxhash64(key), F.lit(n)).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))


def _measured(df: DataFrame, vec: str) -> tuple[int, int | None]:
    """(rows, longest vector)."""
    return tuple(df.agg(F.count(F.lit(1)), F.max(F.size(vec))).first())


def mips_exact(queries: DataFrame, items: DataFrame, k: int = 10, id_col: str = "id",
               vec_col: str = "features", block_items: int | None = None, block_queries: int | None = None,
               single: bool = False, unique: bool = False) -> DataFrame:
    """Exact top-k items by inner product for every query vector.

    Returns ``(query_id, pos, item_id, score)``; ids keep their type.  The two
    sizes are counted first (two numbers come to the driver); they fix the
    number of blocks, nothing else.  A query is copied to every block of items
    and an item to every block of queries, so blocks are as large as a task may
    hold (``block_sizes``).  ``unique``: the caller knows that each query id
    comes once; where the items are one block (of ``ONE_BLOCK`` numbers at most),
    its result is the result.
    ``single``: scores of 32 bits and ties to the larger id, as Spark ML's
    models have them.
    """
    q, i = _sides(queries, items, id_col, vec_col)
    (n_q, _), (n_i, rank) = _measured(q, "_qv"), _measured(i, "_iv")
    most_i, most_q = block_sizes(rank, k)
    if unique and n_i * (rank or 1) <= ONE_BLOCK:
        most_i = max(most_i, n_i)
    n_ib = max(1, -(-n_i // (block_items or most_i)))
    n_qb = max(1, -(-n_q // block_queries)) if block_queries else query_blocks(n_q, most_q, n_ib)
    keys = ["_qx", "_ix"]
    found = _score_blocks(_dealt(_blocks(q, "query_id", n_qb, "_qx", "_ix", n_ib), keys, n_qb * n_ib),
                          _dealt(_blocks(i, "item_id", n_ib, "_ix", "_qx", n_qb), keys, n_qb * n_ib), keys, k, single)
    return found if unique and n_ib == 1 else _rank(found, k, single)


def _norm(vec: str):
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def _lsh_buckets(queries: DataFrame, items: DataFrame, id_col: str, vec_col: str, bucket_length: float,
                 num_tables: int, seed: int, hashes_per_table: int):
    """(keyed queries, keyed items): one row per vector and table, with norm
    class ``_c``, table ``_t`` and bucket ``_b``; queries once per class.

    A class holds the items whose norm lies in (2^(c-1), 2^c]; its bound is a
    fixed number, so an item of huge norm changes no other class.  Each table's
    bucket is the combination of ``hashes_per_table`` projections (AND), tables
    are alternatives (OR).  The bucket key is xxhash64 of the projections; a
    collision only merges two buckets.
    """
    q, i = _sides(queries, items, id_col, vec_col)
    i = i.withColumn("_n", _norm("_iv"))
    i = i.withColumn("_c", F.when(F.col("_n") > 0, F.ceil(F.log2("_n"))).otherwise(-2000).cast("int"))
    classes = i.select("_c").distinct()  # a row per power of two
    bound = F.when(F.col("_n") > 0, F.pow(F.lit(2.0), F.col("_c"))).otherwise(1.0)
    i = i.withColumn("_aug", array_to_vector(F.concat(
        F.transform("_iv", lambda x: x.cast("double") / bound),
        F.array(F.sqrt(F.greatest(F.lit(1.0) - (F.col("_n") / bound) * (F.col("_n") / bound), F.lit(0.0)))))))
    length = F.greatest(_norm("_qv"), F.lit(sys.float_info.min))
    q = q.withColumn("_aug", array_to_vector(F.concat(
        F.transform("_qv", lambda x: x.cast("double") / length), F.array(F.lit(0.0)))))
    r = max(1, int(hashes_per_table))
    lsh = BucketedRandomProjectionLSH(inputCol="_aug", outputCol="_h", bucketLength=bucket_length,
                                      numHashTables=num_tables * r, seed=seed).fit(i)

    def keyed(df: DataFrame, *keep: str) -> DataFrame:
        values = F.transform(F.col("_h"), lambda v: vector_to_array(v)[0])
        keys = F.transform(F.sequence(F.lit(0), F.lit(num_tables - 1)),
                           lambda t: F.xxhash64(F.slice(values, t * r + 1, r)))
        return lsh.transform(df).select(*keep, F.posexplode(keys).alias("_t", "_b"))

    # every query looks into every class
    per_class = classes.agg(F.collect_list("_c").alias("_cs"))
    q = q.select("*", F.explode(F.coalesce(per_class.scalar(), F.array().cast("array<int>"))).alias("_c"))
    return keyed(q, "query_id", "_qv", "_c"), keyed(i, "item_id", "_iv", "_c")


_KEY = ["_c", "_t", "_b"]


def _bucket_sizes(kq: DataFrame, ki: DataFrame) -> DataFrame:
    ni = ki.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("_ni"))
    nq = kq.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("_nq"))
    return ni.join(nq, _KEY)


#: Of the approximate search; see README for what they give on the fixture.
LSH_DEFAULTS = {"bucket_length": 0.5, "num_tables": 6, "hashes_per_table": 2, "seed": 1234}


def lsh_candidate_share(queries: DataFrame, items: DataFrame, id_col: str = "id", vec_col: str = "features",
                        **lsh) -> DataFrame:
    """The pairs that the LSH search scores, over all tables, and their
    share of all (query, item) pairs.  Below 1 the search does less than brute
    force.  One row."""
    p = {**LSH_DEFAULTS, **lsh}
    kq, ki = _lsh_buckets(queries, items, id_col, vec_col, **p)
    q, i = _sides(queries, items, id_col, vec_col)
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    parts = (
        _bucket_sizes(kq, ki).select((F.col("_ni") * F.col("_nq")).alias("_p"), zero.alias("_i"), zero.alias("_q"))
        .unionByName(i.select(zero.alias("_p"), one.alias("_i"), zero.alias("_q")))
        .unionByName(q.select(zero.alias("_p"), zero.alias("_i"), one.alias("_q")))
    )
    return parts.agg(F.sum("_p").alias("scored_pairs"), F.sum("_q").alias("n_queries"),
                     F.sum("_i").alias("n_items")).select(
        "scored_pairs", "n_queries", "n_items",
        (F.col("scored_pairs") / (F.col("n_queries") * F.col("n_items"))).alias("candidate_share"))


def mips_lsh(queries: DataFrame, items: DataFrame, k: int = 10, id_col: str = "id", vec_col: str = "features",
             block_items: int | None = None, block_queries: int | None = None, **lsh) -> DataFrame:
    """Approximate top-k by inner product (the columns of ``mips_exact``).

    A bucket is dealt into blocks by its size, so one that holds a third of all
    items is many bounded groups.  Every query gets its k items: those that
    their buckets leave with fewer are searched exactly.
    """
    p = {**LSH_DEFAULTS, **lsh}
    kq, ki = _lsh_buckets(queries, items, id_col, vec_col, **p)
    most_i, most_q = block_sizes(_measured(items, vec_col)[1], k)
    sizes = _bucket_sizes(kq, ki).select(
        *_KEY, F.ceil(F.col("_ni") / (block_items or most_i)).cast("int").alias("_ib"),
        F.ceil(F.col("_nq") / (block_queries or most_q)).cast("int").alias("_qb"))
    # Items go to one item block and are copied to each query block of their
    # bucket; queries go to one query block and are copied to each item block.
    it_b = ki.join(sizes, _KEY).select(
        *_KEY, F.pmod(F.xxhash64("item_id"), F.col("_ib")).cast("int").alias("_ix"),
        F.explode(F.sequence(F.lit(0), F.col("_qb") - 1)).alias("_qx"), "item_id", "_iv")
    qu_b = kq.join(sizes, _KEY).select(
        *_KEY, F.explode(F.sequence(F.lit(0), F.col("_ib") - 1)).alias("_ix"),
        F.pmod(F.xxhash64("query_id"), F.col("_qb")).cast("int").alias("_qx"), "query_id", "_qv")
    cands = _score_blocks(qu_b, it_b, [*_KEY, "_ix", "_qx"], k)
    # The same pair can meet in several hash tables.
    found = write_once(_rank(cands.groupBy("query_id", "item_id").agg(F.max("score").alias("score")), k))
    full = found.where(F.col("pos") == k).select(F.col("query_id").alias(id_col))
    short = queries.join(full, id_col, "left_anti")
    answered = found.join(full.withColumnRenamed(id_col, "query_id"), "query_id", "left_semi")
    return answered.unionByName(mips_exact(short, items, k, id_col, vec_col, block_items, block_queries))


def retrieval_recall(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Recall@k of an approximate result against the exact one (one row)."""
    found = approx.select("query_id", "item_id").withColumn("_f", F.lit(1))
    flagged = exact.select("query_id", "item_id").join(found, ["query_id", "item_id"], "left")
    return flagged.agg(F.count(F.lit(1)).alias("n_exact"), F.count("_f").alias("n_found")).select(
        (F.col("n_found") / F.col("n_exact")).alias("recall_at_k"), "n_exact", "n_found")


def bench_retrieval(queries: DataFrame, items: DataFrame, k: int = 10, id_col: str = "id",
                    vec_col: str = "features", **lsh_params) -> dict:
    """recall@k of LSH against exact search, and the seconds of each."""
    t0 = time.time()
    exact = write_once(mips_exact(queries, items, k, id_col, vec_col))
    t1 = time.time()
    approx = write_once(mips_lsh(queries, items, k, id_col, vec_col, **lsh_params))
    t2 = time.time()
    rec = retrieval_recall(approx, exact).first()
    return {"recall_at_k": rec["recall_at_k"], "exact_sec": t1 - t0, "lsh_sec": t2 - t1}
