"""Exact top-k inner products with norm bounds.

An inner product is at most the product of the lengths.  Items are put into
classes by descending length; a query goes through the classes in that order,
in rounds of growing width, and keeps its best k so far.  As soon as its length
times the longest item of a class is below its k-th score, no item of that
class or a later one can enter, and the query is done.

Rounds whose items fit one block run one after the other within a task, a query
copied to it once; only a round of more items than a block is dealt into
several, whose results are merged before the next round.  A query is copied
only to blocks that its bound lets it reach.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from earworm.operators.retrieve import (TILE, _Best, _dealt, _few_equal, _found, _Items, _matrix, _measured, _norm, _rank,
                                        _sides, _values, block_sizes, query_blocks)
from earworm.session import write_once

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Classes by length; a class of more items than a block is dealt into blocks.
MAX_CLASSES = 1024
#: Each round goes through so many times the classes that the last one did.
WIDEN = 4
#: Beyond what rounding of lengths and products can amount to.
MARGIN = 1e-9
_KEY = ["_ix", "_qx"]


def _by_length(items: DataFrame, block_items: int) -> tuple[DataFrame, list]:
    """(items with _n, _class and _blocks, [(longest, items, blocks) by class]).

    The class limits are approximate quantiles of the length (``MAX_CLASSES``
    numbers at most come to the driver); equal lengths share a class.
    """
    n_items = items.count()
    n_classes = max(1, min(MAX_CLASSES, math.ceil(n_items / block_items)))
    sized = items.withColumn("_n", _norm("_iv"))
    limits = []
    if n_classes > 1:
        shares = [1 - c / n_classes for c in range(1, n_classes)]
        limits = sorted(set(sized.agg(F.percentile_approx("_n", shares, 100 * MAX_CLASSES)).first()[0]), reverse=True)
    # class c holds the lengths below the c-th limit and not below the next
    bounds = F.array(*[F.lit(float(x)) for x in limits]).cast("array<double>")
    sized = sized.withColumn("_class", F.size(F.filter(bounds, lambda x: F.col("_n") < x)))
    classes = sized.groupBy("_class").agg(F.max("_n").alias("top"), F.count(F.lit(1)).alias("n")).orderBy("_class").collect()
    table = [(r["_class"], r.top, r.n, math.ceil(r.n / block_items)) for r in classes]
    return sized, table


def mips_bounded(queries: DataFrame, items: DataFrame, k: int = 10, id_col: str = "id", vec_col: str = "features",
                 block_items: int = 2048, block_queries: int | None = None, task_items: int | None = None,
                 unique: bool = False) -> DataFrame:
    """The rows of ``mips_exact``, without scoring the pairs that the
    bound rules out.  Runs when called, a job or two a run of rounds.

    ``block_items`` are the items of a class; a task holds ``task_items`` and
    ``block_queries`` at most (``block_sizes``).  ``unique`` as in
    ``mips_exact``."""
    return _search(queries, items, k, id_col, vec_col, block_items, block_queries, task_items, unique)[0]


def mips_bounded_share(queries: DataFrame, items: DataFrame, k: int = 10, id_col: str = "id",
                       vec_col: str = "features", block_items: int = 2048, block_queries: int | None = None,
                       task_items: int | None = None, unique: bool = False) -> DataFrame:
    """The pairs that ``mips_bounded`` scores and their share of all; one row."""
    spark = queries.sparkSession
    _, scored, n_q, n_i = _search(queries, items, k, id_col, vec_col, block_items, block_queries, task_items, unique)
    share = scored / (n_q * n_i) if n_q * n_i else None
    return spark.createDataFrame([(scored, n_q, n_i, share)],
                                 "scored_pairs bigint, n_queries bigint, n_items bigint, scored_share double")


def _runs(classes: list, most: int) -> list[list[list]]:
    """Classes in rounds of growing width, and the rounds in runs: those of a
    run fit one block, or it is a single round."""
    runs, at, width, held = [], 0, 1, 0
    while at < len(classes):
        round_, at, width = classes[at: at + width], at + width, width * WIDEN
        n = sum(c[2] for c in round_)
        if not runs or held + n > most:
            runs.append([])
            held = 0
        runs[-1].append(round_)
        held += n
    return runs


def _open(length: np.ndarray, kth: np.ndarray, top: float) -> np.ndarray:
    """Queries that a class may still change; kth -inf: fewer than k found."""
    with np.errstate(invalid="ignore"):
        return np.isneginf(kth) | (length * top >= kth - MARGIN * np.abs(kth))


def _through_rounds(q, length, kth, iids, x, classes, rounds, k):
    """((query place, item id, score, position) of the best k per query,
    scored pairs) of a block that goes through ``rounds`` of (class, longest)."""
    by_id = np.argsort(iids, kind="stable")
    by_id = by_id[np.argsort(classes[by_id], kind="stable")]
    rank = np.empty(len(iids), np.int64)
    rank[np.argsort(iids, kind="stable")] = np.arange(len(iids))
    sorted_ids = np.sort(iids, kind="stable")
    classes, x, ranks = classes[by_id], x[by_id].T, rank[by_id]
    sizes = {c: n for c, n in zip(*(v.tolist() for v in np.unique(classes, return_counts=True)))}
    few = _few_equal(x, k)  # equal vectors share a class and come in it by their ids
    items, kept = _Items(x[:, few], ranks[few]), classes[few]
    found, scored = [], 0
    for at in range(0, len(q), TILE):
        tile, n = q[at: at + TILE], len(q[at: at + TILE])
        best = _Best(n, k)
        # what is below the k-th score so far is not kept
        best.scores[:] = np.nextafter(kth[at: at + TILE], -np.inf)[:, None]
        full = ~np.isneginf(kth[at: at + TILE])
        for round_ in rounds:
            now = np.where(full, np.maximum(kth[at: at + TILE], best.scores[:, -1]), best.scores[:, -1])
            reached = -np.ones(n, np.int64)
            for c, top in round_:
                is_open = _open(length[at: at + TILE], now, top)
                reached[is_open] = c
                scored += int(is_open.sum()) * sizes.get(c, 0)
            rows = np.flatnonzero(reached >= 0)
            if not len(rows):
                break  # the bounds fall from class to class
            start, stop = np.searchsorted(kept, round_[0][0]), np.searchsorted(kept, reached.max(), "right")
            items.scan(tile, best, rows, int(start), int(stop))
        found.append(_found(best, at))
    rows, ranks, scores, pos = (np.concatenate(column) for column in zip(*found))
    return (rows, sorted_ids[ranks], scores, pos), scored


def _scorer(rounds, k, q_type, i_type):
    """Scores a block; its last row, at position 0, tells the scored pairs."""

    def score(q: pa.Table, i: pa.Table) -> pa.Table:
        found, n = (np.zeros(0, np.int64), [], np.zeros(0), np.zeros(0, np.int32)), 0
        if q.num_rows and i.num_rows:
            found, n = _through_rounds(_matrix(q, "_qv"), _values(q, "_length"), _values(q, "_kth"),
                                       _values(i, "item_id"), _matrix(i, "_iv"), _values(i, "_class"), rounds, k)
        places, ids, scores, pos = found
        asked = q.column("query_id").combine_chunks().cast(q_type)
        return pa.table([
            pa.concat_arrays([asked.take(pa.array(places)), pa.nulls(1, q_type)]), pa.array(np.append(pos, 0), pa.int32()),
            pa.concat_arrays([pa.array(ids, i_type), pa.nulls(1, i_type)]), pa.array(np.append(scores, 0.0)),
            pa.array(np.append(np.zeros(len(pos), np.int64), n))],
            names=["query_id", "pos", "item_id", "score", "scored"])

    return score


def _search(queries, items, k, id_col, vec_col, block_items, block_queries, task_items, unique):
    q, i = _sides(queries, items, id_col, vec_col)
    sized, classes = _by_length(i, block_items)
    sized = write_once(sized)
    n_items, rank = sum(c[2] for c in classes), _measured(sized, "_iv")[1]
    most_i, most_q = block_sizes(rank, k)
    most_i = task_items or most_i
    q = write_once(q.withColumn("_length", _norm("_qv")))
    n_queries = q.count()
    q_field, i_field = q.schema["query_id"], sized.schema["item_id"]
    q_type, i_type = to_arrow_type(q_field.dataType), to_arrow_type(i_field.dataType)
    kinds = f"query_id {q_field.dataType.simpleString()}, pos int, item_id {i_field.dataType.simpleString()}, score double"
    best, scored = None, 0
    for run in _runs(classes, most_i):
        held = [c for round_ in run for c in round_]
        first, last = held[0][0], held[-1][0]
        n_ib = max(1, -(-sum(c[2] for c in held) // most_i))
        n_qb = max(1, -(-n_queries // block_queries)) if block_queries else query_blocks(n_queries, most_q, n_ib)
        rounds = [[(c, float(top)) for c, top, *_ in round_] for round_ in run]
        if best is None:
            asked = q.withColumn("_kth", F.lit(float("-inf")))
        else:
            # a query's kth score bounds whether it goes on
            kth = best.where(F.col("pos") == k).select("query_id", F.col("score").alias("_kth"))
            asked = q.join(kth, "query_id", "left").withColumn("_kth", F.coalesce("_kth", F.lit(float("-inf"))))
            asked = asked.where((F.col("_kth") == float("-inf")) | (
                F.col("_length") * F.lit(held[0][1]) >= F.col("_kth") - MARGIN * F.abs(F.col("_kth"))))

        asked_blocks = asked.select(
            F.explode(F.sequence(F.lit(0), F.lit(n_ib - 1))).alias("_ix"),
            F.pmod(F.xxhash64("query_id"), F.lit(n_qb)).cast("int").alias("_qx"), "query_id", "_qv", "_length", "_kth")
        held_blocks = sized.where(F.col("_class").between(first, last)).select(
            F.pmod(F.xxhash64("item_id"), F.lit(n_ib)).cast("int").alias("_ix"),
            F.explode(F.sequence(F.lit(0), F.lit(n_qb - 1))).alias("_qx"), "item_id", "_iv", "_class")
        asked_blocks, held_blocks = (_dealt(side, _KEY, n_ib * n_qb) for side in (asked_blocks, held_blocks))
        found = write_once(asked_blocks.groupBy(*_KEY).cogroup(held_blocks.groupBy(*_KEY)).applyInArrow(
            _scorer(rounds, k, q_type, i_type), f"{kinds}, scored bigint"))
        n_scored = found.where(F.col("pos") == 0).agg(F.sum("scored")).first()[0] or 0
        scored += n_scored
        rows = found.where(F.col("pos") > 0).drop("scored")
        if best is not None or n_ib > 1 or not unique:
            rows = rows.drop("pos")
            rows = _rank(rows if best is None else rows.unionByName(best.drop("pos")), k)
            best = write_once(rows)
        else:
            best = rows
        if not n_scored:
            break  # the bounds fall from class to class
    if best is None:
        best = queries.sparkSession.createDataFrame([], kinds)
    return best, scored, n_queries, n_items


def recommend_bounded(user_factors: DataFrame, item_factors: DataFrame, k: int = 100, user: str = "user_id",
                      item: str = "recording_msid", **blocks) -> DataFrame:
    """R7 by norm bounds: (user, pos, item, score) of each user's best k items,
    from factor tables (id, features) by the original ids."""
    found = mips_bounded(user_factors, item_factors, k, **blocks)
    return found.select(F.col("query_id").alias(user), "pos", F.col("item_id").alias(item), "score")
