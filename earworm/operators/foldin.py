"""Factors of users that a model has not seen (R6, S6): folding in.

ALS solves a user's factor from the item factors by regularised normal
equations; a new user, or one with new listens, needs just that last step.
Per user the sums ``G = sum w y y'`` and ``b = sum v y`` are added up over the
user's ratings; then ``(G + reg * n * I) x = b``.

* explicit: ``w = 1``, ``v`` the rating, ``n`` the ratings
* implicit: ``w = alpha |r|``, ``v = 1 + alpha |r|`` where ``r > 0`` (else 0),
  ``n`` the positive ratings, and the Gram matrix of all items is added to G

which are the sums of Spark ML's ALS, so a user of the training set is given
that user's own factor.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earworm.operators.forest import _vectors

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ratings of a user that one task adds up; a user of more is several tasks'.
USER_ROWS = 100_000
#: Outer products held at a time, in numbers.
HELD = 1 << 22


def gram(item_factors: DataFrame, vec_col: str = "features") -> np.ndarray:
    """Sum of y y' over all items: rank x rank, added up per task first."""
    def partial(batches):
        total = None
        for batch in batches:
            y = _vectors(batch.column(0)).astype(np.float64)
            if len(y):
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], names=["g"])

    parts = item_factors.where(F.col(vec_col).isNotNull()).select(F.col(vec_col).cast("array<float>")).mapInArrow(
        partial, "g array<double>")
    cells = parts.select(F.posexplode("g").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
    rank = int(round(len(cells) ** 0.5))
    return np.array([c.v for c in cells]).reshape(rank, rank)


def nonnegative_solution(a: np.ndarray, b: np.ndarray, rounds: int = 2000, tol: float = 1e-10) -> np.ndarray:
    """argmin x'ax/2 - b'x over x >= 0, by coordinate descent."""
    x = np.zeros(len(b))
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(b)):
            new = max(0.0, x[j] + (b[j] - a[j] @ x) / a[j, j])
            moved, x[j] = max(moved, abs(new - x[j])), new
        if moved <= tol * max(1.0, float(np.abs(x).max())):
            break
    return x


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """(first column's value of each run of equal ones, run starts, row -> run, batch)."""
    for batch in batches:
        if not len(batch):
            continue
        codes = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        yield batch.column(0).take(pa.array(starts)), starts, batch


def _sums(ratings: DataFrame, rank: int, implicit: bool, alpha: float) -> DataFrame:
    """(user, n, sums): partial normal equations of each run of a user's rows;
    ``ratings`` has _user, _rating, _y, sorted by user within partitions."""
    kind = dict(ratings.dtypes)["_user"]
    step = max(1, HELD // (rank * rank))

    def add(batches):
        for whole in batches:
            for at in range(0, len(whole), step):
                for users, starts, batch in _runs([whole.slice(at, step)]):
                    r = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
                    y = _vectors(batch.column(2)).astype(np.float64)
                    w, v, n = np.ones(len(r)), r, np.ones(len(r))
                    if implicit:
                        w = alpha * np.abs(r)
                        v, n = np.where(r > 0, 1.0 + w, 0.0), (r > 0).astype(np.float64)
                    outer = (w[:, None] * y)[:, :, None] * y[:, None, :]
                    row = np.concatenate([n[:, None], v[:, None] * y, outer.reshape(len(r), -1)], axis=1)
                    sums = np.add.reduceat(row, starts)
                    yield pa.RecordBatch.from_arrays(
                        [users, pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), row.shape[1]).cast(
                            pa.list_(pa.float64()))], names=["_user", "_sums"])

    return ratings.select("_user", "_rating", "_y").mapInArrow(add, f"_user {kind}, _sums array<double>")


def fold_in(ratings: DataFrame, item_factors: DataFrame, reg: float = 0.1, implicit: bool = False, alpha: float = 1.0,
            nonnegative: bool = False, user: str = "user_id", item: str = "recording_msid", value: str = "listens",
            id_col: str = "id", vec_col: str = "features") -> DataFrame:
    """(id, features) of every user in ``ratings`` with an item of the model.

    Ratings of unknown items, and null users, items or ratings, add nothing; a
    user without any other has no row.  Repeated (user, item) rows count each.
    The ratings meet the item factors by a join; a user's sums are added up
    where the rows are, for users of over ``USER_ROWS`` ratings by several
    tasks, and solved from the sums (rank x rank numbers a user and task).
    """
    y = item_factors.select(F.col(id_col).alias("_item"), F.col(vec_col).cast("array<float>").alias("_y")).dropna()
    first = y.select(F.size("_y").alias("rank")).first()
    kind = dict(ratings.dtypes)[user]
    if first is None:
        return ratings.sparkSession.createDataFrame([], f"{id_col} {kind}, {vec_col} array<float>")
    rank = first["rank"]
    rows = ratings.select(F.col(user).alias("_user"), F.col(item).alias("_item"),
                          F.col(value).cast("double").alias("_rating")).dropna()
    parts = rows.groupBy("_user").agg(F.ceil(F.count(F.lit(1)) / USER_ROWS).cast("int").alias("_parts")).where("_parts > 1")
    dealt = rows.join(y, "_item").join(F.broadcast(parts) if parts.limit(10_001).count() <= 10_000 else parts, "_user", "left")
    dealt = dealt.withColumn("_part", F.coalesce(F.pmod(F.xxhash64("_item"), F.col("_parts")), F.lit(0)))
    sums = _sums(dealt.repartition("_user", "_part").sortWithinPartitions("_user", "_part"), rank, implicit, alpha)
    all_items = gram(item_factors, vec_col) if implicit else np.zeros((rank, rank))

    def solve(batches):
        for user_values, total in _totals(batches):
            n, b, g = total[:, 0], total[:, 1:1 + rank], total[:, 1 + rank:].reshape(-1, rank, rank)
            a = g + all_items + (reg * n)[:, None, None] * np.eye(rank)
            a += 1e-300 * np.eye(rank)  # no ratings and no regularisation: zeros
            x = np.stack([nonnegative_solution(m, v) for m, v in zip(a, b)]) if nonnegative else _solved(a, b)
            yield pa.RecordBatch.from_arrays(
                [user_values, pa.FixedSizeListArray.from_arrays(pa.array(x.astype(np.float32).ravel()), rank).cast(
                    pa.list_(pa.float32()))], names=[id_col, vec_col])

    return sums.repartition("_user").sortWithinPartitions("_user").mapInArrow(
        solve, f"{id_col} {kind}, {vec_col} array<float>")


def _solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(a, b[:, :, None])[:, :, 0]
    except np.linalg.LinAlgError:  # a singular one among them: least squares
        return np.stack([np.linalg.lstsq(m, v, rcond=None)[0] for m, v in zip(a, b)])


def _totals(batches) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Sums of each user from sorted partial ones; a user's may lie in several batches."""
    held = None
    for users, starts, batch in _runs(batches):
        total = np.add.reduceat(_vectors(batch.column(1)), starts)
        if held is not None:
            if held[0][0].equals(users[0]):
                total[0] += held[1][0]
            else:
                yield held
        if len(users) > 1:
            yield users.slice(0, len(users) - 1), total[:-1]
        held = users.slice(len(users) - 1), total[-1:]
    if held is not None:
        yield held


def score_with(user_factors: DataFrame, item_factors: DataFrame, pairs: DataFrame, user: str = "user_id",
               item: str = "recording_msid", id_col: str = "id", vec_col: str = "features") -> DataFrame:
    """``pairs`` with ``prediction``, the inner product of the pair's factors
    (R6); pairs with an unknown user or item are dropped."""
    u = user_factors.select(F.col(id_col).alias(user), F.col(vec_col).alias("_u"))
    i = item_factors.select(F.col(id_col).alias(item), F.col(vec_col).alias("_i"))
    product = F.aggregate(F.zip_with("_u", "_i", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0),
                          lambda acc, x: acc + x)
    return pairs.join(u, user).join(i, item).select(*pairs.columns, product.alias("prediction"))
