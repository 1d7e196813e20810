"""Matrix factorization with Spark ML ALS.

ALS wants 32-bit integer ids.  ``index_ratings`` gives users and items dense
ids (identity.dense_ids), so the cast can never overflow or collide, unlike a
cast of ``monotonically_increasing_id``.  Recommendations come back in long
form ``(user, pos, item, score)`` with the original ids.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earworm.operators import few_items
from earworm.operators.identity import dense_ids
from earworm.operators.retrieve import mips_exact
from earworm.session import checkpoint_dir, table_path, write_once

UIDX, IIDX = "_uidx", "_iidx"


@dataclass
class Indexed:
    """Ratings with int ALS ids, and how to map ids back.

    ``users`` / ``items`` are ``(id, _idx)`` tables, or None when the original
    id is itself a valid ALS id (an integer in [0, 2^31)); ``user_type`` /
    ``item_type`` are the original id types.
    """

    ratings: DataFrame
    users: DataFrame | None
    items: DataFrame | None
    user: str = "user_id"
    item: str = "recording_msid"
    user_type: str = "bigint"
    item_type: str = "bigint"


def index_ratings(ratings: DataFrame, user: str = "user_id", item: str = "recording_msid",
                  value: str = "listens", checkpoint: bool = True, keep_ids: tuple[str, ...] = (),
                  label: Callable[[DataFrame], DataFrame] | None = None) -> Indexed:
    """Ratings with int user and item ids for ALS.

    Every id column gets dense ids, whatever its type and values, except those
    named in ``keep_ids``: the caller states that they are integers in
    [0, 2^31) (the cast raises otherwise).  The ratings (an aggregate, far
    smaller than the log) are read by the id passes, the join and every later
    fit and evaluation, so they are written once into the shared checkpoint
    folder, and so is the indexed result; both and the id passes run when this
    is called.  ``label`` adds columns to the result (a split, by row), so they
    are written with it and need no table of their own.
    """
    if checkpoint:
        ratings = write_once(ratings.select(user, item, value))
    types = dict(ratings.dtypes)
    users = None if user in keep_ids else dense_ids(ratings, user, UIDX)
    items = None if item in keep_ids else dense_ids(ratings, item, IIDX)
    idx = Indexed(ratings, users, items, user, item, types[user], types[item])
    rated = _encode(_encode(ratings, idx, "user"), idx, "item")
    indexed = to_als_frame(rated, UIDX, IIDX, value).select(user, item, UIDX, IIDX, value)
    if label is not None:
        indexed = label(indexed)
    if checkpoint and (users is not None or items is not None):
        # id-table joins were added: write again (a projection needs no table)
        indexed = write_once(indexed)
    idx.ratings = indexed
    return idx


def _encode(df: DataFrame, idx: Indexed, side: str) -> DataFrame:
    """Add the ALS id column of ``side`` ('user' or 'item') to ``df``."""
    col, table, out = (idx.user, idx.users, UIDX) if side == "user" else (idx.item, idx.items, IIDX)
    if table is None:
        # Ids outside the int range cannot be known to the model: drop them,
        # as the inner join with an id table would.
        return df.where(F.col(col).between(0, 2**31 - 1)).withColumn(out, F.col(col).cast("int"))
    return df.join(table, col)


def _decode(df: DataFrame, idx: Indexed, side: str) -> DataFrame:
    """Add the original id column of ``side`` to a frame holding its ALS id."""
    col, table, key, typ = ((idx.user, idx.users, UIDX, idx.user_type) if side == "user"
                            else (idx.item, idx.items, IIDX, idx.item_type))
    if table is None:
        return df.withColumn(col, F.col(key).cast(typ))
    return df.join(table, key)


def matrix_shape(indexed: Indexed) -> DataFrame:
    """The shape of the user x item matrix (one row); each side is counted
    by its own group-by."""
    users = indexed.ratings.groupBy(UIDX).agg(F.lit(1)).agg(F.count(UIDX).alias("n_users"))
    items = indexed.ratings.groupBy(IIDX).agg(F.lit(1)).agg(F.count(IIDX))
    return users.select("n_users", items.scalar().alias("n_items"))


def to_als_frame(ratings: DataFrame, user: str, item: str, value: str) -> DataFrame:
    """P10: int ids and float ratings.  ANSI casts raise on overflow."""
    return ratings.withColumns({
        user: F.col(user).cast("int"),
        item: F.col(item).cast("int"),
        value: F.col(value).cast("float"),
    })


#: ALS initialises its factors block by block, so the blocks are part of the
#: model: their number follows from the ratings alone, not from the cluster.  A
#: side has ``ALS_BLOCKS`` up to ``FEW_RATINGS``.  Beyond, every block more sends
#: the other side's factors once more in every iteration, so the more ratings a
#: factor of the other side has, the more blocks; and enough that a block's
#: ratings (12 bytes each) fit an executor and its systems (rank^3 / 3 steps each)
#: are no single task's work.
ALS_BLOCKS, FEW_RATINGS, RATINGS_PER_BLOCK, STEPS_PER_BLOCK = 4, 5_000_000, 60_000_000, 8_000_000_000
RATINGS_PER_COPY, LEAST_BLOCKS, MOST_BLOCKS = 16, 3, 12


def als_estimator(rank: int = 10, reg: float = 0.1, max_iter: int = 10, implicit: bool = False,
                  alpha: float = 1.0, nonnegative: bool = False, seed: int = 1234,
                  value: str = "listens", cold_start: str = "drop",
                  num_user_blocks: int = ALS_BLOCKS, num_item_blocks: int = ALS_BLOCKS,
                  checkpoint_interval: int = 10) -> ALS:
    """The ALS estimator on the dense id columns."""
    return ALS(
        rank=rank, regParam=reg, maxIter=max_iter, implicitPrefs=implicit, alpha=alpha,
        nonnegative=nonnegative, seed=seed, userCol=UIDX, itemCol=IIDX, ratingCol=value,
        coldStartStrategy=cold_start, numUserBlocks=num_user_blocks,
        numItemBlocks=num_item_blocks, checkpointInterval=checkpoint_interval,
    )


def als_blocks(n_ratings: int, n_rows: int = 0, n_other: int = 1, rank: int = 0) -> int:
    """Blocks of a side with ``n_rows`` factors of ``rank`` numbers; the other
    side has ``n_other``."""
    blocks = ALS_BLOCKS
    if n_ratings > FEW_RATINGS:
        blocks = min(MOST_BLOCKS, max(LEAST_BLOCKS, n_ratings // (RATINGS_PER_COPY * max(1, n_other))))
    return max(blocks, -(-n_ratings // RATINGS_PER_BLOCK), -(-n_rows * rank**3 // (3 * STEPS_PER_BLOCK)))


def rating_sizes(where: Column | None = None) -> tuple[Column, Column, Column]:
    """Aggregates of a ratings table that ``als_blocks`` wants: ratings, users,
    items (of the rows that ``where`` holds for)."""
    def of(col: Column) -> Column:
        return col if where is None else F.when(where, col)

    return (F.count(of(F.lit(1))), F.approx_count_distinct(of(F.col(UIDX))), F.approx_count_distinct(of(F.col(IIDX))))


def fit_als(indexed: Indexed, value: str = "listens", sizes: tuple[int, int, int] | None = None,
            held_out: DataFrame | None = None, stops: list[int] | None = None, **params):
    """R3 (explicit, e.g. nonnegative=True) and R4 (implicit=True).

    Blocks that are not given are counted from the ratings (``als_blocks``);
    ``sizes`` are the ``rating_sizes`` where the caller has them.  An explicit
    model of few items is fitted by ``few_items``, any other by Spark ML.

    With ``held_out`` (rows of ALS ids and values) no model is returned but a
    list: (predicted rows, sum of squared errors) after each number of iterations
    in ``stops``, instead of ``max_iter``.  ALS is a sequence, so a few-items fit
    of the most iterations passes through all others.

    Runs when called.  Factor lineage is cut every ``checkpoint_interval``
    iterations into the session's checkpoint folder, so a lost executor does
    not replay all iterations.
    """
    ratings = indexed.ratings
    checkpoint_dir(ratings.sparkSession)
    n, users, items = sizes or ratings.agg(*rating_sizes()).first()
    rank = params.get("rank", 10)
    if not {"num_user_blocks", "num_item_blocks"} <= params.keys():
        params = {"num_user_blocks": als_blocks(n, users, items, rank),
                  "num_item_blocks": als_blocks(n, items, users, rank), **params}
    estimator = als_estimator(value=value, **params)
    stops = sorted(stops or [estimator.getMaxIter()])
    if (n and stops[0] > 0 and not estimator.getImplicitPrefs() and estimator.getRegParam() > 0
            and few_items.few(items, rank)):
        return _fit_few_items(ratings, estimator, n, users, value, held_out, stops)
    if held_out is None:
        return estimator.fit(ratings)
    # in order, so the fit starts from the same tables whatever the partitions were
    ratings = ratings.repartition(8, UIDX).sortWithinPartitions(UIDX, IIDX)
    models = (estimator.copy({estimator.maxIter: most}).fit(ratings) for most in stops)
    return [_squared_errors(model, held_out, value) for model in models]


def _squared_errors(model: ALSModel, rows: DataFrame, value: str) -> tuple[int, float]:
    error = F.col("prediction").cast("double") - F.col(value).cast("double")
    row = model.transform(rows).agg(F.count(F.lit(1)).alias("n"), F.sum(error * error).alias("squares")).first()
    return row.n, row.squares or 0.0


def _fit_few_items(ratings: DataFrame, estimator: ALS, n: int, users: int, value: str,
                   held_out: DataFrame | None, stops: list[int]):
    """``fit_als`` by ``few_items``.  The first user factors are those of Spark
    ML, which depend on the users, the rank, the seed and the blocks: the factors
    of a fit of no iteration over one rating a user."""
    spark, rank = ratings.sparkSession, estimator.getRank()
    first = estimator.copy({estimator.maxIter: 0})
    one = ratings.groupBy(UIDX).agg(F.min(IIDX).alias(IIDX), F.lit(1.0).cast("float").alias(value))

    def kept(factors, known, item_factors) -> ALSModel:
        # a model that holds these factors: one of no iterations is saved, its tables replaced
        path = table_path(spark, "als")
        save_model(first.fit(spark.createDataFrame([(0, 0, 1.0)], f"{UIDX} int, {IIDX} int, {value} float")), path)
        few_items.user_table(spark, factors).write.mode("overwrite").parquet(f"{path}/userFactors")
        few_items.item_table(spark, known, item_factors).write.mode("overwrite").parquet(f"{path}/itemFactors")
        return load_model(path)

    found = few_items.fit(
        ratings, first.fit(one).userFactors, few_items.n_blocks(n, users, rank), stops,
        estimator.getRegParam(), estimator.getNonnegative(), UIDX, IIDX, value, held_out, kept)
    return found if held_out is not None else found[0]


def score_pairs(model: ALSModel, indexed: Indexed, pairs: DataFrame, user: str = "user_id",
                item: str = "recording_msid") -> DataFrame:
    """The model's prediction for (user, item) pairs given in original ids.
    Pairs with an unknown user or item are dropped (cold start)."""
    coded = _encode(_encode(pairs, indexed, "user"), indexed, "item")
    out = model.transform(coded)
    return out.where(~F.isnan("prediction")).drop(UIDX, IIDX)


def recommend_users(model: ALSModel, indexed: Indexed, users: DataFrame, k: int = 100,
                    user: str = "user_id", item: str = "recording_msid") -> DataFrame:
    """R7 + P14: top-k items for the given users, long form with positions.

    The lists of Spark ML's recommendForUserSubset, whose rows of a user grow
    with the blocks of 4,096 items and whose tasks are as few as the files of
    the model: blocks here are as large as a task may hold, one task gives a
    user's best items of a block, and the original ids go with the factors.
    Ties go to the larger id.
    """
    asked, held = factors_with_ids(model, indexed, user, item)
    asked = asked.join(users.select(F.col(user).alias("id")).distinct(), "id", "left_semi")
    found = mips_exact(asked, held, k, single=True, unique=True)
    return found.select(F.col("query_id").alias(user), "pos", F.col("item_id").alias(item), "score")


def factors(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    """(userFactors, itemFactors), each ``id int, features array<float>``."""
    return model.userFactors, model.itemFactors


def factors_with_ids(model: ALSModel, indexed: Indexed, user: str = "user_id",
                     item: str = "recording_msid") -> tuple[DataFrame, DataFrame]:
    """Factor tables keyed by the original ids (keeps ids comparable, D12)."""
    u = _decode(model.userFactors.withColumnRenamed("id", UIDX), indexed, "user") \
        .select(F.col(user).alias("id"), "features")
    i = _decode(model.itemFactors.withColumnRenamed("id", IIDX), indexed, "item") \
        .select(F.col(item).alias("id"), "features")
    return u, i


def save_factors(model: ALSModel, path: str) -> None:
    """Both factor tables as Parquet under ``path``."""
    model.userFactors.write.mode("overwrite").parquet(f"{path}/user_factors")
    model.itemFactors.write.mode("overwrite").parquet(f"{path}/item_factors")


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    """S6."""
    return ALSModel.load(path)


def tune_als(indexed: Indexed, grid: dict | None = None, folds: int = 2, parallelism: int = 2,
             method: str = "cv", train_ratio: float = 0.8, value: str = "listens", seed: int = 1234,
             **fixed):
    """Grid search by RMSE.

    ``method='cv'`` is k-fold CrossValidator (the reference uses 5 folds over
    rank {20,40,50} x reg {.01,.05,.1} x iterations {10,15}); ``'holdout'`` is
    one train/validation split per setting (TrainValidationSplit).  Returns
    ``(best_model, report)``; the report has one row per setting with its mean
    RMSE and the chosen one flagged -- read from the param maps, not from
    private JVM handles.
    """
    grid = grid or {"rank": [10, 20], "regParam": [0.05, 0.1], "maxIter": [5, 10]}
    est = als_estimator(value=value, seed=seed, **fixed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), values)
    maps = builder.build()
    ev = RegressionEvaluator(metricName="rmse", labelCol=value, predictionCol="prediction")
    checkpoint_dir(indexed.ratings.sparkSession)
    if method == "cv":
        tuner = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=ev,
                               numFolds=folds, parallelism=parallelism, seed=seed)
        fitted = tuner.fit(indexed.ratings)
        metrics = fitted.avgMetrics
    else:
        tuner = TrainValidationSplit(estimator=est, estimatorParamMaps=maps, evaluator=ev,
                                     trainRatio=train_ratio, parallelism=parallelism, seed=seed)
        fitted = tuner.fit(indexed.ratings)
        metrics = fitted.validationMetrics
    best = min(range(len(metrics)), key=lambda i: metrics[i])
    rows = [
        (int(m[est.rank]) if est.rank in m else est.getRank(),
         float(m[est.regParam]) if est.regParam in m else est.getRegParam(),
         int(m[est.maxIter]) if est.maxIter in m else est.getMaxIter(),
         float(metrics[i]), i == best)
        for i, m in enumerate(maps)
    ]
    spark = indexed.ratings.sparkSession
    report = spark.createDataFrame(rows, "rank int, reg_param double, max_iter int, rmse double, best boolean")
    return fitted.bestModel, report
