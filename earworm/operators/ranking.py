"""Ground-truth lists and evaluation.

Metrics are computed in long form.  Predictions are ``(user, pos, item)`` rows
(or ``(pos, item)`` for one list shared by all users), truth is a set of
``(user, item)`` rows.  One aggregate per user; the only collected list is the
user's hit positions, at most k long, so no group is unbounded.

Formulas (positions from 1, T = truth set, k = cutoff, users with an empty T
score 0), equal to MLlib's RankingMetrics with (prediction, truth) order:

  MAP@k        sum over hits at pos <= k of (hits up to pos / pos) / min(|T|, k)
  MAP (k=None) the same over all positions, / |T|
  NDCG@k       sum over hits at pos <= k of 1/ln(pos+1) / IDCG(min(|T|, k))
  precision@k  hits at pos <= k / k
  recall@k     hits at pos <= k / |T|
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earworm.functions.exprs import ideal_dcg_sql
from earworm.operators.ordered import running_totals


def user_top_k(ratings: DataFrame, k: int = 100, user: str = "user_id",
               item: str = "recording_msid", score: str = "listens") -> DataFrame:
    """Each user's k items with the highest score, ties by item id.

    ``row_number() <= k`` lets Spark insert a WindowGroupLimit before the
    shuffle, so a user with millions of rows sends at most k per map task.
    """
    w = Window.partitionBy(user).orderBy(F.col(score).desc(), F.col(item).asc())
    return ratings.select(user, item, score, F.row_number().over(w).alias("pos")).where(
        F.col("pos") <= k
    )


def collect_ranked(long_form: DataFrame, user: str = "user_id", item: str = "recording_msid",
                   out: str = "items") -> DataFrame:
    """Long form -> one ordered array per user (at most k elements)."""
    return long_form.groupBy(user).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", item))), lambda s: s[item]).alias(out)
    )


def per_user_ranking(predictions: DataFrame, truth: DataFrame, k: int | None = 100,
                     user: str = "user_id", item: str = "recording_msid",
                     pos: str = "pos", users="truth", distinct_truth: bool = True) -> DataFrame:
    """Per-user AP, NDCG, precision and recall.

    One pass: truth rows are left-joined to the predictions (a hit gets its
    position), then one aggregate per user gives |T|, the hit count, the DCG
    and the sorted hit positions -- at most k of them -- from which AP
    follows.  No window, and the truth is read once.

    ``predictions`` without a user column is one list for everyone (popularity):
    it is joined on the item, and broadcast where ``k`` bounds it.
    ``users='truth'`` scores every truth user (a user without predictions
    scores 0); ``users='both'`` only users present in both (the reference's
    inner join of truth and recommendations); a DataFrame of users scores
    exactly those (a user with an empty truth set scores 0, as in MLlib).
    ``distinct_truth=False`` skips de-duplicating the truth when the caller
    knows each (user, item) occurs once (e.g. it comes from an aggregate).
    """
    t = truth.select(user, item)
    if distinct_truth:
        t = t.distinct()
    preds = predictions.select(*([user] if user in predictions.columns else []), pos, item)
    if k is not None:
        preds = preds.where(F.col(pos) <= k)
    if user in preds.columns:
        joined = t.join(preds, [user, item], "left")
    else:
        # k rows at most are broadcast; a list without a cutoff is of any length
        joined = t.join(F.broadcast(preds) if k is not None else preds, item, "left")

    per_user = joined.groupBy(user).agg(
        F.count(F.lit(1)).alias("_t"),
        F.count(pos).alias("_hits"),
        F.sum(F.lit(1.0) / F.log(F.col(pos).cast("double") + 1.0)).alias("_dcg"),
        F.array_sort(F.collect_list(pos)).alias("_hp"),
    )
    if isinstance(users, DataFrame):
        per_user = users.select(user).distinct().join(per_user, user, "left")
    elif users == "both" and user in preds.columns:
        per_user = per_user.join(preds.select(user).distinct(), user, "left_semi")
    per_user = per_user.fillna(0, subset=["_t", "_hits", "_dcg"])

    # One SQL projection (one JVM round trip).  AP numerator: the j-th hit
    # (1-based) at position p adds j / p.
    cap = "_t" if k is None else f"least(_t, {int(k)})"
    ap_sum = "aggregate(transform(coalesce(_hp, array()), (p, i) -> cast(i + 1 as double) / p), 0D, (a, x) -> a + x)"
    precision = f"cast(_hits as double) / {float(k)!r}" if k is not None else "cast(null as double)"
    return per_user.selectExpr(
        f"`{user}`",
        "_t AS n_truth",
        "_hits AS n_hits",
        f"CASE WHEN _t > 0 THEN {ap_sum} / {cap} ELSE 0D END AS ap",
        f"CASE WHEN _t > 0 THEN _dcg / ({ideal_dcg_sql(cap)}) ELSE 0D END AS ndcg",
        f"{precision} AS `precision`",
        "CASE WHEN _t > 0 THEN cast(_hits as double) / _t ELSE 0D END AS recall",
    )


def ranking_metrics(predictions: DataFrame, truth: DataFrame, k: int | None = 100,
                    user: str = "user_id", item: str = "recording_msid",
                    pos: str = "pos", users="truth", distinct_truth: bool = True) -> DataFrame:
    """One row: map, ndcg, precision, recall (means over users) and n_users."""
    per_user = per_user_ranking(predictions, truth, k, user, item, pos, users, distinct_truth)
    return per_user.agg(
        F.avg("ap").alias("map_at_k"),
        F.avg("ndcg").alias("ndcg_at_k"),
        F.avg("precision").alias("precision_at_k"),
        F.avg("recall").alias("recall_at_k"),
        F.count(F.lit(1)).alias("n_users"),
    )


def rmse(predictions: DataFrame, label: str = "listens", prediction: str = "prediction") -> DataFrame:
    """E5: one row with the root mean squared error; NaN/null predictions
    (cold-start users or items) are left out, as coldStartStrategy='drop' does."""
    ok = predictions.where(F.col(prediction).isNotNull() & ~F.isnan(prediction))
    return ok.agg(
        F.sqrt(F.avg(F.pow(F.col(label).cast("double") - F.col(prediction).cast("double"), 2))).alias("rmse"),
        F.count(F.lit(1)).alias("n_scored"),
    )


def relevance_labels(recommendations: DataFrame, truth: DataFrame, user: str = "user_id",
                     item: str = "recording_msid") -> DataFrame:
    """Recommended pairs of truth users, labelled 1.0 when the pair was
    observed in the truth and 0.0 otherwise (the defined label of D9)."""
    seen = truth.select(user, item).distinct().withColumn("label", F.lit(1.0))
    recs = recommendations.join(truth.select(user).distinct(), user, "left_semi")
    return recs.join(seen, [user, item], "left").fillna(0.0, subset=["label"])


def relevance_auc(labelled: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row with the area under ROC of ``score`` against a 0/1 ``label``
    (``relevance_labels`` makes one), n_pairs and n_relevant.

    A rank sum over the histogram of scores: a score's positives beat all
    negatives below it and half of those at it.  The running count of negatives
    is distributed (``running_totals``).  Null when one label is missing.
    """
    hist = labelled.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
    placed = running_totals(hist, "_s", "_neg")
    beaten = F.sum(F.col("_pos") * (F.col("before__neg") + F.col("_neg") / 2.0))
    pos, neg = F.sum("_pos"), F.sum("_neg")
    return placed.agg(
        F.coalesce(pos + neg, F.lit(0)).cast("bigint").alias("n_pairs"),
        F.coalesce(pos, F.lit(0)).cast("bigint").alias("n_relevant"),
        F.when((pos > 0) & (neg > 0), beaten / (pos.cast("double") * neg.cast("double"))).alias("auc"))


def hit_accuracy(recommendations: DataFrame, truth: DataFrame, user: str = "user_id",
                 item: str = "recording_msid") -> DataFrame:
    """Accuracy of "recommended" as a predictor of "observed".

    Over the pairs that are recommended or observed (truth users only): a
    recommended and observed pair is right, one side only is wrong.
    """
    t = truth.select(user, item).distinct().withColumn("_obs", F.lit(1))
    r = (recommendations.select(user, item).distinct()
         .join(truth.select(user).distinct(), user, "left_semi").withColumn("_rec", F.lit(1)))
    both = t.join(r, [user, item], "full")
    return both.agg(
        (F.sum(F.when(F.col("_obs").isNotNull() & F.col("_rec").isNotNull(), 1).otherwise(0))
         / F.count(F.lit(1))).alias("accuracy"),
        F.count(F.lit(1)).alias("n_pairs"),
    )
