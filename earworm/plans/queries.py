"""Registered end-to-end queries: fixture -> operator chain -> result frame.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
test tables.  Doubles are rounded to a fixed number of digits at the very end
so that results compare exactly with the SQL oracle (plans/oracle.py).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earworm.operators import delta, identity, popularity, profile, ranking, ratings, sketches, splits
from earworm.session import checkpoint_dir, write_once
from earworm.sources import tables
from earworm.sources import testdata as td

K = 100          # list length of the popularity and ground-truth lists
DIGITS = 9       # rounding of double results


def _round(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.selectExpr(*[
        f"round(`{name}`, {digits}) AS `{name}`" if kind == "double" else f"`{name}`"
        for name, kind in df.dtypes
    ])


# ------------------------------------------------------------ building blocks
def canonical_counts_f1(spark, sf, dedupe=True) -> DataFrame:
    return identity.canonical_listens(td.listens_f1(spark, sf), td.tracks_f1(spark, sf), dedupe=dedupe)


def canonical_counts_f2(spark, sf, dedupe=True) -> DataFrame:
    return identity.canonical_listens(td.listens_f2(spark, sf), td.tracks_f2(spark, sf), dedupe=dedupe)


def _split_counts(log: DataFrame, label=lambda df: splits.split_users(df, 0.6)) -> DataFrame:
    """Listens per (user, item) with the user's split, written once: train
    list, truth and reports all read these counts, the log only once."""
    return write_once(label(ratings.count_listens(log, ts=None)))


def _top_list(train: DataFrame, model: str) -> DataFrame:
    """The popularity list from listen counts."""
    if model == "total":
        return popularity.popularity_total(train, K, weight="listens")
    return popularity.top_of(popularity.average_two_level(train, out="score"), K)


def _popularity_eval(spark, sf, model: str, per_user: bool = False, log=None) -> DataFrame:
    """The reference baseline (on F2 unless ``log`` is given): users split
    60/40, popularity list from the train log, truth = each validation user's
    top-K by listens."""
    counts = _split_counts(td.listens_f2(spark, sf) if log is None else log)
    train, val = splits.train_val(counts)
    top, truth = _top_list(train, model), ranking.user_top_k(val, K)
    if per_user:
        return _round(ranking.per_user_ranking(top, truth, K, distinct_truth=False))
    return _round(ranking.ranking_metrics(top, truth, K, distinct_truth=False))


# ------------------------------------------------------------ popularity
def popularity_map(spark: SparkSession, sf: str) -> DataFrame:
    """R1 + E1-E3: MAP / NDCG / precision / recall @100 of the total-listens list."""
    return _popularity_eval(spark, sf, "total")


def popularity_map_f1(spark, sf):
    """R1 + E1-E3 on the events log (F1)."""
    return _popularity_eval(spark, sf, "total", log=td.listens_f1(spark, sf))


def popularity_average_map_f1(spark, sf):
    """R2 + E1-E3 on the events log (F1)."""
    return _popularity_eval(spark, sf, "average", log=td.listens_f1(spark, sf))


def popularity_user_metrics(spark, sf):
    """Per-user AP, NDCG, precision, recall of R1 (long form of E1-E3)."""
    return _popularity_eval(spark, sf, "total", per_user=True)


def popularity_average_map(spark, sf):
    """R2 + E1-E3: metrics of the average-listens list."""
    return _popularity_eval(spark, sf, "average")


def popularity_total_top(spark, sf):
    """The top-100 items by total listens over the whole F2 log."""
    return _round(popularity.popularity_total(td.listens_f2(spark, sf), K))


def popularity_average_top(spark, sf):
    """The top-100 items by listens per distinct listener (F2)."""
    return _round(popularity.popularity_average(td.listens_f2(spark, sf), K))


def popularity_average_top_f1(spark, sf):
    return _round(popularity.popularity_average(td.listens_f1(spark, sf), K))


def popularity_list_text(spark, sf):
    """The top list as one ordered row (items joined as text)."""
    lst = popularity.popularity_list(popularity.popularity_total(td.listens_f2(spark, sf), K))
    return lst.select(F.array_join(F.transform("predicted_recording_msid", lambda x: x.cast("string")), ",")
                      .alias("predicted_recording_msid"))


def item_average_listens(spark, sf):
    """A3 for every item: total, distinct listeners, average (F2)."""
    return _round(popularity.item_average_listens(td.listens_f2(spark, sf)))


def average_two_level(spark, sf):
    """A4: sum(listens) / count(*) per item over listen counts (F2, raw items)."""
    return _round(popularity.average_two_level(ratings.count_listens(td.listens_f2(spark, sf))))


# ------------------------------------------------------------ counts and identity
def listen_counts_f1(spark, sf):
    return ratings.count_listens(td.listens_f1(spark, sf))


def listen_counts_f2(spark, sf):
    return ratings.count_listens(td.listens_f2(spark, sf))


def attach_inner(spark, sf):
    return identity.attach_tracks(td.listens_f2(spark, sf), td.tracks_f2(spark, sf), "inner")


def attach_left_f1(spark, sf):
    return identity.attach_tracks(td.listens_f1(spark, sf), td.tracks_f1(spark, sf), "left")


def canonical_map_f2(spark, sf):
    return identity.canonical_map(td.listens_f2(spark, sf), td.tracks_f2(spark, sf))


def canonical_log_f2(spark, sf):
    """I4 row by row: the canonicalized F2 log (mbid branch de-duplicated)."""
    return identity.canonicalize(td.listens_f2(spark, sf), td.tracks_f2(spark, sf))


def canonical_counts_f2_q(spark, sf):
    return canonical_counts_f2(spark, sf, dedupe=True)


def canonical_counts_f2_nodedupe(spark, sf):
    return canonical_counts_f2(spark, sf, dedupe=False)


def canonical_counts_f1_q(spark, sf):
    return canonical_counts_f1(spark, sf, dedupe=True)


def item_codes(spark, sf):
    """Dense codes over the union of the train and validation item
    vocabularies of the canonical F2 counts (sorted order, 0-based)."""
    labelled = splits.split_rows(canonical_counts_f2(spark, sf))
    train, val = splits.train_val(labelled)
    vocab = identity.item_vocabulary([train, val])
    return identity.dense_ids(vocab, "recording_msid", "codes")


def track_codes(spark, sf):
    """I1 on a string key: dense ids of the mbids of the track table."""
    return identity.dense_ids(td.tracks_f2(spark, sf), "recording_mbid", "mbid_id")


def encoded_ratings(spark, sf):
    """Canonical counts with the item replaced by its dense code."""
    return identity.encode_dense(canonical_counts_f2(spark, sf), "recording_msid", "codes")


def prepared_splits(spark, sf):
    """The whole preparation of the listen log: identity resolution, counts,
    dense item codes, 70/30 user split with 60 % hold-in (I4 A1 I1 J5 L2 L3)."""
    coded = identity.encode_dense(canonical_counts_f2(spark, sf), "recording_msid", "codes")
    return splits.split_users(coded, 0.7, holdin=0.6)


# ------------------------------------------------------------ profiles and filters
def rating_profile_f1(spark, sf):
    return _round(profile.profile_ratings(canonical_counts_f1(spark, sf)))


def rating_profile_f2(spark, sf):
    return _round(profile.profile_ratings(canonical_counts_f2(spark, sf)))


def null_profile_f1(spark, sf):
    """P13 on the left-joined F1 log."""
    return profile.profile_nulls(
        identity.attach_tracks(td.listens_f1(spark, sf), td.tracks_f1(spark, sf), "left"))


def complete_rows_f1(spark, sf):
    """Rows of the left-joined F1 log without any null."""
    return profile.drop_incomplete(
        identity.attach_tracks(td.listens_f1(spark, sf), td.tracks_f1(spark, sf), "left"))


def min_listens_f1(spark, sf):
    return ratings.filter_min_listens(canonical_counts_f1(spark, sf), 1)


def above_median_f1w(spark, sf):
    return ratings.filter_above_median(td.weighted_ratings_f1(spark, sf), 3)


def centered_ratings_f1w(spark, sf):
    return ratings.center_ratings(ratings.filter_above_median(td.weighted_ratings_f1(spark, sf), 3))


def centered_all_f2(spark, sf):
    """Centring without a count threshold, on canonical F2 counts."""
    return ratings.center_ratings(canonical_counts_f2(spark, sf))


# ------------------------------------------------------------ splits
def user_split_f1(spark, sf):
    return splits.split_users(canonical_counts_f1(spark, sf), 0.6)


def holdin_split_f1(spark, sf):
    return splits.split_users(canonical_counts_f1(spark, sf), 0.7, holdin=0.6)


def row_split_f1(spark, sf):
    return splits.split_rows(canonical_counts_f1(spark, sf), 0.7, holdin=0.6)


def split_overlap_f1(spark, sf):
    return splits.split_overlap(holdin_split_f1(spark, sf))


def split_overlap_f2(spark, sf):
    return splits.split_overlap(splits.split_users(canonical_counts_f2(spark, sf), 0.7, holdin=0.6))


def split_overlap_three(spark, sf):
    """L5 U3 over three parts: sizes and pairwise common users of train, val
    and test (F2, users 60/20/20)."""
    return splits.split_overlap(splits.split_three(canonical_counts_f2(spark, sf)), parts=("train", "val", "test"))


def popularity_val_test(spark, sf):
    """R1 + E1-E3 on validation and on test (F2, users 60/20/20): one row each."""
    counts = _split_counts(td.listens_f2(spark, sf), splits.split_three)
    top = _top_list(splits.part(counts, "train"), "total")
    scored = [ranking.ranking_metrics(top, ranking.user_top_k(splits.part(counts, p), K), K, distinct_truth=False)
              .withColumn("split", F.lit(p)) for p in ("val", "test")]
    return _round(scored[0].unionByName(scored[1]))


def seen_only_f1(spark, sf):
    labelled = write_once(splits.split_users(canonical_counts_f1(spark, sf), 0.7, holdin=0.6))
    train, val = splits.train_val(labelled)
    return splits.restrict_to_seen(val, train)


def seen_only_f2(spark, sf):
    labelled = write_once(splits.split_rows(canonical_counts_f2(spark, sf), 0.7, holdin=None))
    train, val = splits.train_val(labelled)
    return splits.restrict_to_seen(val, train)


# ------------------------------------------------------------ ground truth
def user_top_k_f2(spark, sf):
    return ranking.user_top_k(canonical_counts_f2(spark, sf), K)


def user_truth_lists(spark, sf):
    """Each user's ordered top-K as one text value."""
    lists = ranking.collect_ranked(ranking.user_top_k(listen_counts_f2(spark, sf), K))
    return lists.select("user_id", F.array_join(F.transform("items", lambda x: x.cast("string")), ",")
                        .alias("items"))


# ------------------------------------------------------------ left flow, string ids
def attach_left_gaps(spark, sf):
    """J2 with tracks that the dimension lacks: their rows stay, mbid null."""
    return identity.attach_tracks(td.listens_f1(spark, sf), td.tracks_f1_gaps(spark, sf), "left")


def null_profile_gaps(spark, sf):
    """P13 on a left join with unmatched rows."""
    return profile.profile_nulls(attach_left_gaps(spark, sf))


def canonical_counts_left(spark, sf):
    """I4 + A1 keeping listens of unknown tracks (left join)."""
    return identity.canonical_listens(td.listens_f1(spark, sf), td.tracks_f1_gaps(spark, sf), how="left")


def canonical_log_both(spark, sf):
    """I4 row by row, left join, de-duplicated in both branches."""
    return identity.canonicalize(td.listens_f1(spark, sf), td.tracks_f1_gaps(spark, sf), dedupe="both", how="left")


def encoded_left(spark, sf):
    """Counts left-joined to the codes of the items listened to more than
    twice in all; other items have a null code."""
    counts = canonical_counts_f2(spark, sf)
    frequent = popularity.item_totals(counts, weight="listens").where("total_listens > 2")
    codes = identity.dense_ids(frequent, "recording_msid", "codes")
    return identity.encode_items(counts, codes, how="left")


def string_ids_top(spark, sf):
    """The flow on text ids: log and tracks read by the library's readers
    (S1, S2), identity, dense codes, popularity list with the text ids."""
    folder = f"{checkpoint_dir(spark)}/string-ids-{uuid.uuid4().hex}"
    text_id = F.concat(F.lit("msid-"), F.col("recording_msid").cast("string"))
    tables.write_table(td.listens_f2(spark, sf).withColumn("recording_msid", text_id), f"{folder}/log")
    tables.write_table(td.tracks_f2(spark, sf).withColumn("recording_msid", text_id), f"{folder}/tracks")
    counts = identity.canonical_listens(tables.read_interactions(spark, f"{folder}/log"),
                                        tables.read_tracks(spark, f"{folder}/tracks"))
    codes = identity.dense_ids(counts, "recording_msid", "codes")
    coded = identity.encode_items(counts, codes, replace=True)
    top = popularity.popularity_total(coded, K, weight="listens")
    return top.join(codes.withColumnsRenamed({"recording_msid": "item", "codes": "recording_msid"}),
                    "recording_msid").select("pos", F.col("item").alias("recording_msid"), "score")


# ------------------------------------------------------------ evaluators on predictors from the data
def rmse_item_mean(spark, sf):
    """E5 (+ R6's shape): each validation pair predicted by its item's train
    mean; items without train rows are left out (F2, row split)."""
    labelled = write_once(splits.split_rows(canonical_counts_f2(spark, sf), 0.7, holdin=0.6))
    train, val = splits.train_val(labelled)
    means = train.groupBy("recording_msid").agg(F.avg("listens").alias("prediction"))
    return _round(ranking.rmse(val.join(means, "recording_msid", "left")))


def auc_popularity(spark, sf):
    """Does an item's total of listens tell which pairs are heard more than
    once (F1)?"""
    counts = write_once(canonical_counts_f1(spark, sf))
    totals = popularity.item_totals(counts, weight="listens", out="score")
    labelled = counts.join(totals, "recording_msid").withColumn("label", (F.col("listens") > 1).cast("int"))
    return _round(ranking.relevance_auc(labelled))


def _favourites(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(recommended, observed): each user's first ten items by code of the F1
    counts, and the pairs heard more than once."""
    counts = write_once(canonical_counts_f1(spark, sf))
    recommended = ranking.user_top_k(counts.withColumn("low", -F.col("recording_msid")), 10, score="low")
    return recommended, ratings.filter_min_listens(counts, 1)


def hit_accuracy_lists(spark, sf):
    """E7 on per-user lists that the data give."""
    recommended, observed = _favourites(spark, sf)
    return _round(ranking.hit_accuracy(recommended, observed))


def user_list_map(spark, sf):
    """E4 + J9: average precision without cutoff of per-user lists, joined on
    the user (users with both), as means."""
    recommended, observed = _favourites(spark, sf)
    per_user = ranking.per_user_ranking(recommended, observed, None, users="both", distinct_truth=False)
    return _round(per_user.agg(F.avg("ap").alias("map_all"), F.avg("recall").alias("recall"),
                               F.count(F.lit(1)).alias("n_users")))


def seen_precision_popularity(spark, sf):
    """precision@100 of the popularity list on validation pairs whose user
    and item occur in train, over users with such a pair (F2, row split)."""
    labelled = write_once(splits.split_rows(canonical_counts_f2(spark, sf), 0.7, holdin=None))
    train, val = splits.train_val(labelled)
    top = popularity.popularity_total(train, K, weight="listens")
    seen = splits.restrict_to_seen(val, train)
    return _round(ranking.ranking_metrics(top, seen, K, distinct_truth=False).select("precision_at_k", "n_users"))


def listen_counts_sql(spark, sf):
    """S8 + A1: the baseline's listen-count SQL over named views."""
    from earworm.sources.views import register_views
    register_views(spark, sf)
    return spark.sql("""
        SELECT user_id, recording_msid, COUNT(*) AS total_listens
        FROM listens_f2 GROUP BY user_id, recording_msid""")


def heavy_total_top(spark, sf):
    """T1/R1 in two passes: bounded summaries per task, then exact counts of
    the candidates that their error bound leaves."""
    found, _ = sketches.heavy_hitters(td.listens_f2(spark, sf), K)
    return found


def split_overlap_sketches(spark, sf):
    """U3/L5/A11 from stored sketches: the F2 log in two parts by (user, item),
    a sketch of the users of each part and year; sizes and overlaps of the years
    1993 to 1997 from the sketches alone (estimates beyond 4,096 users)."""
    years = F.year("timestamp").alias("year")
    labelled = splits.split_rows(td.listens_f2(spark, sf), 0.5, None).select("user_id", "split", years)
    stored = write_once(sketches.user_sketches(labelled, "year"))
    return sketches.sketch_overlap(stored.where("year between 1993 and 1997"), ("train", "val"))


def exact_split_f2(spark, sf):
    """L1/L2: exactly floor(0.7 n) of the users of F2 in train."""
    counts = ratings.count_listens(td.listens_f2(spark, sf))
    return splits.split_exact(counts, 0.7).select("user_id", "split").distinct()


def exact_row_split_f1(spark, sf):
    """L4 with exactly floor(0.7 n) of the (user, item) pairs of F1 in train."""
    counts = ratings.count_listens(td.listens_f1(spark, sf))
    return splits.split_exact(counts, 0.7, ("user_id", "recording_msid"), splits.ROW_SALT).drop("listens")


def canonical_counts_f2_delta(spark, sf):
    """I4 kept up batch by batch: the F2 log year by year, late years first."""
    log, tracks = td.listens_f2(spark, sf), td.tracks_f2(spark, sf)
    state = delta.IdentityState(spark, f"{checkpoint_dir(spark)}/identity-{uuid.uuid4().hex}")
    for part in (1997, 1996, 1995, 1994, 1993):
        year = F.year("timestamp")
        rows = log.where((year >= 1997) | year.isNull() if part == 1997 else (year <= 1993) if part == 1993 else year == part)
        state.merge(rows, tracks, str(part))
    return state.counts()


def canonical_changes_f1(spark, sf):
    """I4: what the listens of F1 at odd hours, coming after the others, change:
    mbids of another canonical item, with all their users' counts as they now
    are."""
    log, tracks = td.listens_f1(spark, sf), td.tracks_f1(spark, sf)
    state = delta.IdentityState(spark, f"{checkpoint_dir(spark)}/identity-{uuid.uuid4().hex}")
    odd = F.hour("timestamp") % 2 == 1
    state.merge(log.where(~odd), tracks, "even")
    return state.merge(log.where(odd), tracks, "odd").where("old_item is not null")


def laid_out_top(spark, sf):
    """T3/S3 + W1: listen counts written once in buckets by user, sorted; each
    user's top items from that table, without an exchange."""
    path = f"{checkpoint_dir(spark)}/laid-out-{uuid.uuid4().hex}"
    counts = ratings.count_listens(td.listens_f2(spark, sf))
    tables.write_laid_out(counts, path, ["user_id"], 16, ["recording_msid"])
    return ranking.user_top_k(tables.read_laid_out(spark, path), 10)


def csv_round_trip(spark, sf):
    """S4 + S7: listen counts as CSV without a header, item and count swapped,
    read back by position."""
    path = f"{checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    order = ["user_id", "listens", "recording_msid"]
    counts = ratings.count_listens(td.listens_f2(spark, sf))
    tables.write_table(counts.select(*order), path, fmt="csv", header=False)
    return tables.read_ratings(spark, path, fmt="csv", columns=order).select(
        "user_id", "recording_msid", F.col("listens").cast("bigint").alias("listens"))


def tuning_folds_f1(spark, sf):
    """The fold of every rating (five folds by hash of user and item)."""
    from earworm.operators import tuning

    return tuning.with_folds(ratings.count_listens(td.listens_f1(spark, sf)), 5)


REGISTRY = {
    "heavy_total_top": heavy_total_top,
    "split_overlap_sketches": split_overlap_sketches,
    "exact_split_f2": exact_split_f2,
    "exact_row_split_f1": exact_row_split_f1,
    "canonical_counts_f2_delta": canonical_counts_f2_delta,
    "canonical_changes_f1": canonical_changes_f1,
    "laid_out_top": laid_out_top,
    "csv_round_trip": csv_round_trip,
    "tuning_folds_f1": tuning_folds_f1,
    "listen_counts_sql": listen_counts_sql,
    "popularity_map": popularity_map,
    "popularity_map_f1": popularity_map_f1,
    "popularity_average_map_f1": popularity_average_map_f1,
    "popularity_user_metrics": popularity_user_metrics,
    "popularity_average_map": popularity_average_map,
    "popularity_total_top": popularity_total_top,
    "popularity_average_top": popularity_average_top,
    "popularity_average_top_f1": popularity_average_top_f1,
    "popularity_list": popularity_list_text,
    "item_average_listens": item_average_listens,
    "average_two_level": average_two_level,
    "listen_counts_f1": listen_counts_f1,
    "listen_counts_f2": listen_counts_f2,
    "attach_inner": attach_inner,
    "attach_left": attach_left_f1,
    "canonical_map": canonical_map_f2,
    "canonical_log": canonical_log_f2,
    "canonical_counts_f2": canonical_counts_f2_q,
    "canonical_counts_f2_nodedupe": canonical_counts_f2_nodedupe,
    "canonical_counts_f1": canonical_counts_f1_q,
    "item_codes": item_codes,
    "track_codes": track_codes,
    "encoded_ratings": encoded_ratings,
    "prepared_splits": prepared_splits,
    "rating_profile_f1": rating_profile_f1,
    "rating_profile_f2": rating_profile_f2,
    "null_profile": null_profile_f1,
    "complete_rows": complete_rows_f1,
    "min_listens": min_listens_f1,
    "above_median": above_median_f1w,
    "centered_ratings": centered_ratings_f1w,
    "centered_all_f2": centered_all_f2,
    "user_split": user_split_f1,
    "holdin_split": holdin_split_f1,
    "row_split": row_split_f1,
    "split_overlap": split_overlap_f1,
    "split_overlap_f2": split_overlap_f2,
    "seen_only": seen_only_f1,
    "seen_only_f2": seen_only_f2,
    "user_top_k": user_top_k_f2,
    "user_truth_lists": user_truth_lists,
    "split_overlap_three": split_overlap_three,
    "popularity_val_test": popularity_val_test,
    "attach_left_gaps": attach_left_gaps,
    "null_profile_gaps": null_profile_gaps,
    "canonical_counts_left": canonical_counts_left,
    "canonical_log_both": canonical_log_both,
    "encoded_left": encoded_left,
    "string_ids_top": string_ids_top,
    "rmse_item_mean": rmse_item_mean,
    "auc_popularity": auc_popularity,
    "hit_accuracy_lists": hit_accuracy_lists,
    "user_list_map": user_list_map,
    "seen_precision_popularity": seen_precision_popularity,
}
