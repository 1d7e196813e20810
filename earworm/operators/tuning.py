"""Grid search by RMSE that survives the driver and gives everywhere the same
folds (E9-E12).

Folds are a hash of user and item (functions.exprs.unit_hash), so a rating is in
the same fold on every cluster and in SQL.  Each (setting, fold) is one fit; its
result is written as one row into a ledger, a folder in shared storage, before
the next one counts.  A search that starts again, in this driver or another,
reads the ledger and fits only what is missing.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earworm.functions.exprs import unit_hash
from earworm.operators.factorize import IIDX, UIDX, Indexed, als_estimator, fit_als, rating_sizes
from earworm.session import checkpoint_dir, path_exists, write_once

FOLD_SALT = "f:"
#: ``als_estimator`` arguments that a grid may hold, and their defaults.
SETTING = {"rank": 10, "reg": 0.1, "max_iter": 10}
LEDGER = "rank int, reg double, max_iter int, fold int, n bigint, squares double"


def with_folds(ratings: DataFrame, folds: int, user: str = "user_id", item: str = "recording_msid",
               out: str = "fold") -> DataFrame:
    """``ratings`` with a fold 0 .. folds - 1 of every (user, item)."""
    return ratings.withColumn(out, F.floor(unit_hash(user, item, salt=FOLD_SALT) * folds).cast("int"))


def with_holdout(ratings: DataFrame, train_ratio: float, user: str = "user_id", item: str = "recording_msid",
                 out: str = "fold") -> DataFrame:
    """Fold 0 for the held-out rows, -1 for those that are always trained on."""
    held = unit_hash(user, item, salt=FOLD_SALT) >= F.lit(train_ratio)
    return ratings.withColumn(out, F.when(held, 0).otherwise(-1))


def settings_of(grid: dict[str, list]) -> list[dict]:
    """All settings of a grid, the last name running fastest."""
    unknown = set(grid) - set(SETTING)
    if unknown:
        raise ValueError(f"not of the grid: {sorted(unknown)}")
    return [{**SETTING, **dict(zip(grid, values))} for values in itertools.product(*grid.values())]


def ratings_fingerprint(ratings: DataFrame, *columns: str) -> str:
    """The number of rows and the sum of their hashes: a ledger of other
    ratings is not read."""
    n, total = ratings.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()
    return f"{n}:{total}"


class Ledger:
    """One folder a fit below ``path``; a folder counts once its writer has
    committed it, so a fit that a lost driver left half written is done again."""

    def __init__(self, spark, path: str, about: dict):
        self.spark, self.path = spark, path
        self.about = hashlib.md5(json.dumps(about, sort_keys=True).encode()).hexdigest()

    def _folder(self, setting: dict, fold: int) -> str:
        name = "_".join(f"{k}{setting[k]}" for k in SETTING)
        return f"{self.path}/{self.about}/{name}_fold{fold}"

    def get(self, setting: dict, fold: int) -> tuple[int, float] | None:
        folder = self._folder(setting, fold)
        if not path_exists(self.spark, f"{folder}/_SUCCESS"):
            return None
        row = self.spark.read.schema(LEDGER).parquet(folder).first()
        return row.n, row.squares

    def put(self, setting: dict, fold: int, n: int, squares: float) -> None:
        row = (*(type(SETTING[k])(setting[k]) for k in SETTING), fold, n, squares)
        self.spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("overwrite").parquet(self._folder(setting, fold))


def train_sizes(folded: DataFrame, folds: int) -> list[tuple[int, int, int]]:
    """``rating_sizes`` of what each fold's fits train on, in one pass: not once a fit."""
    row = folded.agg(*[size.alias(f"_{f}_{i}") for f in range(folds)
                       for i, size in enumerate(rating_sizes(F.col("fold") != f))]).first()
    return [tuple(row[3 * f: 3 * f + 3]) for f in range(folds)]


def fit_and_test(indexed: Indexed, folded: DataFrame, setting: dict, fold: int, value: str, fixed: dict,
                 sizes: tuple[int, int, int] | None = None, stops: list[int] | None = None) -> list[tuple[int, float]]:
    """(predicted rows, sum of squared errors) on one fold of a model fitted on
    the others, whose ``rating_sizes`` may be given, after each number of
    iterations in ``stops`` (ascending; the setting's by default)."""
    train, test = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
    return fit_als(replace(indexed, ratings=train), value=value, sizes=sizes, held_out=test,
                   stops=stops or [setting["max_iter"]], **setting, **fixed)


def tune(indexed: Indexed, grid: dict[str, list], folds: int = 5, train_ratio: float | None = None,
         value: str = "listens", parallelism: int = 2, ledger: str | None = None, refit: bool = True,
         **fixed) -> tuple[ALSModel | None, DataFrame]:
    """(best model, report): RMSE of each setting, the least flagged.

    With ``train_ratio``, one holdout fit a setting instead of ``folds``.  A
    setting's RMSE is the mean over the folds, as cross-validation averages it;
    equal ones go to the earlier setting.  ``indexed`` ratings hold the
    original ids.  ``fixed`` are further arguments of ``als_estimator``.
    ``ledger`` is a folder in shared storage (default: in the checkpoint
    folder); it may serve any number of searches, which are told apart by
    ratings, folds and fixed arguments.  ``refit`` fits the best setting on
    all ratings.
    """
    spark = indexed.ratings.sparkSession
    ledger = ledger or f"{checkpoint_dir(spark)}/als-ledger"
    als_estimator(value=value, **settings_of(grid)[0], **fixed)  # wrong arguments are told at once
    if train_ratio is None:
        folded = with_folds(indexed.ratings, folds, indexed.user, indexed.item)
    else:
        folded, folds = with_holdout(indexed.ratings, train_ratio, indexed.user, indexed.item), 1
    folded = write_once(folded)
    held = Ledger(spark, ledger, {
        "folds": folds, "train_ratio": train_ratio, "value": value, "fixed": fixed,
        "ratings": ratings_fingerprint(folded, indexed.user, indexed.item, value)})
    settings = settings_of(grid)
    sizes = train_sizes(folded, folds)

    # settings that differ in their iterations only are one fit, to the most of them
    groups: dict[tuple, list[int]] = {}
    for i, s in enumerate(settings):
        groups.setdefault(tuple(s[name] for name in SETTING if name != "max_iter"), []).append(i)
    results: dict[tuple[int, int], tuple[int, float]] = {}

    def fit_missing(at: tuple[list[int], int]) -> None:
        members, fold = at
        missing: dict[int, list[int]] = {}
        for i in members:
            results[i, fold] = held.get(settings[i], fold)
            if results[i, fold] is None:
                missing.setdefault(settings[i]["max_iter"], []).append(i)
        if not missing:
            return
        stops = sorted(missing)
        longest = settings[missing[stops[-1]][0]]
        for stop, found in zip(stops, fit_and_test(indexed, folded, longest, fold, value, fixed, sizes[fold], stops)):
            for i in missing[stop]:
                held.put(settings[i], fold, *found)
                results[i, fold] = found

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        list(pool.map(fit_missing, itertools.product(groups.values(), range(folds))))
    rmse = []
    for i in range(len(settings)):
        tested = [(n, s) for n, s in (results[i, fold] for fold in range(folds)) if n]
        rmse.append(sum((s / n) ** 0.5 for n, s in tested) / len(tested) if tested else float("inf"))
    best = min(range(len(settings)), key=rmse.__getitem__)
    report = spark.createDataFrame(
        [(s["rank"], float(s["reg"]), s["max_iter"], float(e), i == best) for i, (s, e) in enumerate(zip(settings, rmse))],
        "rank int, reg_param double, max_iter int, rmse double, best boolean")
    model = fit_als(indexed, value=value, **settings[best], **fixed) if refit else None
    return model, report
