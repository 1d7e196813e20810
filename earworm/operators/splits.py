"""Reproducible train/validation splits and overlap reports (L1-L5, U2, U3,
P8, P9, J10).

Every split is a hash predicate on the key (functions.exprs.unit_hash): a
narrow, per-row expression.  No user id list is collected to the driver or
inlined into the plan, and the assignment does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earworm.functions.exprs import unit_hash
from earworm.session import write_once

USER_SALT = "u:"
HOLDIN_SALT = "h:"
ROW_SALT = "r:"
ROW_HOLDIN_SALT = "rh:"


def split_users(df: DataFrame, train_fraction: float = 0.7, holdin: float | None = None,
                user: str = "user_id", item: str = "recording_msid", out: str = "split") -> DataFrame:
    """Label rows 'train' / 'val' by user.

    With ``holdin`` (L3) that share of each validation user's (user, item)
    rows moves to train, so validation users are known to the model; the
    moved rows leave validation (no leakage).
    """
    in_train = unit_hash(user, salt=USER_SALT) < F.lit(train_fraction)
    if holdin is not None:
        in_train = in_train | (unit_hash(user, item, salt=HOLDIN_SALT) < F.lit(holdin))
    return df.withColumn(out, F.when(in_train, F.lit("train")).otherwise(F.lit("val")))


def split_rows(df: DataFrame, train_fraction: float = 0.7, holdin: float | None = 0.6,
               user: str = "user_id", item: str = "recording_msid", out: str = "split") -> DataFrame:
    """Row-level split of (user, item) pairs (L4): ``train_fraction`` to train,
    then ``holdin`` of the rest also to train; the remainder is validation."""
    in_train = unit_hash(user, item, salt=ROW_SALT) < F.lit(train_fraction)
    if holdin is not None:
        in_train = in_train | (unit_hash(user, item, salt=ROW_HOLDIN_SALT) < F.lit(holdin))
    return df.withColumn(out, F.when(in_train, F.lit("train")).otherwise(F.lit("val")))


def part(df: DataFrame, name: str, col: str = "split") -> DataFrame:
    return df.where(F.col(col) == F.lit(name)).drop(col)


def train_val(df: DataFrame, col: str = "split") -> tuple[DataFrame, DataFrame]:
    return part(df, "train", col), part(df, "val", col)


def restrict_to_seen(val: DataFrame, train: DataFrame, user: str = "user_id",
                     item: str = "recording_msid") -> DataFrame:
    """Validation rows whose user and item both occur in train."""
    return (
        val.join(train.select(user).distinct(), user, "left_semi")
        .join(train.select(item).distinct(), item, "left_semi")
    )


def split_three(df: DataFrame, train_fraction: float = 0.6, val_fraction: float = 0.2,
                user: str = "user_id", out: str = "split") -> DataFrame:
    """Label rows 'train' / 'val' / 'test' by user."""
    place = unit_hash(user, salt=USER_SALT)
    return df.withColumn(out, F.when(place < F.lit(train_fraction), F.lit("train")).when(
        place < F.lit(train_fraction + val_fraction), F.lit("val")).otherwise(F.lit("test")))


def split_overlap(labelled: DataFrame, user: str = "user_id", value: str | None = "listens",
                  label: str = "split", parts: tuple[str, ...] = ("train", "val")) -> DataFrame:
    """Sizes and user overlap of the parts of a labelled frame in one row (L5,
    U3, A10, A11, P7).

    One group-by on the user with a partial aggregate, then a sum: a part's
    users are those with rows in it, two parts' common users those with rows in
    both.  With two parts the overlap is ``common_users``, with more
    ``common_<a>_<b>`` for each pair.
    """
    def rows_of(p: str):
        return F.col(label) == F.lit(p)

    per_user = labelled.groupBy(user).agg(*[x for p in parts for x in (
        F.count_if(rows_of(p)).alias(f"_{p}"),
        F.count_if(rows_of(p) & (F.col(value) == 1) if value else F.lit(False)).alias(f"_{p}_1"))])
    pairs = [(a, b) for i, a in enumerate(parts) for b in parts[i + 1:]]
    cols = [F.count_if(F.col(f"_{p}") > 0).alias(f"{p}_users") for p in parts]
    cols += [F.count_if((F.col(f"_{a}") > 0) & (F.col(f"_{b}") > 0)).alias(
        "common_users" if len(pairs) == 1 else f"common_{a}_{b}") for a, b in pairs]
    cols += [F.coalesce(F.sum(f"_{p}"), F.lit(0)).cast("bigint").alias(f"{p}_rows") for p in parts]
    if value:
        cols += [F.coalesce(F.sum(f"_{p}_1"), F.lit(0)).cast("bigint").alias(f"{p}_listens_eq_1") for p in parts]
    return per_user.agg(*cols)


def split_exact(df: DataFrame, train_fraction: float = 0.7, keys: tuple[str, ...] = ("user_id",),
                salt: str = USER_SALT, out: str = "split") -> DataFrame:
    """Label rows 'train' / 'val' so that exactly floor(fraction * n) of the n
    distinct ``keys`` are in train: those least by (hash, keys).

    The hash is that of ``unit_hash``; its k-th smallest is found from counts
    of its first 16 bits, then of the other 16 inside one bucket (65,536 rows
    each at most), then among the keys of that one value.  Three numbers come
    to the driver; the rows are labelled by a comparison, not by a join.  Null
    keys are keys.
    """
    place = (unit_hash(*keys, salt=salt) * 2**32).cast("bigint")
    hashed = write_once(df.select(*keys).distinct().withColumn("_h", place))
    n_train = int(hashed.count() * train_fraction + 1e-9)
    if n_train <= 0:
        return df.withColumn(out, F.lit("val"))

    def bucket_of(rows: DataFrame, bucket, k: int) -> tuple[int, int]:
        """(bucket that holds the k-th smallest, rows before it)."""
        sizes = rows.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.orderBy("b")) - F.col("n")
        found = sizes.withColumn("before", before).where((F.col("before") < k) & (k <= F.col("before") + F.col("n"))).first()
        return found.b, found.before

    high, before = bucket_of(hashed, F.shiftright("_h", 16), n_train)
    inside = hashed.where(F.shiftright("_h", 16) == high)
    value, more = bucket_of(inside, F.col("_h"), n_train - before)
    last = inside.where(F.col("_h") == value).orderBy(*[F.asc_nulls_first(k) for k in keys]).limit(
        n_train - before - more).agg(F.max(F.struct(*keys)).alias("last")).first()["last"]
    types = dict(df.dtypes)
    limit = F.struct(*[F.lit(last[k]).cast(types[k]).alias(k) for k in keys])
    in_train = (place < value) | ((place == value) & (F.struct(*keys) <= limit))
    return df.withColumn(out, F.when(in_train, F.lit("train")).otherwise(F.lit("val")))
