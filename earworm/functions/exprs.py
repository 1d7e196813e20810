"""Column-expression helpers.  All are built-in Spark expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_POW_32 = float(2**32)


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql_name(c) -> str:
    return "`" + c.replace("`", "``") + "`"


#: How a null key is written in the hashed text.
NULL_KEY = "\\N"


def unit_hash(*keys: str, salt: str = "") -> Column:
    """A reproducible number in [0, 1) from the key columns.

    Rule: the first 8 hex digits of md5(salt || k1 [|| ':' || k2 ...]) read as an
    unsigned 32-bit integer, divided by 2^32; a null key is written as ``\\N``, so
    the result is never null and (null, 5) differs from (5, null).  Independent
    of partitioning and of row order, so a split is the same on every run and
    every cluster size, and SQL engines with md5 can state it too.  Built as one
    SQL expression (one round trip to the JVM instead of one per function).
    """
    null = NULL_KEY.replace("\\", "\\\\")
    parts = ", ':', ".join(f"coalesce(cast({_sql_name(k)} as string), '{null}')" for k in keys)
    return F.expr(f"cast(conv(substring(md5(concat('{salt}', {parts})), 1, 8), 16, 10) as double) / {_TWO_POW_32!r}")


def round_half_even(c, scale: int = 0) -> Column:
    """Banker's rounding (2.5 -> 2), as pandas/NumPy ``round`` does."""
    return F.bround(_as_col(c), scale)


def ideal_dcg_sql(m: str) -> str:
    """SQL text of sum_{j=1..m} 1/ln(j+1), the DCG of a perfect list with m
    relevant items, over the SQL expression ``m``."""
    return (f"CASE WHEN {m} <= 0 THEN 0D ELSE aggregate(sequence(1, cast({m} as int)), 0D, "
            f"(acc, j) -> acc + 1D / ln(cast(j as double) + 1D)) END")
