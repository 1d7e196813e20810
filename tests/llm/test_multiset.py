"""op2: order, insertion and deletion, the edited texts, the likeness."""

import collections
import hashlib
import math

from pyspark.sql import functions as F

from earworm.llm import multiset_hash as mh
from llm_corpus import frame, rows


def lanes(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    return {r.doc_id: r.lanes for r in mh.fingerprints(df).collect()}


def test_order_does_not_matter_but_number_does(spark):
    got = lanes(spark, "a\nb\nc", "c\na\nb", "a\nb", "a\nb\nc\nc", "", "\n", "a\nb\nC")
    assert got[0] == got[1]
    assert len({tuple(got[i]) for i in (0, 2, 3, 4, 5, 6)}) == 6
    assert set(got[4]) == {0} and all(len(v) == mh.LANES for v in got.values())


def test_insertion_and_deletion(spark):
    df = spark.createDataFrame([("a\nb", "c\nd\na", "d\nb\na\nc\na")], "x string, y string, z string")
    for c in "xyz":
        df = mh.with_lanes(df, c, f"l_{c}")
    row = df.select(mh.combine(F.col("l_x"), F.col("l_y")).alias("sum"), "l_z", "l_x",
                    mh.combine(F.col("l_z"), F.col("l_y"), -1).alias("left")).first()
    assert row["sum"] == row.l_z and row.left == row.l_x


def likeness(a, b):
    a, b = (collections.Counter(t.split("\n")) if t else collections.Counter() for t in (a, b))
    shared = sum(a[k] == b[k] for k in {*a, *b})
    return 1.0 if a == b else 2 * shared / (len({*a, *b}) + shared)


def test_edited_fingerprints_equal_brute_force(spark):
    data = rows()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.edited_sha256, r.n_chars, r.fingerprint, r.edited_fingerprint,
                  r.near_edited, r.near_next) for r in mh.edited_fingerprints(frame(spark, data), buckets=5).collect())
    order = sorted(data, key=lambda d: (d[0] is None, d[0] or 0, d[1] or ""))
    want = []
    for d, after in zip(order, order[1:] + order[:1]):
        t, n = d[1] or "", after[1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + n[:half]
        want.append((d[0] is None, d[0] or 0, hashlib.sha256(edited.encode()).hexdigest(), len(t),
                     likeness(t, edited), likeness(t, n), t))
    want.sort(key=lambda w: w[:4])
    assert [g[:4] for g in got] == [w[:4] for w in want]
    by_text = {}
    for g, w in zip(got, want):
        assert abs(g[6] - w[4]) < 0.3 and abs(g[7] - w[5]) < 0.3
        assert by_text.setdefault(w[6], g[4]) == g[4]
        assert len(g[4]) == 8 * mh.LANES
    texts = {tuple(sorted(t.split("\n"))) if t else () for t in by_text}
    assert len(set(by_text.values())) == len(texts)


def test_likeness_of_long_texts(spark):
    a = "\n".join(f"line {i}" for i in range(2000))
    b = "\n".join(f"line {i}" for i in range(1000, 3000))
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = mh.with_lanes(mh.with_lanes(df, "a", "la"), "b", "lb")
    assert abs(df.select(mh.likeness(F.col("la"), F.col("lb"))).first()[0] - 0.5) < 0.25


def test_likeness_at_any_number_of_lines(spark):
    for n in (50_000, 1_000_000):
        numbers = spark.range(n + n // 2)
        line = F.format_string("line %d", "id")
        df = numbers.agg(F.array_join(F.collect_list(F.when(F.col("id") < n, line)), "\n").alias("a"),
                         F.array_join(F.collect_list(F.when(F.col("id") >= n // 2, line)), "\n").alias("b"))
        df = mh.with_lanes(mh.with_lanes(df, "a", "la"), "b", "lb")
        a, b, got = df.select("a", "b", mh.likeness(F.col("la"), F.col("lb"))).first()
        assert abs(got - likeness(a, b)) < 0.25


def test_some_group_is_readable_at_any_bigint_count():
    assert math.log(mh.SPARSE / (mh.SPARSE - mh.FULL)) * mh.SPARSE * mh.GROUPS[-1] > 2 ** 63
    assert all(b == 8 * a for a, b in zip(mh.GROUPS, mh.GROUPS[1:])) and mh.GROUPS[-1] <= 2 ** 57


def test_short_lanes_are_whole_again(spark):
    df = spark.createDataFrame([("\n".join(map(str, range(n))),) for n in (0, 3, 900, 20_000)], "t string")
    df = mh.with_lanes(df, "t", "l")
    for r in df.select("l", mh.short(F.col("l")).alias("s"), mh.whole(mh.short(F.col("l"))).alias("w"),
                       mh.hex_of(F.col("l")).alias("h")).collect():
        assert r.w == r.l and len(r.s) < len(r.l) and r.h == "".join(f"{v:08x}" for v in r.l)


def test_next_row_under_any_bucket_number(spark):
    df = spark.range(0, 300, 3).select(F.col("id"), F.col("id").cast("string").alias("t")).repartition(7)
    for buckets in (1, 2, 9, 200, 5000):
        got = {r.id: r.next_t for r in mh.with_next(df, "id", "t", ["t"], buckets).collect()}
        assert got == {i: str((i + 3) % 300) for i in range(0, 300, 3)}


def test_empty_one_and_null_ids(spark):
    assert mh.edited_fingerprints(frame(spark, [])).count() == 0
    (r,) = mh.edited_fingerprints(frame(spark, rows()[:1])).collect()
    assert r.near_next == 1.0 and 0 <= r.near_edited <= 1
    nulls = [(None, t, "en", "a", 1, 1, "", 1, "", "") for t in ("b", "a", None)]
    assert mh.edited_fingerprints(frame(spark, nulls)).count() == 3


def test_runs_without_python(spark):
    plan = mh.edited_fingerprints(frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_compact_texts_of_fingerprints(spark):
    """As long as what the text took in; equal for equal texts in any order,
    and another text for each other fingerprint."""
    data = [*rows(), (7001, "one\ntwo", "en", "a", 1, 1, "", 1, "", ""), (7002, "two\none", "en", "a", 1, 1, "", 1, "", "")]
    wide = {r.doc_id: r for r in mh.edited_fingerprints(frame(spark, data)).collect()}
    slim = {r.doc_id: r for r in mh.edited_fingerprints(frame(spark, data), shown=mh.compact_of).collect()}
    for side in ("fingerprint", "edited_fingerprint"):
        same, other = {}, {}
        for i in wide:
            assert same.setdefault(wide[i][side], slim[i][side]) == slim[i][side]
            assert other.setdefault(slim[i][side], wide[i][side]) == wide[i][side]
    assert slim[7001].fingerprint == slim[7002].fingerprint
    for d in data:
        n = len((d[1] or "").split("\n"))
        assert d[0] is None or len(slim[d[0]].fingerprint) <= 8 * 9 + 12 * n * 3
