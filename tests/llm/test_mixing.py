"""op4: targets by repeated resharing, exact quotas, the shards."""

import collections
import math
import re

from pyspark.sql import functions as F

from earworm.llm import mixing
from earworm.llm.store import written
from llm_corpus import frame, rows


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, rest, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while rest > 1e-9 and free:
        total, add, rest = sum(weight[s] for s in free), rest, 0.0
        for s in free:
            target[s] += add * weight[s] / total
        for s in list(free):
            if target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                free.discard(s)
    return target


def mixed(spark, data, **options):
    sized = written(mixing.with_sizes(frame(spark, data), 42).drop("text"), "sizes")
    return mixing.mix(sized, sized, **options)


def check(data, got):
    sizes, taken = collections.Counter(), collections.Counter()
    for d in data:
        sizes[d[3]] += words(d[1])
    target = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, target[r.source])
        assert 0 <= r.taken_2 <= r._size and r.taken_1 <= r._size
        assert (r.shard_1 is None) == (r.taken_1 == 0) and (r.shard_2 is None) == (r.taken_2 == 0)
        taken[r.source] += r.taken_1 + r.taken_2
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)


def test_the_mix_takes_the_targets_to_the_word(spark):
    data = rows()
    for block_words, shard_words in ((10**6, 10**6), (200, 700), (20, 100)):
        got = mixed(spark, data, block_words=block_words, shard_words=shard_words).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(d[0]) for d in data)
        check(data, got)


def test_reruns_agree_under_any_partitioning(spark):
    data = [d for d in rows() if d[0] is not None and d != rows()[2]]
    runs = [{r.doc_id: (r.taken_1, r.taken_2, r.shard_1, r.shard_2) for r in mixing.mix(*[
        written(mixing.with_sizes(frame(spark, data, n), 42).drop("text"), "s")] * 2, block_words=100,
        shard_words=400).collect()} for n in (1, 6)]
    assert runs[0] == runs[1] and any(v[1] for v in runs[0].values())


def test_hypergeometric_follows_its_distribution(spark):
    n, k, d, m = 60, 22, 30, 20_000
    got = dict(spark.range(m).select(mixing.hypergeometric(
        F.lit(n), F.lit(k), F.lit(d), mixing._uniform(F.col("id"))).alias("x")).groupBy("x").count().collect())
    for x in range(23):
        p = math.comb(k, x) * math.comb(n - k, d - x) / math.comb(n, d)
        assert abs(got.get(x, 0) - m * p) <= 5 * math.sqrt(m * p) + 3
    edge = [(0, 0, 0), (5, 0, 2), (5, 5, 2), (5, 3, 5), (5, 3, 0), (10**7, 10**6, 10**6)]
    for total, marked, drawn in edge:
        x = spark.range(1).select(mixing.hypergeometric(F.lit(total), F.lit(marked), F.lit(drawn), F.lit(0.5))).first()[0]
        assert max(0, drawn - (total - marked)) <= x <= min(marked, drawn)
        if total > 100:
            assert abs(x - drawn * marked / total) < 5


def test_quotas_add_up(spark):
    blocks = [17, 0, 3, 250, 1]
    df = spark.createDataFrame(list(enumerate(blocks)), "rank int, blocks bigint")
    for depth in (0, 1, 4):
        got = {r["rank"]: r.ends for r in mixing.split_quotas(df, depth, 7).collect()}
        shares = [[b - a for a, b in zip([0, *got[i]], got[i])] for i in range(5)]
        assert [sum(s) for s in shares] == blocks and all(x >= 0 for s in shares for x in s)
        per_shard = [sum(s[j] for s in shares) for j in range(2 ** depth)]
        assert max(per_shard) - min(per_shard) <= depth + 1
    assert got[3] == {r["rank"]: r.ends for r in mixing.split_quotas(df, 4, 7).collect()}[3]


def test_place_by_bisection(spark):
    for depth in (0, 1, 3):
        ends = sorted((7 * i * i) % 23 for i in range(2 ** depth))
        df = spark.range(-1, 30).select("id", F.array(*[F.lit(e) for e in ends]).alias("ends"))
        got = df.select("id", mixing._place(F.col("ends"), F.col("id"), depth).alias("n")).collect()
        assert all(r.n == sum(e <= r.id for e in ends) for r in got)


def test_documents_of_the_mix(spark):
    data = rows()
    out = mixing.mixed_documents(frame(spark, data), block_words=100, shard_words=500)
    got = out.collect()
    assert out.columns == frame(spark, data).columns
    sizes = collections.Counter()
    for d in data:
        sizes[d[3]] += words(d[1])
    target, taken = brute_targets(sizes), collections.Counter()
    for r in got:
        taken[r.source] += words(r.text)
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    often = collections.Counter(str(r.doc_id) for r in got)
    held = collections.Counter(str(d[0]) for d in data)
    assert all(n <= 2 * held[i] for i, n in often.items())


def test_empty_table_and_sources_without_words(spark):
    assert mixed(spark, []).count() == 0
    assert mixing.mixed_documents(frame(spark, [])).count() == 0
    blank = [(i, t, "en", s, 0, 0, "", 0, "", "") for i, (t, s) in enumerate([("", "a"), (None, "b"), ("one two", "c")])]
    got = {r.doc_id: r.taken_1 + r.taken_2 for r in mixed(spark, blank).collect()}
    assert got == {0: 0, 1: 0, 2: 3}
    assert {r.target for r in mixed(spark, blank[:2]).collect()} == {0.0}


def test_runs_without_python(spark):
    plan = mixed(spark, rows())._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
