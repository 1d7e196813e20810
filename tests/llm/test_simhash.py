"""op9 against all pairs, and the pieces it is made of."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from earworm.llm import components, simhash
from llm_corpus import SCHEMA, frame, rows


def brute_fingerprint(text, k=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lower + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, radius=3):
    """{position: least id reachable} of (id, fingerprint) items."""
    up = list(range(len(items)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= radius:
                up[find(i)] = find(j)
    least = {}
    for i, (x, _) in enumerate(items):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return [least.get(find(i)) for i in range(len(items))]


def test_near_duplicates_equal_brute_force(spark):
    data = rows()
    rng = random.Random(4)
    long = " ".join(str(rng.random()) for _ in range(400))
    data += [(500 + i, long + f" changed {i}", "en", "a", 0, 0, "", 0, "", "") for i in range(8)]
    data += [(600, "A B c", "en", "a", 0, 0, "", 0, "", ""), (601, "a b C", "en", "a", 0, 0, "", 0, "", "")]
    items = [(d[0], brute_fingerprint(d[1])) for d in data]
    want = sorted((str(d[0]), f"{fp:016x}", c) for d, (_, fp), c in zip(data, items, brute_components(items)))
    got = simhash.near_duplicates(frame(spark, data))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got.collect()) == want
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want})  # some links are not copies


def test_links_join_what_all_pairs_join(spark):
    rng = random.Random(8)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(900):  # families, chains and pairs at the edge of the radius
        x = rng.choice(fps[-300:])
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    fps = sorted(set(fps))
    frame_ = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp bigint")
    links = simhash.near_links(frame_).collect()
    assert all((np.uint64(a & (1 << 64) - 1) ^ np.uint64(b & (1 << 64) - 1)).item().bit_count() <= 3 for a, b in links)
    node = {r.node: r.root for r in components.component_roots(
        spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    want = brute_components(list(zip(signed, fps)))
    assert [node.get(s, s) for s in signed] == want


def test_spanning_links_are_few():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 1, dtype=np.uint64)[0]
    fps = np.unique(np.array([base ^ np.uint64((1 << int(a)) | (1 << int(b))) for a, b in rng.integers(0, 64, (800, 2))],
                             np.uint64))
    links = simhash.spanning_links(fps, simhash.pivot_table(fps, simhash.pivot_references()), 3)
    assert len(links) == len(fps) - 1


def test_components_of_a_long_chain_and_a_star(spark):
    rng = random.Random(2)
    names = list(range(400))
    rng.shuffle(names)
    chain = list(zip(names, names[1:]))
    star = [(1000, 2000 + i) for i in range(300)]
    edges = spark.createDataFrame(chain + star + [(5, 5), chain[0]], "a bigint, b bigint")
    got = {r.node: r.root for r in components.component_roots(edges).collect()}
    assert got == {**{n: 0 for n in names}, 1000: 1000, **{2000 + i: 1000 for i in range(300)}}
    assert components.component_roots(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_row_of_each_component_stays(spark):
    data = rows()
    items = [(d[0], brute_fingerprint(d[1])) for d in data]
    kept = simhash.without_near_duplicates(frame(spark, data))
    groups = {}
    for (x, fp), c in zip(items, brute_components(items)):
        groups.setdefault(c if c is not None else f"null {fp}", set()).add(x)
    got = sorted(str(r.doc_id) for r in kept.collect())
    assert got == sorted(str(min((x for x in g if x is not None), default=None)) for g in groups.values())
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.without_near_duplicates(frame(spark, [])).count() == 0


def test_no_cross_join_in_the_plan(spark):
    plan = simhash.near_links(spark.range(10).select(F.col("id").alias("fp")))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def family(n: int, seed: int):
    """Distinct fingerprints that share 36 bits: one key of three blocks holds
    them all; some are near each other, most are not."""
    rng = random.Random(seed)
    shared = rng.getrandbits(64) & ~((1 << 28) - 1)
    out = set()
    while len(out) < n:
        x = shared | rng.getrandbits(28)
        out.add(x)
        if rng.random() < 0.2:
            out.add(x ^ (1 << rng.randrange(28)) ^ (1 << rng.randrange(28)))
    return sorted(out)


def test_a_key_of_many_fingerprints_is_dealt_on(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_ROWS", 100)
    fps = family(1500, 3) + [random.Random(9).getrandbits(64) for _ in range(200)]
    frame_ = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp bigint")
    links = simhash.near_links(frame_).collect()
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    node = {r.node: r.root for r in components.component_roots(
        spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert [node.get(s, s) for s in signed] == brute_components(list(zip(signed, fps)))
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in links)


def test_a_hot_key_is_many_bounded_tasks(spark):
    """20,000 distinct fingerprints under one key: the same components as with
    one task, no further key holds more than a part of them."""
    fps = family(20_000, 5)
    frame_ = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp bigint")
    links = simhash.near_links(frame_)
    node = {r.node: r.root for r in components.component_roots(links).collect()}
    array = np.array(fps, np.uint64)
    whole = simhash.spanning_links(array, simhash.pivot_table(array, simhash.pivot_references()), 3)
    pairs = spark.createDataFrame([(int(array[a].astype(np.int64)), int(array[b].astype(np.int64))) for a, b in whole],
                                  "a bigint, b bigint")
    want = {r.node: r.root for r in components.component_roots(pairs).collect()}
    assert node == want and len(want) > 1000
    stripes = [sum(1 << b for b in range(i, 64, 5)) for i in range(5)]
    for i in range(5):
        for j in range(i):
            kept = array & np.uint64(stripes[i] | stripes[j])
            assert np.unique(kept, return_counts=True)[1].max() < 2000
