"""op13: a replay of every order, document by document."""

import re
from collections import Counter
from itertools import permutations

from earworm.llm import filter_audit
from llm_corpus import frame, rows, text

import random

LABELS = "doc_id bigint, quality int, toxic int, part string"


def corpus():
    rng = random.Random(8)
    more = [text(rng, 220), text(rng, 250) + " #", "word " * 300, "Abc DEF " * 5, text(rng, 400) + " A$B", "100 % & more"]
    texts = more + more[:4] + [more[0]] * 5
    data = rows() + [(5000 + i, t, rng.choice(["en", "fr", "", None]), "s", 0, 0, "h", 5, "s", "t") for i, t in enumerate(texts)]
    data += [(5003, more[3], "en", "s", 0, 0, "h", 5, "s", "t"), (5003, "another text", "en", "s", 0, 0, "h", 5, "s", "t"),
             (None, more[1], "en", "s", 0, 0, "h", 5, "s", "t")]
    ids = sorted({d[0] for d in data if d[0] is not None})
    labels = [(i, rng.choice([0, 1, 2, None]), rng.choice([0, 1, None]), "x") for i in ids if rng.random() < 0.7]
    return data, labels + labels[:5] + [(ids[0], 1, 1, "x"), (None, 1, 1, "x"), (10**9, 1, 1, "x")]


def brute(data, labels):
    good = {i for i, q, _, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, _ in labels if t == 1 and i is not None}
    docs = []
    for d in data:
        t = d[1] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if d[0] is not None and any(o[0] is not None and o[0] < d[0] and (o[1] or "") == t for o in data):
            fails.add("E")
        docs.append((d[2] or "", fails, d[0] in good, d[0] in toxic))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            gone = [False] * len(mine)
            for step, letter in enumerate(order, 1):
                removed = [i for i, d in enumerate(mine) if letter in d[1] and not gone[i]]
                redundant = sum(letter in d[1] and gone[i] for i, d in enumerate(mine))
                for i in removed:
                    gone[i] = True
                shapley[part, letter] += len(removed)
                out[part, "".join(order), step] = (
                    gone.count(False), len(removed), redundant, sum(d[1] == {letter} for d in mine),
                    sum(mine[i][2] for i in removed), sum(mine[i][3] for i in removed))
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_every_order_against_a_replay(spark):
    data, labels = corpus()
    docs, marks = frame(spark, data), spark.createDataFrame(labels, LABELS)
    got = filter_audit.filter_orders(filter_audit.mask_cells(docs, marks))
    assert got.columns == ["part", "filter_order", "step", *filter_audit.METRICS, "shapley"]
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string", "int"] + ["bigint"] * 7
    found = {(r[0], r[1], r[2]): tuple(r[3:]) for r in got.collect()}
    assert found == brute(data, labels)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") != "-1"


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.filter_orders(filter_audit.mask_cells(frame(spark, []), none)).count() == 0
    assert filter_audit.filter_orders(filter_audit.mask_cells(frame(spark), none)).count() == 600 * 3


def test_more_prefixes_than_the_session_allows(spark):
    """1,000 parts, 325 prefixes each, and a row limit of 1,000 in the session."""
    spark.conf.set("spark.sql.cteRecursionRowLimit", "1000")
    try:
        cells = spark.range(1000).selectExpr("cast(id as string) part", "cast(id % 32 as int) mask", "id n", "0L good", "id toxic")
        got = filter_audit.filter_orders(cells)
        assert got.count() == 600_000
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "1000"
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")


def test_words_of_long_texts(monkeypatch):
    monkeypatch.setattr(filter_audit, "PIECE", 7)
    for t in ("", " ", "a", "aa bb aa", "word " * 50, "x" * 100 + " y\n\n z", " lead\ttail "):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        assert filter_audit.word_counts(t.encode()) == (len(words), len(set(words)))
