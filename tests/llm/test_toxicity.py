"""op5: the solver against its optimum, held-out accuracy, odd inputs."""

import random

import numpy as np
import pytest

from earworm.llm import toxicity
from llm_corpus import frame, rows, text

BAD = ["vilewort", "scornling", "grimefoul", "hatebane"]


def planted(seed, n):
    """Texts, one in five toxic by one to four of the bad words (with endings)."""
    rng = random.Random(seed)
    docs, marks = [], []
    for i in range(n):
        words = text(rng, rng.randint(5, 150)).split(" ")
        toxic = i % 5 == 0
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(BAD) + rng.choice(["", "en", "ish"]))
        docs.append((i, " ".join(words), "en", "a", 0, 0, "", 0, "", ""))
        marks.append((i, int(rng.random() < 0.9), int(toxic)))
    return docs, marks


LABELS = "doc_id bigint, quality int, toxic int"


def test_logistic_finds_the_optimum():
    rng = np.random.default_rng(1)
    x = (rng.random((300, 6)) < 0.4).astype(np.float32)
    y = rng.random(300) < 1 / (1 + np.exp(-(x @ np.array([2, -1, 0, 1, 0, 0]) - 1)))
    w = toxicity.logistic(x, y, l2=0.01, steps=2000)
    weight = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum())
    one = np.concatenate([x, np.ones((300, 1))], axis=1)
    p = 1 / (1 + np.exp(-one @ w))
    gradient = one.T @ (weight * (p - y)) + 0.01 * np.append(w[:-1], 0)
    assert np.abs(gradient).max() < 1e-3
    assert toxicity.logistic(x, np.zeros(300, bool))[-1] == -20 and toxicity.logistic(x, np.ones(300, bool))[-1] == 20


def test_best_threshold():
    p = np.array([0.9, 0.8, 0.7, 0.6, 0.2])
    assert 0.6 < toxicity.best_threshold(p, np.array([1, 1, 1, 0, 0], bool), 1.0) < 0.7
    assert toxicity.best_threshold(p, np.array([1, 1, 0, 1, 0], bool), 100.0) == pytest.approx(0.75)
    assert toxicity.best_threshold(p, np.zeros(5, bool), 1.0) == 0.5


@pytest.fixture(scope="module")
def fitted(spark):
    docs, marks = planted(1, 1500)
    return toxicity.fit_chain(frame(spark, docs), spark.createDataFrame(marks, LABELS))


def test_held_out_accuracy(spark, fitted):
    docs, marks = planted(2, 800)
    toxic = {i for i, _, t in marks if t}
    got = {r.doc_id: r for r in toxicity.scored(frame(spark, docs), fitted).collect()}
    called = {i for i, r in got.items() if r.toxic or r.severe}
    assert len(called & toxic) >= 0.97 * len(toxic) and len(called - toxic) <= 0.01 * (len(got) - len(toxic))
    kept = {r.doc_id for r in toxicity.without_toxic(frame(spark, docs), fitted).collect()}
    assert kept == got.keys() - called


def test_later_models_read_earlier_probabilities(fitted):
    sizes = [len(w) for folds in fitted.weights for w in folds]
    k = len(fitted.terms)
    assert sizes == [k + 1] * 3 + [k + 2] * 3 + [k + 3] * 3
    assert fitted.probabilities([]) == fitted.probabilities([]) and len(fitted.probabilities([])) == 3


def test_a_second_fit_agrees(spark, fitted):
    docs, marks = planted(1, 1500)
    again = toxicity.fit_chain(frame(spark, docs, 7), spark.createDataFrame(marks, LABELS).repartition(5))
    assert again.terms == fitted.terms and again.thresholds == fitted.thresholds


def test_odd_tables(spark, fitted):
    data = rows()
    got = toxicity.scored(frame(spark, data), fitted).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d[0]) for d in data)
    assert not any(r.toxic for r in got)
    assert toxicity.scored(frame(spark, []), fitted).count() == 0
    kept = toxicity.without_toxic(frame(spark, data), fitted)
    assert kept.count() == len(data) and kept.columns == frame(spark, data).columns
    for marks in ([], [(1, 1, 0), (4, 0, 0), (None, 1, 1), (7, None, None), (1, 1, 0)]):
        model = toxicity.fit_chain(frame(spark, data), spark.createDataFrame(marks, LABELS))
        assert not any(r.toxic for r in toxicity.scored(frame(spark, data), model).collect())


def test_labels_outside_0_and_1(spark):
    """Only 1 is toxic, only 0 is poor quality; a null mark is no label."""
    docs, marks = planted(3, 300)
    odd = [(i, q if i % 3 else 7, t if t else [0, 2, -1, None][i % 4]) for i, q, t in marks]
    got = {r.doc_id: (r.toxic, r.quality) for r in toxicity.sample_labels(spark.createDataFrame(odd, LABELS), 1000).collect()}
    assert got == {i: (int(t == 1), int(q != 0)) for i, q, t in odd if t is not None}
    model = toxicity.fit_chain(frame(spark, docs), spark.createDataFrame(odd, LABELS), n_terms=64)
    assert len(model.thresholds) == 3


def test_threshold_of_bins_equals_a_search():
    rng = np.random.default_rng(7)
    for _ in range(200):
        bins = 64
        hits, misses = rng.integers(0, 4, bins) * (rng.random(bins) < 0.2), rng.integers(0, 4, bins) * (rng.random(bins) < 0.2)
        got = toxicity.threshold_of_bins(hits, misses)
        best, want = -1.0, 0.5
        for edge in range(bins - 1, bins // 2 - 1, -1):
            if hits[edge] + misses[edge]:
                f1 = 2 * hits[edge:].sum() / max(1, hits[edge:].sum() + misses[edge:].sum() + hits.sum())
                if f1 > best:
                    lower = [b for b in range(edge) if hits[b] + misses[b]]
                    best, want = f1, max(0.5, (edge + (lower[-1] + 1 if lower else 0)) / 2 / bins)
        assert got == (want if hits.sum() else 0.5)


def test_terms_are_counted_in_all_labelled_documents(spark):
    docs, marks = planted(4, 400)
    terms = ["vile*", "vilewort", "scornling", "and", "heer*", "unmet"]
    found = toxicity.features(frame(spark, docs), toxicity.ChainModel.of(terms), 3)
    labelled = found.join(toxicity.all_labels(spark.createDataFrame(marks, LABELS)), "doc_id")
    counts = {t: [0, 0] for t in terms}
    toxic = {i: t for i, _, t in marks}
    for d in docs:
        for t in toxicity.terms_of(toxicity.text_words(d[1])) & counts.keys():
            counts[t][toxic[d[0]]] += 1
    got = toxicity.counted_terms(labelled, terms, 10)
    assert {t: [b, a] for t, a, b in got} == {t: c for t, c in counts.items() if any(c)}
    n1, n0 = sum(toxic.values()), 400 - sum(toxic.values())

    def chi(a, b):
        return (a * n0 - b * n1) ** 2 * 400 / ((a + b) * max(400 - a - b, 0.5) * n1 * n0)

    assert [t for t, _, _ in got] == [t for t, a, b in sorted(got, key=lambda r: (-chi(r[1], r[2]), r[0]))]
    assert toxicity.counted_terms(labelled, terms, 2) == got[:2]


def test_chain_against_a_plain_one(spark):
    """The whole fit again in plain loops: folds, out-of-fold columns, thresholds."""
    docs, marks = planted(5, 500)
    model = toxicity.fit_chain(frame(spark, docs), spark.createDataFrame(marks, LABELS), per_class=120, n_terms=40, folds=3)
    labels = {i: (q, t) for i, q, t in marks}
    import xxhash

    order = {i: None for i in labels}
    sampled = {r.doc_id for r in toxicity.sample_labels(spark.createDataFrame(marks, LABELS), 120).collect()}
    assert len(sampled) < len(order)
    counts = {t: [0, 0] for t in model.terms}
    for d in docs:
        for t in toxicity.terms_of(toxicity.text_words(d[1])) & counts.keys():
            counts[t][labels[d[0]][1]] += 1
    telling = {t for t, (b, a) in counts.items() if a >= toxicity.TELLING * max(b, 0.2)}
    fold = {d[0]: xxhash.xxh64_intdigest(d[1], toxicity.SEED) % 3 for d in docs}
    rows = {}
    for d in docs:
        present = toxicity.terms_of(toxicity.text_words(d[1])) & counts.keys()
        q, t = labels[d[0]]
        rows[d[0]] = ([1.0 if term in present else 0.0 for term in model.terms],
                      (q == 0, t == 1, t == 1 and len(present & telling) >= toxicity.SEVERE_TERMS))
    features = {i: list(x) for i, (x, _) in rows.items()}
    ids = sorted(sampled)
    for c in range(3):
        weights = []
        for k in range(3):
            train = [i for i in ids if fold[i] != k]
            weights.append(toxicity.logistic(np.array([features[i] for i in train], np.float32),
                                             np.array([rows[i][1][c] for i in train], bool)))
            assert np.allclose(weights[k], model.weights[c][k], atol=1e-3)
        p = {}
        for i, x in features.items():
            w = weights[fold[i]]
            p[i] = 1 / (1 + np.exp(-np.clip(np.dot(w[:-1], x) + w[-1], -30, 30)))
        ones = [p[i] for i in p if rows[i][1][c]]
        if ones:  # no other cut at 0.5 or more has a better F1
            def f1(cut):
                called = [i for i in p if p[i] >= cut]
                return 2 * sum(rows[i][1][c] for i in called) / max(1, len(called) + len(ones))

            assert f1(model.thresholds[c]) >= max(f1(v) for v in p.values() if v >= 0.5) - 0.01
        for i in features:
            features[i].append(np.float32(p[i]))
