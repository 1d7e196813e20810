"""Toxicity by a classifier chain (operator 5).

The categories of ``CHAIN`` are predicted one after another by logistic models
on the terms of a text; each later model also gets the earlier categories'
probabilities.  It is trained with out-of-fold probabilities (every document's
come from models that have not seen its fold), so it learns from them as they
will be; for new texts the models of all folds together are used.

``labels`` holds one mark of toxicity.  The category ``severe`` is derived from
it: toxic documents with several terms that hardly ever stand in clean ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earworm.llm.store import documents, written

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
CHAIN = ("low_quality", "toxic", "severe")
#: Telling terms (found in toxic documents at least so often for each time in a
#: clean one) that make a toxic document a severe one.
SEVERE_TERMS, TELLING = 5, 50
SEED = 42


def terms_of(words: set[str]) -> set[str]:
    """Words and their first letters (a prefix ends in ``*``)."""
    return words.union(*({w[:k] + "*" for w in words if len(w) > k} for k in PREFIXES))


def text_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def all_labels(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, toxic, quality), 0 or 1, of every labelled id: a doc_id
    labelled twice is toxic if one label says so, good if all do.  Only 1 says
    toxic and only 0 says poor quality, whatever else a label holds; a null
    mark of toxicity is no label."""
    marks = labels.select(labels[doc_id].cast("bigint").alias("doc_id"), (F.col("toxic") == 1).cast("int").alias("toxic"),
                          (F.col("quality") != 0).cast("int").alias("quality")).where("doc_id is not null and toxic is not null")
    return marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))


def sample_labels(labels: DataFrame, per_class: int, doc_id: str = "doc_id") -> DataFrame:
    """At most ``per_class`` toxic and as many other labelled ids, least hash
    first."""
    marks = all_labels(labels, doc_id)
    order = F.xxhash64(F.lit(SEED), "doc_id")
    return marks.where("toxic = 1").orderBy(order, "doc_id").limit(per_class).unionByName(
        marks.where("toxic <> 1").orderBy(order, "doc_id").limit(per_class))


def telling_terms(sample: DataFrame, n_terms: int, min_docs: int = 5) -> list[tuple[str, int, int]]:
    """The ``n_terms`` terms with the highest chi-squared for toxicity, as
    (term, toxic documents, clean documents).  Counted per task, then by a
    partial aggregate; only the chosen terms come to the driver."""
    n1, n0 = sample.agg(F.sum("toxic"), F.count(F.lit(1)) - F.sum("toxic")).first()
    if not n1 or not n0:
        return []

    def count(batches):
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for term in terms_of(text_words(text)):
                    counts.setdefault(term, [0, 0])[toxic] += 1
        if counts:
            clean, toxic = zip(*counts.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys()), pa.array(toxic, pa.int64()), pa.array(clean, pa.int64())],
                names=["term", "a", "b"])

    found = sample.select("text", "toxic").mapInArrow(count, "term string, a bigint, b bigint").groupBy("term").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b")).where(F.col("a") + F.col("b") >= min_docs)
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    return [tuple(r) for r in found.select("term", "a", "b", _chi_squared(a, b, n1, n0, F.greatest).alias("chi")).orderBy(
        F.desc("chi"), "term").limit(n_terms).select("term", "a", "b").collect()]


def _chi_squared(a, b, n1, n0, greatest):
    """Of a term in ``a`` of n1 toxic and ``b`` of n0 other documents."""
    n = float(n1 + n0)
    half = F.lit(0.5) if greatest is F.greatest else 0.5
    return (a * n0 - b * n1) ** 2 * n / ((a + b) * greatest(n - a - b, half) * n1 * n0)


def _fold(text: str | None, folds: int) -> int:
    """Equal texts share a fold."""
    return xxhash.xxh64_intdigest(text or "", SEED) % folds


def features(docs: DataFrame, lookup: ChainModel, folds: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fold, places) of every row with an id: its terms among
    ``lookup``'s.  A map; what follows is shuffled without the texts."""
    def find(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_fold(t, folds) for t in texts], pa.int32()),
                 pa.array([lookup.places(t) for t in texts], pa.list_(pa.int32()))], names=["doc_id", "fold", "places"])

    return docs.where(docs[doc_id].isNotNull()).select(
        docs[doc_id].cast("bigint"), docs[text].cast("string")).mapInArrow(find, "doc_id bigint, fold int, places array<int>")


def counted_terms(labelled: DataFrame, terms: list[str], n_terms: int) -> list[tuple[str, int, int]]:
    """The ``n_terms`` of ``terms`` with the highest chi-squared over all
    labelled documents (places and toxic), as (term, toxic documents, clean
    documents).  A task passes on one row a term; as many reach the driver."""
    n = len(terms)

    def count(batches):
        counts = np.zeros((2, n + 1), np.int64)
        for batch in batches:
            places, toxic = batch.column(0), batch.column(1).to_numpy()
            flat = places.flatten().to_numpy()
            marks = np.repeat(toxic, np.diff(places.offsets.to_numpy()))
            for mark in (0, 1):
                counts[mark, :n] += np.bincount(flat[marks == mark], minlength=n)
                counts[mark, n] += int((toxic == mark).sum())
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[1, at]), pa.array(counts[0, at])],
                                         names=["place", "a", "b"])

    sums = {r.place: (r.a, r.b) for r in labelled.select("places", "toxic").mapInArrow(
        count, "place bigint, a bigint, b bigint").groupBy("place").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()}
    n1, n0 = sums.pop(n, (0, 0))
    if not n1 or not n0:
        return []
    found = [(-_chi_squared(float(a), float(b), n1, n0, max), terms[place], a, b) for place, (a, b) in sums.items()]
    return [(term, a, b) for _, term, a, b in sorted(found)[:n_terms]]


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 200) -> np.ndarray:
    """Weights (last: intercept) of a logistic model with both classes given the
    same weight in sum, by accelerated gradient steps; one class only: a
    constant."""
    n, k = x.shape
    if not y.any() or y.all():
        return np.concatenate([np.zeros(k), [20.0 if n and y.all() else -20.0]])
    x = np.concatenate([x, np.ones((n, 1), x.dtype)], axis=1)
    weight = np.where(y, 0.5 / y.sum(), 0.5 / (n - y.sum())).astype(x.dtype)
    v = np.ones(k + 1, x.dtype)
    for _ in range(15):  # the largest curvature, by power iteration
        v = x.T @ (weight * (x @ (v / np.linalg.norm(v))))
    rate = 1.0 / (0.25 * float(np.linalg.norm(v)) * 1.1 + l2)
    w, look = np.zeros(k + 1, x.dtype), np.zeros(k + 1, x.dtype)
    for step in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ look, -30, 30)))
        grad = x.T @ (weight * (p - y))
        grad[:-1] += l2 * look[:-1]
        new = look - rate * grad
        look = new + step / (step + 3.0) * (new - w)
        w = new
    return w.astype(np.float64)


def best_threshold(p: np.ndarray, y: np.ndarray, clean_weight: float) -> float:
    """The out-of-fold probability, 0.5 or more, from which on calling a text
    positive gives the best F1; a negative stands for ``clean_weight`` ones
    (the sample holds fewer of them than the labels)."""
    order = np.argsort(-p, kind="stable")
    hit, miss = np.cumsum(y[order]), np.cumsum(~y[order]) * clean_weight
    f1 = 2 * hit / (hit + miss + max(1, int(y.sum())))
    usable = np.flatnonzero((p[order] >= 0.5) & (np.append(p[order][1:], -1) < p[order]))
    if not len(usable) or not y.any():
        return 0.5
    best = usable[np.argmax(f1[usable])]
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float(max(0.5, (float(p[order][best]) + float(below)) / 2))


#: Bins of probability in the histogram of the labelled documents' scores.
BINS = 4096


def threshold_of_bins(hits: np.ndarray, misses: np.ndarray) -> float:
    """The bin's edge, 0.5 or more, from which on calling a text positive gives
    the best F1, put halfway down to the next bin that holds anything;
    ``hits`` and ``misses`` count positive and other documents by bin."""
    total = int(hits.sum())
    if not total:
        return 0.5
    hit, miss = np.cumsum(hits[::-1])[::-1], np.cumsum(misses[::-1])[::-1]
    f1 = 2 * hit / np.maximum(hit + miss + total, 1)
    usable = np.flatnonzero((hits + misses > 0) & (np.arange(len(hits)) >= len(hits) // 2))
    if not len(usable):
        return 0.5
    best = int(usable[::-1][np.argmax(f1[usable[::-1]])])
    lower = np.flatnonzero(hits[:best] + misses[:best])
    below = (lower[-1] + 1) / len(hits) if len(lower) else 0.0
    return float(max(0.5, (best / len(hits) + below) / 2))


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass
class ChainModel:
    terms: dict[str, int]            # at most n_terms
    heads: frozenset[str]            # first letters of all terms
    weights: list[list[np.ndarray]]  # by category, by fold; terms, earlier probabilities, intercept
    thresholds: list[float]          # by category

    @classmethod
    def of(cls, terms: list[str]) -> ChainModel:
        """A chain without links yet."""
        return cls({t: i for i, t in enumerate(terms)}, frozenset(t.rstrip("*")[: PREFIXES[0]] for t in terms), [], [])

    def places(self, text: str | None) -> list[int]:
        words = {w for w in text_words(text) if w[: PREFIXES[0]] in self.heads}
        return sorted(self.terms[t] for t in terms_of(words) if t in self.terms)

    def probabilities(self, places: list[int]) -> list[float]:
        """The chain for one text: each category's mean over its fold models."""
        earlier: list[float] = []
        k = len(self.terms)
        for folds in self.weights:
            earlier.append(float(np.mean([
                1.0 / (1.0 + np.exp(-np.clip(w[places].sum() + np.dot(w[k:-1], earlier) + w[-1], -30, 30)))
                for w in folds])))
        return earlier

    def unseen(self, places: list[int], fold: int) -> list[float]:
        """The chain by the models that have not seen texts of ``fold``."""
        earlier: list[float] = []
        k = len(self.terms)
        for folds in self.weights:
            w = folds[fold]
            earlier.append(float(1.0 / (1.0 + np.exp(-np.clip(
                w[places].sum() + np.dot(w[k:-1], earlier) + w[-1], -30, 30)))))
        return earlier


def fit_chain(docs: DataFrame, labels: DataFrame, per_class: int = 3000, n_terms: int = 512, folds: int = 3,
              doc_id: str = "doc_id", text: str = "text", candidates: int = 4) -> ChainModel:
    """Weights fitted on a bounded sample of the labelled documents, all counts
    and thresholds from all of them.

    ``per_class`` bounds the sample, ``n_terms`` the features, so the matrix on
    the driver is at most 2 x per_class x (n_terms + 3) floats at any size of
    the corpus.  ``candidates * n_terms`` terms that tell most in the sample
    are counted in all labelled documents, which decides.  The thresholds come
    from a histogram of the labelled documents' probabilities, each from the
    models that have not seen its fold.  Equal texts share a fold.  The
    texts are read once more for the candidate terms in them, which meet the
    labels without the texts.  Without toxic labels nothing is toxic.
    """
    texts = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text"))
    sample = written(texts.join(F.broadcast(sample_labels(labels, per_class, doc_id)), "doc_id"), "sampled")
    likely = [t for t, _, _ in telling_terms(sample, candidates * n_terms)]
    labelled = written(features(texts, ChainModel.of(likely), folds).join(all_labels(labels, doc_id), "doc_id"), "labelled")
    chosen = counted_terms(labelled, likely, n_terms) if likely else []
    model = ChainModel.of([t for t, _, _ in chosen])
    terms = model.terms
    position = np.array([terms.get(t, -1) for t in likely], np.int64)  # of the candidates in the model
    telling = {terms[t] for t, a, b in chosen if a >= TELLING * max(b, 0.2)}

    def marks_of(places: list[int], toxic: int, quality: int | None) -> tuple[bool, bool, bool]:
        return quality == 0, toxic == 1, toxic == 1 and len(telling.intersection(places)) >= SEVERE_TERMS

    def index(batches):
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["doc_id"] for r in rows], pa.int64()), pa.array([r["toxic"] for r in rows], pa.int32()),
                 pa.array([r["quality"] for r in rows], pa.int32()),
                 pa.array([_fold(r["text"], folds) for r in rows], pa.int32()),
                 pa.array([model.places(r["text"]) for r in rows], pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "quality", "fold", "places"])

    rows = sample.select("doc_id", "text", "toxic", "quality").mapInArrow(
        index, "doc_id bigint, toxic int, quality int, fold int, places array<int>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.fold, r.places))
    x = np.zeros((len(rows), len(terms)), np.float32)
    for i, r in enumerate(rows):
        x[i, r.places] = 1.0
    marks = np.array([marks_of(r.places, r.toxic, r.quality) for r in rows], bool).reshape(len(rows), len(CHAIN))
    fold = np.array([r.fold for r in rows], int)
    for y in marks.T:
        out_of_fold = np.zeros((len(rows), 1), np.float32)
        fitted = []
        for k in range(folds):
            w = logistic(x[fold != k], y[fold != k])
            out_of_fold[fold == k, 0] = _probability(x[fold == k], w)
            fitted.append(w)
        model.weights.append(fitted)
        x = np.concatenate([x, out_of_fold], axis=1)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def bins(batches):
        counts = np.zeros((len(CHAIN), BINS, 2), np.int64)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for candidate_places, in_fold, toxic, quality in rows:
            places = [i for i in position[candidate_places].tolist() if i >= 0]
            p = sent.value.unseen(places, in_fold)
            for c, is_one in enumerate(marks_of(places, toxic, quality)):
                counts[c, min(BINS - 1, int(p[c] * BINS)), int(is_one)] += 1
        category, at = np.nonzero(counts.any(axis=2))
        yield pa.RecordBatch.from_arrays(
            [pa.array(category), pa.array(at), pa.array(counts[category, at, 1]), pa.array(counts[category, at, 0])],
            names=["category", "bin", "hits", "misses"])

    histogram = np.zeros((len(CHAIN), 2, BINS), np.int64)
    for r in labelled.select("places", "fold", "toxic", "quality").mapInArrow(
            bins, "category bigint, bin bigint, hits bigint, misses bigint").groupBy("category", "bin").agg(
            F.sum("hits").alias("hits"), F.sum("misses").alias("misses")).collect():
        histogram[r.category, :, r["bin"]] = r.hits, r.misses
    model.thresholds = [threshold_of_bins(hits, misses) for hits, misses in histogram]
    return model


def scored(docs: DataFrame, model: ChainModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, p_<category> ..., toxic, severe) of every row; a map without
    shuffle, the model (its size is bounded by ``n_terms``) broadcast.  Null or
    empty text has no terms.  Null ids and repeated rows pass through."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        chain = sent.value
        seen: dict[tuple, list[float]] = {}
        for batch in batches:
            p = []
            for t in batch.column(1):
                places = tuple(chain.places(t.as_py()))
                if places not in seen:
                    if len(seen) >= 100_000:
                        seen.clear()
                    seen[places] = chain.probabilities(list(places))
                p.append(seen[places])
            p = np.array(p).reshape(batch.num_rows, len(CHAIN))
            over = p >= np.array(chain.thresholds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(np.round(p[:, i], 6)) for i in range(len(CHAIN))],
                 *[pa.array(over[:, CHAIN.index(c)]) for c in ("toxic", "severe")]],
                names=["doc_id", *[f"p_{c}" for c in CHAIN], "toxic", "severe"])

    return docs.select(docs[doc_id].cast("bigint"), docs[text].cast("string")).mapInArrow(
        score, "doc_id bigint, " + ", ".join(f"p_{c} double" for c in CHAIN) + ", toxic boolean, severe boolean")


def without_toxic(docs: DataFrame, model: ChainModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the chain does not call toxic or severe."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def keep(batches):
        chain = sent.value
        limits = [(CHAIN.index(c), chain.thresholds[CHAIN.index(c)]) for c in ("toxic", "severe")]
        for batch in batches:
            clean = []
            for t in batch.column(at):
                p = chain.probabilities(chain.places(t.as_py()))
                clean.append(all(p[i] < limit for i, limit in limits))
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op5_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain probabilities of all documents, fitted on the labelled ones."""
    docs = documents(spark, sf_dir)
    return scored(docs, fit_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
