"""How filters act on each other in every order, by a recursive CTE (operator 13).

Every document becomes a mask: bit i is set if it fails filter i.  The corpus is
counted once into mask cells (part, mask, documents, good, toxic); at most 32
cells a part are left, whatever the corpus holds.  The CTE then begins with the
empty order of each part, extends every prefix by each unused letter, joins the
part's cells and carries the bits applied so far; each level of the recursion
emits the metrics of its step.
"""

from __future__ import annotations

import hashlib
import re
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earworm.llm.store import documents, written

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 3
#: The filter of exact copies; it is judged table-wide, the others text by text.
COPY = 1 << FILTERS.index("E")
METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOL = re.compile(rb"[#$%&*|]").search
_SPACE = re.compile(rb"[\x20\x09-\x0D]").search
PIECE = 1 << 20
MEASURED = "doc_id bigint, part string, mask int, digest binary"


def word_counts(text: bytes) -> tuple[int, int]:
    """(words, distinct words) of UTF-8 text; pieces of about a MB are split at
    a time (``bytes.split`` cuts at just the white space of the definition)."""
    total, seen, at = 0, set(), 0
    while at < len(text):
        cut = _SPACE(text, at + PIECE)
        end = cut.start() if cut else len(text)
        words = text[at:end].split()
        total += len(words)
        seen.update(words)
        at = end
    return total, len(seen)


def text_mask(text: bytes, n_chars: int) -> int:
    """Bits of the failed filters A to D of one text."""
    words, distinct = word_counts(text)
    upper = len(text) - len(text.translate(None, _UPPER))
    return ((words < MIN_WORDS) | (100 * distinct < MIN_DISTINCT_PERCENT * words) << 1
            | (100 * upper > MAX_UPPER_PERCENT * n_chars) << 2 | bool(_SYMBOL(text)) << 3)


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(doc_id, part, mask of A to D, SHA-256 of the text) of every row; a map
    without shuffle.  Null text: empty; null part: empty string."""

    def measure(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(2), "")
            raw, chars = texts.cast(pa.binary()).to_pylist(), pc.utf8_length(texts).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(map(text_mask, raw, chars), pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary())],
                names=["doc_id", "part", "mask", "digest"])

    return docs.select(docs[doc_id].cast("bigint"), F.coalesce(docs[part].cast("string"), F.lit("")),
                       docs[text].cast("string")).mapInArrow(measure, MEASURED)


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failed filters.

    A row fails E if a smaller doc_id has the same text.  The least id of each
    text is a partial aggregate, so a group of copies of any size is a few rows
    before the shuffle; rows then meet it by (id, text), a key that no copies
    share, and labels by id.  Rows with a null id are no copies, make no other
    row one, and have no label.  Rows that repeat an id and its text fail E
    only for a smaller id; a row is good or toxic if any label of its id is.
    """
    rows = written(measured(docs), "masks")
    known = rows.where("doc_id is not null")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    copy = F.when(F.col("first").isNull(), COPY).otherwise(0)
    joined = known.join(first, ["doc_id", "digest"], "left").join(marks, "doc_id", "left").select(
        "part", F.col("mask").bitwiseOR(copy).alias("mask"), F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"))
    unknown = rows.where("doc_id is null").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return joined.unionByName(unknown).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def _total(value: str, condition: str) -> str:
    return f"aggregate(p.cells, 0L, (total, c) -> total + if({condition}, c.{value}, 0L))"


def _walk_sql(cells: str, letters: str) -> str:
    """Prefixes with the metrics of all their steps, from a table of one row
    (part, cells) a part."""
    choices = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << i})" for i, x in enumerate(letters))
    here, fails = "(c.mask & s.applied) = 0", "(c.mask & f.choice.bit) <> 0"
    metrics = {
        "kept": _total("n", f"{here} and not {fails}"),
        "removed": _total("n", f"{here} and {fails}"),
        "redundant": _total("n", f"not {here} and {fails}"),
        "unique_fails": _total("n", "c.mask = f.choice.bit"),
        "good_lost": _total("good", f"{here} and {fails}"),
        "toxic_lost": _total("toxic", f"{here} and {fails}"),
    }
    step = "named_struct('letter', f.choice.letter, 'step', s.step + 1, " + ", ".join(
        f"'{name}', {value}" for name, value in metrics.items()) + ")"
    empty = "array<struct<letter: string, step: int, " + ", ".join(f"{m}: bigint" for m in METRICS) + ">>"
    return f"""
        WITH RECURSIVE orders (part, filter_order, step, applied, steps) MAX RECURSION LEVEL {len(letters) + 1} AS (
            SELECT part, '', 0, 0, cast(array() AS {empty}) FROM {cells}
            UNION ALL
            SELECT s.part, concat(s.filter_order, f.choice.letter), s.step + 1, s.applied | f.choice.bit,
                   concat(s.steps, array({step}))
            FROM (SELECT o.*, filter(array({choices}), x -> (o.applied & x.bit) = 0) AS unused FROM orders o) s
            JOIN {cells} p ON s.part = p.part
            LATERAL VIEW explode(s.unused) f AS choice)
        SELECT part, filter_order, steps FROM orders WHERE step = {len(letters)}"""


@contextmanager
def _any_number_of_rows(spark: SparkSession):
    """A recursion's rows are bounded by its levels here, not by the session's
    limit of rows (a table may have more parts than that allows for)."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def filter_orders(cells: DataFrame, letters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, the six metrics, shapley) of all orders of
    ``letters`` in every part of ``cells``.

    The recursion holds a row per prefix and part (325 for five letters) with
    the part's at most 2^letters cells beside it.  ``shapley`` is what the
    step's filter removes summed over all orders.  No cells: no rows.
    """
    if not 0 < len(letters) <= 8:
        raise ValueError("between 1 and 8 filters: the orders are their permutations")
    spark = cells.sparkSession
    parts = written(cells.groupBy("part").agg(F.sort_array(F.collect_list(
        F.struct("mask", "n", "good", "toxic"))).alias("cells")), "mask-cells")
    parts.createOrReplaceTempView(name := f"mask_cells_{id(parts)}")
    try:
        with _any_number_of_rows(spark):
            orders = written(spark.sql(_walk_sql(name, letters)), "filter-orders")
    finally:
        spark.catalog.dropTempView(name)
    steps = orders.select("part", "filter_order", F.inline("steps"))
    return steps.select("part", "filter_order", "step", *METRICS, F.sum("removed").over(
        Window.partitionBy("part", "letter")).alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the five filters over all documents, by language."""
    return filter_orders(mask_cells(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")))


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
firsts AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
masks AS (
    SELECT w.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
           (len(w.words) < 200)::INT + 2 * (100 * len(list_distinct(w.words)) < 50 * len(w.words))::INT
           + 4 * (100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 3 * length(w.text))::INT
           + 8 * regexp_matches(w.text, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > f.first_id, false)::INT AS mask
    FROM words w JOIN firsts f USING (text) LEFT JOIN marks m ON m.doc_id = w.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
filters (letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
prefixes (filter_order, letter, step, before, bit) AS (
    SELECT letter, letter, 1, 0, bit FROM filters
    UNION ALL
    SELECT p.filter_order || f.letter, f.letter, p.step + 1, p.before + p.bit, f.bit
    FROM prefixes p JOIN filters f ON ((p.before + p.bit) & f.bit) = 0),
metrics AS (
    SELECT c.part, p.filter_order, p.letter, p.step,
           sum(CASE WHEN c.mask & (p.before + p.bit) = 0 THEN c.n ELSE 0 END) AS kept,
           sum(CASE WHEN c.mask & p.before = 0 AND c.mask & p.bit <> 0 THEN c.n ELSE 0 END) AS removed,
           sum(CASE WHEN c.mask & p.before <> 0 AND c.mask & p.bit <> 0 THEN c.n ELSE 0 END) AS redundant,
           sum(CASE WHEN c.mask = p.bit THEN c.n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN c.mask & p.before = 0 AND c.mask & p.bit <> 0 THEN c.good ELSE 0 END) AS good_lost,
           sum(CASE WHEN c.mask & p.before = 0 AND c.mask & p.bit <> 0 THEN c.toxic ELSE 0 END) AS toxic_lost
    FROM prefixes p CROSS JOIN cells c GROUP BY c.part, p.filter_order, p.letter, p.step)
SELECT o.part, o.filter_order, m.step::INT AS step, m.kept::BIGINT AS kept, m.removed::BIGINT AS removed,
       m.redundant::BIGINT AS redundant, m.unique_fails::BIGINT AS unique_fails, m.good_lost::BIGINT AS good_lost,
       m.toxic_lost::BIGINT AS toxic_lost, (sum(m.removed) OVER (PARTITION BY o.part, m.letter))::BIGINT AS shapley
FROM metrics o JOIN metrics m ON m.part = o.part AND m.filter_order = left(o.filter_order, m.step::INT)
WHERE o.step = 5
"""
