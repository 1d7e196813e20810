"""SimHash near-duplicates with pivot distance tables (operator 9).

Fingerprints that differ in at most ``radius`` bits are linked.  Candidate
pairs agree on whole blocks: of ``radius + 3`` blocks a linked pair keeps at
least three unchanged, so every pair meets under one of the choices of three
blocks.  (Pivot distances alone cannot deal out candidates at this radius: the
distances of 64-bit fingerprints to a reference spread over a few units only,
so a cell of width 4 holds a large share of all rows.)  Among the rows that
meet, the pivot table does its work: the Hamming distances to fixed reference
fingerprints are computed once per row, a pair whose distances to any reference
differ by more than the radius cannot be linked (triangle inequality) and is
discarded, and only survivors are compared bit by bit.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from earworm.llm.components import component_roots
from earworm.llm.store import documents, neutral, written

RADIUS = 3
SHINGLE = 3
PIVOTS = 16
#: Fingerprints under one key of three blocks that one task takes.
HOT_ROWS = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = 42) -> int:
    """64-bit SimHash of a whole text; no words: 0.

    A-Z are lower-cased, words are runs of non-space (ASCII white space), and
    every shingle counts as often as it occurs; a text of fewer words has one
    shingle, all of them.
    """
    words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII rules
    if not words:
        return 0
    k = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: len(words) - k] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[k - 1:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.unpackbits(hashes[at: at + (1 << 16)].astype("<u8").view(np.uint8), bitorder="little")
        ones += block.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(((2 * ones > len(hashes)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row, fp as a signed bigint; a map without shuffle."""
    def hash_texts(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(docs[doc_id].cast("bigint"), docs[text].cast("string")).mapInArrow(
        hash_texts, "doc_id bigint, fp bigint")


def pivot_references(n: int = PIVOTS, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=np.uint64)


def pivot_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each pivot, uint8."""
    return np.bitwise_count(fps[:, None] ^ pivots[None, :])


def _near(fps, table, i, others, radius):
    """Which of ``others`` are within ``radius`` bits of row ``i``."""
    gap = np.abs(table[others].astype(np.int16) - table[i].astype(np.int16)).max(axis=1)
    survivors = others[gap <= radius]
    return survivors[np.bitwise_count(fps[survivors] ^ fps[i]) <= radius]


def spanning_links(fps: np.ndarray, table: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Index pairs within ``radius`` that connect all that is linked among the
    rows: one fewer than the rows of each component, never all its pairs.

    Breadth first: a row taken up is held against the rows not yet reached
    whose first pivot distance lies within the radius (kept sorted by it).
    """
    order = np.argsort(table[:, 0], kind="stable")
    links, left = [], order
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            at = int(table[i, 0])
            lo = np.searchsorted(table[left, 0], max(at - radius, 0), "left")
            hi = np.searchsorted(table[left, 0], min(at + radius, 255), "right")
            found = _near(fps, table, i, left[lo:hi], radius)
            if len(found):
                links += [(int(i), int(j)) for j in found]
                queue += found.tolist()
                left = left[~np.isin(left, found)]
    return links


def _links_of_sorted(keys: np.ndarray, fps: np.ndarray, pivots: np.ndarray, radius: int) -> np.ndarray:
    """Links among the rows of each run of equal keys, as an (n, 2) array."""
    cut = np.flatnonzero(np.diff(keys)) + 1
    starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(keys)]])
    sizes = ends - starts
    first = starts[sizes == 2]
    gap = np.abs(pivot_table(fps[first], pivots).astype(np.int16)
                 - pivot_table(fps[first + 1], pivots).astype(np.int16)).max(axis=1, initial=0)
    first = first[gap <= radius]
    first = first[np.bitwise_count(fps[first] ^ fps[first + 1]) <= radius]
    out = [np.stack([fps[first], fps[first + 1]], axis=1)]
    for a, b in zip(starts[sizes > 2], ends[sizes > 2]):
        run = fps[a:b]
        links = spanning_links(run, pivot_table(run, pivots), radius)
        if links:
            out.append(run[np.array(links)])
    return np.concatenate(out)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_links(distinct: DataFrame, radius: int = RADIUS, n_pivots: int = PIVOTS) -> DataFrame:
    """(a, b): links between the distinct fingerprints of column ``fp`` that
    join every linked pair's components, all pairs with radius or fewer bits
    between them taken into account.

    Each fingerprint goes to one row per choice of three blocks, dealt by
    (choice, the three blocks): about 32 of 64 bits, so rows meet by chance
    only in tables of billions.  A task streams its sorted keys and holds the
    16 bytes a row of one key at a time.  A key of over ``HOT_ROWS``
    fingerprints (texts that share most of a boilerplate) is dealt on: the 64
    bits lie in ``radius + 2`` stripes, of which a linked pair keeps two
    unchanged, so each of its rows goes to one row per choice of two stripes.
    Under one such key at most 2^26 fingerprints can differ, some of them
    hot by chance only.
    """
    blocks = radius + 3
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]

    def key(choice: tuple[int, int, int], number: int):
        out = F.lit(number).cast("bigint")
        for c in choice:
            width = cuts[c + 1] - cuts[c]
            block = F.shiftrightunsigned("fp", cuts[c]).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
            out = F.shiftleft(out, width).bitwiseOR(block)
        return out

    keys = [key(choice, i) for i, choice in enumerate(combinations(range(blocks), 3))]
    pivots = pivot_references(n_pivots)

    def link(batches):
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            done = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0  # the last key may go on
            if done:
                yield _batch(_links_of_sorted(keys[:done], fps[:done], pivots, radius))
                keys, fps = keys[done:], fps[done:]
        if len(keys):
            yield _batch(_links_of_sorted(keys, fps, pivots, radius))

    def _batch(pairs: np.ndarray) -> pa.RecordBatch:
        signed = np.ascontiguousarray(pairs).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[:, 0]), pa.array(signed[:, 1])], names=["a", "b"])

    def linked(dealt: DataFrame) -> DataFrame:
        return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(link, "a bigint, b bigint")

    dealt = distinct.select(F.explode(F.array(*keys)).alias("key"), "fp")
    hot = written(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS).select("key"), "hot-keys")
    if hot.isEmpty():
        return linked(dealt).distinct()
    stripes = [sum(1 << b for b in range(i, 64, radius + 2)) for i in range(radius + 2)]
    masks = [_signed(stripes[i] | stripes[j]) for i, j in combinations(range(radius + 2), 2)]
    further = F.array(*[F.xxhash64("key", F.lit(i), F.col("fp").bitwiseAND(F.lit(mask).cast("bigint")))
                        for i, mask in enumerate(masks)])
    again = dealt.join(hot, "key", "left_semi").select(F.explode(further).alias("key"), "fp")
    return linked(dealt.join(hot, "key", "left_anti")).unionByName(linked(again)).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Rows with equal fingerprints are one node (a partial aggregate, so a group
    of copies of any size is one row before it is dealt out).  Nodes are linked
    by ``near_links``, components found on the links alone, and the component
    of a fingerprint joined back to its rows.  ``component_id`` is the least
    doc_id reachable, the row's own included.

    Null and empty texts have fingerprint zero and are linked like any other.
    A null doc_id takes part but never names a component (null only where all
    of its ids are null).  Repeated rows come out once each.
    """
    rows = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = written(component_roots(near_links(nodes.select("fp"), radius)), "roots")
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    members = written(linked.join(named, "root").select("fp", "component_id"), "members")
    # written, so that both sides of the last join are plain exchanges and a
    # fingerprint of many rows can be split
    per_fp = written(nodes.join(members, "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id")), "components")
    return rows.join(per_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                            radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` of each component: that of the least doc_id (null
    last); of several such rows, one.

    The rows are numbered and written once with their fingerprints; components
    are found on numbers and fingerprints, and the survivors' rows read back by
    a semi join on the (unique) number.
    """
    plain, (doc_id, text) = neutral(docs, doc_id, text)
    at = plain.columns.index(text)

    def hash_texts(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(at)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))],
                                             names=[*batch.schema.names, "_fp"])

    numbered = plain.withColumn("_row", F.monotonically_increasing_id())
    rows = written(numbered.mapInArrow(hash_texts, StructType([*numbered.schema.fields, StructField("_fp", LongType())])), "fingerprinted")
    first = F.min(F.struct(F.col(f"`{doc_id}`").isNull().alias("no_id"), F.col(f"`{doc_id}`").alias("id"), "_row")).alias("first")
    nodes = written(rows.groupBy(F.col("_fp").alias("fp")).agg(first), "nodes")
    roots = written(component_roots(near_links(nodes.select("fp"), radius)), "roots")
    survivors = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").groupBy(
        F.coalesce("root", "fp").alias("component")).agg(F.min("first").alias("first")).select("first._row")
    return rows.join(survivors, "_row", "left_semi").drop("_row", "_fp").toDF(*docs.columns)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-word-shingle SimHash components of all documents at 3 bits."""
    return near_duplicates(documents(spark, sf_dir))
