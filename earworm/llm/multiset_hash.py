"""Homomorphic multiset fingerprints of documents (operator 2).

A text is the multiset of its paragraphs (its lines).  Each paragraph is hashed
to a wide vector, a fingerprint is the sum of the vectors modulo powers of two,
lane by lane:

  lane 0          1 (modulo 2^32: the number of paragraphs)
  lanes 1-8       eight dense 32-bit values, for equality
  lanes 9-1288    twenty groups of 64: a 32-bit value in one lane of the group,
                  zero in the others; the first group takes in all paragraphs,
                  each further one 1 in 8 of those before it (by hash)

Sums do not depend on order, and adding or subtracting a paragraph's vector
inserts or deletes it (``combine``).  The sparse lanes tell how much two
fingerprints share: the lanes of a group that differ estimate, by linear
counting, the size of the symmetric difference, and the first group that is
not full is read; some group is not at any bigint count of paragraphs.  Groups
that took in nothing are zeros, which are not computed lane by lane nor
shuffled.  All of it is SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earworm.llm.store import documents

DENSE, SPARSE = 8, 64
#: One paragraph in so many goes to each sparse group; the last one is not full
#: with 2^63 distinct paragraphs (64 ln(64 / 12) 8^19 = 1.5e19).
GROUPS = tuple(8 ** i for i in range(20))
#: The groups from here on are empty in most texts.
FIRST = 3
LANES = 1 + DENSE + SPARSE * len(GROUPS)
#: A group with more differing lanes than this is too full to count by.
FULL = 52
_MASK = (1 << 32) - 1


def _low(value: Column) -> Column:
    return value.bitwiseAND(F.lit(_MASK).cast("bigint"))


def _sum(values: Column, of) -> Column:
    """Sum modulo 2^32 of ``of(element)``; a bigint cannot overflow on the way."""
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: _low(acc + of(x)))


def paragraph_hashes(text: Column) -> Column:
    """One struct of hashes per paragraph; an empty text has none."""
    lines = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n", -1))
    return F.transform(lines, lambda p: F.struct(
        F.xxhash64(p).alias("h"), F.xxhash64(p, F.lit("second")).alias("g")))


def _zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0).cast("bigint"), n)


def _group(hashes: str) -> Column:
    """A sparse group's lanes.  The column is named twice, which also keeps the
    optimizer from inlining its expression into the loop over lanes."""
    lanes = F.transform(
        F.sequence(F.lit(0), F.lit(SPARSE - 1)),
        lambda b: _sum(F.filter(hashes, lambda x: F.pmod(x["g"], F.lit(SPARSE)) == b), lambda x: _low(x["h"])))
    return F.when(F.size(hashes) == 0, _zeros(SPARSE)).otherwise(lanes)


def with_lanes(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with the fingerprint of a non-null text as bigint lanes."""
    kept = rows.columns
    rows = rows.withColumn("_hashes", paragraph_hashes(F.col(text)))

    def one_in(hashes: str, n: int) -> Column:
        return F.filter(hashes, lambda x: F.pmod(F.shiftright(x["g"], 6), F.lit(n).cast("bigint")) == 0).alias(f"_hashes_{n}")

    few = GROUPS[FIRST]  # what the sparser groups take in is among this one's
    rows = rows.select("*", *[one_in("_hashes", n) for n in GROUPS[:FIRST + 1]])
    rows = rows.select("*", *[one_in(f"_hashes_{few}", n) for n in GROUPS[FIRST + 1:]])
    dense = [_sum(F.col("_hashes"), lambda x, i=i: _low(F.xxhash64(x["h"], x["g"], F.lit(i)))) for i in range(DENSE)]
    groups = [_group(f"_hashes_{n}") for n in GROUPS]
    rest = F.when(F.size(f"_hashes_{few}") == 0, _zeros(SPARSE * (len(GROUPS) - FIRST))).otherwise(F.concat(*groups[FIRST:]))
    lanes = F.concat(F.array(F.size("_hashes").cast("bigint"), *dense), *groups[:FIRST], rest)
    return rows.select(*kept, lanes.alias(out))


def short(lanes: Column) -> Column:
    """The lanes without the sparse groups that are zeros to the end."""
    out = F.when(F.lit(False), lanes)
    for group in range(FIRST, len(GROUPS)):
        upto = 1 + DENSE + SPARSE * group
        out = out.when(F.array_max(F.slice(lanes, upto + 1, LANES - upto)) == 0, F.slice(lanes, 1, upto))
    return out.otherwise(lanes)


def whole(lanes: Column) -> Column:
    """All lanes of what ``short`` gave."""
    return F.concat(lanes, F.array_repeat(F.lit(0).cast("bigint"), F.lit(LANES) - F.size(lanes)))


def combine(left: Column, right: Column, sign: int = 1) -> Column:
    """Lanes of the union of two multisets, or, with ``sign=-1``, of what is
    left of the first when the second is taken out."""
    return F.zip_with(left, right, lambda a, b: F.pmod(a + F.lit(sign) * b, F.lit(1 << 32).cast("bigint")))


def hex_of(lanes: Column) -> Column:
    used = F.lower(F.array_join(F.transform(short(lanes), lambda v: F.lpad(F.hex(v), 8, "0")), ""))
    return F.rpad(used, 8 * LANES, "0")


def compact_of(lanes: Column) -> Column:
    """Text of a fingerprint, as long as what it took in: 8 digits of the count
    and of each dense lane, then, of the sparse lanes that are not 0, place (4
    digits) and value (8).  Equal lanes have equal texts and the other way
    round."""
    used = short(lanes)
    dense = F.array_join(F.transform(F.slice(used, 1, 1 + DENSE), lambda v: F.lpad(F.hex(v), 8, "0")), "")
    sparse = F.transform(F.slice(used, 2 + DENSE, LANES), lambda v, i: F.when(
        v != 0, F.concat(F.lpad(F.hex(i.cast("bigint")), 4, "0"), F.lpad(F.hex(v), 8, "0"))))
    return F.lower(F.concat(dense, F.array_join(sparse, "")))  # nulls are not joined


def likeness(left: Column, right: Column) -> Column:
    """2 s / (2 s + u), 0 to 1; equal: 1.  s: distinct paragraphs that occur
    equally often on both sides; u: the other distinct paragraphs.

    Both are counted by the lanes of one group, the first that is not too full:
    u from the lanes that differ, s from the equal, non-zero ones among the
    rest (paragraphs that share a lane are allowed for).  Near exact for some
    ten paragraphs, within about 15 per cent for any greater number.
    """
    def lanes(group: int, test) -> Column:
        at = 2 + DENSE + group * SPARSE
        marks = F.zip_with(F.slice(left, at, SPARSE), F.slice(right, at, SPARSE), lambda a, b: test(a, b).cast("int"))
        return F.aggregate(marks, F.lit(0), lambda acc, x: acc + x)

    like = F.when(left == right, 1.0)
    for group in range(len(GROUPS)):
        differ = lanes(group, lambda a, b: a != b)
        equal = lanes(group, lambda a, b: (a == b) & (a != 0))
        n_differ, n_equal = F.least(differ, F.lit(FULL)), F.least(equal, F.lit(FULL) - F.least(differ, F.lit(FULL)))
        others = -F.log(F.lit(1.0) - n_differ / F.lit(float(SPARSE)))
        shared = -F.log(F.lit(1.0) - n_equal / (F.lit(float(SPARSE)) - n_differ))
        like = like.when(differ + equal <= FULL, F.when(shared == 0, 0.0).otherwise(2 * shared / (2 * shared + others)))
    return like.otherwise(0.0)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, lanes) of every row; null text: empty.  No shuffle."""
    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"),
                       F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    return with_lanes(rows, "text", "lanes")


def range_bounds(ids: DataFrame, column: str, buckets: int) -> list[int]:
    """At most ``buckets`` ids, least first, that cut the ids into like ranges
    (quantiles of all rows; ``buckets`` values come to the driver)."""
    cuts = [i / buckets for i in range(1, buckets)] or [0.5]
    row = ids.agg(F.min(column), F.percentile_approx(column, cuts, max(10_000, 10 * buckets))).first()
    return sorted({row[0], *(row[1] or [])} - {None})


def _bucket(value: Column, bounds: list[int]) -> Column:
    """How many bounds are at or below the value: two short scans, over the
    first bounds of blocks and then inside the block."""
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i: i + step] for i in range(0, len(bounds), step)]

    def longs(values):
        return F.array(*[F.lit(v).cast("bigint") for v in values])

    block = F.size(F.filter(longs([b[0] for b in blocks]), lambda x: x <= value)) - 1
    inside = F.size(F.filter(F.get(F.array(*map(longs, blocks)), block), lambda x: x <= value))
    return block * step + inside


def with_next(rows: DataFrame, order: str, tie: str, carry: list[str], buckets: int | None = None) -> DataFrame:
    """Each row with ``next_<c>`` of the row that follows it in ascending
    ``order`` (ties by ``tie``, nulls last); the last row is followed by the
    first.

    One shuffle, no global sort: rows are dealt into ranges of ``order``, and
    the first row of each range also goes to the range before it (the very
    first to the last range), where it only serves as a follower.
    """
    spark = rows.sparkSession
    buckets = buckets or min(65_536, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = range_bounds(rows.select(order), order, buckets)
    value = F.col(order)
    if bounds:
        last = len(bounds)
        own = F.when(value.isNull(), F.lit(last)).otherwise(_bucket(value, bounds))
        heads = F.array(*[F.lit(b).cast("bigint") for b in bounds])
        rows = rows.withColumn("_own", own)
        places = F.when(F.array_contains(heads, value), F.array(
            F.struct(F.col("_own").alias("bucket"), F.lit(0).alias("follows")),
            F.struct(F.when(F.col("_own") == 1, F.lit(last)).otherwise(F.col("_own") - 1).alias("bucket"),
                     F.lit(1).alias("follows")))).otherwise(
            F.array(F.struct(F.col("_own").alias("bucket"), F.lit(0).alias("follows"))))
    else:  # an empty table, or ids that are all null
        places = F.array(F.struct(F.lit(0).alias("bucket"), F.lit(0).alias("follows")))
    dealt = rows.withColumn("_place", F.explode(places)).select(
        *[c for c in rows.columns if c != "_own"], "_place.*")
    window = Window.partitionBy("bucket").orderBy("follows", F.col(order).asc_nulls_last(), tie)
    follower = F.struct(*[F.col(c) for c in carry])
    following = F.lead(follower).over(window)
    if not bounds:  # the last of the only range: the range's first
        following = F.coalesce(following, F.first(follower).over(
            window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    found = dealt.withColumn("_next", following)
    return found.where("follows = 0").select(
        *[c for c in rows.columns if c != "_own"], *[F.col("_next")[c].alias(f"next_{c}") for c in carry])


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                        buckets: int | None = None, shown=hex_of) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last half of its
    characters replaced by as many of the next document), and their likeness.
    ``shown`` makes the text of a fingerprint: ``hex_of``, of one width, or
    ``compact_of``.

    Rows of equal doc_id follow one another by text; a null doc_id comes last;
    one lone row follows itself.  Null text counts as empty.
    """
    rows = fingerprints(docs, doc_id, text).withColumn("lanes", short(F.col("lanes")))
    rows = with_next(rows, "doc_id", "text", ["text", "lanes"], buckets)
    n_chars = F.char_length("text").cast("bigint")
    half = F.floor(n_chars / 2).cast("int")
    rows = rows.withColumn("n_chars", n_chars).withColumn(
        "edited", F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half),
                           F.substr("next_text", F.lit(1), half)))
    rows = with_lanes(rows.select("doc_id", "n_chars", whole(F.col("lanes")).alias("lanes"),
                                  whole(F.col("next_lanes")).alias("next_lanes"), "edited"), "edited", "edited_lanes")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), shown(F.col("lanes")).alias("fingerprint"),
        shown(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"))


def op2_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset fingerprints of all documents, their edits and successors."""
    return edited_fingerprints(documents(spark, sf_dir), shown=compact_of)
