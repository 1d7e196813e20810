"""Mixing sources to target weights by a hypergeometric splitting tree (operator 4).

1. Targets: the sources share a number of words by weight; none may get more
   than ``max_repeat`` times its own words, and what is above goes to the others
   by weight (water filling, solved on the table of sources).
2. Blocks: a source's documents are permuted by a hash and cut into blocks of
   about ``block_words`` words; running sums give each block, and each document
   in it, its place in the source's permuted stream.  A source gives the first
   ``target`` words of that stream, which starts again from its beginning when
   it is used up.  So the taken words are the target to the word, and at most
   one document a pass is cut.
3. Splitting tree: the numbers of taken blocks per source are split among the
   output shards, by halves: how many of each source's blocks go to the left
   half is one multivariate hypergeometric draw, source after source.  The
   quotas of the shards therefore add up exactly, and a shard draws its quota
   of a source as the next blocks of the permuted order: disjoint, nothing
   left over.
4. Within a shard rows are ordered by a hash.

Random numbers are hashes of seed and place, so reruns agree.  All of it is
SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earworm.llm.quality import SPACE, log_factorial, named
from earworm.llm.store import documents, neutral, written

WEIGHTS = (5, 2, 1)
#: Tables over sources are broadcast up to this size.
BROADCAST_BYTES = 16 << 20
#: Levels of the splitting tree between two exchanges of its nodes.
DEAL_LEVELS = 4
#: Blocks per group of the two-level running sums.
GROUP = 1024


def _uniform(*parts) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0 ** -53)


def with_sizes(docs: DataFrame, seed: int, doc_id: str = "doc_id", text: str = "text",
               source: str = "source") -> DataFrame:
    """``docs`` with _key (a source's key, never null), _size in words, and _u, the place of
    the document in the permutation (by id and text: rows of one id, or of
    none, are spread too, and equal rows are interchangeable)."""
    words = F.array_remove(F.split(F.coalesce(docs[text].cast("string"), F.lit("")), SPACE, -1), "")
    return docs.withColumns({
        "_key": F.when(docs[source].isNull(), "n").otherwise(F.concat(F.lit("v"), docs[source].cast("string"))),
        "_size": F.size(words).cast("bigint"),
        "_u": _uniform(F.lit(seed), F.lit("permute"), docs[doc_id].cast("bigint"),
                       F.xxhash64(docs[text].cast("string")))})


def source_targets(sized: DataFrame, weights: tuple[float, ...], share: float, max_repeat: float) -> DataFrame:
    """(_key, rank, source_size, target) per source, from the sizes.

    The windows run over the table of sources.  Sources are ranked by code
    point, null last; sorted by how early they are full (max_repeat x size /
    weight), the level is the first that the next source is not full at.
    """
    sources = sized.groupBy("_key").agg(F.sum("_size").alias("source_size"))
    by_name = Window.orderBy((F.col("_key") == "n").cast("int"), "_key")
    sources = sources.withColumn("rank", (F.row_number().over(by_name) - 1).cast("int"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))))
    full = max_repeat * F.col("source_size")
    sources = sources.select("*", weight.alias("weight"), full.alias("full"), (full / weight).alias("full_at"))
    before = Window.orderBy("full_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("full_at", "rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = Window.partitionBy()
    level = (share * F.sum("source_size").over(everyone) - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum(
        "weight").over(after)
    sources = sources.withColumn("level", level)
    sources = sources.withColumn("level", F.min_by(
        "level", F.when(F.col("level") <= F.col("full_at"), F.col("full_at"))).over(everyone))
    return sources.select("_key", "rank", "source_size",
                          F.least(F.col("full"), F.coalesce(F.col("level") * F.col("weight"), F.col("full"))).alias("target"))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """The number of marked ones among ``drawn`` of ``total``, by inversion of
    the distribution function at ``u`` (within 12 standard deviations and 2)."""
    def choose(a: Column, b: Column) -> Column:
        return log_factorial(a) - log_factorial(b) - log_factorial(a - b)

    def invert(v: Column) -> Column:
        n, k, d, u, low, high = (v[c] for c in ("n", "k", "d", "u", "low", "high"))
        at_low = F.exp(choose(k, low) + choose(n - k, d - low) - choose(n, d))
        return F.aggregate(
            F.sequence(low, F.greatest(low, high)),
            F.struct(at_low.alias("p"), F.lit(0.0).alias("below"), low.alias("x")),
            lambda acc, i: F.struct(
                (acc["p"] * (k - i) * (d - i) / ((i + 1.0) * F.greatest(n - k - d + i + 1.0, F.lit(1.0)))).alias("p"),
                (acc["below"] + acc["p"]).alias("below"),
                F.when(acc["below"] < u, i).otherwise(acc["x"]).alias("x")))["x"]

    def bounds(v: Column) -> Column:
        n, k, d, mean = (v[c] for c in ("n", "k", "d", "mean"))
        spread = F.ceil(12 * F.sqrt(F.greatest(
            F.lit(0.0), mean * (n - k) * (n - d) / F.greatest(n * (n - 1), F.lit(1.0))))) + 2
        return named(spread, lambda s: F.struct(
            n.alias("n"), k.alias("k"), d.alias("d"), v["u"].alias("u"),
            F.greatest(F.lit(0.0), d - (n - k), F.floor(mean) - s).cast("bigint").alias("low"),
            F.least(k, d, F.ceil(mean) + s).cast("bigint").alias("high")))

    n, k, d = total.cast("double"), marked.cast("double"), drawn.cast("double")
    given = F.struct(n.alias("n"), k.alias("k"), d.alias("d"), u.alias("u"),
                     (d * k / F.greatest(n, F.lit(1.0))).alias("mean"))
    return named(named(given, bounds), invert)


def split_quotas(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """(rank, ends): of each source, where the quota of each of 2^depth shards
    ends in the order of its taken blocks.

    ``quotas`` has (rank, blocks), ranks from 0 without gap.  A node of the tree
    is one row with an array over the sources; each level is one projection.
    Every ``DEAL_LEVELS`` levels the nodes are dealt out anew, so the tree is
    drawn by as many tasks as it has nodes there.
    """
    nodes = quotas.agg(F.array_sort(F.collect_list(F.struct("rank", "blocks"))).alias("all")).select(
        F.lit(0).cast("bigint").alias("node"), F.transform("all", lambda x: x["blocks"]).alias("counts"))
    for level in range(depth):
        if level and level % DEAL_LEVELS == 0:
            nodes = nodes.repartition("node")
        total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda acc, x: acc + x)

        def draw(acc: Column, marked: Column) -> Column:
            i = F.size(acc["left"])
            x = hypergeometric(acc["total"], marked, acc["drawn"],
                               _uniform(F.lit(seed), F.lit("tree"), F.lit(level), F.col("node"), i))
            return named(x, lambda x: F.struct(
                (acc["total"] - marked).alias("total"), (acc["drawn"] - x).alias("drawn"),
                F.concat(acc["left"], F.array(x)).alias("left")))

        nodes = nodes.withColumn("total", total)
        left = F.aggregate("counts", F.struct(
            F.col("total"), F.floor(F.col("total") / 2).cast("bigint").alias("drawn"),
            F.array().cast("array<bigint>").alias("left")), draw)["left"]
        nodes = nodes.withColumn("left", left)
        nodes = nodes.select(F.explode(F.array(
            F.struct((2 * F.col("node")).alias("node"), F.col("left").alias("counts")),
            F.struct((2 * F.col("node") + 1).alias("node"),
                     F.zip_with("counts", "left", lambda a, b: a - b).alias("counts")))).alias("n")).select("n.*")
    shares = nodes.select("node", F.posexplode("counts").alias("rank", "n"))
    running = F.sum("n").over(Window.partitionBy("rank").orderBy("node"))
    return shares.withColumn("end", running).groupBy("rank").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("node", "end"))), lambda x: x["end"]).alias("ends"))


def _few(sources: DataFrame, key: str, numbers: int = 1) -> DataFrame:
    """``sources`` marked for broadcast where its measured size allows it: rows
    of ``numbers`` bigints and a key; beyond it is joined by shuffle."""
    n, chars = sources.agg(F.count(F.lit(1)), F.sum(F.length(key))).first()
    return F.broadcast(sources) if 8 * numbers * n + 4 * (chars or 0) <= BROADCAST_BYTES else sources


def _place(ends: Column, value: Column, depth: int) -> Column:
    """How many of the 2^depth ascending ``ends`` are at or below ``value``, by
    bisection."""
    step = F.aggregate(
        F.sequence(F.lit(depth - 1), F.lit(0), F.lit(-1)), F.lit(0),
        lambda at, i: F.when(F.get(ends, at + F.pow(F.lit(2), i).cast("int") - 1) <= value,
                             at + F.pow(F.lit(2), i).cast("int")).otherwise(at)) if depth else F.lit(0)
    return step + (F.get(ends, step) <= value).cast("int")


def mix(sized: DataFrame, sizes: DataFrame, doc_id: str = "doc_id", weights: tuple[float, ...] = WEIGHTS,
        share: float = 1.5, max_repeat: float = 2.0, block_words: int = 200_000, shard_words: int = 2_000_000,
        max_shards: int = 65_536, seed: int = 42) -> DataFrame:
    """``sized`` with source_size, target, taken_1 and taken_2 (words taken in
    the first and second pass) and shard_1, shard_2 (null where nothing is).

    ``sized`` comes from ``with_sizes``; ``sizes`` has its _key, _size and _u
    and should be a written table, as it is read for the sources and for the
    blocks.  Rows are shuffled once, by block, so a source of a third of all
    rows is as many tasks as it has blocks.  Shards hold about ``shard_words``
    words: where the tree would need over ``max_shards`` leaves, each leaf's
    documents are dealt by hash to as many shards as its words ask for, so a
    shard is no larger in a larger corpus.  Empty documents take 0 words; an
    empty table stays empty.
    """
    if not 0 < max_repeat <= 2:
        raise ValueError("a source is passed over twice at most")
    sources = written(source_targets(sizes, weights, share, max_repeat), "sources").withColumn(
        "quota", F.round("target").cast("bigint")).withColumn(
        "n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("bigint"))
    few = _few(sources.select("_key", "n_blocks"), "_key")

    def block(df: DataFrame) -> DataFrame:
        return df.join(few, "_key").withColumn(
            "_block", F.least(F.floor(F.col("_u") * F.col("n_blocks")), F.col("n_blocks") - 1).cast("bigint")).drop("n_blocks")

    # where each block starts, in words and in blocks: sums by group, then inside
    blocks = block(sizes).groupBy("_key", "_block").agg(F.sum("_size").alias("words")).withColumn(
        "_group", F.floor(F.col("_block") / GROUP))
    groups = blocks.groupBy("_key", "_group").agg(F.sum("words").alias("gw"), F.count(F.lit(1)).alias("gn"))

    def before(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    of_source = Window.partitionBy("_key").orderBy("_group")
    groups = groups.select("_key", "_group", before("gw", of_source).alias("gw0"), before("gn", of_source).alias("gn0"))
    of_group = Window.partitionBy("_key", "_group").orderBy("_block")
    blocks = blocks.withColumn("one", F.lit(1)).select(
        "_key", "_group", "_block", before("words", of_group).alias("w0"), before("one", of_group).alias("n0"))
    blocks = blocks.join(groups, ["_key", "_group"]).select(
        "_key", "_block", (F.col("w0") + F.col("gw0")).alias("at"), (F.col("n0") + F.col("gn0")).alias("ordinal"))
    blocks = written(blocks.join(sources.drop("n_blocks"), "_key"), "blocks")
    # the blocks that give words, per pass; a source's blocks stand in one order
    taken = blocks.groupBy("_key", "rank").agg(
        F.count_if(F.col("at") < F.col("quota")).alias("n_1"),
        F.count_if(F.col("at") + F.col("source_size") < F.col("quota")).alias("n_2"))
    taken = written(taken.withColumn("blocks", F.col("n_1") + F.col("n_2")), "taken")
    quota = sources.agg(F.sum("quota")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(1, min(max_shards, quota / shard_words)))))
    dealt = max(1, math.ceil(quota / (shard_words << depth)))
    ends = split_quotas(taken.select("rank", "blocks"), depth, seed)
    ends = written(taken.select("_key", "rank", "n_1", "n_2").join(ends, "rank").drop("rank"), "shards")

    def shard(ordinal: Column) -> Column:
        return _place(F.col("ends"), ordinal, depth)

    blocks = blocks.join(_few(ends, "_key", 2 ** depth + 3), "_key").select(
        "_key", "_block", "at", "quota", "source_size", "target",
        F.when(F.col("ordinal") < F.col("n_1"), shard(F.col("ordinal"))).alias("shard_1"),
        F.when(F.col("ordinal") < F.col("n_2"), shard(F.col("ordinal") + F.col("n_1"))).alias("shard_2"))
    inside = Window.partitionBy("_key", "_block").orderBy("_u", doc_id, "_size")
    rows = block(sized).withColumn("_start", before("_size", inside)).join(blocks, ["_key", "_block"])

    def words(run: int) -> Column:
        start = F.col("at") + F.col("_start") + run * F.col("source_size")
        return F.greatest(F.lit(0), F.least(F.col("_size"), F.col("quota") - start)).cast("bigint")

    rows = rows.withColumn("taken_1", words(0)).withColumn("taken_2", words(1))

    def shard_of(run: int) -> Column:
        leaf = F.col(f"shard_{run}")
        if dealt > 1:
            leaf = leaf * dealt + F.pmod(F.xxhash64(F.lit(seed), F.lit("deal"), F.lit(run), "_u"), F.lit(dealt)).cast("int")
        return F.when(F.col(f"taken_{run}") > 0, leaf).alias(f"shard_{run}")

    return rows.select(*sized.columns, "source_size", "target", "taken_1", "taken_2", shard_of(1), shard_of(2))


def _sizes(sized: DataFrame) -> DataFrame:
    return written(sized.select("_key", "_size", "_u"), "sizes")


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                    seed: int = 42, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each pass in which a
    document is taken, shard after shard, shuffled within each.

    A document that is cut (one a source and pass at most) keeps its first
    words, single-spaced.  Documents of no words are not taken.
    """
    plain, (doc_id, text, source) = neutral(docs, doc_id, text, source)
    sized = with_sizes(plain, seed, doc_id, text, source)
    rows = mix(sized, _sizes(sized), doc_id, seed=seed, **options)
    passes = F.filter(F.array(*[F.struct(F.lit(p).alias("run"), F.col(f"taken_{p}").alias("n"),
                                         F.col(f"shard_{p}").alias("shard")) for p in (1, 2)]), lambda x: x["n"] > 0)
    rows = rows.withColumn("_pass", F.explode(passes))
    cut = F.array_join(F.slice(F.array_remove(F.split(F.col(text).cast("string"), SPACE, -1), ""), 1, F.col("_pass.n").cast("int")), " ")
    rows = rows.withColumn(text, F.when(F.col("_pass.n") < F.col("_size"), cut).otherwise(F.col(text)))
    order = F.xxhash64(F.lit(seed), F.lit("shuffle"), F.col("_pass.shard"), F.col(doc_id), F.col("_pass.run"))
    return (rows.withColumn("_shard", F.col("_pass.shard")).withColumn("_order", order)
            .repartition("_shard").sortWithinPartitions("_shard", "_order").select(*plain.columns).toDF(*docs.columns))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    sized = written(with_sizes(documents(spark, sf_dir).select("doc_id", "text", "source"), 42)
                    .drop("text", "source"), "sizes")
    return mix(sized, sized).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        (F.col("taken_1") + F.col("taken_2")).alias("taken"), "shard_1", "shard_2")
