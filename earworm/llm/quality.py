"""Quality rules with risk-controlled thresholds (operator 3).

Four shares of a text, each in [0, 1], are the rules: symbols among characters,
repeated lines among lines, words in repeated 8-word windows, upper-case
letters.  The cutoff of each rule is selected per stratum (language) on the
labelled documents, which no other step has used: a cutoff may be used only if
the exact binomial test rejects, from the good documents it would reject,
that its false rejection rate is above the limit.  The tests of a rule in a
stratum run from the loosest cutoff down and stop at the first that fails
(fixed sequence, so the grid costs nothing); over rules and strata the error
probability is divided (Bonferroni), and the limit is divided over the rules,
so that, with probability 1 - delta at least, no stratum loses more than
``max_false_rejection`` of its good documents to the rules together.  A stratum
with too few labels to prove anything gets no cutoff and loses nothing.

All of it is SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earworm.llm.store import documents, written

RULES = ("symbols", "dup_lines", "repeats", "upper")
#: Cutoffs 0, 1/50, ..., 49/50; bin b holds shares in ((b-1)/50, b/50].
BINS = 50
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
SPACE = "[\\x20\\x09-\\x0D]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five counts and the rules' bins; no shuffle.

    Repeated windows: 8-word windows are hashed to 64 bits; only texts in which
    a hash occurs twice have their windows sorted (by hash, then place), and
    the places of repeated ones, in order, are merged into covered words.
    Null or empty text: all counts 0, all bins 0.
    """
    kept = docs.columns
    whole = F.coalesce(docs[text].cast("string"), F.lit(""))
    df = docs.withColumn("_words", F.array_remove(F.split(whole, SPACE, -1), "")).withColumn(
        "_lines", F.filter(F.split(whole, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")))
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w))).withColumn(
        "_chars", F.array_join("_words", ""))
    # named more than once here, so that the optimizer does not inline the
    # hashes into the loop over windows
    n = F.size("_hashes")
    df = df.withColumn("_windows", F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), n - (WINDOW - 1))),
        lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")))
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_placed", F.when(repeated, F.sort_array(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twin = F.filter("_placed", lambda x, j: F.get("_placed", j - 1)["h"].eqNullSafe(x["h"])
                    | F.get("_placed", j + 1)["h"].eqNullSafe(x["h"]))
    df = df.withColumn("_places", F.sort_array(F.transform(twin, lambda x: x["i"])))
    covered = F.aggregate(
        "_places", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n"),
                                (p + WINDOW).alias("end")))["n"]
    df = df.withColumn("n_words", F.size("_words").cast("bigint")).withColumn(
        "word_chars", F.char_length("_chars").cast("bigint")).withColumn(
        "n_symbols", (F.char_length("_chars") - F.char_length(F.translate("_chars", "#*$%&|<>", ""))).cast("bigint")).withColumn(
        "_n_lines", F.size("_lines").cast("bigint")).withColumn(
        "n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint")).withColumn(
        "n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).withColumn(
        "_n_upper", F.char_length(F.regexp_replace("_chars", "[^A-Z]+", "")).cast("bigint"))

    def bin_of(part: str, total: str) -> Column:  # whole numbers: the same bin on every machine
        return F.when(F.col(total) > 0, F.expr(f"({part} * {BINS} + {total} - 1) div {total}")).otherwise(0).cast("int")

    return df.select(
        *kept, *COUNTS,
        ((F.col("n_words") < MIN_WORDS)
         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        F.array(bin_of("n_symbols", "word_chars"), bin_of("n_dup_lines", "_n_lines"),
                bin_of("n_repeat_words", "n_words"), bin_of("_n_upper", "word_chars")).alias("_bins"))


def named(value: Column, use) -> Column:
    """``use(value)`` with the value computed once and named by a lambda: its
    expression does not grow with the number of times it is used."""
    return F.transform(F.array(value), use)[0]


def log_factorial(x: Column) -> Column:
    """ln x! by Stirling's series at x + 11, to about 1e-12."""
    def series(x: Column) -> Column:
        w = x + 11.0
        stirling = ((w - 0.5) * F.log(w) - w + 0.5 * math.log(2 * math.pi)
                    + 1.0 / (12.0 * w) - 1.0 / (360.0 * w * w * w) + 1.0 / (1260.0 * F.pow(w, F.lit(5.0)))
                    - 1.0 / (1680.0 * F.pow(w, F.lit(7.0))))
        return F.aggregate(F.sequence(F.lit(1), F.lit(10)), stirling, lambda acc, i: acc - F.log(x + i))

    return named(x.cast("double"), series)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p) where k <= n p, else 1.

    Summed downwards from the k-th probability; terms beyond 40 standard
    deviations are below any double and left out.
    """
    at_k = F.exp(log_factorial(n) - log_factorial(k) - log_factorial(n - k)
                 + k * math.log(p) + (n - k) * math.log1p(-p))
    terms = F.least(k.cast("double"), F.ceil(40 * F.sqrt(n * p)) + 50).cast("int")
    k_, n_ = k.cast("double"), n.cast("double")
    total = F.aggregate(
        F.sequence(F.lit(0), terms), F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda acc, j: F.struct(
            (acc["term"] * (k_ - j) * (1 - p) / ((n_ - k_ + j + 1.0) * p)).alias("term"),
            (acc["sum"] + acc["term"]).alias("sum")))["sum"]
    return F.when(k > n * p, 1.0).otherwise(F.least(F.lit(1.0), at_k * total))


def select_cutoffs(labelled: DataFrame, max_false_rejection: float, delta: float) -> DataFrame:
    """(stratum, cutoffs): per rule the least bin that may be kept, or null.

    ``labelled`` has stratum, good (0/1) and _bins.  A partial aggregate to
    strata x rules x bins rows; one count comes to the driver.
    """
    good = labelled.where("good = 1").select("stratum", F.posexplode("_bins").alias("rule", "bin"))
    counts = good.groupBy("stratum", "rule", "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = counts.groupBy("stratum", "rule").agg(
        F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin"))
    tests = len(RULES) * max(1, good.select("stratum").distinct().count())
    limit = max_false_rejection / len(RULES)
    # each cutoff c, loosest first: the good documents in bins above c
    grid = grid.withColumn("cut", F.explode(F.sequence(F.lit(BINS - 1), F.lit(0), F.lit(-1))))
    above = F.aggregate(F.map_values(F.map_filter("by_bin", lambda b, _: b > F.col("cut"))),
                        F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    tested = grid.withColumn("p", binomial_cdf(above, F.col("n"), limit))
    tested = tested.withColumn("passed", F.col("p") <= delta / tests)
    # fixed sequence: the cutoffs before (above) the first failure
    stopped = tested.groupBy("stratum", "rule").agg(
        F.coalesce(F.max(F.when(~F.col("passed"), F.col("cut"))), F.lit(-1)).alias("failed"))
    cutoffs = stopped.select("stratum", "rule", F.when(F.col("failed") < BINS - 1, F.col("failed") + 1).alias("cut"))
    return cutoffs.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("cutoffs"))


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang", max_false_rejection: float = 0.02,
                     delta: float = 0.05, doc_id: str = "doc_id", text: str = "text",
                     quality: str = "quality") -> DataFrame:
    """(doc_id, counts, base_failed, failed_rules, kept) of every row.

    The measures are computed once and written to the shared folder (some 60
    bytes a row); calibration and verdicts read them there.  Null stratum: a
    stratum of its own.  A doc_id labelled twice counts as good only if all its
    labels say so; null labels and null doc_ids calibrate nothing.  Repeated
    rows come out once each.  Empty labels: no cutoffs, base rules only.
    """
    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"),
                       F.coalesce(docs[stratum].cast("string"), F.lit("(null)")).alias("stratum"))
    measured = written(text_measures(rows).drop("text"), "quality")
    marks = labels.select(labels[doc_id].cast("bigint").alias("doc_id"), labels[quality].alias("good")).dropna()
    marks = marks.groupBy("doc_id").agg(F.min("good").alias("good"))
    cutoffs = select_cutoffs(measured.join(marks, "doc_id"), max_false_rejection, delta)
    failed = F.filter(F.array(*[
        F.when(F.get("_bins", F.lit(i)) > F.col("cutoffs")[i], F.lit(rule)) for i, rule in enumerate(RULES)]),
        lambda r: r.isNotNull())
    judged = measured.join(cutoffs, "stratum", "left").withColumn(
        "_failed", F.coalesce(failed, F.array().cast("array<string>")))
    return judged.select(
        "doc_id", *COUNTS, "base_failed", F.array_join("_failed", ",").alias("failed_rules"),
        (~F.col("base_failed") & (F.size("_failed") == 0)).alias("kept"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdicts of all documents, calibrated on all labels."""
    return quality_verdicts(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLE_SQL = r"""
with d as (select doc_id, coalesce(text, '') as text, coalesce(lang, '(null)') as stratum from documents),
     w as (select *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
                  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
     g as (select doc_id, i, list_slice(words, i, i + 7) as gram
             from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from w where len(words) >= 8)),
     twice as (select doc_id, i from g qualify count(*) over (partition by doc_id, gram) > 1),
     covered as (select doc_id, count(distinct i + j) as n from (select doc_id, i, unnest(range(0, 8)) as j from twice)
                  group by doc_id),
     m as (select doc_id, stratum, cast(len(words) as bigint) as n_words,
                  cast(length(array_to_string(words, '')) as bigint) as word_chars,
                  cast(length(regexp_replace(array_to_string(words, ''), '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
                  cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
                  cast(coalesce(n, 0) as bigint) as n_repeat_words, len(lines) as n_lines,
                  length(regexp_replace(array_to_string(words, ''), '[^A-Z]', '', 'g')) as n_upper
             from w left join covered using (doc_id)),
     b as (select *, case when word_chars > 0 then (n_symbols * 50 + word_chars - 1) // word_chars else 0 end as b0,
                  case when n_lines > 0 then (n_dup_lines * 50 + n_lines - 1) // n_lines else 0 end as b1,
                  case when n_words > 0 then (n_repeat_words * 50 + n_words - 1) // n_words else 0 end as b2,
                  case when word_chars > 0 then (n_upper * 50 + word_chars - 1) // word_chars else 0 end as b3 from m),
     l as (select doc_id from labels where quality is not null group by doc_id having min(quality) = 1),
     good as (unpivot (select stratum, b0, b1, b2, b3 from b join l using (doc_id)) on b0, b1, b2, b3 into name rule value bin),
     tests as (select 4 * count(distinct stratum) as n from good),
     above as (select stratum, rule, cut, count(*) as n, count(*) filter (bin > cut) as k
                 from good, (select unnest(range(0, 50)) as cut) group by all),
     tested as (select *, case when k > n * 0.005 then 1.0 else list_sum(list_transform(range(0, k + 1), lambda i:
                         exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.005) + (n - i) * ln(0.995)))) end as p
                  from above),
     cuts as (select stratum, rule, coalesce(max(cut) filter (p > 0.05 / (select n from tests)), -1) + 1 as cut
                from tested group by all),
     c as (select stratum, max(cut) filter (rule = 'b0') as c0, max(cut) filter (rule = 'b1') as c1,
                  max(cut) filter (rule = 'b2') as c2, max(cut) filter (rule = 'b3') as c3
             from cuts where cut < 50 group by all),
     v as (select b.*, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
                  concat_ws(',', case when b0 > c0 then 'symbols' end, case when b1 > c1 then 'dup_lines' end,
                            case when b2 > c2 then 'repeats' end, case when b3 > c3 then 'upper' end) as failed_rules
             from b left join c using (stratum))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rules,
       not base_failed and failed_rules = '' as kept
  from v"""
