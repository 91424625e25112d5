"""Quality rules with risk-controlled cutoffs.

A base rule rejects texts of few words or much repetition. Four more rules compare a signal of the text, in
thousandths, with a cutoff for each stratum (the language): symbols per word, repeated lines per line, words in
repeated 5-word windows per word, capitals per character. A cutoff must be earned on labelled holdout documents:

* With k of n good documents of a stratum rejected, the exact binomial test rejects "the rule loses more than
  ``alpha`` of the good ones" if P(Binomial(n, alpha) <= k) <= delta. The tests of all rules and strata share the error
  ``delta`` (Bonferroni); cutoffs of one rule are tested from lenient to strict and testing stops at the first
  failure, which needs no further correction.
* Among the cutoffs that passed, the one with the most bad documents rejected wins, a good one counting ``penalty``
  bad ones; ties go to the lenient side, and a rule without gain stays off. So does every rule of a stratum with too
  few labelled documents: nothing is rejected on thin evidence. All rules of a stratum together lose at most
  4 * alpha of its good documents, with probability 1 - delta.

Everything is column expressions. Each text is read in its own row, no word leaves it; 5-word windows are compared by
64-bit hashes inside the row, and the sorting step runs only for texts in which a hash repeats. Labels are joined with
the narrow signals by id. Calibration aggregates to at most 1,001 rows for each rule and stratum.

Defined results: a null or empty text has no words and fails the base rule; a null language is the stratum "";
labels other than 0 and 1 and ids with contradicting labels are left out, repeated labels count once; repeated
documents are judged alike; without labels only the base rule acts; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnlake.llm.common import SPACES, as_row, let, lookup_join, staged, words_of

ALPHA = 0.01
DELTA = 0.05
PENALTY = 10
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
RULES = ("symbols", "lines", "repeats", "capitals")


def _repeated(grams: Column) -> Column:
    """Number of words covered by windows whose hash occurs more than once."""
    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def twice(s: Column) -> Column:
        kept = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return let(F.array_sort(F.transform(kept, lambda x: x["p"])), covered)

    def ordered(g: Column) -> Column:
        return let(F.array_sort(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), twice)

    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(ordered(g)))


def _word_counts(text: Column) -> Column:
    def counts(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        repeats = F.when(F.size(w) > WINDOW, _repeated(grams)).otherwise(F.lit(0))
        return F.struct(F.size(w).cast("long").alias("n_words"), repeats.cast("long").alias("n_repeat_words"))
    return let(words_of(text), counts)


def _line_counts(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    return let(lines, lambda s: F.struct(
        F.size(s).cast("long").alias("n_lines"), (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines")))


def _per_mille(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.least(F.lit(1000), F.floor(part * 1000 / whole))).otherwise(0).cast("int")


def signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
            carry: bool = False) -> DataFrame:
    """id, stratum, the counts of the contract, base_failed and one signal for each rule; ``row`` with ``carry``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    n_chars = F.length(F.translate(text, SPACES, ""))
    counted = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")).alias("stratum"),
        _word_counts(text).alias("w"), _line_counts(text).alias("l"), n_chars.cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
        *([as_row(docs).alias("row")] if carry else []))
    flat = counted.select(
        "id", "stratum", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines",
        "n_capitals", *(["row"] if carry else []))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        flat.withColumn("base_failed", failed)
        .withColumn("symbols", _per_mille(F.col("n_symbols"), F.col("n_words")))
        .withColumn("lines", _per_mille(F.col("n_dup_lines"), F.col("n_lines")))
        .withColumn("repeats", _per_mille(F.col("n_repeat_words"), F.col("n_words")))
        .withColumn("capitals", _per_mille(F.col("n_capitals"), F.col("word_chars"))))


def allowed_losses(n: Column, alpha: float, delta: Column) -> Column:
    """The largest k with P(Binomial(n, alpha) <= k) <= delta, or -1. The sum runs in logarithms, up to n * alpha."""
    odds = math.log(alpha / (1 - alpha))

    def add(acc: Column, j: Column) -> Column:
        total = acc["total"] + F.exp(acc["term"])
        return F.struct(
            (acc["term"] + F.log((n - j).cast("double") / (j + 1)) + odds).alias("term"), total.alias("total"),
            F.when(total <= delta, j).otherwise(acc["k"]).alias("k"))

    start = F.struct((n * math.log(1 - alpha)).cast("double").alias("term"), F.lit(0.0).alias("total"),
                     F.lit(-1).cast("long").alias("k"))
    upto = F.least(n - 1, F.ceil(n * alpha)).cast("long")
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0).cast("long"), upto), start, add, lambda a: a["k"])).otherwise(-1)


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
            penalty: int = PENALTY) -> DataFrame:
    """stratum and a cutoff for each rule (null: off) from documents' signals and labels (doc_id, quality)."""
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
        .agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
        .where("least = most").select(F.col("doc_id").alias("labelled"), F.col("most").alias("good")))
    narrow = measured.where(~F.col("base_failed")).select("id", "stratum", *RULES)
    held = narrow.join(known, F.col("id") == F.col("labelled"))
    each = held.select(
        "stratum", "good", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES]))
        .alias("e")).select("stratum", "good", "e.rule", "e.value")
    counts = staged(each.groupBy("stratum", "rule", "value").agg(
        F.sum("good").cast("long").alias("good"), F.sum(1 - F.col("good")).cast("long").alias("bad")), "quality-counts")
    tests = max(1, counts.select("stratum", "rule").distinct().count())
    strict = W.partitionBy("stratum", "rule").orderBy(F.col("value").desc())
    losses = (
        counts.withColumn("n", F.sum("good").over(W.partitionBy("stratum", "rule")))
        .withColumn("lost", F.sum("good").over(strict)).withColumn("caught", F.sum("bad").over(strict)))
    sizes = counts.groupBy("stratum", "rule").agg(F.sum("good").cast("long").alias("m")).groupBy("m").agg(F.lit(0))
    limits = staged(sizes.select("m", allowed_losses(F.col("m"), alpha, F.lit(delta / tests)).alias("allowed")), "quality-limits")
    passed = (
        lookup_join(losses.where("value > 0"), limits, F.col("n") == F.col("m"), "inner")
        .where("lost <= allowed").withColumn("gain", F.col("caught") - penalty * F.col("lost")).where("gain > 0"))
    best = passed.groupBy("stratum", "rule").agg(F.max(F.struct("gain", "value"))["value"].alias("cutoff"))
    return best.groupBy(F.col("stratum").alias("of")).agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"{r}_cutoff") for r in RULES])


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, penalty: int = PENALTY,
          carry: bool = False) -> DataFrame:
    """Signals of every document with ``kept`` and ``reasons``, the rules that it breaks."""
    measured = staged(signals(docs, carry=carry), "quality-signals")
    rules = staged(cutoffs(measured, labels, alpha, delta, penalty), "quality-cutoffs")
    joined = lookup_join(measured, rules, F.col("stratum") == F.col("of")).drop("of")
    broken = [F.when(F.coalesce(F.col(r) >= F.col(f"{r}_cutoff"), F.lit(False)), F.lit(r)) for r in RULES]
    reasons = F.array_compact(F.array(F.when(F.col("base_failed"), F.lit("base")), *broken))
    return joined.withColumn("reasons", reasons).withColumn("kept", F.size("reasons") == 0)


def kept_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    return judge(docs, labels, carry=True, **settings).where("kept").select("row.*")
