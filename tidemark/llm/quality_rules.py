"""Quality rules whose cutoffs are certified on labelled documents. DataFrame functions only.

Per stratum (language; null is one of its own) and rule, a ladder of cutoffs is tried from lax to strict.
A cutoff is certified if, were its true rate of rejecting good documents ``limit``, so few rejections
among the labelled good ones would have a chance of at most ``risk`` divided by the number of tests in
parallel (strata times rules): an exact binomial bound with a Bonferroni correction. Along a ladder the
tests stop at the first failure, which needs no further correction. Of the certified cutoffs the
strictest is used that also rejects ``lift`` times as large a share of labelled bad documents as of good
ones. Rules share the limit, so that all of them together stay below ``total_limit`` in each stratum.

Defined results: null text has no words and fails the base; a stratum with too few labels gets no cutoff
and keeps all that passes the base; labels of an id that disagree, or are null, are not used; repeated
rows are judged alike; columns of the input that have a result's name are replaced.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, replacing, settled, small, text_or_empty

BLANK_RUN = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"

#: Cutoffs from lax to strict; a document is rejected if its value is above.
LADDERS = {
    "symbol_rate": (0.5, 0.35, 0.25, 0.18, 0.13, 0.1, 0.08, 0.06, 0.05, 0.04),
    "dup_line_rate": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25),
    "repeat_rate": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15),
    "long_word_mean": (30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0),
}
TOTAL_LIMIT, RISK, LIFT = 0.05, 0.05, 5.0


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more: sort windows, mark equal neighbours, measure their union."""
    n = F.size(words)

    def window(i: Column) -> Column:
        three = [words[i], words[i + 1], words[i + 2]]
        return F.struct(F.xxhash64(*three).alias("h"), i.alias("i"))

    def same(x: Column, y: Column) -> Column:
        equal = x["h"] == y["h"]
        for k in range(3):
            equal = equal & (words[x["i"] + k] == words[y["i"] + k])
        return equal

    def marked(windows: Column) -> Column:
        def twice(x, j):
            return same(x, F.get(windows, j - 1)) | same(x, F.get(windows, j + 1))

        return F.transform(F.filter(windows, lambda x, j: F.coalesce(twice(x, j), F.lit(False))), lambda x: x["i"])

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.sort_array(places),
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"],
        )

    def measured(windows: Column) -> Column:
        some = F.size(F.array_distinct(F.transform(windows, lambda x: x["h"]))) < F.size(windows)
        return F.when(some, covered(let(F.sort_array(windows), marked))).otherwise(F.lit(0))

    return F.when(n >= 4, let(F.transform(F.sequence(F.lit(0), n - 3), window), measured)).otherwise(F.lit(0))


def with_base(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with the base counts, base_failed and the values of the rules (columns ``_r_*``)."""
    text = text_or_empty(text_column)
    words = F.array_remove(F.split(text, BLANK_RUN, -1), "")
    counted = let(words, lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), repeat_words(w).alias("repeated")))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(NOT_BLANK)))
    lined = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))
    df = docs.withColumns({"_counted": counted, "_lined": lined})
    df = df.withColumns(
        {
            "_n_words": F.col("_counted.n").cast("long"),
            "_word_chars": F.col("_counted.chars").cast("long"),
            "_n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "_n_lines": F.col("_lined.n"),
            "_n_dup_lines": (F.col("_lined.n") - F.col("_lined.distinct")).cast("long"),
            "_n_repeat_words": F.col("_counted.repeated").cast("long"),
        }
    ).drop("_counted", "_lined")
    over = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return df.withColumns(
        {
            "_base_failed": (F.col("_n_words") < 50) | (100 * F.col("_n_repeat_words") > 50 * F.col("_n_words")),
            "_r_symbol_rate": over("_n_symbols", "_word_chars"),
            "_r_dup_line_rate": over("_n_dup_lines", "_n_lines"),
            "_r_repeat_rate": over("_n_repeat_words", "_n_words"),
            "_r_long_word_mean": over("_word_chars", "_n_words"),
        }
    ).drop("_n_lines")


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(at most k of n) at rate p, summed in logarithms; terms past n * p need no sum, as then it exceeds any risk of use."""
    start = n * math.log1p(-p)
    odds = math.log(p) - math.log1p(-p)
    plus = lambda a, b: F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        return F.struct(term.alias("term"), plus(a["sum"], term).alias("sum"))

    summed = F.aggregate(
        F.sequence(F.lit(0).cast("long"), k.cast("long")),
        F.struct(start.alias("term"), start.alias("sum")),
        lambda a, i: F.when(i == 0, a).otherwise(step(a, F.greatest(i, F.lit(1)))),
        lambda a: F.exp(a["sum"]),
    )
    return F.when(k > n * p, F.lit(1.0)).otherwise(summed)


def agreed_labels(labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality") -> DataFrame:
    """One row per id whose labels agree."""
    known = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1))
    per = known.groupBy(F.col(id_column).alias("_label_id")).agg(F.min(label_column).alias("_label"), F.max(label_column).alias("_other"))
    return per.where("_label = _other").drop("_other")


def certified(values: DataFrame, ladders: dict = LADDERS, total_limit: float = TOTAL_LIMIT, risk: float = RISK, lift: float = LIFT) -> DataFrame:
    """(stratum, rule, cutoff) from rows of stratum, ``_label`` and rule values, one row a labelled document."""
    counts = [F.sum(F.col("_label")).alias("good"), F.sum(1 - F.col("_label")).alias("bad")]
    for rule, steps in ladders.items():
        for j, cutoff in enumerate(steps):
            hit = F.col(f"_r_{rule}") > cutoff
            counts += [F.sum(F.when(hit, F.col("_label")).otherwise(0)).alias(f"g_{rule}_{j}"), F.sum(F.when(hit, 1 - F.col("_label")).otherwise(0)).alias(f"b_{rule}_{j}")]
    per = values.groupBy("stratum").agg(*counts)
    steps = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(j).alias("j"), F.lit(c).alias("cutoff"), F.col(f"g_{r}_{j}").alias("g"), F.col(f"b_{r}_{j}").alias("b")) for r, ladder in ladders.items() for j, c in enumerate(ladder)])
    strata = settled(per.select("stratum", "good", "bad", F.explode(steps).alias("s")).select("stratum", "good", "bad", "s.*"))
    parallel = max(1, strata.select("stratum").distinct().count()) * len(ladders)
    tested = strata.withColumn("chance", binomial_tail(F.col("g"), F.col("good"), total_limit / len(ladders)))
    ok = tested.where((F.col("chance") <= risk / parallel) & (F.col("b") * F.col("good") > lift * F.col("g") * F.col("bad")) & (F.col("b") > 0))
    best = ok.groupBy("stratum", "rule").agg(F.max(F.struct("j", "cutoff")).alias("x"))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("x.cutoff"))).alias(f"_c_{r}") for r in ladders])


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", stratum_column: str = "lang", keep_text: bool = False, **options) -> DataFrame:
    """The documents with the base counts, base_failed and kept.

    Texts are read once: their counts are settled, and fit and verdict use those. With ``keep_text`` the
    result carries the texts, at the price of a second reading.
    """
    ladders = options.get("ladders", LADDERS)
    stratum = F.col(stratum_column).cast("string")
    counts = settled(with_base(docs, text_column).drop(text_column))
    known = agreed_labels(labels, id_column)
    labelled = counts.join(known, F.col(id_column) == F.col("_label_id")).where("not _base_failed")
    cutoffs = small(certified(labelled.withColumn("stratum", stratum), **options).withColumnRenamed("stratum", "_stratum"))
    judged = (with_base(docs, text_column) if keep_text else counts).join(cutoffs, stratum.eqNullSafe(F.col("_stratum")), "left")
    reject = F.lit(False)
    for rule in ladders:
        reject = reject | F.coalesce(F.col(f"_r_{rule}") > F.col(f"_c_{rule}"), F.lit(False))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = replacing(judged, {n: F.col(f"_{n}") for n in names} | {"kept": ~F.col("_base_failed") & ~reject})
    return out.drop(*[f"_{n}" for n in names], "_stratum", *[f"_r_{r}" for r in ladders], *[f"_c_{r}" for r in ladders])
