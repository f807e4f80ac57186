"""Mix sources to target weights by hash thresholds, without sorting documents.

Every document has a place on a line of ``2**BITS`` hash values. A source takes all its documents
``floor(target / size)`` times and, once more, those below a threshold whose sizes come nearest the
rest. The threshold is found in nested histograms: sizes are summed by source and bucket, the bucket
in which the running sum crosses the budget is cut into buckets in turn, down to one hash value.

Defined results: null text has size 0; null is a source of its own, the last; rows that
share id and text share a hash value, so they are taken together; a source without words has target 0; an empty table gives an
empty result. Columns of the input that have a result's name are replaced.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, replacing, settled, small, text_or_empty

BITS, STEP = 40, 10


def words_in(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def place(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """A document's hash value, from its id and text: the first 40 bits of an md5."""
    key = F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("null")), F.lit("\u0001"), text_or_empty(text_column))
    digits = F.substring(F.md5(key), 1, BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Source, source_size and target from rows of (source, size).

    Shares go by weight until a source meets ``most`` times its size; the rest is shared again. Ordered
    by cap over weight, the sources that meet their cap come first, so two running sums settle it. One
    row per source arrives in the windows without partition.
    """
    cycle = F.array(*map(F.lit, weights))
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("w", cycle[(rank % len(weights)).cast("int")]).withColumn("cap", F.col("source_size") * most)
    common = 1
    for w in weights:
        common *= w
    order = Window.orderBy(F.expr(f"cap * {common} div w"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        F.sum("w").over(after).alias("w_left"),
    )
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    per = per.withColumn("capped", wide("cap") * wide("w_left") <= wide("left") * wide("w"))
    # the first source that misses its cap sets the level for all behind it
    all_in_order = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = F.first(F.when(~F.col("capped"), F.struct("left", "w_left")), ignorenulls=True).over(all_in_order)
    per = per.withColumn("level", level)
    share = (F.col("level.left") * F.col("w")).cast("double") / F.col("level.w_left").cast("double")
    capped = F.col("capped")
    return per.select("source", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(share).alias("target"))


def thresholds(places: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: times that all is taken, and the hash value below which it is taken once more."""
    state = small(
        targets.withColumn("times", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
        .withColumn("budget", F.col("target") - F.col("times") * F.col("source_size"))
        .select("source", "source_size", "target", "times", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"), F.lit(True).alias("open"))
    )
    running = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    for shift in range(BITS - STEP, -1, -STEP):
        at = F.shiftright("place", shift)
        inside = places.join(state.select(F.col("source").alias("s"), "prefix", "open", "budget", "before"), F.col("source").eqNullSafe(F.col("s")))
        inside = inside.where(F.col("open") & (F.shiftright("place", shift + STEP) == F.col("prefix")))
        sums = inside.groupBy("s", at.alias("bucket")).agg(F.sum("size").alias("n"), F.first("budget").alias("budget"), F.first("before").alias("b"))
        sums = sums.withColumn("upto", F.sum("n").over(running) + F.col("b")).where(F.col("upto") > F.col("budget"))
        crossed = sums.groupBy("s").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"), "n")).alias("x"))
        state = state.join(crossed, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "times", "budget",
            F.coalesce("x.bucket", "prefix").alias("prefix"), F.coalesce("x.before", "before").alias("before"),
            F.col("x").isNotNull().alias("open"), F.col("x.n").alias("n"),
        )
        state = small(state)
    # the last bucket is one hash value: it is taken if that comes nearer the budget
    last = F.col("prefix") + (2 * F.col("before") + F.col("n") <= 2 * F.col("budget")).cast("long")
    return small(
        state.select("source", "source_size", "target", "times", F.when(F.col("open"), last).otherwise(F.lit(1 << BITS)).alias("below"))
    )


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The documents with size, source_size, target, copies (times the mix holds it) and taken (its words)."""
    source = F.col(source_column).cast("string")
    places = settled(docs.select(source.alias("source"), words_in(text_column).alias("size"), place(id_column, text_column).alias("place")))
    found = thresholds(places, source_targets(places, weights, most)).select(
        F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("times").alias("_times"), F.col("below").alias("_below")
    )
    wide = docs.withColumns({"_size": words_in(text_column), "_place": place(id_column, text_column)})
    wide = wide.join(found, source.eqNullSafe(F.col("_source")))
    copies = F.when(F.col("_size") > 0, F.col("_times") + (F.col("_place") < F.col("_below")).cast("long")).otherwise(F.lit(0)).cast("long")
    return replacing(
        wide,
        {"size": F.col("_size"), "source_size": F.col("_source_size"), "target": F.col("_target"), "copies": copies, "taken": F.col("_size") * copies},
    ).drop("_size", "_place", "_source", "_source_size", "_target", "_times", "_below")
