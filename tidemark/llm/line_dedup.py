"""Remove multi-line chunks, and passages on one line, that the corpus repeats. DataFrame functions only.

Lines are hashed; a hash rolling over ``window`` line hashes ends a chunk where it falls on a chosen
residue, so boundaries depend on content alone and survive insertions before them. Compared are chunks
of ``min_lines`` lines or more and, as chunks whose size forces a cut, single lines of ``long_words``
words or more. So that the ends of a repeated passage, which lie between its outermost boundaries and its
neighbours, go with it, every two successive lines that are not blank are compared, too, with the blank ones
between: a run of two or more equal lines goes as a whole wherever it stands, whatever its lines' length.
Narrow rows (hash, document, place) first tell which hashes repeat. Only for those are the
bytes compared, by grouping on the text itself. The first occurrence (by id, then place) stays; a pair that
overlaps its own first occurrence (a line said three times) leaves that standing.

Skew: hashes are counted on the map side. The occurrences of a hash, which carry text, are dealt into one share
for every ``SHARE`` of them; a share finds its first and last, shares agree on the first of all, and that
meets the occurrences share by share. Work is linear in the lines of a text.

Defined results: null text stays null; an empty text has one empty line, which is never dropped; a text
that loses all its lines becomes empty; rows that share id and text share decisions, and count once.
Columns of the input that have a result's name are replaced.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, let, replacing, row_key, text_or_empty

WINDOW, DIVISOR, MIN_LINES, LONG_WORDS = 2, 2, 2, 20
#: Base and modulus of the rolling hash.
BASE, PRIME = 31, 2147483647
#: Occurrences of a hash that one share takes.
SHARE = 500


def line_hashes(lines: Column) -> Column:
    return F.transform(lines, lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long"))


def pairs(long_words: int) -> Column:
    """Two successive lines that are not blank, with what stands between; two long ones are units by themselves."""
    words = F.transform("_lines", lambda x, i: F.struct(i.alias("i"), F.regexp_count(x, F.lit(WORD)).alias("words")))
    full = F.filter(words, lambda w: w["words"] > 0)

    def of(full: Column) -> Column:
        both = F.arrays_zip(full.alias("a"), F.slice(full, 2, F.greatest(F.size(full) - 1, F.lit(0))).alias("b"))
        both = F.filter(both, lambda p: p["b"].isNotNull() & ((p["a"]["words"] < long_words) | (p["b"]["words"] < long_words)))
        return F.transform(both, lambda p: F.struct(p["a"]["i"].alias("first"), (p["b"]["i"] - p["a"]["i"] + 1).alias("lines")))

    return let(full, of)


def with_units(df: DataFrame, window: int, divisor: int, min_lines: int, long_words: int) -> DataFrame:
    """From ``_lines``: ``_units``, an array of (first line, number of lines, text)."""
    df = df.withColumn("_hashes", line_hashes(F.col("_lines")))

    def cut(i: Column) -> Column:
        rolled = F.col("_hashes")[i]
        for back in range(1, window):
            power = pow(BASE, back, PRIME)
            rolled = rolled + F.when(i >= back, F.col("_hashes")[F.greatest(i - back, F.lit(0))] * power).otherwise(F.lit(0))
        return (rolled % PRIME) % divisor == 0

    n = F.size("_lines")
    df = df.withColumn("_ends", F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == n - 1) | cut(i)))

    def chunk(end: Column, j: Column) -> Column:
        first = F.when(j > 0, F.col("_ends")[F.greatest(j - 1, F.lit(0))] + 1).otherwise(F.lit(0))
        return F.struct(first.alias("first"), (end - first + 1).alias("lines"))

    chunks = F.filter(F.transform("_ends", chunk), lambda c: c["lines"] >= min_lines)
    solo = F.filter(
        F.transform("_lines", lambda x, i: F.struct(i.alias("first"), F.when(F.regexp_count(x, F.lit(WORD)) >= long_words, 1).otherwise(0).alias("lines"))),
        lambda c: c["lines"] == 1,
    )
    return df.withColumn("_units", F.concat(chunks, solo, pairs(long_words))).drop("_hashes", "_ends")


def unit_text(unit: Column) -> Column:
    return F.array_join(F.slice(F.col("_lines"), unit["first"] + 1, unit["lines"]), "\n")


def repeated_lines(keyed: DataFrame, id_column: str, text_column: str, window: int, divisor: int, min_lines: int, long_words: int) -> DataFrame:
    """``_key`` and ``_drop``, the array of line numbers to remove."""
    split = keyed.select("_key", F.col(id_column).alias("_id"), F.split(text_or_empty(text_column), "\n", -1).alias("_lines"))
    hashed = with_units(split, window, divisor, min_lines, long_words).select(
        "_key", F.explode(F.transform("_units", lambda u: F.struct(u["first"].alias("first"), u["lines"].alias("lines"), F.xxhash64(unit_text(u)).alias("h")))).alias("u")
    )
    hashed = hashed.select("_key", "u.*")
    often = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", F.ceil(F.col("n") / SHARE).alias("shares"))
    listed = hashed.join(often, "h").groupBy("_key").agg(F.collect_set(F.struct("first", "lines", "h", "shares")).alias("_found"))
    # the same exchange of texts by key serves here and where lines are dropped, if there are no further columns
    found = keyed.select("_key", id_column, text_column).join(listed, "_key")
    found = found.select("_key", F.col(id_column).alias("_id"), "_found", F.split(text_or_empty(text_column), "\n", -1).alias("_lines"))
    units = found.select("_key", "_id", F.explode(F.transform("_found", lambda u: F.struct(u["first"].alias("first"), u["lines"].alias("lines"), u["h"].alias("h"), u["shares"].alias("shares"), unit_text(u).alias("unit")))).alias("u"))
    share = F.pmod(F.xxhash64("_key", "u.first"), F.col("u.shares"))
    units = units.select("_key", "_id", "u.first", "u.lines", "u.h", "u.unit", "u.shares", share.alias("share")).repartition("h", "unit", "share")
    place = F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_key", "first")
    of = Window.partitionBy("h", "unit", "share")
    units = units.withColumn("place", place).withColumn("low", F.min("place").over(of)).withColumn("high", F.max("place").over(of))
    # only what has several shares moves again, one row a share
    ends = units.where((F.col("shares") > 1) & (F.col("place") == F.col("low")))
    owners = ends.groupBy("h", "unit").agg(F.min("low").alias("least"), F.max("high").alias("most"), F.collect_set("share").alias("in"))
    owners = owners.select("h", "unit", "least", "most", F.explode("in").alias("share"))
    later = units.join(owners, ["h", "unit", "share"], "left").withColumn("owner", F.coalesce("least", "low"))
    later = later.where((F.col("owner") != F.coalesce("most", "high")) & (F.col("place") != F.col("owner")))
    after = F.when(F.col("_key") == F.col("owner._key"), F.greatest(F.col("first"), F.col("owner.first") + F.col("lines"))).otherwise(F.col("first"))
    covered = F.sequence(after, F.col("first") + F.col("lines") - 1)
    return later.groupBy("_key").agg(F.array_distinct(F.flatten(F.collect_set(covered))).alias("_drop"))


def drop_repeated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES, long_words: int = LONG_WORDS) -> DataFrame:
    """The documents with their remaining text, n_lines and n_dropped."""
    keyed = docs.select(row_key(id_column, text_column).alias("_key"), *docs.columns)
    drops = repeated_lines(keyed, id_column, text_column, window, divisor, min_lines, long_words)
    wide = keyed.join(drops, "_key", "left").withColumn("_lines", F.split(text_or_empty(text_column), "\n", -1))
    numbers = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    kept = F.array_join(F.transform(numbers, lambda i: F.col("_lines")[i]), "\n")
    return replacing(
        wide,
        {
            text_column: F.when(F.col("_drop").isNull(), F.col(text_column)).otherwise(kept),
            "n_lines": F.when(F.col(text_column).isNull(), 0).otherwise(F.size("_lines")).cast("long"),
            "n_dropped": F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long"),
        },
    ).drop("_key", "_drop", "_lines")
