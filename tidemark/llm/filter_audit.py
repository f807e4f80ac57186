"""How five text filters interact: what each removes in every order, and its Shapley share.

Each document becomes a mask of the filters it fails. For every part (a language) all 32 sets of filters are
tabulated: how many documents, good ones and toxic ones a set removes. From these 32 numbers everything
follows. A step of an order takes the difference of two sets. The Shapley share is the exact solution of the
least-squares problem whose weights are the Shapley kernel's, under the constraint that the shares add up to
what all filters remove together: the normal equations with their multiplier are solved once in rationals,
since the matrix depends on the number of filters alone, and the solution's rows, as whole numbers over one
denominator, meet each part's right-hand sides as column expressions.

Filter E (a text that a smaller id holds, too) needs no join of copies: rows are counted by text, part and
label, with the least id of each and its count, and only the rows at a text's least id are first. A text is
known by its SHA-256.

Skew: all groupings combine on the map side, and the first has the id in its key, so that a text or an id
that a third of all rows share is spread or folded before anything meets. After it a text is one row per
part and label. Labels are sent to every executor only if counted few; else they are shuffled, and rows
without an id are dealt over ``SPREAD`` keys.

Defined results: null text counts as empty; a null part is the empty string; a row without an id has no
smaller id and is none, so it never fails E and carries no label; rows that share id and text are equally
first; a document with several labels is good (toxic) if any says 1; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial, lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, small, text_or_empty

FILTERS = "ABCDE"
DUPLICATE = "E"
MIN_WORDS, MIN_DISTINCT_PCT, MAX_CAPITALS_PCT = 100, 80, 10
SYMBOLS = r"[#$%&*|]"
BLANKS = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPREAD = 1024


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS, -1), lambda w: w != "")


def own_failures(text: Column) -> Column:
    """Bits of the filters that look at one text: too few words, too few distinct ones, capitals, symbols."""

    def bit(letter: str, fails: Column) -> Column:
        return F.when(fails, 1 << FILTERS.index(letter)).otherwise(0)

    def of_words(words: Column) -> Column:
        n = F.size(words)
        return bit("A", n < MIN_WORDS) + bit("B", 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PCT * n)

    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return let(words_of(text), of_words) + bit("C", 100 * capitals > MAX_CAPITALS_PCT * F.length(text)) + bit("D", text.rlike(SYMBOLS))


def failure_table(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "lang") -> DataFrame:
    """Rows (part, mask, good, toxic, n): how many documents fail exactly the filters of the mask."""
    text = text_or_empty(text_column)
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), own_failures(text).alias("own"),
    )
    rows = rows.groupBy("id", "digest", "part", "own").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where(F.col("doc_id").isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1)))
    marks = marks.groupBy(F.col("doc_id").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    marks = small(marks.withColumn("deal", F.lit(0)))
    dealt = rows.withColumn("deal", F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest", "part"), F.lit(SPREAD))).otherwise(0).cast("int"))
    marked = dealt.join(marks, ["id", "deal"], "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    same = ("digest", "part", "own", "good", "toxic")
    groups = marked.groupBy(*same).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"),
    )
    # the groups of a text are few: its parts, times two labels
    known = groups.withColumn("first_id", F.min("least.id").over(Window.partitionBy("digest")))
    first = F.col("nameless") + F.when(F.col("least.id") == F.col("first_id"), F.col("least.n")).otherwise(0)
    both = F.array(
        F.struct(F.col("own").alias("mask"), first.alias("n")),
        F.struct((F.col("own") + (1 << FILTERS.index(DUPLICATE))).alias("mask"), (F.col("n") - first).alias("n")),
    )
    cells = known.select("part", "good", "toxic", F.inline(both)).where("n > 0")
    return cells.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def coalitions(table: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """One row per part: ``removed``, a map from each set of filters (as a mask) to what it removes."""
    members = table.withColumn("set", F.explode(F.sequence(F.lit(0), F.lit((1 << n_filters) - 1))))
    gone = F.when(F.col("mask").bitwiseAND(F.col("set")) != 0, F.col("n")).otherwise(0)
    sums = members.groupBy("part", "set").agg(
        F.sum(gone).alias("docs"),
        F.sum(F.when(F.col("good"), gone).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), gone).otherwise(0)).alias("toxic"),
        F.sum("n").alias("total"),
    )
    entry = F.struct("set", F.struct("docs", "good", "toxic"))
    return sums.groupBy("part").agg(F.max("total").alias("total"), F.map_from_entries(F.collect_list(entry)).alias("removed"))


def solve(matrix: Sequence[Sequence[Fraction]]) -> list[list[Fraction]]:
    """The inverse, by elimination in rationals."""
    n = len(matrix)
    rows = [[Fraction(v) for v in row] + [Fraction(i == j) for j in range(n)] for i, row in enumerate(matrix)]
    for c in range(n):
        pivot = next(r for r in range(c, n) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [v / rows[c][c] for v in rows[c]]
        for r in range(n):
            if r != c and rows[r][c]:
                factor = rows[r][c]
                rows[r] = [a - factor * b for a, b in zip(rows[r], rows[c])]
    return [row[n:] for row in rows]


def kernel(n: int, size: int) -> Fraction:
    """Weight of a set in the least-squares problem; the empty and the full one are constraints."""
    return Fraction(n - 1, comb(n, size) * size * (n - size)) if 0 < size < n else Fraction(0)


def shares(n: int = len(FILTERS)) -> tuple[list[dict[int, int]], int]:
    """For each filter whole factors of v(set), and the denominator, of its share of v(all).

    Least squares over sets S of weight w: sum of x_i over S is to be v(S), with the sum of all x equal to
    v(all). Normal equations: sum_j A_ij x_j + m = b_i, A_ij = sum of w over the sets holding i and j,
    b_i = sum of w v(S) over the sets holding i.
    """
    sets = range(1, (1 << n) - 1)
    weight = {s: kernel(n, bin(s).count("1")) for s in sets}
    normal = [[sum((weight[s] for s in sets if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(n)] + [Fraction(1)] for i in range(n)]
    inverse = solve([*normal, [Fraction(1)] * n + [Fraction(0)]])
    factors = []
    for i in range(n):
        own = {s: sum((inverse[i][j] * weight[s] for j in range(n) if s >> j & 1), Fraction(0)) for s in sets}
        factors.append(own | {(1 << n) - 1: inverse[i][n]})
    bottom = lcm(*(f.denominator for own in factors for f in own.values()))
    return [{s: int(f * bottom) for s, f in own.items()} for own in factors], bottom


def shapley_columns(removed: Column, n: int = len(FILTERS)) -> Column:
    """Array by filter: what it removes, summed over all orders; n! times a share is a whole number."""
    factors, bottom = shares(n)

    def column(own: dict[int, int]) -> Column:
        total = sum((removed[F.lit(s)]["docs"] * F.lit(f * factorial(n)).cast("long") for s, f in own.items() if f), F.lit(0).cast("long"))
        return F.call_function("div", total, F.lit(bottom).cast("long"))

    return F.array(*(column(own) for own in factors))


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part, order of the filters and step of it; see the module's head."""
    found = coalitions(failure_table(docs, labels, **columns)).withColumn("shares", shapley_columns(F.col("removed")))
    orders = ",".join("".join(p) for p in permutations(FILTERS))
    bits = F.create_map(*(F.lit(v) for i, letter in enumerate(FILTERS) for v in (letter, 1 << i)))
    steps = found.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letters = F.transform(F.split(F.substring("filter_order", 1, len(FILTERS)), ""), lambda x: bits[x])
    before = F.aggregate(F.slice(letters, F.lit(1), F.col("step") - 1), F.lit(0), lambda s, b: s + b)
    steps = steps.withColumns({"before": before, "bit": F.get(letters, F.col("step") - 1)})
    old, new = F.col("removed")[F.col("before")], F.col("removed")[F.col("before") + F.col("bit")]
    alone = F.col("removed")[F.col("bit")]["docs"]
    full = (1 << len(FILTERS)) - 1
    unique = F.col("removed")[F.lit(full)]["docs"] - F.col("removed")[F.lit(full) - F.col("bit")]["docs"]
    return steps.select(
        "part", "filter_order", "step",
        (F.col("total") - new["docs"]).alias("kept"),
        (new["docs"] - old["docs"]).alias("removed"),
        (alone - (new["docs"] - old["docs"])).alias("redundant"),
        unique.alias("unique_fails"),
        (new["good"] - old["good"]).alias("good_lost"),
        (new["toxic"] - old["toxic"]).alias("toxic_lost"),
        F.get("shares", F.log2("bit").cast("int")).alias("shapley"),
    )
