"""How far the sources of a language differ in their words: distances of sources, and their typical terms.

Identical texts of a language are grouped first, with the number of copies in each source, and each is
tokenised once: its term counts are added, times the copies, to the counts of its sources, and the copies to the
term's document frequency. A language keeps the terms of enough documents. A group (source of a language)
gives each kept term a smoothed share in billionths; shares of absent terms are one number per group, so
sums over all kept terms follow from the terms that occur:

    sum |p_g - p_h| = V |z_g - z_h| + one(g, z_h) + one(h, z_g) + both(g, h)

with ``z`` the share of an absent term, ``one(g, z)`` the sum over g's terms of |p_g - z| - |z_g - z|, taken from
g's histogram of shares, and ``both`` the correction on terms that g and h share. That last sum runs over blocks of
``BLOCK`` sources in numpy: a term adds a small matrix to the block's, and a block's matrix leaves its task once for
``TERMS`` terms, so no pair of sources is ever written for a single term.

Skew: copies fold on the map side before texts move, and texts are known by their SHA-256. Counts leave Python as
sums of many texts, so a common term is a few rows per task. A term has at most one entry per source, a histogram at
most one per distinct count. Pairs of sources of a language are the result itself; they are dealt over ``DEAL`` tasks.

Arithmetic is exact, in whole numbers. Defined results: null text, lang and source are the empty string;
repeated rows count each; groups without terms take part with zero counts; a language without kept terms has
distance 0 between all sources and no typical terms; an empty table gives no rows.
"""
from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled, small, trim

MIN_DOCS, SMOOTH, SCALE, TOP = 30, 5, 1_000_000_000, 50
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Terms, and words times sources, that a task holds before it hands its counts on, so many rows at a time.
HELD, WORDS, ROWS = 400_000, 2_000_000, 50_000
BLOCK, TERMS, DEAL = 512, 2_000, 16


def collapse(docs: DataFrame) -> DataFrame:
    """One row per language and text, with ``sources``, an array of (source, copies). Texts move once."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    copies = rows.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("n"))
    copies = copies.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    return texts.join(copies, ["lang", "digest"]).drop("digest")


def texts(value: str, n: int) -> np.ndarray:
    """A column of one text as plain objects, which all versions of pandas hand on as one array."""
    return np.full(n, value, object)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over many texts: (lang, source, term, n occurrences, number of documents).

    Terms and sources become numbers as they come, and the numbers are counted together by sorting.
    """
    terms: dict[str, defaultdict[str, int]] = {}
    names: defaultdict[str, int] = defaultdict(count().__next__)
    number, n_terms, size = count(), 0, 0
    words, held = [], []  # by text: its terms in order, and its (source, copies)

    def out() -> Iterator[pa.RecordBatch]:
        lang, place = np.empty(n_terms, np.int64), np.empty(n_terms, np.int64)
        at = 0
        for k, of in enumerate(terms.values()):
            own = np.fromiter(of.values(), np.int64, len(of))
            lang[own], place[own] = k, np.arange(at, at + len(of))
            at += len(of)
        text = np.repeat(np.arange(len(words)), [len(w) for w in words])
        key, times = np.unique(text * n_terms + np.concatenate(words), return_counts=True)
        text, term = np.divmod(key, n_terms)
        # a row for each source of a text
        n_sources = np.array([len(x) for x in held])
        source, copies = np.array([x for one in held for x in one], np.int64).T
        each = n_sources[text]
        within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        where = np.repeat((np.cumsum(n_sources) - n_sources)[text], each) + within
        key, times, copies = source[where] * n_terms + np.repeat(term, each), np.repeat(times, each), copies[where]
        order = np.argsort(key, kind="stable")
        key, times, copies = key[order], times[order], copies[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n, docs = np.add.reduceat(times * copies, first), np.add.reduceat(copies, first)
        source, term = np.divmod(key[first], n_terms)
        langs, sources, all_terms = (pa.array(list(x), pa.string()) for x in (terms, names, chain.from_iterable(terms.values())))
        for at in range(0, len(first), ROWS):
            s, t = source[at : at + ROWS], term[at : at + ROWS]
            columns = [langs.take(pa.array(lang[t])), sources.take(pa.array(s)), all_terms.take(pa.array(place[t])), pa.array(n[at : at + ROWS]), pa.array(docs[at : at + ROWS])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, text, sources in zip(*(batch.column(c) for c in ("lang", "text", "sources")), strict=True):
            found = TERM.findall(text.as_py().encode().lower().decode())  # of bytes, only A to Z have a lower case
            if not found:
                continue
            of = terms.setdefault(lang.as_py(), defaultdict(number.__next__))
            before = len(of)
            numbers = np.fromiter(map(of.__getitem__, found), np.int64, len(found))
            n_terms += len(of) - before
            own = [(names[s["source"]], s["n"]) for s in sources.as_py()]
            part = max(1, WORDS // len(found))  # a text of very many sources in turns
            for k in range(0, len(own), part):
                words.append(numbers)
                held.append(own[k : k + part])
                size += len(found) * len(held[-1])
                if size > WORDS or n_terms > HELD:
                    yield from out()
                    words.clear()
                    held.clear()
                    size = 0
            if not words:  # all is out, and so are the numbers
                terms.clear()
                names.clear()
                number, n_terms = count(), 0
                names.default_factory = count().__next__
                trim()
    if words:
        yield from out()
    trim()


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE (count + SMOOTH) / (n + SMOOTH v)), exact; null if nothing is kept."""
    top = (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (n + SMOOTH * v).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", top, F.when(v > 0, below)).cast("long")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows (lang, term, n, sources): the kept terms with their counts, in all and by source."""
    counted = collapse(docs).mapInArrow(count_terms, "lang string, source string, term string, n long, docs long")
    # Python has folded these rows, so they are dealt by term as they are, and both sums are taken where they lie
    dealt = counted.repartition("lang", "term")
    sums = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = sums.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    return terms.where(F.col("docs") >= min_docs).drop("docs")


def groups(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Every (lang, source) with its number ``i``, its sum ``n``, the language's ``v`` and ``n_lang``, and ``z``."""
    found = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n_lang"))
    own = terms.select("lang", F.inline("sources")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    known = found.join(langs, "lang", "left").join(own, ["lang", "source"], "left").na.fill(0, ["v", "n_lang", "n"])
    known = known.withColumn("z", F.coalesce(share(F.lit(0), F.col("n"), F.col("v")), F.lit(0).cast("long")))
    return known.withColumn("i", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)


def add_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Corrections of shared terms by pairs of sources; rows come ordered by language and pair of blocks."""
    at, total = None, None

    def out() -> pd.DataFrame:
        lang, a, b = at
        rows, columns = np.nonzero(total)
        return pd.DataFrame({"lang": texts(lang, len(rows)), "g": rows + a * BLOCK, "h": columns + b * BLOCK, "value": total[rows, columns]})

    for batch in batches:
        for lang, a, b, entries in zip(batch["lang"], batch["a"], batch["b"], batch["entries"]):
            if at != (lang, a, b):
                if at is not None:
                    yield out()
                at, total = (lang, a, b), np.zeros((BLOCK, BLOCK), dtype=np.int64)
            i, p, z = (np.array([e[c] for e in entries], dtype=np.int64) for c in ("i", "p", "z"))
            left, right = np.flatnonzero(i // BLOCK == a), np.flatnonzero(i // BLOCK == b)
            pl, zl, pr, zr = p[left, None], z[left, None], p[None, right], z[None, right]
            total[np.ix_(i[left] % BLOCK, i[right] % BLOCK)] += abs(pl - pr) - abs(pl - zr) - abs(zl - pr) + abs(zl - zr)
    if at is not None:
        yield out()


def shared_terms(entries: DataFrame) -> DataFrame:
    """(lang, g, h, both): the correction for two sources, by number, that have kept terms in common."""
    rows = entries.groupBy("lang", "term", "v").agg(F.collect_list(F.struct("i", "p", "z")).alias("entries"))
    rows = rows.withColumn("blocks", F.array_sort(F.array_distinct(F.transform("entries", lambda e: F.floor(e["i"] / BLOCK).cast("int")))))
    pairs = F.flatten(F.transform("blocks", lambda a: F.transform(F.filter("blocks", lambda b: b >= a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    deal = F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / TERMS)).alias("deal")
    dealt = rows.select("lang", deal, F.inline(pairs), "entries").repartition("lang", "a", "b", "deal")
    sums = dealt.sortWithinPartitions("lang", "a", "b").mapInPandas(add_blocks, "lang string, g long, h long, value long")
    # a pair of different blocks is summed one way only; a block with itself both ways
    other = (F.floor(F.col("g") / BLOCK) != F.floor(F.col("h") / BLOCK)).alias("other")
    both = F.array(F.struct("g", "h"), F.struct(F.col("h").alias("g"), F.col("g").alias("h")))
    sides = sums.select("lang", "value", F.inline(F.slice(both, F.lit(1), F.when(other, 2).otherwise(1))))
    return sides.groupBy("lang", "g", "h").agg(F.sum("value").alias("both"))


def one_sided(terms: Column, z: Column, other: Column) -> Column:
    """Sum over a histogram of (p, n) of n (|p - other| - |z - other|)."""
    step = lambda total, t: total + t["n"] * (F.abs(t["p"] - other) - F.abs(z - other))
    return F.aggregate(F.coalesce(terms, F.array().cast("array<struct<p:bigint,n:bigint>>")), F.lit(0).cast("long"), step)


def distances(entries: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value) for all ordered pairs of sources of a language."""
    steps = entries.groupBy("lang", "i", "p").agg(F.count(F.lit(1)).alias("n"))
    steps = steps.groupBy("lang", "i").agg(F.collect_list(F.struct("p", "n")).alias("terms"))
    sides = known.select("lang", "source", "i", "z", "v").join(steps, ["lang", "i"], "left")
    left = sides.withColumn("deal", F.pmod("i", F.lit(DEAL)).cast("int"))
    right = sides.select("lang", *(F.col(c).alias(f"{c}_2") for c in ("source", "i", "z", "terms")), F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1))).alias("deal"))
    pairs = left.join(right, ["lang", "deal"]).where("i != i_2")
    apart = F.col("v") * F.abs(F.col("z") - F.col("z_2")) + one_sided(F.col("terms"), F.col("z"), F.col("z_2")) + one_sided(F.col("terms_2"), F.col("z_2"), F.col("z"))
    pairs = pairs.select("lang", "source", F.col("source_2").alias("item"), F.col("i").alias("g"), F.col("i_2").alias("h"), apart.alias("apart"))
    met = pairs.join(shared_terms(entries), ["lang", "g", "h"], "left")
    return met.select("lang", "source", "item", (F.col("apart") + F.coalesce("both", F.lit(0))).alias("value"))


def typical_terms(entries: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value): the terms that a group uses more than its language does."""
    over = entries.where(F.col("p") > F.col("q"))
    return over.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))


def ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): part ``pair``, all other sources of the language by
    distance, and part ``term``, the ``top`` terms of which the source has more than its language."""
    terms = settled(kept_terms(docs, min_docs))
    known = small(groups(docs, terms))
    entries = terms.select("lang", "term", F.col("n").alias("all"), F.inline("sources")).withColumnRenamed("n", "count")
    entries = entries.join(known, ["lang", "source"]).select(
        "lang", "term", "source", "i", "z", "v",
        share(F.col("count"), F.col("n"), F.col("v")).alias("p"), share(F.col("all"), F.col("n_lang"), F.col("v")).alias("q"),
    )
    pairs, words = ranked(distances(entries, known), "pair"), ranked(typical_terms(entries), "term")
    return pairs.unionByName(words.where(F.col("rank") <= top))
