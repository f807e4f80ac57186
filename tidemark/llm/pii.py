"""Personal data in texts, and the terms that give it away. DataFrame functions only.

Base spans are mail addresses, IP addresses, card and phone numbers, found by pattern and checked (parts up to 255,
Luhn's sum, numbers of digits). Each distinct value is a protected entity. A term (a run of three or more letters;
all characters beyond ASCII count as letters) reveals an entity as far as the corpus says so. With N documents, n(c) of
them holding entity c, n(t) holding term t anywhere, and n(c, t) holding t within ``WINDOW`` characters of c:

    PMI(c; t) = log2( N n(c, t) / (n(c) n(t)) ),    IC(c) = log2( N / n(c) )

A term exceeds the threshold for c if it stands beside c in ``SUPPORT`` documents or more, makes c likelier than not
(2 n(c, t) >= n(t)), tells ``BITS`` bits or more about c, and at least half of c's information (2 PMI >= IC). All four
are compared in whole numbers. Such a term is sanitised wherever it occurs in the corpus, beside the entity or not:
it is generalised to its first letters if that class of terms (counted in the same way) stays below the threshold, and
removed if not. Spans of terms that overlap a base span are left out; base spans always stay.

Positions are code points. Patterns have no match positions in Spark SQL, so texts are split at the matches and lengths
are summed up, in blocks of about the root of their number: a text of n matches takes n^1.5 small steps, no text is
scanned once per match. Quantifiers are possessive and runs are entered at their start only, which gives the same matches in
linear time, without recursion.

Skew: every count combines on the map side, so an entity, term or passage in a third of all rows is one row per task. Terms
that no entity could reveal are dropped by their counts before entities and terms are joined, so that common words never
meet all entities. Flagged terms are sent to every executor only if counted few.

Defined results: null text counts as empty; an empty text has no spans; rows that share id and text share spans and
count each as a document; equal starts are ordered by kind as listed; an empty table gives no rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, row_key, settled, small, text_or_empty

WINDOW, SUPPORT, BITS, CLASS_LETTERS = 48, 3, 3, 3
#: The same class written as what it excludes takes Java thirty times as long.
LETTERS = r"[A-Za-z\x{80}-\x{10FFFF}]"
TERM = LETTERS + "{3,}+"
#: Kinds in order, each with its pattern: as stated, with possessive quantifiers.
_local, _name = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_local})){_local}++@{_name}++(?:\.{_name}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*PATTERNS, "general", "removed")
_part = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
IP = rf"^{_part}(?:\.{_part}){{3}}$"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def running(steps: Column) -> Column:
    """Sums of the first 1, 2, ... numbers of an array."""

    def along(values: Column, start: Column) -> Column:
        empty = F.struct(start.alias("sum"), F.array().cast("array<int>").alias("all"))

        def add(acc: Column, v: Column) -> Column:
            return F.struct((acc["sum"] + v).alias("sum"), F.concat(acc["all"], F.array(acc["sum"] + v)).alias("all"))

        return F.aggregate(values, empty, add, lambda acc: acc["all"])

    def blocks(steps: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(steps))).cast("int"), F.lit(1))
        cut = let(size, lambda b: F.transform(F.sequence(F.lit(0), F.ceil(F.size(steps) / b).cast("int") - 1), lambda k: F.slice(steps, k * b + 1, b)))

        def joined(parts: Column) -> Column:
            sums = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, v: a + v))
            before = let(along(sums, F.lit(0)), lambda e: F.concat(F.array(F.lit(0)), F.slice(e, F.lit(1), F.size(e) - 1)))
            return F.flatten(F.zip_with(parts, before, along))

        return let(cut, joined)

    return F.when(F.size(steps) > 0, let(steps, blocks)).otherwise(F.array().cast("array<int>"))


def matches(text: Column, pattern: str) -> Column:
    """All matches from left to right: (start, end, value, before, after), the texts up to the next match on both sides."""
    kind = "array<struct<start:int,end:int,value:string,before:string,after:string>>"

    def placed(found: Column, gaps: Column) -> Column:
        lengths = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.length(m) + F.length(g))

        def build(ends: Column) -> Column:
            return F.transform(
                found,
                lambda m, i: F.struct(
                    (ends[i] - F.length(m)).alias("start"), ends[i].alias("end"), m.alias("value"), gaps[i].alias("before"), gaps[i + 1].alias("after")
                ),
            )

        return let(running(lengths), build)

    some = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, let(F.split(text, pattern, -1), lambda gaps: placed(found, gaps))))
    return F.coalesce(some, F.array().cast(kind))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a number's digits, every second one from the right doubled, add up to a multiple of ten."""
    each = F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(i % 2 == 1, d.cast("int") * 2).otherwise(d.cast("int")))
    return F.aggregate(each, F.lit(0), lambda s, d: s + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP)
    if kind == "card":
        return let(digits(value), lambda d: F.length(d).between(12, 19) & luhn(d))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def near(window: int, before: Column, after: Column) -> Column:
    """Distinct terms within so many characters on both sides, without those that the window cuts."""
    left = F.when(F.length(before) > window, F.regexp_replace(F.right(before, F.lit(window)), f"^{LETTERS}++", "")).otherwise(before)
    right = F.when(F.length(after) > window, F.regexp_replace(F.left(after, F.lit(window)), f"{LETTERS}++$", "")).otherwise(after)
    return with_classes(F.regexp_extract_all(F.concat_ws(" ", left, right), F.lit(TERM), F.lit(0)))


def term_class(term: Column) -> Column:
    """The generalisation of a term: its first letters and a star, which no term has; null for short ones."""
    return F.when(F.length(term) > CLASS_LETTERS + 1, F.concat(F.substring(term, 1, CLASS_LETTERS), F.lit("*")))


def with_classes(terms: Column) -> Column:
    return let(F.array_distinct(terms), lambda t: F.array_compact(F.concat(t, F.array_distinct(F.transform(t, term_class)))))


def base_spans(text: Column, window: int = WINDOW) -> Column:
    """The checked matches of all kinds, by start and kind, with the terms beside them."""

    def of(kind: str, number: int) -> Column:
        # a look for the one character that every match holds saves most texts the pattern
        sign = {"email": "@", "phone": "+", "ip": "."}.get(kind)
        found = matches(text, PATTERNS[kind])
        if sign:
            found = F.when(F.contains(text, F.lit(sign)), found)
        checked = F.filter(found, lambda m: valid(kind, m["value"]))
        spans = F.transform(
            checked, lambda m: F.struct(m["start"], F.lit(number).alias("kind"), m["end"], m["value"], near(window, m["before"], m["after"]).alias("terms"))
        )
        return F.coalesce(spans, F.array().cast("array<struct<start:int,kind:int,end:int,value:string,terms:array<string>>>"))

    return F.array_sort(F.concat(*(of(kind, i) for i, kind in enumerate(PATTERNS))))


def entity(span: Column) -> Column:
    """A protected value: its kind, and its text or, of cards and phones, its digits."""
    numbers = list(PATTERNS).index("card")
    return F.concat_ws(":", span["kind"].cast("string"), F.when(span["kind"] >= numbers, digits(span["value"])).otherwise(span["value"]))


def revealing(base: DataFrame, texts: DataFrame, total: int) -> DataFrame:
    """Rows (term): the terms and classes of terms that exceed the threshold for some entity."""
    entities = base.select(F.explode(F.array_distinct(F.transform("base", entity))).alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"))
    beside = F.flatten(F.transform("base", lambda s: let(entity(s), lambda e: F.transform(s["terms"], lambda t: F.struct(e.alias("entity"), t.alias("term"))))))
    pairs = base.select(F.inline(F.array_distinct(beside))).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_ct"))
    pairs = settled(pairs.where(F.col("n_ct") >= SUPPORT))
    most = pairs.groupBy("term").agg(F.max("n_ct").alias("most"))
    held = texts.select(F.explode(with_classes(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)))).alias("term"))
    counts = held.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    rare = small(counts.join(most, "term").where(2 * F.col("most") >= F.col("n_t")).select("term", "n_t"))
    known = pairs.join(rare, "term").join(entities, "entity")
    n, c, t, ct = (v.cast("decimal(12,0)") for v in (F.lit(total), F.col("n_c"), F.col("n_t"), F.col("n_ct")))
    likely, tells, half = 2 * F.col("n_ct") >= F.col("n_t"), n * ct >= c * t * (1 << BITS), ct * ct * n >= t * t * c
    return known.where(likely & tells & half).select("term").distinct()


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, ``base`` and ``spans``, arrays of (start, kind, end, value) in order."""
    keyed = docs.select(row_key(id_column, text_column).alias("_key"), F.col(id_column), text_or_empty(text_column).alias("text"))
    base = settled(keyed.select("_key", id_column, base_spans(F.col("text")).alias("base")))
    flagged = settled(revealing(base, keyed, base.count()))
    classes = flagged.where(F.endswith("term", F.lit("*"))).select(F.col("term").alias("class"), F.lit(True).alias("known"))
    terms = flagged.where(~F.endswith("term", F.lit("*"))).withColumn("class", term_class(F.col("term"))).join(classes, "class", "left")
    general, removed = KINDS.index("general"), KINDS.index("removed")
    terms = small(terms.select("term", F.when(F.col("class").isNull() | F.col("known"), removed).otherwise(general).alias("kind")))
    # few texts hold a flagged term; the others are not asked for places
    words = keyed.select("_key", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)))).alias("term"))
    holders = small(words.join(terms, "term", "left_semi").select("_key").distinct())
    places = keyed.join(holders, "_key", "left_semi").select("_key", F.inline(F.transform(matches(F.col("text"), TERM), lambda m: F.struct(m["start"], m["end"], m["value"]))))
    found = places.join(terms, F.col("value") == F.col("term")).groupBy("_key").agg(F.collect_set(F.struct("start", "kind", "end", "value")).alias("found"))
    plain = base.withColumn("base", F.transform("base", lambda s: F.struct(s["start"], s["kind"], s["end"], s["value"])))
    apart = F.filter("found", lambda f: ~F.exists("base", lambda b: (f["start"] < b["end"]) & (b["start"] < f["end"])))
    more = F.when(F.col("found").isNotNull(), apart).otherwise(F.array().cast(SPAN))
    return plain.join(settled(found), "_key", "left").withColumn("spans", F.array_sort(F.concat("base", more))).drop("found")


def listed(spans: str) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    counts = (count(i).alias(f"n_{kind}") for i, kind in enumerate(PATTERNS))
    return found.select(id_column, *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def sanitise(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with their spans replaced: ``[EMAIL]`` and so on, a class like ``abc*``, or ``[REMOVED]``.

    Of spans that overlap, the first one's replacement stands for all. A null text stays null.
    """
    known = found.select("_key", "spans").dropDuplicates(["_key"])
    wide = docs.withColumn("_key", row_key(id_column, text_column)).join(known, "_key", "left")
    text = F.col(text_column)
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def put(acc: Column, s: Column) -> Column:
        kind = F.when(s["kind"] == KINDS.index("general"), term_class(s["value"])).otherwise(names[s["kind"]])
        piece = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), kind)
        fresh = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["parts"], F.array(piece))).otherwise(acc["parts"]).alias("parts"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    done = F.aggregate("spans", empty, put, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return wide.withColumn(text_column, F.when(text.isNotNull(), done)).select(*docs.columns)
