"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of hits in a lexicon, hits near a second-person word, capitals,
punctuation, and words disguised by signs, digits or spaced letters. The lexicon has a few common insults
and the words and word beginnings that labelled rows show to be toxic, by standing in a text at all or by
standing there twice or three times. Labelled rows that may be learned from (at most about ``rows``, drawn
by a hash) all serve the lexicon, by cross-fitting: a row's features come from a lexicon learned without
its fold, and copies share a fold; new texts get the lexicon of all folds. Trees are fitted on one part of
the rows and calibrated on the other, so nothing judges what it was fitted on. Trees and calibration are Spark's own.

Fitting reads each text once and keeps bounded narrow tables; a lexicon has at most ``words`` learned units.
Scoring is a map over all texts, then trees on narrow rows: no shuffle.

Defined results: null text counts as empty; empty texts are scored as their features say; labels of an
id that disagree, or are null, are not used; if one class lacks labels, every score is the smoothed share
of toxic labels (0 without labels); repeated rows get equal results; columns of the input that have a
result's name are replaced.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import replacing, settled, text_or_empty, trim
from .quality_rules import agreed_labels

#: Common insults to start from.
INSULTS = (
    "asshole bastard bitch coward creep damn disgusting dumb fool freak garbage hate idiot idiots imbecile jerk kill "
    "liar loser losers moron morons nazi pathetic pig pigs retard scum shit slut stupid trash ugly vermin whore worthless"
).split()
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu toi te ton ta tes vous votre vos du dich dir dein deine euch euer ihr sie usted ustedes ti tus vosotros".split()
)
WORD = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"[@$0-9!]?[^\W\d_]+(?:[*@$!#0-9.\-_]+[^\W\d_]+)+|[@$0-9!][^\W\d_]{2,}")
SPACED = re.compile(r"\b(?:[^\W\d_][ .\-_*]){3,}[^\W\d_]\b")
PLAIN = str.maketrans("@$01345!7", "asoieasit")
CAPITAL = re.compile("[A-ZÀ-ÖØ-Þ]")
SIGNS = re.compile(r"[*#.\-_ ]")
NEAR = 3
ROWS, WORDS, TREES, DEPTH, LEAST = 20_000, 300, 20, 3, 5
#: Bound on the expected share of false units in a learned lexicon, however many are tried (Benjamini and Hochberg).
FALSE = 0.01
#: Folds for cross-fitting; candidates for a lexicon that are looked at on the driver, as a multiple of its size.
FOLDS, LOOKED_AT = 4, 20
#: Times that a stem must stand in a text, besides once.
TIMES = (2, 3)
#: Lengths of the word beginnings that serve as stems.
STEMS = (4, 5, 6, 7)
SHORTEST = min(STEMS)
#: Units that a worker holds as Python objects at a time.
UNITS_HELD = 50_000
#: Partitions of the bounded sample; rows are dealt in turn, so copies of a text do not meet in one.
SAMPLE_PARTS = 32
#: score from which a document is predicted toxic
CUTOFF = 0.7


def held_out(id_column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 3 == 1


@lru_cache(maxsize=2 * FOLDS)
def heads_of(lexicon: frozenset[str]) -> frozenset[str]:
    """First letters of all stems, to pass over most words quickly."""
    return frozenset(s[1 : SHORTEST + 1] for s in lexicon if s[0] == "^")


@lru_cache(maxsize=2 * FOLDS)
def repeated_of(lexicon: frozenset[str]) -> tuple[frozenset[str], dict[str, list[int]]]:
    """First letters of the stems that count by their number in a text, and those numbers by stem."""
    times: dict[str, list[int]] = {}
    for k, _, stem in (s.partition("^") for s in lexicon if s[0].isdigit()):
        times.setdefault(stem, []).append(int(k))
    return frozenset(x[:SHORTEST] for x in times), times


def features(text: str, lexicon: frozenset[str]) -> list[float]:
    """``lexicon`` holds words, stems as their letters behind a ``^``, and stems said ``k`` times behind ``k^``."""
    lower = text.lower()
    words = WORD.findall(lower)
    n = max(1, len(words))
    hits = [i for i, w in enumerate(words) if w in lexicon]
    heads, (often, times) = heads_of(lexicon), repeated_of(lexicon)
    either = heads | often
    begun = [w for w in words if w[:SHORTEST] in either]
    stems = sum(1 for w in begun if any("^" + w[:k] in lexicon for k in STEMS))
    said = Counter(w[:k] for w in begun for k in STEMS if len(w) >= k and w[:k] in times)
    reached = Counter(k for x, c in said.items() for k in times[x] if c >= k)
    most = max((c for x, c in said.items() if c >= min(times[x])), default=0)
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = sum(1 for gap in _gaps(hits, you) if gap <= NEAR)
    disguised = DISGUISED.findall(text)
    unmasked = [w for d in disguised if (w := SIGNS.sub("", d.lower().translate(PLAIN))) in lexicon]
    spaced = [w for s in SPACED.findall(text) if (w := SIGNS.sub("", s.lower())) in lexicon]
    capitals = len(CAPITAL.findall(text))
    marks = text.count("!") + text.count("?")
    return [
        float(len(hits)), len(hits) / n, float(len({words[i] for i in hits})), float(stems), stems / n, float(near), near / n,
        len(you) / n, float(len(unmasked) + len(spaced)), len(disguised) / n, capitals / max(1, len(text)), marks / n,
        text.count("!") / max(1, len(text)), float(np.log1p(len(words))),
        *(float(reached[k]) for k in TIMES), float(most), most / n,
    ]


def _gaps(hits: list[int], you: list[int]) -> np.ndarray:
    """Distance of each hit to the nearest second-person word."""
    if not hits or not you:
        return np.zeros(0)
    at = np.searchsorted(you, hits)
    y = np.array([-(10**9), *you, 10**9])
    return np.minimum(np.array(hits) - y[at], y[at + 1] - np.array(hits))


def features_of(*lexicons: frozenset[str]):
    """Of texts, and with several lexicons of the number of each row's lexicon."""

    @F.arrow_udf("array<double>")
    def run(texts: pa.Array, fold: pa.Array) -> pa.Array:
        made = pa.array((features(t.as_py() or "", lexicons[k.as_py()]) for t, k in zip(texts, fold, strict=True)), pa.list_(pa.float64()))
        trim()
        return made

    return run


def sketch(column: str) -> Column:
    """The smallest hash of a text's word triples; copies share it."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = (WORD.findall((t.as_py() or "").lower()) for t in texts)
        return pa.array((min(zlib.crc32(" ".join(x[i : i + 3]).encode()) for i in range(max(1, len(x) - 2))) for x in found), pa.int64())

    return of(column)


def units(column: str) -> Column:
    """Distinct words, stems, and stems that stand there several times."""

    @F.arrow_udf("array<string>")
    def of(texts: pa.Array) -> pa.Array:
        done, out, held = [], [], 0

        def pack() -> None:
            done.append(pa.array(out, pa.list_(pa.string())))
            out.clear()

        for t in texts:
            words = Counter(WORD.findall((t.as_py() or "").lower()))
            stems: Counter[str] = Counter()
            for w, c in words.items():
                for k in STEMS:
                    if len(w) >= k:
                        stems[w[:k]] += c
            out.append([*words, *("^" + x for x in stems), *(f"{k}^{x}" for x, c in stems.items() for k in TIMES if c >= k)])
            held += len(out[-1])
            if held > UNITS_HELD:  # as Python objects they take ten times the room
                pack()
                held = 0
        pack()
        packed = pa.concat_arrays(done)
        trim()
        return packed

    return of(column)


def sure_units(found: list[tuple[str, int, int, float]], tried: int, words: int) -> list[str]:
    """From (unit, toxic, all, likelihood ratio), surest first: those within the bound on false ones, and one of stems that say the same."""
    chance = np.exp(-0.5 * np.array([x[3] for x in found]))  # Chernoff's bound on the binomial tail
    within = np.flatnonzero(chance <= FALSE * np.arange(1, len(found) + 1) / max(1, tried))
    kept = found[: within[-1] + 1] if len(within) else []
    counts = {x[0]: x[1:3] for x in kept}
    same = lambda unit: "^" in unit and len(unit.partition("^")[2]) > SHORTEST and counts.get(unit[:-1]) == counts[unit]
    return [x[0] for x in kept if not same(x[0])][:words]


def learned_words(labelled: DataFrame, words: int, least: int) -> list[list[str]]:
    """For each fold what the other folds, and at last what all of them, show: words and stems that stand
    in toxic documents far more often than chance has it.

    A unit counts once for all texts of one label that share a sketch, or groups of copies would make their
    rare words look toxic.
    """
    total = labelled.groupBy("fold", "_label").agg(F.countDistinct("sketch").alias("n")).collect()
    by = {(r["fold"], r["_label"]): r["n"] for r in total}
    share = []
    for k in range(FOLDS + 1):
        toxic, clean = (sum(n for (fold, label), n in by.items() if label == y and fold != k) for y in (1.0, 0.0))
        share.append(toxic / (toxic + clean) if toxic and clean else None)
    usable = [k for k, p in enumerate(share) if p is not None]
    if not usable:
        return [[]] * (FOLDS + 1)
    seen = labelled.select("_label", "sketch", "fold", F.explode(units("text")).alias("unit")).distinct()
    apart = lambda k, x: F.sum(F.when(F.col("fold") != k, x).otherwise(0.0))
    views = [F.struct(F.lit(k).alias("view"), F.lit(share[k]).alias("p"), apart(k, F.col("_label")).alias("t"), apart(k, F.lit(1.0)).alias("n")) for k in usable]
    seen = seen.groupBy("unit").agg(F.array(*views).alias("views")).select("unit", F.inline("views")).where(F.col("n") >= least)
    part = lambda k, q: F.when(k > 0, k * F.log(k / (F.col("n") * q))).otherwise(0.0)
    seen = settled(seen.select("view", "unit", "t", "n", "p", (2 * (part(F.col("t"), F.col("p")) + part(F.col("n") - F.col("t"), 1 - F.col("p")))).alias("sure")))
    tried = {r["view"]: r["m"] for r in seen.groupBy("view").agg(F.count(F.lit(1)).alias("m")).collect()}
    found = seen.where((F.col("t") > 3 * F.col("p") * F.col("n")) & (F.col("sure") >= -2 * float(np.log(FALSE))))
    found = found.orderBy(F.desc("sure"), "unit", "view").limit(LOOKED_AT * words * len(usable)).collect()
    return [sure_units([(r["unit"], r["t"], r["n"], r["sure"]) for r in found if r["view"] == k], tried.get(k, 0), words) for k in range(FOLDS + 1)]


class Toxicity:
    """A fitted lexicon, trees and calibration; or a constant where nothing can be learned."""

    def __init__(self, lexicon: frozenset[str], trees=None, calibration=None, constant: float = 0.0):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", rows: int = ROWS, words: int = WORDS, trees: int = TREES, depth: int = DEPTH, least: int = LEAST) -> Toxicity:
        known = agreed_labels(labels, id_column, label_column).where(~held_out("_label_id"))
        draw = F.pmod(F.xxhash64(F.col("_label_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
        n = known.count()
        known = known.where(draw < min(1.0, rows / max(1, n)))
        part = F.pmod(F.xxhash64(F.col("_label_id").cast("string"), F.lit(7)), F.lit(10))
        sample = docs.select(F.col(id_column).alias("_id"), text_or_empty(text_column).alias("text")).join(known, F.col("_id") == F.col("_label_id"))
        sample = sample.select("text", F.col("_label").cast("double"), part.alias("part")).repartition(SAMPLE_PARTS)
        sample = sample.withColumn("sketch", sketch("text"))
        sample = settled(sample.withColumn("fold", F.pmod(F.xxhash64("sketch"), F.lit(FOLDS)).cast("int")))
        *others, lexicon = (frozenset(INSULTS) | frozenset(x) for x in learned_words(sample, words, least))
        made = sample.select("_label", "part", features_of(*others)("text", "fold").alias("f"))
        # bounded rows that the trees pass over many times: few partitions
        made = settled(made.select("_label", "part", array_to_vector("f").alias("features")).coalesce(8))
        classes = {(r["tree"], r["_label"]): r["n"] for r in made.groupBy((F.col("part") < 8).alias("tree"), "_label").agg(F.count(F.lit(1)).alias("n")).collect()}
        if len(classes) < 4:
            toxic = sum(v for (_, y), v in classes.items() if y == 1)
            total = sum(classes.values())
            return cls(lexicon, constant=(toxic + 0.5) / (total + 1) if total else 0.0)
        booster = GBTClassifier(labelCol="_label", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=1, maxBins=64)
        model = booster.fit(made.where("part < 8"))
        rest = made.where("part >= 8").select("_label", "features")
        raw = model.transform(rest).select("_label", vector_to_array("rawPrediction")[1].alias("margin"))
        return cls(lexicon, model, IsotonicRegression(labelCol="_label", featuresCol="margin").fit(raw))

    def score(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", cutoff: float = CUTOFF) -> DataFrame:
        """The documents with held_out, score and predicted."""
        if self.trees is None:
            score = F.lit(float(self.constant))
            return replacing(docs, {"held_out": held_out(id_column), "score": score, "predicted": (score >= cutoff).cast("int")})
        made = docs.withColumn("_features", features_of(self.lexicon)(text_or_empty(text_column), F.lit(0)))
        made = made.withColumn("_vector", array_to_vector("_features"))
        trees = self.trees.setFeaturesCol("_vector").setRawPredictionCol("_raw").setProbabilityCol("_p").setPredictionCol("_y")
        made = trees.transform(made).withColumn("_margin", vector_to_array("_raw")[1])
        made = self.calibration.setFeaturesCol("_margin").setPredictionCol("_score").transform(made)
        score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_score")))
        out = replacing(made, {"held_out": held_out(id_column), "score": score, "predicted": (score >= cutoff).cast("int")})
        return out.drop("_features", "_vector", "_raw", "_p", "_y", "_margin", "_score")
