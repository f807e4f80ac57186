"""Language identification by a string kernel with Nyström landmarks and ridge regression.

The kernel of two texts is the number of distinct character 1- to 3-grams they share, over the root of the
product of their own numbers (blended spectrum, presence). Letters are lower-cased and all else is one
blank. A 3-gram packs its code points in 63 bits, so no two collide. Landmarks are labelled texts; kernel
values against them, turned by the inverse root of the landmarks' own kernel, are the features of one
ridge regression per language against the rest. Texts are scored in batches: a sparse presence matrix
times the landmarks' presence matrix, times the weights.

Fitting is bounded by parameters: at most about ``rows`` labelled rows in equal numbers per language, of
which ``landmarks`` in all are landmarks (texts of up to ``landmark_chars`` characters, whole). Their sums
of products meet in eight rows. Scoring is a map over all texts and holds the landmark matrix only.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if
nothing can be learned; null languages are not learned; ties go to the language first in order; repeated
rows get equal results; columns of the input that have a result's name are replaced.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import replacing, settled

NO_LETTERS = re.compile(r"[\W\d_]+")
ROWS, LANDMARKS, LANDMARK_CHARS, RIDGE, MOST_LANGUAGES = 6000, 96, 20_000, 1e-3, 1000


def held_out(id_column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 5 == 0


def grams(text: str) -> np.ndarray:
    """The distinct 1-, 2- and 3-grams of a text, sorted; empty if it has no letter."""
    if not any(map(str.isalpha, text)):  # letters only: no powers, fractions or numerals
        return np.zeros(0, np.int64)
    codes = np.frombuffer(f" {NO_LETTERS.sub(' ', text.lower()).strip()} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    two = codes[:-1] << 21 | codes[1:]
    three = two[:-1] << 21 | codes[2:]
    return np.concatenate([np.unique(codes), np.unique(two), np.unique(three)])


@dataclass
class Kernel:
    """The landmarks' presence matrix by gram."""

    vocabulary: np.ndarray
    presence: np.ndarray
    norms: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Kernel:
        vocabulary = np.unique(np.concatenate(sets))
        presence = np.zeros((len(vocabulary) + 1, len(sets)), np.float32)  # the last row is for unknown grams
        for k, s in enumerate(sets):
            presence[np.searchsorted(vocabulary, s), k] = 1
        return cls(vocabulary, presence, np.sqrt([len(s) for s in sets]))

    def values(self, sets: list[np.ndarray]) -> np.ndarray:
        """Kernel of each set against each landmark."""
        out = np.zeros((len(sets), len(self.norms)))
        for k, s in enumerate(sets):
            at = np.searchsorted(self.vocabulary, s)
            at[at == len(self.vocabulary)] = 0
            known = at[self.vocabulary[at] == s]
            out[k] = np.ones(len(known), np.float32) @ self.presence[known]
        return out / (np.sqrt([max(1, len(s)) for s in sets])[:, None] * self.norms)


@dataclass
class Model:
    languages: list[str]
    kernel: Kernel | None
    weights: np.ndarray | None

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        sets = [grams(t or "") for t in texts]
        if self.kernel is None:
            return ["und"] * len(texts), [0.0] * len(texts)
        margins = self.kernel.values(sets) @ self.weights
        best = margins.argmax(1)
        letters = np.array([len(s) > 0 for s in sets], bool)
        score = np.where(letters, np.clip((margins[np.arange(len(sets)), best] + 1) / 2, 0, 1), 0.0)
        return [self.languages[b] if ok else "und" for b, ok in zip(best, letters)], score.tolist()


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", rows: int = ROWS, landmarks: int = LANDMARKS, landmark_chars: int = LANDMARK_CHARS, ridge: float = RIDGE) -> Model:
    """Learn from text and language of documents that are not held out."""
    usable = docs.where(F.col(lang_column).isNotNull() & F.rlike(F.col(text_column), F.lit(r"\p{L}")) & ~held_out(id_column))
    usable = usable.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"))
    counts = usable.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return Model([], None, None)
    # a hash of the id draws about as many rows of each language; the text breaks ties
    quota = max(1, rows // len(counts))
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 1.2 * quota / r["count"]))])
    drawn = usable.where(draw < share[F.col("lang")])
    parts = 8
    sample = settled(drawn.repartition(parts, F.xxhash64("id", "text")))
    # longer texts serve where shorter ones are too few
    order = Window.partitionBy("lang").orderBy(F.length("text") > landmark_chars, F.xxhash64("id", "text", F.lit(1)), "text")
    marks = sample.withColumn("r", F.row_number().over(order))
    marks = marks.where(F.col("r") <= max(1, landmarks // len(counts))).orderBy("lang", "r").select("text").limit(max(landmarks, len(counts)))
    sets = [s for r in marks.toLocalIterator() if len(s := grams(r["text"]))]
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not sets or not languages:
        return Model(languages, None, None)
    kernel = Kernel.of(sets)
    own, turn = np.linalg.eigh(kernel.values(sets))
    root = turn / np.sqrt(np.maximum(own, 1e-6)) @ turn.T
    place = {lang: k for k, lang in enumerate(languages)}
    m, c = len(sets), len(languages)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, right, n = np.zeros((m, m)), np.zeros((m, c)), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts, langs = (batch.column(k).slice(at, 256).to_pylist() for k in (0, 1))
                phi = kernel.values([grams(t) for t in texts]) @ root
                y = -np.ones((len(texts), c))
                y[np.arange(len(texts)), [place[x] for x in langs]] = 1
                gram, right, n = gram + phi.T @ phi, right + phi.T @ y, n + len(texts)
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()]), pa.array([right.tobytes()]), pa.array([n])], ["gram", "right", "n"])

    found = sample.select("text", "lang").mapInArrow(sums, "gram binary, right binary, n long").collect()
    gram = sum(np.frombuffer(r["gram"]).reshape(m, m) for r in found)
    right = sum(np.frombuffer(r["right"]).reshape(m, c) for r in found)
    n = sum(r["n"] for r in found)
    return Model(languages, kernel, root @ np.linalg.solve(gram + ridge * n * np.eye(m), right))


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with held_out, lang_pred and score."""

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def of(texts: pa.Array) -> pa.Array:
        lang, score = [], []
        for at in range(0, len(texts), 256):
            a, b = model.predict(texts.slice(at, 256).to_pylist())
            lang, score = lang + a, score + b
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    found = docs.withColumn("_found", of(F.col(text_column).cast("string")))
    return replacing(found, {"held_out": held_out(id_column), "lang_pred": F.col("_found.lang_pred"), "score": F.col("_found.score")}).drop("_found")
