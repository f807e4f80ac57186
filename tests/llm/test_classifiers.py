"""Learned operators: accuracy on documents they have not learned from, and defined results on odd rows."""
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id, toxicity
from tidemark.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string"


def test_language_of_held_out_documents(spark, sf):
    got = QUERIES["op10_language_id"](spark, sf).toPandas()
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth)
    assert (both.held_out == both.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all() and len(got) == len(truth)


def test_kernel_counts_shared_grams():
    sets = [language_id.grams(t) for t in ("abc", "abd!", "ABC")]
    kernel = language_id.Kernel.of(sets[:2])
    values = kernel.values(sets)
    assert values[0, 0] == pytest.approx(1) and np.allclose(values[0], values[2])
    # " abc " and " abd " share " ", a, b; " a", "ab"; " ab"
    assert values[0, 1] == pytest.approx(6 / np.sqrt(len(sets[0]) * len(sets[1])))


def test_language_edges(spark):
    rows = [(i, ("the cat and dog " if i % 2 else "der hund und die katze ") * 5 + str(i), "en" if i % 2 else "de") for i in range(200)]
    rows += [(900, None, "en"), (901, "", "de"), (902, "12 34!", "en"), (903, "the dog", None), (None, "die katze", "de"), (904, "the cat " * 30_000, "en")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as score", "2 as lang_pred")
    got = {r["doc_id"]: r for r in language_id.predict(docs, language_id.fit(docs)).collect()}
    assert [got[k]["lang_pred"] for k in (900, 901, 902, 903, None, 904)] == ["und", "und", "und", "en", "de", "en"]
    assert got[900]["score"] == 0
    empty = docs.limit(0)
    assert language_id.predict(empty, language_id.fit(empty)).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in language_id.predict(unlabelled, language_id.fit(unlabelled)).collect()} == {"und"}


def corpus(n=900):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.integers(400)}" for _ in range(40)]
        words = ["x" + "".join("abcdefghij"[int(c)] for c in w[1:]) for w in words]
        bad = i % 6 == 0
        if bad:
            for w in ("you", "blargist", "zorkhead"):
                words.insert(int(rng.integers(len(words))), w)
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_learns_words_that_copies_do_not_hide(spark):
    rows, labels = corpus()
    # copies of one clean text, labelled toxic by chance of their group: their words must not enter the lexicon
    rows += [(5000 + i, rows[1][1] + " uniqueword otherword", "en") for i in range(300)]
    labels += [(5000 + i, 1) for i in range(300)]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.Toxicity.fit(docs, marks)
    assert {"blargist", "zorkhead"} <= model.lexicon and "uniqueword" not in model.lexicon
    got = model.score(docs.selectExpr("*", "1 as score", "2 as features")).toPandas()
    held = got[got.held_out & (got.doc_id < 5000)]
    assert (held.predicted == (held.doc_id % 6 == 0)).mean() > 0.97
    assert got.score.between(0, 1).all()
    odd = spark.createDataFrame([(1, None, None), (1, None, None), (None, "", "en"), (2, "a " * 100_000, "en")], DOCS)
    assert model.score(odd).where("score between 0 and 1").count() == 4
    assert model.score(odd.limit(0)).count() == 0


def test_toxicity_learns_few_texts_that_repeat_a_common_stem(spark):
    rng = np.random.default_rng(7)
    letter = lambda k: "x" + "".join("abcdefghij"[int(c)] for c in str(k))
    rows, labels = [], []
    for i in range(3000):
        words = [letter(rng.integers(400)) for _ in range(40)]
        bad, once = i % 50 == 0, i % 8 == 1
        for j in range(3 if bad else once):  # one such word shows nothing, three do
            words.insert(int(rng.integers(len(words))), "gromlich" + "abcdefgh"[int(rng.integers(8))] * (1 + j))
        rows.append((i, " ".join(words), "de"))
        labels.append((i, int(bad)))
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.Toxicity.fit(docs, marks)
    assert "3^grom" in model.lexicon
    got = model.score(docs).toPandas()
    held = got[got.held_out]
    assert held[held.doc_id % 50 == 0].predicted.mean() > 0.9 and held[held.doc_id % 50 > 0].predicted.mean() < 0.01


def test_no_fold_is_judged_by_words_it_taught(spark):
    # "foldword" marks toxic texts of fold 0 alone, "everyword" those of all folds
    rows = [(float(i % 4 == 0), i, i // 4 % 4, f"plain text w{'abcdefghij'[i % 10]}" + " everyword" * (i % 4 == 0) + " foldword" * (i % 16 == 0)) for i in range(800)]
    found = toxicity.learned_words(spark.createDataFrame(rows, "_label double, sketch long, fold int, text string"), 300, 5)
    assert ["everyword" in x for x in found] == [True] * 5
    assert ["foldword" in x for x in found] == [False, True, True, True, True]


def test_sure_units_bound_the_share_of_false_ones():
    strong, weak = [(f"w{i}", 9, 9, 40.0) for i in range(5)], [(f"v{i}", 5, 9, 10.0) for i in range(5)]
    assert toxicity.sure_units(strong + weak, 10_000, 300) == [f"w{i}" for i in range(5)]
    assert toxicity.sure_units([("^abcd", 9, 9, 40.0), ("^abcde", 9, 9, 40.0), ("2^abcde", 8, 8, 36.0)], 100, 300) == ["^abcd", "2^abcde"]
    assert toxicity.sure_units([], 0, 300) == []


def test_toxicity_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "a", "en"), (2, "b", "en")], DOCS)
    none = spark.createDataFrame([(None, 1), (1, None), (2, 0), (2, 1)], "doc_id long, toxic int")
    got = toxicity.Toxicity.fit(docs, none).score(docs).collect()
    assert [(r["score"], r["predicted"]) for r in got] == [(0.0, 0), (0.0, 0)]


def test_features_see_disguised_and_near_words():
    lexicon = frozenset(["idiot", "^stup"])
    plain = toxicity.features("You are an 1d10t and i d i o t, idiot! stupid", lexicon)
    assert plain[0] == 1 and plain[3] == 1 and plain[8] >= 2
    assert toxicity.features("", lexicon)[0] == 0


def test_toxicity_query(spark, sf):
    got = QUERIES["op7_toxicity"](spark, sf).toPandas()
    truth = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    both = got.merge(truth)
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert both[both.predicted == 1].toxic.mean() > 0.9 and (got.predicted == (got.score >= 0.7)).all()


def test_a_table_of_long_texts_only_has_languages(spark):
    import random

    random.seed(8)
    words = {"xx": ["tafo", "rilu", "senta"], "yy": ["kjørn", "brøta", "vlemp"]}
    rows = [(i, " ".join(random.choices(words[lang], k=5000)), lang) for i in range(60) for lang in (sorted(words)[i % 2],)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.predict(docs.drop("lang"), language_id.fit(docs)).collect()
    assert all(r.lang_pred == sorted(words)[r.doc_id % 2] for r in got)


def test_powers_and_numerals_are_no_letters(spark):
    assert all(len(language_id.grams(t)) == 0 for t in ("12²", "½", "Ⅷ 4", "")) and len(language_id.grams("12 m²"))


def test_labels_of_held_out_rows_change_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    other = docs.withColumn("lang", F.when(language_id.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    one, two = (language_id.fit(d) for d in (docs, other))
    assert one.languages == two.languages and np.array_equal(one.weights, two.weights)
