"""Line dedup, mixing and quality rules on hand-made rows."""
import random

import pytest

import corpus_pipeline
from tidemark.llm import line_dedup, mixing, quality_rules

DOCS = "doc_id long, text string, lang string, source string"


def test_repeated_long_line_stays_in_the_first_document_only(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(2, f"a\n{long}\nb", "en", "s"), (1, f"{long}\nc", "en", "s"), (3, "short\nshort", "en", "s")], DOCS)
    got = {r["doc_id"]: r for r in line_dedup.drop_repeated(docs).collect()}
    assert got[1]["text"] == f"{long}\nc" and got[2]["text"] == "a\nb" and got[3]["text"] == "short\nshort"
    assert [got[k]["n_dropped"] for k in (1, 2, 3)] == [0, 1, 0]


def test_a_shared_block_of_short_lines_is_found_wherever_it_stands(spark):
    random.seed(1)
    block = [f"line {i} of the block" for i in range(40)]
    rows = [(k, "\n".join([f"own {k} {j}" for j in range(random.randrange(1, 9))] + block), "en", "s") for k in range(6)]
    got = {r["doc_id"]: r for r in line_dedup.drop_repeated(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[0]["n_dropped"] == 0
    assert all(got[k]["n_dropped"] == 40 for k in range(1, 6))
    assert all(f"own {k} 0" in got[k]["text"] for k in range(6))


def test_the_pipeline_removes_whole_runs_of_short_lines(spark):
    random.seed(4)
    blocks = [[f"line {i} of block {b}" + "\n" * (i % 3 == 0 and i < n - 1) for i in range(n)] for b, n in enumerate([2, 3, 4, 5, 6, 7, 8, 40])]
    rows = []
    for b, block in enumerate(blocks):
        for k in range(6):
            own = [[f"own {b} {k} {side} {j}" for j in range(random.randrange(1, 5))] for side in (0, 1)]
            rows.append((10 * b + k, "\n".join(own[0] + block + own[1]), "\n".join(own[0] + own[1]), "s"))
    rows += [(900, "x\nx\nx\nx", "x\nx", "s"), (903, "c\nline 0 of block 0\nd", "c\nline 0 of block 0\nd", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, wanted string, source string")
    got = corpus_pipeline.without_repeated_lines(spark, docs, "").collect()
    assert len(got) == len(rows)
    wanted = {i: without if i % 10 or i == 900 else text for i, text, without, _ in rows}
    assert {r["doc_id"]: r["text"] for r in got} == wanted


def test_line_dedup_edges(spark):
    whole = "\n".join(" ".join(f"{j}x{i}" for i in range(30)) for j in range(3))
    rows = [(1, None, "en", "s"), (2, "", "en", "s"), (None, whole, "en", "s"), (5, whole, None, None), (5, whole, None, None), (6, "\n\n", "en", "s")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' as n_lines", "1 as h", "2 as unit")
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup.drop_repeated(docs).collect()), key=str)
    assert got == sorted(
        [(1, None, 0, 0), (2, "", 1, 0), (None, "", 3, 3), (5, whole, 3, 0), (5, whole, 3, 0), (6, "\n\n", 3, 0)], key=str
    )
    assert line_dedup.drop_repeated(docs.limit(0)).count() == 0


def test_targets_are_shared_until_none_is_above_its_cap(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 10), (None, 100), ("c", 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # total 111; weights a 1, b 2, c 3, null 1; caps 3, 30, 0, 300
    assert got == {"a": 3.0, "b": 30.0, "c": 0.0, None: 78.0}


def test_mix_comes_near_its_targets_and_repeats_agree(spark):
    random.seed(2)
    rows = [(i, "w " * random.randrange(1, 40), "en", random.choice("aaaaabc")) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "7 as times", "8 as target")
    got = mixing.mix(docs).toPandas()
    again = mixing.mix(docs.repartition(5)).toPandas()
    by = got.groupby("source").agg({"taken": "sum", "target": "first", "source_size": "first"})
    assert (abs(by.taken - by.target) <= 40).all()
    assert (got.taken <= 3 * got["size"]).all()
    assert got.set_index("doc_id").taken.equals(again.set_index("doc_id").taken.reindex(got.doc_id.values).rename("taken"))


def test_mix_edges(spark):
    rows = [(1, None, "en", None), (None, "a b", "en", "s"), (2, "", "en", "z"), (3, "a", "en", "s"), (3, "a", "en", "s")]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).toPandas()
    assert len(got) == 5 and (got[got["size"] == 0].taken == 0).all() and (got.taken <= 3 * got["size"]).all()
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


def plain_base(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_base_counts_equal_plain_python(spark):
    random.seed(3)
    texts = [None, "", " \n\t", "a b c", "a a a a", "\u00a0x\x0b|y\n\nz"] + [
        "".join(random.choices(["a ", "b ", "c\n", "# ", "é\t", "\n", "a b c d "], k=random.randrange(0, 60))) for _ in range(200)
    ]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], DOCS)
    got = quality_rules.with_base(docs).toPandas().set_index("doc_id")
    names = ["_n_words", "_word_chars", "_n_symbols", "_n_dup_lines", "_n_repeat_words"]
    assert [tuple(got.loc[i, names]) for i in range(len(texts))] == [plain_base(t) for t in texts]


@pytest.mark.parametrize("k,n,p", [(0, 50, 0.05), (3, 400, 0.0125), (10, 20_000, 0.01), (300, 100, 0.5)])
def test_binomial_tail(spark, k, n, p):
    from math import comb

    got = spark.range(1).selectExpr(f"{k}L as k", f"{n}L as n").select(quality_rules.binomial_tail(_c("k"), _c("n"), p)).first()[0]
    wanted = 1.0 if k > n * p else sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if n < 1000 else None
    assert (got == pytest.approx(wanted, rel=1e-9)) if wanted is not None else 0 <= got <= 1e-30


def _c(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_rules_reject_only_where_labels_certify_it(spark):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(i, words + (" ### $$$ %%% &&&" * 5 if i % 5 == 0 else "") + f" d{i}", "en" if i < 4000 else "rare", "s") for i in range(4040)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(4040)] + [(1, 0), (None, 1)], "doc_id long, quality int")
    got = quality_rules.judge(docs.selectExpr("*", "1 as stratum", "2 as kept"), labels).toPandas()
    common = got[got.lang == "en"]
    assert (common.kept == (common.doc_id % 5 > 0)).all()
    assert got[got.lang == "rare"].kept.all()  # too few labels to certify anything
    assert quality_rules.judge(docs, labels.limit(0)).where("not kept").count() == 0
    assert quality_rules.judge(docs.limit(0), labels).count() == 0


def test_a_source_without_ids_is_not_taken_as_one_lump(spark):
    rows = [(None, f"word {i} " * 5, "en", "a") for i in range(100)] + [(7, f"text {i} " * 15, "en", "b") for i in range(100)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(docs).groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect()
    for r in got:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"]


def test_a_hot_run_is_dealt_into_shares_and_keeps_its_first(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARE", 3)
    rows = [(k, f"own {k}\nfirst short\nsecond short\nend {k}", "en", "s") for k in range(40)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {k: rows[0][1] if k == 0 else f"own {k}\nend {k}" for k in range(40)}


def test_a_text_of_many_lines_loses_all_that_repeat(spark):
    lines = [f"line {i} of a long text" for i in range(8000)]
    rows = [(1, "\n".join(lines), "en", "s"), (2, "\n".join(["before", *lines, "after"]), "en", "s")]
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in line_dedup.drop_repeated(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("before\nafter", 8000)}
