"""Joins that link rows, against comparing all pairs in plain Python."""
import random
import re
from collections import defaultdict

import numpy as np

from tidemark.llm import embedding_dedup, ngram_join
from tidemark.llm.components import components


def classes_of(n, links, ids):
    parent, count = list(range(n)), [0] * n

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        count[a] += 1
        count[b] += 1
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    least = {}
    for i in range(n):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), 1 << 60), ids[i])
    return sorted((-1 if ids[i] is None else ids[i], count[i], least.get(find(i), -1)) for i in range(n))


def jaccard_links(texts, n=5, threshold=0.8):
    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()

    sets = [grams(t) for t in texts]
    return [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if (not sets[i] and not sets[j]) or len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9 > 0
    ]


def found(frame, id_column, class_column):
    return sorted(zip(frame[id_column].fillna(-1).astype(int), frame.n_links, frame[class_column].fillna(-1).astype(int)))


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, k) for k in range(501, 700)] + [(900, 900)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 201)} | {i: 500 for i in range(501, 700)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ngram_join_equals_all_pairs(spark):
    random.seed(4)
    base = [[f"w{random.randrange(5000)}" for _ in range(random.randrange(1, 90))] for _ in range(60)]
    texts = []
    for _ in range(400):
        words = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 2, 9])):
            words[random.randrange(len(words))] = f"n{random.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [None, "", " ", "same", "same", "w " * 4000, "w " * 4001]
    ids = [None if i == 50 else i for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    for block in (7, 256):
        got = ngram_join.join(docs, block=block).toPandas()
        assert found(got, "doc_id", "class_id") == classes_of(len(ids), jaccard_links(texts), ids)
        assert got.kept.sum() == got.class_id.nunique(dropna=False)
    # a row twice counts as a copy, and one of the two goes
    twice = docs.where("doc_id = 3")
    assert ngram_join.join(twice.unionAll(twice)).toPandas().n_links.tolist() == [1, 1]
    assert ngram_join.keep_one(twice.unionAll(twice)).count() == 1
    assert ngram_join.join(docs.limit(0)).count() == 0


def test_bands_reach_the_target_recall():
    for threshold, recall in ((0.8, 0.9995), (0.5, 0.9), (0.9, 0.99)):
        b = ngram_join.bands_for(threshold, recall, 6)
        assert 1 - (1 - threshold**6) ** b >= recall > 1 - (1 - threshold**6) ** (b - 1)


def test_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(1)
    centers, rows = rng.normal(size=(12, 6)), []
    for i in range(900):
        v = (centers[rng.integers(12)] + rng.normal(size=6) * 0.12).astype(np.float32).tolist()
        if rng.random() < 0.2 and rows and rows[-1][1]:
            v = list(rows[rng.integers(len(rows))][1] or v)
        if i % 101 == 0:
            v = [0.0] * 6
        if i % 103 == 0:
            v[2] = float("nan")
        if i % 107 == 0:
            v = v[:4]
        if i % 109 == 0:
            v[0] = None
        if i % 97 == 0:
            v = None
        rows.append((None if i % 211 == 0 else int(i if i % 50 else 7), v, None if i % 113 == 0 else int(rng.integers(3))))
    groups = defaultdict(list)
    for i, (_, v, label) in enumerate(rows):
        if v is not None and label is not None and all(c is not None and np.isfinite(c) for c in v) and any(v):
            groups[label, len(v)].append(i)
    links = []
    for members in groups.values():
        x = np.array([rows[i][1] for i in members], np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        links += [(members[a], members[b]) for a, b in zip(*np.nonzero(np.tril(x @ x.T >= 0.98, -1)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as cell", "'x' as v")
    got = embedding_dedup.link_vectors(frame, per_cell=60, block=40).toPandas()
    assert found(got, "vec_id", "component_id") == classes_of(len(rows), links, [r[0] for r in rows])
    assert embedding_dedup.link_vectors(frame.limit(0)).count() == 0


def test_vectors_of_huge_and_tiny_components_link(spark):
    rows = [(1, [1e200, 2e200, 1e199], 0), (2, [1e200, 2.0001e200, 1e199], 0), (3, [1e-200, 2e-200, 1e-201], 0), (4, [1e-200, -2e-200, 0.0], 0), (5, [3.0, 6.0, 0.3], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.link_vectors(frame).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 5: (3, 1), 4: (0, 4)}
