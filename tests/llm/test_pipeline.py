"""The pipeline stage by stage, each held against plain Python on its own input."""
import re

import sentencepiece

import corpus_pipeline
from tests.llm.test_links import jaccard_links


def test_stages_on_their_own_inputs(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 300")
    columns, seen = docs.columns, [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(docs.toPandas())
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    raw, mild, lines, single, mixed, ids = seen
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    gone = set(raw.doc_id) - set(mild.doc_id)
    assert gone and labels[labels.doc_id.isin(gone)].toxic.mean() > 0.9
    assert sorted(lines.doc_id) == sorted(mild.doc_id)
    long = [x for t in lines.text for x in t.split("\n") if len(x.split()) >= 20]
    assert len(long) == len(set(long)) and (lines.n_chars == lines.text.str.len()).all()
    links = jaccard_links(list(lines.text))
    left = set(single.doc_id)
    parent = {i: i for i in lines.doc_id}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    order = list(lines.doc_id)
    for a, b in links:
        a, b = find(order[a]), find(order[b])
        parent[max(a, b)] = min(a, b)
    assert left == {i for i in order if find(i) == i}
    size = single.set_index("doc_id").text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    times = mixed.doc_id.value_counts()
    assert times.max() <= 3 and set(times.index) <= left
    total = sum(size)
    assert abs((times * size.reindex(times.index)).sum() - total) < 0.2 * total
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECES)
    texts = mixed.drop_duplicates("doc_id").set_index("doc_id").text
    assert len(ids) == len(mixed) and ids.round_trip.all()
    for r in ids.drop_duplicates("doc_id").itertuples():
        assert list(r.ids) == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids)
