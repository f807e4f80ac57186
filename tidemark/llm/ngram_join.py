"""Join of documents whose sets of word 5-grams are alike, by MinHash bands and full verification.

Documents with equal sets form a class, and only one of each class goes on. The signature of a set falls
into bands; band and row counts are the cheapest that reach the target recall at the threshold. Band hashes
are shuffled, and documents that share one are hung under the smallest of their bucket: as many rows as
bucket members, however large. What hangs together is a candidate cluster; its documents' full sets are
dealt into blocks and compared by sparse products there. Blocks return counts per document and the edges
of spanning forests, never pairs. So all links among the documents of a cluster are found and all are
verified; a pair is missed only if no chain of shared bands connects it.

Skew: classes and buckets combine on the map side, a block holds a bounded number of documents, and no
pair leaves a block. Signatures are narrow and settled; sets, which are wide, are made again from the texts
of candidates only.

Defined results: a text of fewer words than an n-gram is one gram of all its words; null text is empty, and
texts without words are one class; rows that share id and text count as copies; an empty table gives an
empty result.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, row_key, settled, text_or_empty, trim
from .components import components, in_blocks
from .embedding_dedup import local_roots

N, THRESHOLD, RECALL, BLOCK = 5, 0.8, 0.9995, 256
#: A band of so many rows lets few pairs of half the threshold pass.
ROWS = 6
_word = re.compile(WORD)
_ODD = np.random.default_rng(5).integers(1 << 62, size=16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """As few bands as find a pair at the threshold with the target chance."""
    return max(1, ceil(log(1 - recall) / log(1 - threshold**rows)))


def gram_hashes(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a whole text."""
    words = _word.findall(text)
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    k = min(n, len(words))
    with np.errstate(over="ignore"):
        out = np.full(len(words) - k + 1, len(words) if k < n else 0, np.uint64)
        for j in range(k):
            out = (out ^ hashed[j : len(hashed) - k + 1 + j]) * _ODD[j]
            out ^= out >> np.uint64(29)
    return np.unique(out)


class MinHash:
    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(11)
        self.a = rng.integers(1 << 63, size=bands * rows, dtype=np.uint64) | np.uint64(1)
        self.b = rng.integers(1 << 63, size=bands * rows, dtype=np.uint64)

    def bands_of(self, grams: np.ndarray) -> np.ndarray:
        """One hash per band of a set that is not empty."""
        with np.errstate(over="ignore"):
            low = np.full(len(self.a), np.iinfo(np.uint64).max)
            for at in range(0, len(grams), 512):
                low = np.minimum(low, (grams[at : at + 512, None] * self.a + self.b).min(0))
            mixed = (low >> np.uint64(20)).reshape(self.bands, self.rows)
            out = np.zeros(self.bands, np.uint64)
            for j in range(self.rows):
                out = (out ^ mixed[:, j]) * _ODD[j]
                out ^= out >> np.uint64(31)
        return out.view(np.int64)


def signatures(keyed: DataFrame, minhash: MinHash, n: int) -> DataFrame:
    """(_id, _key, node, grams, bands): node names the set of a document."""
    id_kind = dict(keyed.dtypes)["_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, bands = [], [], []
            for text in batch.column("_text"):
                grams = gram_hashes(text.as_py(), n)
                node.append(xxhash.xxh3_128_digest(grams.tobytes()))
                size.append(len(grams))
                bands.append(minhash.bands_of(grams) if len(grams) else np.zeros(0, np.int64))
            at = np.cumsum([0, *map(len, bands)])
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_key"), pa.array(node, pa.binary()), pa.array(size, pa.int64()), lists], ["_id", "_key", "node", "grams", "bands"])
        trim()

    return keyed.select("_id", "_key", "_text").mapInArrow(run, f"_id {id_kind}, _key binary, node binary, grams long, bands array<long>")


def verify(dealt: DataFrame, threshold: float) -> DataFrame:
    """(node, links, other) from blocks of sets: counts of verified links, and edges of their spanning forest."""

    def compare(table: pa.Table) -> pa.Table:
        p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
        side, mult = table.column("block").to_numpy(), table.column("mult").to_numpy()
        sets = table.column("set").combine_chunks()
        size, flat = sets.value_lengths().to_numpy(), sets.flatten().to_numpy()
        a, b = np.flatnonzero(side == p), np.flatnonzero(side == q)
        # grams that one document alone has add nothing to what two share
        order = np.argsort(flat, kind="stable")
        new = np.r_[True, np.diff(flat[order]) != 0] if len(flat) else np.zeros(0, bool)
        gram = np.empty(len(flat), np.int64)
        gram[order] = np.cumsum(new) - 1
        shared = np.bincount(gram) > 1 if len(flat) else np.zeros(0, bool)
        column = np.cumsum(shared) - 1
        keep = shared[gram] if len(flat) else np.zeros(0, bool)
        row, column = np.repeat(np.arange(len(size)), size)[keep], column[gram[keep]]
        by = np.argsort(column, kind="stable")
        row, column = row[by], column[by]
        both = np.zeros((len(a), len(b)), np.float64)
        for at in range(0, int(shared.sum()), 4096):
            lo, hi = np.searchsorted(column, [at, at + 4096])
            part = np.zeros((len(size), 4096), np.float32)
            part[row[lo:hi], column[lo:hi] - at] = 1
            both += part[a] @ part[b].T
        linked = both >= threshold * (size[a][:, None] + size[b] - both) - 1e-9
        if p == q:
            np.fill_diagonal(linked, False)
        count = np.zeros(len(size), np.int64)
        count[a] += linked @ mult[b]
        if p != q:
            count[b] += linked.T @ mult[a]
        root = local_roots(linked, a, b, len(size))
        at, to = np.flatnonzero(count), np.flatnonzero(root != np.arange(len(size)))
        nodes = table.column("node").combine_chunks()
        return pa.table({
            "node": pa.concat_arrays([nodes.take(pa.array(at)), nodes.take(pa.array(to))]),
            "links": pa.array([*count[at], *[0] * len(to)], pa.int64()),
            "other": pa.concat_arrays([pa.nulls(len(at), nodes.type), nodes.take(pa.array(root[to]))]),
        })

    return dealt.groupBy("cluster", "p", "q").applyInArrow(compare, "node binary, links long, other binary")


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """Narrow rows (_key, _id, class_id, n_links): the smallest id that links reach, and the number of other documents linked."""
    minhash = MinHash(bands_for(threshold, recall, rows), rows)
    keyed = docs.select(F.col(id_column).alias("_id"), row_key(id_column, text_column).alias("_key"), text_or_empty(text_column).alias("_text"))
    signed = settled(signatures(keyed, minhash, n))
    named = F.struct(F.col("_id").isNull().alias("none"), "_id", "_key")
    sets = settled(signed.groupBy("node").agg(F.min(named).alias("rep"), F.count(F.lit(1)).alias("mult"), F.first("bands").alias("bands")))
    banded = sets.select("node", F.posexplode("bands").alias("band", "h"))
    heads = banded.groupBy("band", "h").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    hung = banded.join(heads, ["band", "h"]).where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    hung = components(hung)
    clusters = hung.select("node", F.col("root").alias("cluster")).unionByName(hung.select(F.col("root").alias("node"), F.col("root").alias("cluster")).distinct())
    members = settled(sets.join(clusters, "node").select("node", "mult", "cluster", F.col("rep._key").alias("_key")))
    # copies of a document under one key have one set: one of them is enough
    texts = keyed.select("_key", "_text").dropDuplicates(["_key"]).join(members, "_key")

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [gram_hashes(t.as_py(), n).view(np.int64) for t in batch.column("_text")]
            at = np.cumsum([0, *map(len, made)])
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(made) if made else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("node", "mult", "cluster", "_key")], lists], ["node", "mult", "cluster", "_key", "set"])
        trim()

    wide = texts.select("node", "mult", "cluster", "_key", "_text").mapInArrow(with_sets, "node binary, mult long, cluster binary, _key binary, set array<long>")
    found = settled(verify(in_blocks(wide, ["cluster"], F.xxhash64("node"), block, counted=members), threshold))
    links = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    rooted = sets.join(roots, "node", "left").select("node", "rep", "mult", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("least"))
    per_set = rooted.join(least, "root").join(links, "node", "left").select("node", "least", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"))
    return signed.select("_id", "_key", "node").join(per_set, "node").select("_key", "_id", F.col("least._id").alias("class_id"), "n_links", (F.col("least._key") == F.col("_key")).alias("kept"))


def join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row per document: its id, class_id, n_links and whether it is the one of its class that stays."""
    return classes(docs, id_column, text_column, **options).select(F.col("_id").alias(id_column), "class_id", F.col("n_links").cast("long").alias("n_links"), "kept")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents of which one stays in each class; of rows that share id and text, one."""
    kept = classes(docs, id_column, text_column, **options).where("kept").select("_key")
    keyed = docs.withColumn("_key", row_key(id_column, text_column))
    return keyed.join(kept.distinct(), "_key", "left_semi").dropDuplicates(["_key"]).drop("_key")
