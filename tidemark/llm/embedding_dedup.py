"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative per group.

Equal vectors of a label are one to begin with. A label has as many cells as its vectors call for: one, or a
power of four whose centroids are fitted on a bounded sample, as they decide only how much is compared. Every
vector has a home, the cell of its nearest centroid, and is a guest in those cells before its own where a
vector it links to could live: its distance to the plane between the two centroids is at most the chord of
the threshold, and it lies within the cell's reach plus the angle of the threshold. So two vectors that link
meet once, in the earlier of their homes, in double precision, and no link is lost. Guests are not compared
with each other, so a label never costs more than all its pairs.

Cells of any size are dealt into blocks; a task holds two blocks. Blocks return counts per vector and the
edges of a spanning forest, so never more rows than went in. Components come from the edges.

Defined results: a vector that is null, zero, or has null or non-finite components, or no label, links
with nothing; so do vectors of different length; repeated rows link with each other; a null id is a vector
of its own that others count but that names no group. Other columns are not used.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled
from .components import components, in_blocks

#: Labels of up to four times PER_CELL vectors have one cell; SAMPLE rows teach the centroids of one length and number of cells.
THRESHOLD, PER_CELL, MOST_CELLS, SAMPLE, ROUNDS, BLOCK = 0.98, 2000, 1024, 10_000, 8, 2048


def matrix(column: pa.Array) -> np.ndarray:
    """Unit rows, in double precision, of vectors of one length."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    # by powers of two, which change no digit, so that squares of huge or tiny components stay finite and above zero
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1]) if rows.size else rows
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_cells(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: means of the nearest vectors, put back on the sphere."""
    cells = min(cells, len(sample))
    centroids = sample[np.random.default_rng(0).choice(len(sample), cells, replace=False)]
    for _ in range(rounds):
        nearest = (sample @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 0, sums / np.maximum(length, 1e-300), centroids)
    return centroids


def usable(vectors: DataFrame) -> DataFrame:
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col("label").isNotNull() & F.col("v").isNotNull()).where(whole & F.exists("v", lambda x: x != 0))


def link_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", threshold: float = THRESHOLD, per_cell: int = PER_CELL, most_cells: int = MOST_CELLS, sample_rows: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """One row per vector: id, n_links, component_id (the smallest id reached) and kept."""
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v"), F.col(label_column).alias("label"))
    groups = usable(rows).groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult"))
    # nodes are ordered by id, those without one last
    groups = settled(groups.withColumn("node", F.struct(F.col("rep").isNull().alias("none"), "rep", F.xxhash64("label", "v").alias("h"))))
    # of each label and length, the power of four that its number of vectors calls for
    most = math.floor(math.log(most_cells, 4) + 1e-9)
    level = F.greatest(F.lit(0), F.least(F.lit(most), F.floor(F.log(F.count(F.lit(1)) / per_cell) / math.log(4))))
    levels = settled(groups.groupBy("label", F.size("v").alias("d")).agg(level.cast("int").alias("level"), F.count(F.lit(1)).alias("n")))
    placed = groups.withColumn("d", F.size("v")).join(levels.drop("n"), ["label", "d"])
    # a length and level is named only if a label has many vectors of it
    centroids = {}
    for r in levels.where("level > 0").groupBy("d", "level").agg(F.sum("n").alias("n")).collect():
        drawn = placed.where((F.col("d") == r["d"]) & (F.col("level") == r["level"]))
        drawn = drawn.where(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < max(1.0, (1 << 20) * sample_rows / r["n"])).select("v").limit(2 * sample_rows)
        sample = drawn.toArrow().column("v").combine_chunks()
        if len(sample):
            centroids[r["d"], r["level"]] = fit_cells(matrix(sample), 4 ** r["level"])

    def by_kind(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        kinds = np.column_stack([batch.column(c).to_numpy() for c in ("d", "level")])
        for kind in map(tuple, np.unique(kinds, axis=0).tolist()):
            if kind in centroids:
                yield kind, np.flatnonzero((kinds == kind).all(1))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, near = np.zeros(batch.num_rows, np.int32), np.ones(batch.num_rows)
            for kind, at in by_kind(batch):
                close = matrix(batch.column("v").take(pa.array(at))) @ centroids[kind].T
                cell[at], near[at] = close.argmax(1), close.max(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(near)], [*batch.schema.names, "home", "near"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in placed.dtypes)
    at_home = settled(placed.mapInArrow(homes, f"{kinds}, home int, near double"))
    # of each cell, how far its own vectors reach; as many rows as there are centroids
    reach = {((r["d"], r["level"]), r["home"]): r["r"] for r in at_home.where("level > 0").groupBy("d", "level", "home").agg(F.min("near").alias("r")).collect()}
    angle, chord = math.acos(threshold), math.sqrt(2 - 2 * threshold)
    # cells where nobody lives are beyond the reach of all
    reaching = {
        kind: np.array([math.cos(min(math.pi, math.acos(max(-1.0, min(1.0, reach[kind, k]))) + angle)) if (kind, k) in reach else 2.0 for k in range(len(c))])
        for kind, c in centroids.items()
    }

    def guests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = batch.column("home").to_numpy()
            row, cell = [np.arange(batch.num_rows)], [home]
            for kind, at in by_kind(batch):
                c, own = centroids[kind], home[at]
                close = matrix(batch.column("v").take(pa.array(at))) @ c.T
                behind = close[np.arange(len(at)), own][:, None] - close
                apart = np.sqrt(np.maximum(0, 2 - 2 * c[own] @ c.T))
                inside = (behind <= chord * apart + 1e-9) & (close >= reaching[kind] - 1e-9) & (np.arange(len(c)) < own[:, None])
                r, k = np.nonzero(inside)
                row.append(at[r])
                cell.append(k)
            taken = batch.take(pa.array(np.concatenate(row)))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.concatenate(cell), pa.int32())], [*batch.schema.names, "cell"])

    alone, shared = at_home.where("level = 0").withColumn("cell", F.col("home")), at_home.where("level > 0")
    shared = settled(shared.mapInArrow(guests, f"{kinds}, home int, near double, cell int"))
    members = alone.unionByName(shared)
    dealt = in_blocks(members, ["label", "d", "level", "cell"], F.xxhash64("v"), block, guest=F.col("home") != F.col("cell"))

    def compare(table: pa.Table) -> pa.Table:
        p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
        mult, side = table.column("mult").to_numpy(), table.column("block").to_numpy()
        x = matrix(table.column("v"))
        a, b = np.flatnonzero(side == p), np.flatnonzero(side == q)
        linked = x[a] @ x[b].T >= threshold
        if p == q:
            np.fill_diagonal(linked, False)
        count = np.zeros(len(x), np.int64)
        count[a] += linked @ mult[b]
        if p != q:
            count[b] += linked.T @ mult[a]
        root = local_roots(linked, a, b, len(x))
        at = np.flatnonzero(count)
        to = np.flatnonzero(root != np.arange(len(x)))
        nodes = table.column("node").combine_chunks()
        return pa.table({
            "node": pa.concat_arrays([nodes.take(pa.array(at)), nodes.take(pa.array(to))]),
            "links": pa.array([*count[at], *[0] * len(to)], pa.int64()),
            "other": pa.concat_arrays([pa.nulls(len(at), nodes.type), nodes.take(pa.array(root[to]))]),
        })

    node_kind = dict(groups.dtypes)["node"]
    found = settled(dealt.groupBy("label", "d", "level", "cell", "p", "q").applyInArrow(compare, f"node {node_kind}, links long, other {node_kind}"))
    links = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    # a node's first part is an id, so the smallest node of a component holds the smallest id
    result = groups.join(links, "node", "left").join(roots, "node", "left").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("root.rep", "rep").alias("component_id")
    )
    return (
        rows.join(result, ["label", "v"], "left")
        .select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
        .withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))
    )


def local_roots(linked: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For n rows, of which a[i] and b[j] are linked: a row of the same local component, the same for all of it."""
    label, none = np.arange(n), n
    while True:
        before = label.copy()
        label[a] = np.minimum(label[a], np.where(linked, label[b], none).min(1))
        label[b] = np.minimum(label[b], np.where(linked.T, label[a], none).min(1))
        label = label[label]
        if (label == before).all():
            return label
