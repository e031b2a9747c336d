"""Near-duplicate embeddings through an inverted multi-index.

Two codebooks, one for each half of the unit vectors, form a grid of cells. Every vector is
stored once, in the cell of its nearest codewords; vectors of neighbouring cells share a pack of
at most ``PACK``. As queries the vectors of a pack walk together over the cells in the order of
the sum of two lower bounds (how near the cell's halves can come) and stop where no vector of a
cell can reach the threshold any more, so the traversal ends at a recall of 1 rather than at a
number of cells. In each cell only the queries whose own bounds reach it are compared, by the
cosine in double precision.

Only vectors of one label and one length are compared. Every length has codebooks of its own,
fitted on a bounded sample (``SAMPLE``); they only steer the traversal: bounds hold for any
codebook. What travels does not follow the number of cells that are visited: packs are dealt to
the blocks of a square per label, and a task holds one block's packs while those of another pass
by. A label has blocks by its part of all pairs (``SHARES``), so a pack is copied at most
``sqrt(2 * SHARES) + 2`` times whatever the size of the table. Every pair of packs meets once and
counts for both sides; it returns the numbers of links and a spanning set of edges per group of
linked vectors, not every pair. Equal vectors of a label are one node with a weight.

Defined results: a row without label, or whose vector is null, zero, holds null or non-finite
components, links with nothing and is its own component; rows without vec_id take part and their component's id is its smallest id; an empty table gives an
empty result; further columns are ignored.
"""

from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import components, materialize, shuffle_tasks

#: Vectors that codebooks are fitted on: shared by all lengths, and the least of one length.
SAMPLE, LEAST_SAMPLE = 4_096, 256
PACK = 1_024
PER_CELL = 100
PACKS_AT_ONCE = 16
#: Tasks that the pairs of packs are shared out to, about.
SHARES = 16

_LINKS = "a long, b long, n long"


def codebook(points: np.ndarray, size: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly spaced first points."""
    size = min(size, len(points))
    centres = points[np.linspace(0, len(points) - 1, size).astype(int)].copy()
    for _ in range(rounds):
        near = ((points[:, None] ** 2).sum(-1) - 2 * points @ centres.T + (centres**2).sum(-1)).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=size)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def bounds(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest codeword of each half, and how near (squared) a point of each codeword's region can be.

    The region of a codeword lies behind the plane halfway to the query's own codeword.
    """
    squares = np.maximum(((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)), 0)
    own = squares.argmin(1)
    apart = np.sqrt(np.maximum(((centres[:, None] - centres[None]) ** 2).sum(-1), 1e-300))
    least = (squares - squares[np.arange(len(points)), own][:, None]) / (2 * apart[own])
    least[np.arange(len(points)), own] = 0
    return own, np.maximum(least - 1e-9, 0) ** 2


def visited(first: np.ndarray, second: np.ndarray, most: float):
    """Cells in the order of the sum of both bounds, up to ``most``: a multi-sequence walk of one query.

    The walk of a pack has the least bounds of its queries.
    """
    i, j = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    i, j = i[first[i] <= most], j[second[j] <= most]
    sums = first[i][:, None] + second[j][None]
    a, b = np.nonzero(sums <= most)
    order = np.argsort(sums[a, b], kind="stable")
    return i[a[order]], j[b[order]]


def _unit(matrix: np.ndarray) -> np.ndarray:
    wide = matrix.astype(float)
    return wide / np.sqrt((wide**2).sum(1))[:, None]


class Pack:
    """Vectors of neighbouring cells of a label, sorted by cell."""

    def __init__(self, nodes: bytes, weights: bytes, cells: bytes, vectors: bytes):
        self.nodes, self.weights, self.cells = (np.frombuffer(x, np.int64) for x in (nodes, weights, cells))
        self.unit = _unit(np.frombuffer(vectors, np.float32).reshape(len(self.nodes), -1))

    def runs(self):
        """Each cell with the range of its vectors."""
        cuts = np.flatnonzero(np.r_[True, self.cells[1:] != self.cells[:-1], True])
        return zip(self.cells[cuts[:-1]].tolist(), cuts[:-1].tolist(), cuts[1:].tolist())

    def walk(self, first: np.ndarray, second: np.ndarray, most: float) -> None:
        """What the pack's queries visit: the cells of their common walk, and each query's bounds."""
        half = first.shape[1]
        self.near = [np.ascontiguousarray(bounds(part, book)[1].T) for part, book in ((self.unit[:, :half], first), (self.unit[:, half:], second))]
        i, j = visited(self.near[0].min(1), self.near[1].min(1), most)
        self.columns = len(second)
        self.open = np.zeros(len(first) * len(second), bool)
        self.open[i * len(second) + j] = True


def reached(queries: Pack, stored: Pack, most: float, threshold: float) -> np.ndarray:
    """Which queries link with which stored vectors; only cells that a query visits are compared with it."""
    found = np.zeros((len(queries.nodes), len(stored.nodes)), bool)
    for cell, start, end in stored.runs():
        if queries.open[cell]:
            own = np.flatnonzero(queries.near[0][cell // queries.columns] + queries.near[1][cell % queries.columns] <= most)
            found[own, start:end] = queries.unit[own] @ stored.unit[start:end].T >= threshold
    return found & (queries.nodes[:, None] != stored.nodes[None])


def linked(queries: Pack, stored: Pack, found: np.ndarray, both: bool) -> pd.DataFrame:
    """Links of two packs: (a, null, number) of the queries, and with ``both`` of the stored vectors; spanning edges (a, b, 0)."""
    rows, columns = found.any(1), found.any(0)
    if not rows.any():
        return pd.DataFrame({"a": [], "b": [], "n": []})
    found, q_own, s_own = found[rows][:, columns], queries.nodes[rows], stored.nodes[columns]
    counts = [(q_own, (found * stored.weights[columns][None]).sum(1))]
    if both:
        counts.append((s_own, (found * queries.weights[rows][:, None]).sum(0)))
    top = np.iinfo(np.int64).max
    labels = q_own.copy()
    while True:  # smallest query of each group of linked vectors
        right = np.where(found, labels[:, None], top).min(0)
        left = np.where(found, right[None], top).min(1)
        if (left >= labels).all():
            break
        labels = np.minimum(labels, left)
    a = np.concatenate([*[nodes for nodes, _ in counts], q_own, s_own])
    b = np.concatenate([*[np.full(len(nodes), -1) for nodes, _ in counts], labels, right])
    n = np.concatenate([*[number for _, number in counts], np.zeros(len(labels) + len(right), np.int64)])
    out = pd.DataFrame({"a": a, "b": pd.array(b, dtype="Int64"), "n": n})
    out.loc[out["b"] == -1, "b"] = pd.NA
    return out[out["a"] != out["b"].fillna(-1)]


def paired(packs: DataFrame) -> DataFrame:
    """Every two packs of a label once, and each pack with itself: its columns, as q_* for the queries.

    The packs of a label are dealt to ``blocks``, and each pair of blocks is one key of the join.
    Only labels with more than a share of all pairs have several blocks; at most twice ``SHARES``
    of them exist.
    """
    sizes = packs.groupBy("label").agg(F.count(F.lit(1)).alias("packs"))
    squares, pairs = sizes.agg(F.sum(F.col("packs").cast("double") * F.col("packs")), F.sum(F.col("packs") * (F.col("packs") + 1) / 2)).first()
    large = sizes.where(F.col("packs").cast("double") * F.col("packs") * 2 * SHARES > squares).collect()
    blocks = [(r.label, min(r.packs, ceil(sqrt(2 * SHARES * r.packs**2 / squares)))) for r in large]
    blocks = packs.sparkSession.createDataFrame(blocks, "label string, blocks int")
    dealt = packs.join(F.broadcast(blocks), "label", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("pack"), F.col("blocks")).cast("int"))
    tasks, key = int(min(pairs, 2 * SHARES)), ["label", "one", "other"]
    own = [c for c in packs.columns if c != "label"]
    queries = dealt.withColumns({"one": F.col("block"), "other": F.explode(F.sequence(F.col("block"), F.col("blocks") - 1))})
    stored = dealt.withColumns({"one": F.explode(F.sequence(F.lit(0), F.col("block"))), "other": F.col("block")})
    queries = queries.select(*key, *[F.col(c).alias(f"q_{c}") for c in own]).repartition(tasks, *key)
    pairs = queries.join(stored.select(*key, *own).repartition(tasks, *key), key)
    return pairs.where("one < other or q_pack <= pack").drop("one", "other")


def _codebooks(nodes: DataFrame, lengths: dict) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Both codebooks of every length, from vectors with small hashes."""
    most, space = max(LEAST_SAMPLE, SAMPLE // len(lengths)), 1 << 40
    limits = nodes.sparkSession.createDataFrame([(k, -(-2 * most * space // r.number)) for k, r in lengths.items()], "length int, most long")
    some = nodes.join(F.broadcast(limits), "length").withColumn("place", F.pmod(F.xxhash64("key"), F.lit(space))).where("place < most")
    found: dict[int, list] = {}
    for r in some.select("length", "place", "embedding").collect():
        found.setdefault(r.length, []).append((r.place, r.embedding))
    books = {}
    for k, r in lengths.items():
        # a length none of whose vectors has a small hash gets one codeword
        points = _unit(np.array([v for _, v in sorted(found.get(k, [(0, [1.0] * k)]))[:most]], np.float32))
        size = int(np.clip(np.ceil(np.sqrt(r.number / max(r.labels, 1) / PER_CELL)), 4, 1_024))
        books[k] = (codebook(points[:, : k // 2], size), codebook(points[:, k // 2 :], size))
    return books


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<float>").alias("embedding"))
    usable = F.col("label").isNotNull() & F.coalesce(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )
    # a row's node is named by its length, label and vector; copies of a vector share it
    rows = rows.withColumn("key", F.when(usable, F.md5(F.concat_ws(",", F.size("embedding"), "label", F.col("embedding").cast("array<string>")))))
    nodes = rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("head"), F.count(F.lit(1)).alias("weight"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()))
    # from here on a label is one of a length, so that unlike lengths never meet
    nodes = nodes.withColumn("length", F.size("embedding")).withColumn("label", F.concat_ws(":", "length", "label"))
    lengths = {r.length: r for r in nodes.groupBy("length").agg(F.count(F.lit(1)).alias("number"), F.approx_count_distinct("label").alias("labels")).collect()}
    if not lengths:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    books = spark.sparkContext.broadcast(_codebooks(nodes, lengths))
    most = 2 - 2 * threshold + 1e-9  # squared distance of unit vectors at the threshold

    def place(batches):
        for mixed in batches:
            for length, pdf in mixed.groupby(mixed["embedding"].map(len)):
                first, second = books.value[length]
                raw = np.array(list(pdf["embedding"]), np.float32)
                unit, half = _unit(raw), first.shape[1]
                cells = bounds(unit[:, :half], first)[0] * len(second) + bounds(unit[:, half:], second)[0]
                yield pdf[["label", "node", "weight"]].assign(cell=cells, vector=[v.tobytes() for v in raw])

    def bundle(batches):
        held, current = [], None
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if held and (row.label != current or len(held) == PACK):
                    yield bundled(current, held)
                    held = []
                current = row.label
                held.append(row)
        if held:
            yield bundled(current, held)

    def bundled(label, held):
        nodes_, weights, cells = (np.array(x, np.int64).tobytes() for x in zip(*[(r.node, r.weight, r.cell) for r in held]))
        return pd.DataFrame({"label": [label], "nodes": [nodes_], "weights": [weights], "cells": [cells], "vectors": [b"".join(r.vector for r in held)]})

    placed = nodes.select("label", "node", "weight", "embedding").mapInPandas(place, "label string, node long, weight long, cell long, vector binary")
    packs = (
        placed.repartitionByRange(shuffle_tasks(spark), "label", "cell", "node")
        .sortWithinPartitions("label", "cell", "node")
        .mapInPandas(bundle, "label string, nodes binary, weights binary, cells binary, vectors binary")
    )
    packs = materialize(packs.withColumn("pack", F.monotonically_increasing_id()))

    def verify(batches):
        number, queries = None, None
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if number != r.q_pack:
                    number, queries = r.q_pack, Pack(r.q_nodes, r.q_weights, r.q_cells, r.q_vectors)
                    queries.walk(*books.value[queries.unit.shape[1]], most)
                stored = queries if r.pack == number else Pack(r.nodes, r.weights, r.cells, r.vectors)
                yield linked(queries, stored, reached(queries, stored, most, threshold), stored is not queries)

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(PACKS_AT_ONCE))
    found = materialize(paired(packs).drop("label").mapInPandas(verify, _LINKS))
    spark.conf.set(setting, before)
    numbers = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"))
    own = materialize(
        nodes.select("key", "node", "head", "weight").join(numbers, "node", "left").join(roots, "node", "left").select("key", "head", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    )
    least = own.groupBy("root").agg(F.min("head").alias("least"))
    per_node = own.join(least, "root").select("key", "n_links", "least")
    return rows.join(per_node, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("least")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
