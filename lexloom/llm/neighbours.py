"""Approximate nearest neighbours by inner product: learned partitions.

On a bounded sample of vectors a neighbour graph is built and cut into balanced parts (spectral bisections
with swaps); a small classifier learns in which parts a vector's neighbours lie. A part that more than ``LEAF``
vectors fall into gets a graph, parts and a classifier of its own, from a bounded sample of its vectors and in a task
of its own, so leaves grow in number with the table. Every vector is indexed in its most probable leaf. A query is
compared with all vectors of its most probable leaves, until these hold a set share of the probability and enough
candidates. That share is measured, not assumed: vectors kept out of the fit are compared with the whole
table, and the least share under which ``RECALL`` of their true neighbours are met is taken. Vectors in clear
clusters need few leaves; directions spread evenly need most of them for the same recall.

Equal vectors are one entry of the index with the smallest ids that a result can need; equal queries are
searched once. Large parts, and many queries to one part, are cut into a grid of bounded cells.

* Vectors that are NULL, zero, hold NULL or non-finite components, or are of another length than most: no part.
  Rows without id: no part.
* Fewer candidates than asked for: all of them. Ties go to the smaller id.
* A repeated row (same id and vector) is one more candidate of that id; as a query it is answered once.
* An empty table, or one without queries, gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexloom.llm.common import materialize, share_below

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors the graph and the classifier are made from, at most (about).
FIT_ROWS = 6000
#: Parts (a power of two), and neighbours in the graph.
PARTS, GRAPH = 64, 10
#: Vectors in a part, at most, before it is cut again (once).
LEAF = 1 << 16
#: Share of the true neighbours of the trial vectors that the search must meet, and number of trial vectors.
RECALL, TRIALS = 0.96, 200
NEAREST = 20
_ROUTED_AT_ONCE = 512  # vectors times leaves are held as one matrix
#: Entries and queries compared in one cell.
CELL, QUERIES = 16384, 4096
_LEAST_PART = 32  # sample vectors a part should have at least


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """For each row the ``k`` others with the largest inner products."""
    out = []
    for at in range(0, len(x), 1024):
        near = x[at : at + 1024] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out.append(np.argpartition(-near, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def bisect(a: np.ndarray, b: np.ndarray, count: int, seed: int, rounds: int = 60) -> np.ndarray:
    """Halves of a graph: True for one of them. Spectral order, cut in the middle, then swaps that lower the cut."""
    degree = np.bincount(a, minlength=count) + np.bincount(b, minlength=count) + 1.0
    root = np.sqrt(degree)
    v = np.random.default_rng(seed).standard_normal(count)
    for _ in range(rounds):
        v -= root * (v @ root) / (root @ root)
        w = v / root
        v = v + (np.bincount(a, w[b], count) + np.bincount(b, w[a], count)) / root  # lazy step: no negative end of the spectrum
        v /= np.linalg.norm(v) or 1.0
    side = np.zeros(count, bool)
    side[np.argsort(v / root, kind="stable")[count // 2 :]] = True
    for _ in range(20):
        other = np.bincount(a, side[a] != side[b], count) + np.bincount(b, side[a] != side[b], count)
        gain = 2 * other - (degree - 1)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        n = max(1, min(len(left), len(right)) // 50)
        left, right = left[np.argsort(-gain[left], kind="stable")[:n]], right[np.argsort(-gain[right], kind="stable")[:n]]
        good = gain[left] + gain[right] > 0
        if not good.any():
            break
        trial = side.copy()
        trial[left[good]], trial[right[good]] = True, False
        if (trial[a] != trial[b]).sum() >= (side[a] != side[b]).sum():
            break
        side = trial
    return side


def balanced_parts(near: np.ndarray, parts: int) -> np.ndarray:
    """Part of each node of the neighbour graph, by repeated halving."""
    count = len(near)
    a, b = np.repeat(np.arange(count), near.shape[1]), near.ravel()
    part = np.zeros(count, int)
    size = 1
    while size < parts:
        new = part * 2
        for p in range(size):
            inside = np.flatnonzero(part == p)
            number = np.full(count, -1)
            number[inside] = np.arange(len(inside))
            both = (number[a] >= 0) & (number[b] >= 0)
            new[inside] += bisect(number[a[both]], number[b[both]], len(inside), p)
        part, size = new, size * 2
    return part


@dataclass
class Router:
    """One hidden layer from a vector (scaled to length one) to the logits of the parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def fit_router(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 15, rate: float = 3e-3) -> Router:
    """Cross-entropy against the shares of each vector's neighbours in the parts; Adam steps."""
    random = np.random.default_rng(0)
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
    p = [random.standard_normal((x.shape[1], hidden)) * np.sqrt(2 / x.shape[1]) * 2, np.zeros(hidden), random.standard_normal((hidden, target.shape[1])) * np.sqrt(1 / hidden), np.zeros(target.shape[1])]
    m, s, step = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
    for _ in range(epochs):
        order = random.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            h = np.maximum(x[rows] @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            e = np.exp(z - z.max(1, keepdims=True))
            d = (e / e.sum(1, keepdims=True) - target[rows]) / len(rows)
            dh = (d @ p[2].T) * (h > 0)
            step += 1
            for i, g in enumerate((x[rows].T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.999 * s[i] + 0.001 * g * g
                p[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.999**step)) + 1e-8)
    return Router(*p)


def learn(x: np.ndarray, parts: int = PARTS) -> Router:
    """Graph, balanced parts and classifier from sample vectors; fewer parts for few vectors."""
    while parts > 1 and len(x) < parts * _LEAST_PART:
        parts //= 2
    if parts == 1:
        width = x.shape[1] if len(x) else 1
        return Router(np.zeros((width, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    near = neighbour_graph(x, min(GRAPH, len(x) - 1))
    part = balanced_parts(near, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1.0)
    np.add.at(target, (np.arange(len(x)), part), 2.0)
    return fit_router(x, target / target.sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def _softmax(logits: np.ndarray) -> np.ndarray:
    likely = np.exp(logits - logits.max(1, keepdims=True))
    return likely / likely.sum(1, keepdims=True)


@dataclass
class Tree:
    """A classifier over parts and, for parts cut again, one over their own; leaves are numbered part by part."""

    root: Router
    below: dict[int, Router]

    def firsts(self) -> np.ndarray:
        """First leaf of each part, and the number of leaves at the end."""
        sizes = [self.below[p].w2.shape[1] if p in self.below else 1 for p in range(self.root.w2.shape[1])]
        return np.cumsum([0, *sizes])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        top = _softmax(self.root.logits(x))
        return np.hstack([top[:, [p]] * _softmax(self.below[p].logits(x)) if p in self.below else top[:, [p]] for p in range(top.shape[1])])

    def homes(self, x: np.ndarray) -> np.ndarray:
        """The leaf each vector is indexed in."""
        part = self.root.logits(x).argmax(1)
        leaf = self.firsts()[part]
        for p, router in self.below.items():
            rows = np.flatnonzero(part == p)
            if len(rows):
                leaf[rows] += router.logits(x[rows]).argmax(1)
        return leaf


def _packed(tree: Tree) -> tuple[dict, dict]:
    """Plain arrays of a tree, which travel to the tasks without this module."""
    return asdict(tree.root), {p: asdict(r) for p, r in tree.below.items()}


def _unpacked(weights: tuple[dict, dict]) -> Tree:
    return Tree(Router(**weights[0]), {p: Router(**r) for p, r in weights[1].items()})


def _indexed(entries: DataFrame, tree: Tree) -> DataFrame:
    """``entries`` with ``part``, the leaf of their vector."""
    weights, names = _packed(tree), entries.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _unpacked(weights)
        for batch in batches:
            if batch.num_rows:
                leaf = held.homes(_matrix(batch.column("embedding")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], [*names, "part"])

    return entries.mapInArrow(place, entries.select("*", F.lit(0).alias("part")).schema)


def _routed(entries: DataFrame, tree: Tree, mass: float, held: np.ndarray, needed: int) -> DataFrame:
    """``entries`` with ``part``: one row for each of the most probable leaves, until they hold ``mass`` of
    the probability and ``needed`` ids (``held`` of them each)."""
    weights, names = _packed(tree), entries.columns

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = _unpacked(weights)
        for batch in (b.slice(at, _ROUTED_AT_ONCE) for b in batches for at in range(0, b.num_rows, _ROUTED_AT_ONCE)):
            likely = tree.probabilities(_matrix(batch.column("embedding")))
            order = np.argsort(-likely, axis=1, kind="stable")
            summed = np.cumsum(np.take_along_axis(likely, order, axis=1), axis=1)
            enough = np.cumsum(held[order], axis=1) >= needed
            count = np.maximum(1 + (summed[:, :-1] < mass).sum(1), np.where(enough.any(1), enough.argmax(1) + 1, order.shape[1]))
            chosen = np.arange(order.shape[1])[None, :] < count[:, None]
            rows = pa.array(np.nonzero(chosen)[0])
            yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns), pa.array(order[chosen].astype(np.int32))], [*names, "part"])

    return entries.mapInArrow(route, entries.select("*", F.lit(0).alias("part")).schema)


def _cut_again(index: DataFrame, sizes: dict[int, int], rows: int) -> dict[int, Router]:
    """Classifiers of the parts that hold more than ``LEAF`` vectors, each learned in its own task from about
    ``rows`` of them. At most ``PARTS`` classifiers of bounded size reach the driver."""
    large = {p: n for p, n in sizes.items() if n > LEAF}
    if not large:
        return {}
    share = F.get(F.array(*(F.lit(min(1.0, rows / large[p]) if p in large else 0.0) for p in range(max(large) + 1))), F.col("part"))
    least = F.get("ids", F.lit(0))
    # another hash than the one that chose the first sample, so the trial vectors are as rare here as any
    drawn = index.where(F.pmod(F.xxhash64(F.lit("leaf"), least), F.lit(1_000_000)) < F.coalesce(share, F.lit(0.0)) * 1_000_000)
    parts = PARTS

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        router = asdict(learn(_matrix(table.column("embedding")), parts))
        shapes = [list(w.shape) for w in router.values()]
        return pa.table({"part": table.column("part")[:1], "weights": [[w.astype("<f8").tobytes() for w in router.values()]], "shapes": [shapes]})

    learned = drawn.select("part", "embedding", least.alias("id")).groupBy("part").applyInArrow(fit, "part int, weights array<binary>, shapes array<array<long>>")
    return {r["part"]: Router(*(np.frombuffer(w, "<f8").reshape(shape) for w, shape in zip(r["weights"], r["shapes"]))) for r in learned.collect()}


def _mass(index: DataFrame, tree: Tree, trials: np.ndarray, ids: np.ndarray, k: int, recall: float) -> float:
    """The least share of the probability within which ``recall`` of the ``k`` nearest vectors of the trial
    vectors lie, the whole index compared. A task keeps only the nearest it has seen."""
    if not len(trials):
        return 1.0

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(trials), k), -np.inf)
        leaf = np.zeros((len(trials), k), np.int32)
        for batch in (b.slice(at, 8192) for b in batches for at in range(0, b.num_rows, 8192)):
            near = trials @ _matrix(batch.column("embedding")).T
            near[ids[:, None] == batch.column("id").to_numpy()[None, :]] = -np.inf
            near = np.hstack([best, near])
            leaves = np.hstack([leaf, np.broadcast_to(batch.column("part").to_numpy(), (len(trials), batch.num_rows))])
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            best, leaf = np.take_along_axis(near, top, 1), np.take_along_axis(leaves, top, 1)
        trial, at = np.nonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(trial.astype(np.int32)), pa.array(leaf[trial, at]), pa.array(best[trial, at])], ["trial", "part", "score"])

    nearest_first = Window.partitionBy("trial").orderBy(F.desc("score"), "part")
    seen = index.select("embedding", "part", F.get("ids", F.lit(0)).alias("id")).mapInArrow(compare, "trial int, part int, score double")
    true = seen.withColumn("n", F.row_number().over(nearest_first)).where(F.col("n") <= k).select("trial", "part").toPandas()  # k rows a trial vector
    likely = tree.probabilities(trials)
    order = np.argsort(-likely, axis=1, kind="stable")
    before = np.zeros(likely.shape)
    np.put_along_axis(before, order[:, 1:], np.cumsum(np.take_along_axis(likely, order, axis=1), axis=1)[:, :-1], axis=1)
    needed = np.sort(before[true["trial"].to_numpy(), true["part"].to_numpy()])
    return float(np.nextafter(needed[int(np.ceil(recall * len(needed))) - 1], 2)) if len(needed) else 1.0


def inner_products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row by row, added from the first component to the last: the same sum wherever it is computed."""
    total = np.zeros(len(q))
    for i in range(q.shape[1]):
        total += q[:, i] * v[:, i]
    return total


def _compared(base: pa.Table, queries: pa.Table, most: int) -> pa.Table:
    """The ``most`` best ids of one cell for each of its queries."""
    out: list[list] = [[], [], []]
    if base.num_rows and queries.num_rows:
        v, ids = _matrix(base.column("embedding")), base.column("ids").combine_chunks()
        first, flat = ids.offsets.to_numpy(), ids.flatten().to_numpy()
        first = first - first[0]
        q, names = _matrix(queries.column("embedding")), queries.column("query").to_numpy()
        for at in range(0, len(q), 128):
            near = q[at : at + 128] @ v.T
            if near.shape[1] > most:
                low = np.partition(near, near.shape[1] - most, axis=1)[:, near.shape[1] - most]
            else:
                low = np.full(len(near), -np.inf)
            row, col = np.nonzero(near >= (low - 1e-9 * (1 + np.abs(low)))[:, None])
            exact = inner_products(q[at + row], v[col])
            size = first[col + 1] - first[col]
            member = np.repeat(first[col] - np.concatenate([[0], size.cumsum()[:-1]]), size) + np.arange(size.sum())
            row, exact, member = np.repeat(row, size), np.repeat(exact, size), flat[member]
            order = np.lexsort((member, -exact, row))
            place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
            order = order[place < most]
            for column, values in zip(out, (names[at + row[order]], member[order], exact[order])):
                column.append(values)
    columns = [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(out, (np.int64, np.int64, np.float64))]
    return pa.table(dict(zip(("query", "vec_id", "score"), map(pa.array, columns))))


def _usable(embeddings: DataFrame) -> DataFrame:
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False)))
    lengths = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("embedding") == (lengths[0]["n"] if lengths else 0))


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = NEAREST, recall: float = RECALL, rows: int = FIT_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of each query, itself left out.

    ``queries`` are rows of ``embeddings`` (vec_id, embedding); an id with several vectors is answered for each,
    so its ranks repeat. ``recall`` is the share of true neighbours met on the trial vectors.
    """
    usable, asked = _usable(embeddings), _usable(queries)
    most = k + 1  # a query may find itself
    smallest = Window.partitionBy("embedding").orderBy("vec_id")
    entries = materialize(
        usable.withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= most).groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries"
    )
    sample = share_below(entries.select("embedding", F.get("ids", F.lit(0)).alias("id")), "id", rows).toPandas().sort_values("id")
    vectors = np.stack(sample["embedding"]) if len(sample) else np.zeros((0, 1))
    tried = np.zeros(len(sample), bool)
    if len(sample) >= 10:
        tried[:: max(10, len(sample) // TRIALS)] = True
    tree = Tree(learn(vectors[~tried]), {})

    index = _indexed(entries, tree)
    below = _cut_again(index, {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}, rows)  # one row per part
    if below:
        tree = Tree(tree.root, below)
        index = _indexed(entries, tree)
    index = materialize(index, "index")
    leaves = int(tree.firsts()[-1])
    mass = _mass(index, tree, vectors[tried], sample["id"].to_numpy()[tried], k, recall) if leaves > 1 else 1.0

    held, cells, loads = np.zeros(leaves, np.int64), np.ones(leaves, np.int64), np.ones(leaves, np.int64)
    for r in index.groupBy("part").agg(F.sum(F.size("ids")).alias("ids"), F.count("*").alias("n")).collect():  # one row per leaf
        held[r["part"]], cells[r["part"]] = r["ids"], -(-r["n"] // CELL)
    distinct = asked.groupBy("embedding").agg(F.min("vec_id").alias("query"))
    sought = materialize(_routed(distinct, tree, mass, held, most), "sought")
    for r in sought.groupBy("part").count().collect():
        loads[r["part"]] = -(-r["count"] // QUERIES)

    spark = embeddings.sparkSession
    grid = F.broadcast(spark.createDataFrame(list(zip(range(leaves), cells.tolist(), loads.tolist())), "part int, cells long, loads long"))
    mixed = F.xxhash64("embedding")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    base = index.join(grid, "part").select("part", F.pmod(mixed, "cells").alias("row"), every("loads").alias("col"), "embedding", "ids")
    probe = sought.join(grid, "part").select("part", every("cells").alias("row"), F.pmod(mixed, "loads").alias("col"), "embedding", "query")
    cell = ["part", "row", "col"]
    found = base.groupBy(*cell).cogroup(probe.groupBy(*cell)).applyInArrow(lambda b, q: _compared(b, q, most), "query long, vec_id long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= most)
    lists = top.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    lists = materialize(lists.join(distinct, "query").select("embedding", "near"), "lists")

    own = F.array_position(F.transform("near", lambda x: x["vec_id"]), F.col("query_id")) - 1
    answers = asked.select(F.col("vec_id").alias("query_id"), "embedding").distinct().join(lists, "embedding").withColumn("own", own)
    kept = F.slice(F.filter("near", lambda x, i: i != F.col("own")), 1, k)
    return answers.select("query_id", F.posexplode(kept).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )


def search(embeddings: DataFrame, every: int = 20) -> DataFrame:
    """The nearest of every row whose vec_id is divisible by ``every``."""
    return nearest(embeddings, embeddings.where(F.col("vec_id") % every == 0))
