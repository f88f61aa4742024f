"""Merkle manifest of a dataset: a digest per document, a tree per language, one root, and a proof per document.

A leaf is the SHA-256 of a document's fields, each with its length in front. Per language leaves stand in order
of doc_id; every ``FANOUT`` consecutive nodes have the hash of their joined hex digests as parent, level by
level, until one is left (a last run may hold fewer nodes, one even). The languages' subroots, in order of the
language, are the leaves of one more tree.

1. Leaves (narrow rows) are dealt by range and written in order; counts per partition give each its place.
2. Aligned blocks of ``FANOUT ** BLOCK`` leaves are whole subtrees: each is hashed in one task.
3. Butterfly exchange: in round r, groups of ``FANOUT ** STEP`` blocks that differ in digit r of their number
   swap the roots of their subtrees, and every block hashes the ancestors of the group for itself. After a
   logarithm of rounds each block holds its whole upper proof and the root; nothing is passed down again.
   Where the last subtree is not full, its blocks answer for the missing partners in turn.
4. Each block adds its upper proof to the proofs inside it.

A group never holds more than a block of leaves or ``FANOUT ** STEP`` nodes, whatever the language's size.

* NULL fields are ``-``; NULL languages form a tree of their own, the first one. NULL doc_ids come first.
* Rows of one doc_id follow the order of their leaves; rows with the same leaf are interchangeable. A row
  number breaks ties when rows are dealt, so one document repeated in a third of the rows is spread.
* Texts of any length are hashed where they are read. Other columns pass only if asked for. An empty table
  gives an empty result.
"""

from __future__ import annotations

import sys
from hashlib import sha256

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import materialize, numbered

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FANOUT = 2
#: Levels inside a block, and levels climbed per round of the exchange.
BLOCK = 12
STEP = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEPS = "array<struct<before:string,after:string>>"
_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def leaf(**changed: Column) -> Column:
    """Digest of a document's fields; ``changed`` columns stand for the fields of their name."""

    def field(c: Column) -> Column:
        value = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*(field(changed.get(c, F.col(c))) for c in FIELDS)).cast("binary"), 256)


def climbed(nodes: list[str], width: int, levels: int, fanout: int) -> tuple[list[list[tuple[str, str]]], list[str]]:
    """Steps of each of the neighbouring ``nodes`` of a level ``width`` wide, up to ``levels`` higher, and what is on top.

    A step holds the joined siblings before and after. The first node must begin a run on every level.
    """
    steps: list[list[tuple[str, str]]] = [[] for _ in nodes]
    size = 1  # given nodes below one of the level
    while levels and width > 1:
        for i, path in enumerate(steps):
            at = i // size
            start = at - at % fanout
            path.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + fanout])))
        nodes = [sha256("".join(nodes[i : i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]
        size, width, levels = size * fanout, -(-width // fanout), levels - 1
    return steps, nodes


def _placed(rows: DataFrame, fanout: int, *order: str) -> DataFrame:
    """Rows with their place ``at`` in the tree, its number ``total`` of leaves, their ``block`` and the number ``blocks``."""
    span = F.lit(fanout**BLOCK)
    return numbered(rows, "tree", *order).withColumn("block", F.call_function("div", F.col("at"), span)).withColumn("blocks", F.ceil(F.col("total") / span))


def _ordered(table: pa.Table) -> tuple[pa.Table, int]:
    table = table.sort_by("at")
    return table, table.column("total")[0].as_py()


def _exchanged(placed: DataFrame, fanout: int) -> DataFrame:
    """(tree, block, path, node): the upper proof of every block, and the root of its tree."""

    def block_root(table: pa.Table) -> pa.Table:
        ordered, total = _ordered(table)
        _, top = climbed(ordered.column("leaf").to_pylist(), total, BLOCK, fanout)
        return pa.table({"tree": ordered.column("tree")[:1], "block": ordered.column("block")[:1], "blocks": ordered.column("blocks")[:1], "node": pa.array(top)})

    leaves = placed.select("tree", "block", "blocks", "at", "total", "leaf")
    roots = leaves.groupBy("tree", "block").applyInArrow(block_root, "tree string, block long, blocks long, node string")
    state = materialize(roots.withColumn("path", F.array().cast(_STEPS)), "blocks")
    group, reach = fanout**STEP, 1
    most = state.agg(F.max("blocks")).first()[0] or 0
    while reach < most:
        span = reach * group
        begin = F.call_function("div", F.col("block"), F.lit(span)) * span + F.col("digit") * reach
        asked = state.select("tree", "block", "blocks", F.explode(F.sequence(F.lit(0), F.lit(group - 1))).alias("digit")).withColumn("begin", begin)
        partner = F.col("begin") + F.pmod("block", F.least(F.lit(reach), F.col("blocks") - F.col("begin")))
        asked = asked.where("begin < blocks").select("tree", F.col("block").alias("asker"), "digit", partner.alias("block"))
        told = asked.join(state.select("tree", "block", "node"), ["tree", "block"]).groupBy("tree", F.col("asker").alias("block"))
        met = told.agg(F.sort_array(F.collect_list(F.struct("digit", "node"))).alias("group"))  # at most ``group`` nodes

        def climb(batches, reach=reach):
            for batch in batches:
                columns = {c: batch.column(c).to_pylist() for c in ("block", "blocks", "path", "group")}
                paths, tops = [], []
                for block, blocks, path, nodes in zip(*columns.values()):
                    steps, top = climbed([n["node"] for n in nodes], -(-blocks // reach), STEP, fanout)
                    paths.append([*path, *({"before": b, "after": a} for b, a in steps[block // reach % group])])
                    tops += top
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("tree", "block", "blocks")), pa.array(tops), pa.array(paths, _PATH)], ["tree", "block", "blocks", "node", "path"])

        joined = state.select("tree", "block", "blocks", "path").join(met, ["tree", "block"])
        state = materialize(joined.mapInArrow(climb, f"tree string, block long, blocks long, node string, path {_STEPS}"), "exchanged")
        reach = span
    return state.select("tree", "block", "path", "node")


def _proven(placed: DataFrame, upper: DataFrame, fanout: int) -> DataFrame:
    """(row, leaf, path, subroot, root) of every leaf: its way through its block, then the block's own."""

    def proven(leaves: pa.Table, above: pa.Table) -> pa.Table:
        ordered, total = _ordered(leaves)
        steps, _ = climbed(ordered.column("leaf").to_pylist(), total, BLOCK, fanout)
        rest, n = [(s["before"], s["after"]) for s in above.column("path")[0].as_py()], len(ordered)
        paths = pa.array([[{"before": b, "after": a} for b, a in [*s, *rest]] for s in steps], _PATH)
        ends = {c: pa.array([above.column(c)[0].as_py()] * n, pa.string()) for c in ("subroot", "root")}
        return pa.table({"row": ordered.column("row"), "leaf": ordered.column("leaf"), "path": paths, **ends})

    rows = placed.select("tree", "block", "at", "total", "leaf", "row")
    ends = F.lit("").alias("subroot"), F.lit("").alias("root")
    schema = rows.select("row", "leaf", F.array().cast(_STEPS).alias("path"), *ends).schema
    return rows.groupBy("tree", "block").cogroup(upper.select("tree", "block", "path", "subroot", "root").groupBy("tree", "block")).applyInArrow(proven, schema)


def manifest(documents: DataFrame, keep: list[str], fanout: int = FANOUT) -> DataFrame:
    """Columns ``keep`` of every document, leaf, subroot, root and path.

    ``path`` holds, from the leaf to the root, the joined hex digests of the siblings before and after; empty
    ones where a node is alone in its run.
    """
    tree = F.when(F.col("lang").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("lang")))
    rows = documents.select(F.struct(*keep).alias("row"), tree.alias("tree"), "doc_id", leaf().alias("leaf"), F.monotonically_increasing_id().alias("nth"))
    placed = _placed(materialize(rows, "leaves"), fanout, "doc_id", "leaf", "nth")
    blocks = _exchanged(placed, fanout)

    subroots = blocks.where("block = 0").select(F.struct("tree").alias("row"), F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("node").alias("leaf"))
    trees = _placed(subroots, fanout, "name")
    top = _exchanged(trees, fanout).select("tree", "block", "path", F.col("node").alias("subroot"), F.col("node").alias("root"))
    ends = _proven(trees, top, fanout).select(F.col("row.tree").alias("tree"), F.col("path").alias("rest"), "root")
    upper = blocks.join(ends, "tree").select("tree", "block", F.concat("path", "rest").alias("path"), F.col("node").alias("subroot"), "root")
    found = _proven(placed, materialize(upper, "upper"), fanout)
    return found.select("row.*", *(F.col(c).alias(c) for c in ("leaf", "subroot", "root", "path") if c not in keep))


def folded(start: Column, path: Column) -> Column:
    """Root that follows from a leaf and the siblings on its way."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]).cast("binary"), 256))


def report(documents: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified, with a seventh of the documents tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    given = documents.select(*FIELDS, F.when(tampered, leaf(n_chars=F.col("n_chars") + 1)).alias("altered"))
    proven = manifest(given, ["doc_id", "altered"])
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    rows = proven.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), folded(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
