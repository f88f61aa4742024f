"""SimHash near-duplicates: anchor-point covering over the fingerprint space.

A document's fingerprint holds, per bit, the majority among the XXH64 values of its word shingles. Links
(at most ``distance`` differing bits) are found with a covering code: the 2**12 words of a fixed linear
code of length 64 are the anchors. Each distinct fingerprint ``x`` lives at its nearest anchor, ``r(x)``
bits away (at most the covering radius), and is replicated to every anchor within ``r(x) + distance``.
For a link (x, y) with r(x) <= r(y) the home of x is at most r(x) + distance from y, so y's replica meets
x there: no link is missed. Cells are compared with XOR and bit counts in numpy.

Size: only distinct fingerprints are replicated (8 bytes each, about 40 anchors). Cells over ``CELL`` homes
or ``REPLICAS`` replicas are cut into a grid of smaller ones, so a crowded anchor is many bounded tasks.
A cell returns a spanning forest of its links, not the pairs, so a group of copies yields as many rows as
members. Components are joined up on tables in the shared folder.

* No words (NULL, empty, white space): fingerprint zero, linked like any other.
* Fewer words than the shingle: the whole sequence is the one shingle.
* Repeated rows and equal texts: one fingerprint, one component. NULL ids never name a component unless
  all its ids are NULL. An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexloom.llm.common import materialize, slices
from lexloom.llm.graph import components, local_roots

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Homes and replicas compared in one task at a time.
CELL = 8192
REPLICAS = 65536
_DIMENSION = 12


def anchors(dimension: int = _DIMENSION) -> np.ndarray:
    """All words of the linear code spanned by hashes of 0, 1, 2, ..."""
    words = np.zeros(1, np.uint64)
    for i in range(dimension):
        words = np.concatenate([words, words ^ np.uint64(xxhash.xxh64_intdigest(bytes([i]), SEED))])
    return words


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingle hashes, as a signed 64-bit number."""
    words = (text or b"").lower().split()  # bytes: lowers A-Z, splits at ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    hashed, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(first), 65536):
        values = np.array([hashed(joined[a:b], SEED) for a, b in zip(first[at : at + 65536], last[at : at + 65536])], "<u8")
        counts += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(first), bitorder="little").view("<i8")[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, a hash of the text and the fingerprint of every document, row by row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            prints = pa.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), prints], ["doc_id", "text_hash", "print"])

    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(hashed, rows.select("doc_id", "text_hash", F.lit(0).cast("long").alias("print")).schema)


def _replicas(prints: DataFrame, distance: int) -> DataFrame:
    """(anchor, home, print): one row per anchor within reach, home marks the nearest."""
    code = anchors()

    def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("print").to_numpy(zero_copy_only=False)
            for at in range(0, len(values), 2048):
                part = values[at : at + 2048]
                away = np.bitwise_count(part.view(np.uint64)[:, None] ^ code[None, :])
                nearest = away.argmin(1)
                row, anchor = np.nonzero(away <= away.min(1)[:, None] + distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.astype(np.int32)), pa.array(anchor == nearest[row]), pa.array(part[row])],
                    ["anchor", "home", "print"],
                )

    return prints.mapInArrow(covered, "anchor int, home boolean, print long")


def _spanning(table: pa.Table, distance: int) -> pa.Table:
    """Edges that join up all linked fingerprints of one cell."""
    values = table.column("print").to_numpy()
    homes = np.unique(values[table.column("home").to_numpy(zero_copy_only=False)])
    others = np.unique(values)
    # Nodes are positions in ``others``, of which the homes are some.
    node, left, right = np.searchsorted(others, homes), [], []
    step = max(1, (1 << 22) // max(len(others), 1))
    for at in range(0, len(homes), step):
        part = homes[at : at + step].view(np.uint64)
        near = np.bitwise_count(part[:, None] ^ others.view(np.uint64)[None, :]) <= distance
        row, col = np.nonzero(near)
        roots = local_roots(len(others), node[at : at + step][row], col)  # a tile's pairs shrink to stars at once
        moved = np.flatnonzero(roots != np.arange(len(others)))
        left.append(moved)
        right.append(roots[moved])
    roots = local_roots(len(others), np.concatenate(left or [[]]).astype(int), np.concatenate(right or [[]]).astype(int))
    moved = np.flatnonzero(roots != np.arange(len(others)))
    return pa.table({"a": pa.array(others[moved]), "b": pa.array(others[roots[moved]])})


def _links(prints: DataFrame, distance: int) -> DataFrame:
    """Edges between distinct fingerprints with the components of all links."""
    placed = materialize(_replicas(prints, distance), "anchored")
    sizes = placed.groupBy("anchor").agg(  # one row per anchor: bounded by the code
        F.ceil(F.sum(F.col("home").cast("long")) / CELL).cast("int").alias("rows"), F.ceil(F.count("*") / REPLICAS).cast("int").alias("cols")
    )
    sized = placed.join(F.broadcast(sizes), "anchor").where("rows > 0")
    mixed = F.xxhash64("print")
    row, col = F.pmod(mixed, F.col("rows")), F.pmod(F.shiftright(mixed, 20), F.col("cols"))
    # A home also meets the other homes: it is in the columns of the grid as well.
    as_home = sized.where("home").select("*", row.alias("row"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("cols").cast("long") - 1)).alias("col"))
    as_copy = sized.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows").cast("long") - 1)).alias("row"), col.cast("long").alias("col")).withColumn("home", F.lit(False))
    cells = as_home.union(as_copy).select("anchor", "row", "col", "home", "print")
    return cells.groupBy("anchor", "row", "col").applyInArrow(lambda t: _spanning(t, distance), "a long, b long")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, text_hash, print and component_id (smallest doc_id of the component) of every document."""
    hashed = materialize(fingerprints(documents, shingle), "prints")
    owned = materialize(hashed.groupBy("print").agg(F.min("doc_id").alias("least")), "owned")
    roots = components(_links(owned.select("print"), distance))
    grouped = owned.join(roots.withColumnRenamed("node", "print"), "print", "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialize(grouped.join(named, "root").select("print", "component_id"), "classes")
    return hashed.join(classes, "print").select("doc_id", "text_hash", "print", "component_id")


def fingerprint_components(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id."""
    hexed = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return near_duplicates(documents).select("doc_id", hexed, "component_id")


def one_per_component(documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The row with the smallest doc_id of each component, with its own columns.

    Of rows equal in id and text the one whose columns have the least hash stays; that choice is made in
    every task before the one shuffle of the texts, whose partitioning the join with the chosen keys keeps.
    """
    found = near_duplicates(documents, shingle, distance)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")
    component = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("print"), F.col("print").cast("string")))
    chosen = found.groupBy(component.alias("component")).agg(F.min(order).alias("first"))
    chosen = chosen.select(_row_key(F.col("first.doc_id"), F.col("first.text_hash")).alias("__key")).distinct()
    keyed = documents.withColumn("__key", _row_key(F.col("doc_id"), F.xxhash64("text")))
    each = Window.partitionBy("__key").orderBy(F.xxhash64(*documents.columns))
    first = keyed.withColumn("__nth", F.row_number().over(each)).where("__nth = 1")
    return first.join(chosen, "__key", "left_semi").select(*documents.columns)


def _row_key(doc_id: Column, text_hash: Column) -> Column:
    """One key, never NULL, for rows equal in id and text."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.hex(text_hash))
