"""Near-duplicates by the Jaccard similarity of word shingles, found with bottom-k sketches.

One hash function gives every distinct shingle of a document a 64-bit value; the ``RETAINED`` smallest are
the sketch. Documents of equal sets are one node. For a link (similarity of 4/5 or more) the sketches share
``least_shared`` values at least, except with a probability of ``RISK`` a pair (the shared values among the
least of the union are a sample of the union).

1. Values are counted over all sketches. Of a sketch's values that others have too, rarest first, only so
   many enter inverted lists that two sketches sharing enough of them meet in a list; sketches without
   enough shared values drop out. So common lines and passages make no lists of their own.
2. Lists of at most ``LIST`` members give their pairs, a number of them that grows with the members only.
   The union sketch of a pair estimates its similarity; what passes is verified on the full sets.
3. Members of longer lists are joined up, unverified, into regions; no link leaves a region. A region is cut by
   size of the set (linked sizes differ by a quarter at most) and into a grid of bounded tiles. A tile holds
   full sets, counts overlaps with an inverted index, estimates, verifies, and returns a spanning forest of
   its links. A group of thousands of near copies yields as many rows as members.
4. Components are joined up on tables in the shared folder; a root carries its smallest doc_id.

Links are confirmed on full sets of 64-bit values; two different shingles of one pair of documents pass for
equal with a probability of about 10**-14.

* No words (NULL, empty, white space): the empty set, linked with nothing, not even with another one.
* Fewer words than the shingle: the whole sequence is the one shingle.
* Repeated rows and equal texts: one node, one component. NULL ids never name a component unless all its
  ids are NULL. Other columns of ``documents`` are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import materialize, slices
from lexloom.llm.graph import components
from lexloom.llm.substrings import Hasher

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 4
RETAINED = 64
RISK = 1e-9
#: Members of a list that gives its pairs.
LIST = 64
#: Values of the sets compared in one tile at a time.
HOMES = 1 << 17
OTHERS = 1 << 20
#: Bytes of text hashed at once.
BLOCK = 4 << 20
_GRADE = 1.3  # sizes of linked sets, at most a factor of 1.25 apart, are in equal or neighbouring grades


def least_shared(retained: int, risk: float = RISK) -> int:
    """Most values that two sketches of similarity 4/5 share except with probability ``risk``."""
    total = 0.0
    for shared in range(retained + 1):
        total += math.comb(retained, shared) * 0.8**shared * 0.2 ** (retained - shared)
        if total > risk:
            return shared
    return retained


def linked(shared, a, b):
    """Similarity of two sets of sizes a and b of 4/5 or more, for numbers, arrays or columns."""
    return 100 * shared >= 80 * (a + b - shared)


def shingle_sets(texts: list[bytes], hasher: Hasher) -> Iterator[np.ndarray]:
    """Ascending distinct shingle values of each text."""
    lowered = [t.lower() for t in texts]  # bytes: lowers A-Z only
    starts, words = hasher.words_of(np.frombuffer(b"\n".join(lowered), np.uint8))
    first = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in lowered)])).tolist()
    values = hasher.windows_of(words)[0].view(np.int64)
    for text, a, b in zip(lowered, first, first[1:]):
        if b - a >= hasher.window:
            yield np.unique(values[a : b - hasher.window + 1])
        else:
            whole = [xxhash.xxh64_intdigest(b" ".join(text.split()))] if b > a else []
            yield np.array(whole, np.uint64).view(np.int64)


def _sketches(documents: DataFrame, shingle: int, retained: int) -> DataFrame:
    """doc_id, text_hash, digest of the set, its size n and sketch, row by row."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(shingle)
        for batch in slices(batches, "text", BLOCK):
            digests, sizes, kept = [], [], []
            for values in shingle_sets([t or b"" for t in batch.column("text").to_pylist()], hasher):
                digests.append(xxhash.xxh3_128_digest(values.tobytes()))
                sizes.append(len(values))
                kept.append(values[:retained])
            offsets = np.cumsum([0, *map(len, kept)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(kept)))
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "digest", "n", "sketch"])

    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    empty = F.array().cast("array<bigint>").alias("sketch")
    schema = rows.select("doc_id", "text_hash", F.lit(b"").alias("digest"), F.lit(0).cast("long").alias("n"), empty).schema
    return rows.mapInArrow(sketched, schema)


def _lists(nodes: DataFrame, retained: int) -> DataFrame:
    """(value, id, n, members, lead): inverted lists of two members at least."""
    most = least_shared(retained)
    values = nodes.select("id", "n", F.explode("sketch").alias("value"))
    counted = values.groupBy("value").agg(F.count("*").alias("count")).where("count > 1")
    held = values.join(counted, "value").groupBy("id").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("count", "value"))).alias("common"))
    need = F.least(F.lit(most), F.expr("cast((4 * n + 4) div 5 as int)"))
    # Values of one sketch alone are rarest of all and share no list, so they shorten what is listed.
    listed = held.where(F.size("common") >= need).select("id", "n", F.explode(F.slice("common", F.lit(1), F.size("common") - need + 1)).alias("c"))
    lists = materialize(listed.select(F.col("c.value").alias("value"), "id", "n"), "lists")
    counts = lists.groupBy("value").agg(F.count("*").alias("members"), F.min("id").alias("lead")).where("members > 1")
    return materialize(lists.join(counts, "value"), "placed")


def _row_key(doc_id: Column, text_hash: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.hex(text_hash))


def _full_sets(documents: DataFrame, nodes: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(id, values) of the nodes in ``ids``: the whole set, as 64-bit numbers."""
    wanted = nodes.join(ids, "id", "left_semi").select("id", _row_key(F.col("owner.doc_id"), F.col("owner.text_hash")).alias("key"))
    rows = documents.select(_row_key(F.col("doc_id"), F.xxhash64("text")).alias("key"), F.col("text").cast("binary").alias("text"))
    texts = rows.join(wanted, "key").groupBy("id").agg(F.first("text").alias("text"))  # repeated rows

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(shingle)
        for batch in slices(batches, "text", BLOCK):
            sets = [v.tobytes() for v in shingle_sets(batch.column("text").to_pylist(), hasher)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], ["id", "values"])

    return materialize(texts.select("id", "text").mapInArrow(hashed, "id long, values binary"), "full")


def _likely(left: pa.ListArray, right: pa.ListArray, retained: int) -> np.ndarray:
    """Whether the union sketch of each pair of sketches holds enough shared values."""
    count = len(left)
    held = [np.diff(side.offsets.to_numpy()) for side in (left, right)]
    pair = np.concatenate([np.repeat(np.arange(count), n) for n in held])
    values = np.concatenate([side.flatten().to_numpy() for side in (left, right)])
    order = np.lexsort((values, pair))
    pair, values = pair[order], values[order]
    again = np.concatenate([[False], (pair[1:] == pair[:-1]) & (values[1:] == values[:-1])])
    new = np.cumsum(~again)  # distinct values so far
    before = np.concatenate([[0], new])[np.searchsorted(pair, np.arange(count))]
    inside = new - before[pair] <= retained
    shared, union = np.bincount(pair[inside & again], minlength=count), np.bincount(pair[inside & ~again], minlength=count)
    return (shared >= least_shared(retained)) | ((union < retained) & (5 * shared >= 4 * union))


def _pairs(lists: DataFrame, nodes: DataFrame, full: DataFrame, retained: int) -> DataFrame:
    """(a, b): verified links of the short lists."""
    left = lists.select("value", F.col("id").alias("a"), F.col("n").alias("na"))
    right = lists.select("value", F.col("id").alias("b"), F.col("n").alias("nb"))
    pairs = left.join(right, "value").where("a < b and 5 * least(na, nb) >= 4 * greatest(na, nb)").select("a", "b").distinct()

    sketches = nodes.select("id", "sketch")
    for side in ("a", "b"):
        pairs = pairs.join(sketches.select(F.col("id").alias(side), F.col("sketch").alias(f"sketch_{side}")), side)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = pa.array(_likely(batch.column("sketch_a"), batch.column("sketch_b"), retained))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])

    likely = pairs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(passed, "a long, b long")
    checked = materialize(likely, "likely")
    for side in ("a", "b"):
        checked = checked.join(full.select(F.col("id").alias(side), F.col("values").alias(f"values_{side}")), side)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("values_a").to_pylist(), batch.column("values_b").to_pylist()):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                keep.append(linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])

    return checked.select("a", "b", "values_a", "values_b").mapInArrow(verified, "a long, b long")


def _tile(table: pa.Table, retained: int) -> pa.Table:
    """Links that join up the sets of one tile, home against other; a home also comes as an other."""
    home = table.column("home").to_numpy(zero_copy_only=False)
    ids = table.column("id").to_numpy()
    own = table.column("own").to_numpy(zero_copy_only=False)
    sets = [np.frombuffer(v, np.int64) for v in table.column("values").to_pylist()]
    most, nodes = least_shared(retained), np.unique(ids)
    others = np.flatnonzero(~home)
    sizes = np.array([len(sets[o]) for o in others], np.int64)
    node, above = np.searchsorted(nodes, ids[others]), ids[others]
    lower = ~own[others]  # of the grade below: never a home here

    def index(width: int | None):
        held = [sets[o][:width] for o in others]
        values, owner = np.concatenate([np.zeros(0, np.int64), *held]), np.repeat(np.arange(len(others)), [len(h) for h in held])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(h)) for h in held)])
        order = np.argsort(values, kind="stable")
        return values[order], owner[order], place[order]

    def hits(values: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the index of each value, and which value it was."""
        low, high = np.searchsorted(held, values, "left"), np.searchsorted(held, values, "right")
        count = high - low
        which = np.repeat(np.arange(len(values)), count)
        return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[which], which

    short, whole = index(retained), None
    label, a, b = np.arange(len(nodes)), [], []
    for h in np.flatnonzero(home):
        x, me = sets[h], int(np.searchsorted(nodes, ids[h]))
        at, rank = hits(x[:retained], short[0])
        owner, place = short[1][at], short[2][at]
        open_ = (label[node] != label[me]) & (lower | (above > ids[h])) & (5 * np.minimum(sizes, len(x)) >= 4 * np.maximum(sizes, len(x)))
        open_ &= np.bincount(owner, minlength=len(others)) >= np.minimum(most, (4 * np.minimum(sizes, len(x)) + 4) // 5)
        if not open_.any():
            continue
        # The t-th shared value, of rank i here and j there, has rank i + j - t in the union.
        chosen = open_[owner]
        owner, rank, place = owner[chosen], rank[chosen], place[chosen]
        order = np.argsort(owner, kind="stable")
        owner, rank, place = owner[order], rank[order], place[order]
        new = np.concatenate([[True], owner[1:] != owner[:-1]])
        nth = np.arange(len(owner)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        shared = np.bincount(owner[rank + place - nth < retained], minlength=len(others))
        union = len(x) + sizes - shared  # exact where both sketches are whole sets
        open_ &= (shared >= most) | ((union < retained) & (5 * shared >= 4 * union))
        if not open_.any():
            continue
        whole = whole or index(None)
        at, _ = hits(x, whole[0])
        common = np.bincount(whole[1][at], minlength=len(others))
        for o in np.flatnonzero(open_ & linked(common, len(x), sizes)):
            if label[node[o]] != label[me]:
                label[label == label[node[o]]] = label[me]
                a.append(ids[h])
                b.append(above[o])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _regions(lists: DataFrame, full: DataFrame, retained: int) -> DataFrame:
    """(a, b): verified links that join up the members of the long lists."""
    joined = components(lists.select(F.col("id").alias("a"), F.col("lead").alias("b")))
    grade = F.floor(F.log("n") / math.log(_GRADE)).cast("int")
    members = lists.select("id", "n").distinct().join(joined.withColumnRenamed("node", "id"), "id")
    members = materialize(members.select("root", grade.alias("grade"), "id", "n"), "members")
    # A cell: the homes are of one grade; they meet that grade and the one below.
    own = members.withColumn("own", F.lit(True))
    both = own.union(members.select("root", F.col("grade") + 1, "id", "n", F.lit(False)))
    cells = both.groupBy("root", "grade").agg(
        F.ceil(F.sum(F.when(F.col("own"), F.col("n")).otherwise(0)) / HOMES).alias("rows"), F.ceil(F.sum("n") / OTHERS).alias("cols")
    )
    sized = both.join(cells.where("rows > 0"), ["root", "grade"])
    mixed = F.xxhash64("id")
    row, col = F.pmod(mixed, F.col("rows")), F.pmod(F.shiftright(mixed, 20), F.col("cols"))
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    homes = sized.where("own").select("root", "grade", row.alias("row"), F.explode(upto("cols")).alias("col"), F.lit(True).alias("home"), "own", "id")
    others = sized.select("root", "grade", F.explode(upto("rows")).alias("row"), col.alias("col"), F.lit(False).alias("home"), "own", "id")
    tiles = homes.union(others).join(full, "id")
    return tiles.groupBy("root", "grade", "row", "col").applyInArrow(lambda t: _tile(t, retained), "a long, b long")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, retained: int = RETAINED) -> DataFrame:
    """doc_id, text_hash, n_shingles and component_id (smallest doc_id of the component) of every document."""
    sets = materialize(_sketches(documents, shingle, retained), "sets")
    owner = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    nodes = sets.where("n > 0").groupBy("digest").agg(F.min(owner).alias("owner"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = materialize(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    lists = _lists(nodes, retained)
    full = _full_sets(documents, nodes, lists.select("id").distinct(), shingle)
    links = _pairs(lists.where(F.col("members") <= LIST), nodes, full, retained).union(_regions(lists.where(F.col("members") > LIST), full, retained))

    # Nodes ordered by their smallest doc_id, so that a root carries the component's.
    named = nodes.select("id", F.struct(F.col("owner.unnamed"), F.col("owner.doc_id"), "id").alias("node"))
    edges = materialize(links, "links")
    for side in ("a", "b"):
        edges = edges.join(named.select(F.col("id").alias(side), F.col("node").alias(f"node_{side}")), side)
    roots = components(edges.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    roots = roots.select(F.col("node.id").alias("id"), F.col("root.doc_id").alias("least"))
    classes = nodes.join(roots, "id", "left").select("digest", F.coalesce("least", "owner.doc_id").alias("component_id"))
    found = sets.select("doc_id", "text_hash", "digest", "n").join(materialize(classes, "classes"), "digest", "left")
    return found.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept: one document of each component."""
    return near_duplicates(documents).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
