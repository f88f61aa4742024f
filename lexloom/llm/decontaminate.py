"""Benchmark decontamination with suffix arrays over the training texts.

Each task cuts its documents into shards, turns words into numbers and sorts the shard's suffixes (prefix
doubling). Every suffix of every benchmark item is then looked up by binary search: the range that shares
its window gives all verbatim occurrences with their places; chains of occurrences give the longest match.

A training word that occurs in no benchmark item ends every match, so it becomes a stop, and runs of
benchmark words shorter than the shortest window are left out of the array: they cannot hold a match.

The benchmark is the query set and goes to the tasks in slices of at most about ``SLICE`` bytes of text. One
slice takes one pass over the documents, which are not shuffled. More slices take a pass each, one after
another: a pass writes only what it found, and its slice is freed, so neither the driver nor a task ever holds
two. The last pass meets the findings of the others by a digest of the text.
A window that many items share is looked up once.

* NULL or empty document: no words, no hits, not contaminated. NULL or empty item: no window.
* Item without id: takes no part. Repeated items count once; rows of one id with different texts are one item.
* Equal documents get equal results, repeated rows stay. Long texts are one shard each.
* An empty benchmark leaves every document clean; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import materialize, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
#: Bytes of benchmark text sent to the tasks at once.
SLICE = 8 << 20
#: Windows looked up at once, and pairs of place and suffix listed at once (or those of one document).
SOUGHT, PAIRS = 1 << 17, 1 << 20
#: Bytes of document text in one suffix array.
SHARD = 16 << 20
#: A document is contaminated if at least one in so many of its words is hit.
SHARE = 20

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and characters beyond ASCII."""
    return (text or b"").translate(_FOLD).split()


@dataclass
class Probe:
    """One slice of the benchmark: word numbers from 1, the suffixes that start a window, its distinct windows."""

    vocabulary: dict[bytes, int]
    ids: list[str]
    item: np.ndarray  # of each suffix
    tokens: np.ndarray  # distinct windows, padded with 0
    width: np.ndarray  # words of each distinct window
    by_window: np.ndarray  # suffixes, those of one distinct window together
    first: np.ndarray  # where in by_window those of each distinct window begin; one more at the end
    longest: int

    def suffixes(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All suffixes of each of these windows in turn, and how many each has."""
        size = self.first[windows + 1] - self.first[windows]
        return self.by_window[_ranges(self.first[windows], size)], size


def _ranges(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """low[i], low[i] + 1, ... : ``size[i]`` numbers for each i."""
    return np.repeat(low - np.concatenate([[0], size.cumsum()])[:-1], size) + np.arange(size.sum())


def distinct_windows(tokens: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the window at each of ``starts``, equal for equal words, and one place of each number."""
    if not len(starts):
        return starts, starts
    rank, reach = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while reach * 2 <= window:
        after = np.concatenate([rank[reach:], np.zeros(reach, np.int64)])
        rank, reach = np.unique(rank * (len(rank) + 1) + after, return_inverse=True)[1].astype(np.int64), reach * 2
    # Two overlapping pieces of ``reach`` words make up the window.
    _, place, number = np.unique(rank[starts] * (len(rank) + 1) + rank[starts + window - reach], return_index=True, return_inverse=True)
    return number, starts[place]


def probe(items: list[tuple[str, bytes]], window: int = WINDOW) -> Probe:
    """``items``: (id, text) pairs; an item shorter than the window is one window."""
    vocabulary: dict[bytes, int] = {}
    pieces, counts = [], []
    for _, text in items:
        numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)]
        pieces.append(np.array(numbers + [0] * window, np.int32))
        counts.append(len(numbers))
    tokens = np.concatenate([np.zeros(0, np.int32), *pieces])
    counts = np.array(counts, np.int64)
    begin = np.cumsum(counts + window) - counts - window
    suffixes = np.where(counts > 0, np.maximum(counts - window + 1, 1), 0)
    item = np.repeat(np.arange(len(items)), suffixes)
    starts = _ranges(begin, suffixes)
    number, place = distinct_windows(tokens, starts, window)
    rows = tokens[place[:, None] + np.arange(window)]
    first = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(place)))]).astype(np.int64)
    return Probe(
        vocabulary, [name for name, _ in items], item, rows, (rows != 0).sum(1), np.argsort(number, kind="stable"), first, int(counts.max(initial=0))
    )


def suffix_array(tokens: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of the suffixes of ``tokens`` there, compared over ``depth`` words at least."""
    rank, reach = np.zeros(len(tokens) + 1, np.int64), 1
    rank[starts] = tokens[starts]
    if not len(starts):
        return starts
    while True:
        key = rank[starts] * (rank.max() + 1) + rank[np.minimum(starts + reach, len(tokens))]
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.concatenate([[1], np.diff(key[order]) != 0]))
        rank[starts[order]] = new
        reach *= 2
        if new[-1] == len(starts) or reach >= depth:
            return starts[order]


def bounds(tokens: np.ndarray, array: np.ndarray, sought: np.ndarray, width: np.ndarray, after: bool) -> np.ndarray:
    """Where each prefix ``sought[i, :width[i]]`` begins (or, ``after``, ends) in the suffix array."""
    low, high = np.zeros(len(sought), np.int64), np.full(len(sought), len(array))
    step = np.arange(sought.shape[1])
    used = step[None, :] < width[:, None]
    while len(open_ := np.flatnonzero(low < high)):
        mid = (low[open_] + high[open_]) // 2
        here, want = tokens[array[mid][:, None] + step], sought[open_]
        differ = (here != want) & used[open_]
        first = differ.argmax(1)
        rows = np.arange(len(open_))
        right = np.where(differ[rows, first], here[rows, first] < want[rows, first], after)
        low[open_[right]] = mid[right] + 1
        high[open_[~right]] = mid[~right]
    return low


def search(tokens: np.ndarray, probe: Probe) -> tuple[np.ndarray, np.ndarray]:
    """All (place in ``tokens``, distinct window of the probe) at which it occurs verbatim, by place."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(probe.tokens):
        return nothing
    padded = np.concatenate([tokens, np.zeros(max(probe.longest, probe.tokens.shape[1]) + 1, tokens.dtype)])
    known = padded != 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
    opened, closed = edge[::2], edge[1::2]
    runs = closed - opened >= probe.width.min()
    mark = np.zeros(len(padded) + 1, np.int64)
    np.add.at(mark, opened[runs], 1)
    np.add.at(mark, closed[runs], -1)
    array = suffix_array(padded, np.flatnonzero(mark.cumsum()), probe.longest)
    if not len(array):
        return nothing
    places, windows = [], []
    for at in range(0, len(probe.tokens), SOUGHT):
        sought, width = probe.tokens[at : at + SOUGHT], probe.width[at : at + SOUGHT]
        low = bounds(padded, array, sought, width, False)
        size = bounds(padded, array, sought, width, True) - low
        places.append(array[_ranges(low, size)])
        windows.append(at + np.repeat(np.arange(len(size)), size))
    place, window = np.concatenate(places), np.concatenate(windows)
    order = np.argsort(place, kind="stable")
    return place[order], window[order]


def longest_matches(place: np.ndarray, window: np.ndarray, probe: Probe) -> tuple[np.ndarray, np.ndarray]:
    """(start, words) of each maximal chain of windows at consecutive places of document and item."""
    if not len(place):
        return place, window
    suffix, size = probe.suffixes(window)
    place, width = np.repeat(place, size), np.repeat(probe.width[window], size)
    # Suffixes of one item are numbered in a row, so a verbatim match keeps place - suffix and the item.
    order = np.lexsort((place, probe.item[suffix], place - suffix))
    p, s, width = place[order], suffix[order], width[order]
    new = np.concatenate([[True], (np.diff(p) != 1) | (np.diff(s) != 1) | (np.diff(probe.item[s]) != 0)])
    starts = np.flatnonzero(new)
    return p[starts], np.diff(np.concatenate([starts, [len(p)]])) + width[starts] - 1


def _merge(spans: np.ndarray) -> np.ndarray:
    """Maximal intervals of sorted or unsorted (start, end) rows."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(spans) - 1]])
    return np.stack([spans[new, 0], ends[last]], axis=1)


_STATE = ("n_words", "n_hit", "hit_spans", "items", "longest_match", "longest_at")


def _searched(batch: pa.RecordBatch, probe: Probe) -> list[list]:
    """The columns of ``_STATE`` with this probe's findings added."""
    texts = [words(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
    first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    tokens = np.zeros(first[-1], np.int32)
    get = probe.vocabulary.get
    for start, text in zip(first, texts):
        tokens[start : start + len(text)] = np.fromiter(map(get, text, repeat(0)), np.int32, len(text))
    place, window = search(tokens, probe)
    owner = np.searchsorted(first, place, side="right") - 1
    cuts = np.flatnonzero(np.diff(owner)) + 1
    heads = np.concatenate([[0], cuts]).astype(np.int64) if len(owner) else cuts
    best: dict[int, tuple[int, int]] = {}
    listed = np.cumsum(probe.first[window + 1] - probe.first[window])
    # Documents whose pairs are listed together: as many as PAIRS allows, one at least.
    group = listed[np.concatenate([heads[1:] - 1, [len(owner) - 1]])] // PAIRS if len(owner) else heads
    turns = [heads[0], *heads[1:][np.diff(group) != 0], len(owner)] if len(owner) else []
    for a, b in zip(turns[:-1], turns[1:]):
        at, length = longest_matches(place[a:b], window[a:b], probe)
        for doc, start, size in zip((np.searchsorted(first, at, side="right") - 1).tolist(), at.tolist(), length.tolist()):
            best[doc] = max(best.get(doc, (0, 0)), (size, int(first[doc]) - start))  # of equals the earliest
    found: dict[int, tuple[np.ndarray, list[str]]] = {}
    for a, b in zip(heads.tolist(), [*cuts.tolist(), len(owner)]):
        doc = int(owner[a])
        spans = np.stack([place[a:b], place[a:b] + probe.width[window[a:b]]], axis=1) - first[doc]
        found[doc] = _merge(spans), [probe.ids[i] for i in np.unique(probe.item[probe.suffixes(np.unique(window[a:b]))[0]])]
    out: list[list] = [[] for _ in range(6)]
    old_spans, old_items, old_long, old_at = (batch.column(c).to_pylist() for c in ("hit_spans", "items", "longest_match", "longest_at"))
    for i, text in enumerate(texts):
        spans, items = _merge(np.frombuffer(old_spans[i], "<i8").reshape(-1, 2)), set(old_items[i])
        if i in found:
            spans, items = _merge(np.concatenate([spans, found[i][0]])), items | set(found[i][1])
        size, back = max(best.get(i, (0, 0)), (old_long[i], -old_at[i]))
        row = (len(text), int((spans[:, 1] - spans[:, 0]).sum()), spans.astype("<i8").tobytes(), sorted(items), size, -back)
        for column, value in zip(out, row):
            column.append(value)
    return out


def _slices_of(benchmark: DataFrame) -> list[DataFrame]:
    """The items, in slices of at most about ``SLICE`` bytes; one empty slice if there is none."""
    items = (
        benchmark.where("item_id is not null and text is not null")
        .select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("binary").alias("text"))
        .distinct()
    )
    count = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SLICE) or 1
    if count == 1:
        return [items]
    items = materialize(items, "benchmark")
    return [items.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == i) for i in range(count)]


def _text_key() -> Column:
    return F.md5(F.col("text").cast("binary"))


def _passed(state: DataFrame, sent: Broadcast, out: list[str], window: int, hits_only: bool) -> DataFrame:
    """One slice searched in every row of ``state``; columns ``out`` and those of ``_STATE``."""
    types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.int64(), pa.int64()]

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = probe(sent.value, window)
        for batch in slices(batches, "text", SHARD):
            columns = [pa.array(c, t) for c, t in zip(_searched(batch, sought), types)]
            done = pa.RecordBatch.from_arrays([*(batch.column(c) for c in out), *columns], [*out, *_STATE])
            yield done.filter(pc.greater(done.column("n_hit"), 0)) if hits_only else done

    return state.mapInArrow(passed, state.select(*out, *_STATE).schema)


def _no_findings() -> dict[str, Column]:
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    return dict(zip(_STATE, (zero, zero, F.lit(b""), none, zero, zero)))


def _with_state(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and empty findings."""
    return rows.select(*columns, *(empty.alias(c) for c, empty in _no_findings().items()))


def _earlier(documents: DataFrame, parts: list[DataFrame], window: int) -> DataFrame:
    """Findings of these slices together, one row of each text (by ``_text_key``) that holds any."""
    found = []
    for part in parts:
        sent = documents.sparkSession.sparkContext.broadcast([(r["id"], bytes(r["text"])) for r in part.collect()])
        rows = _with_state(documents.select(_text_key().alias("__text"), "text"), ["__text", "text"])
        found.append(materialize(_passed(rows, sent, ["__text"], window, True), "found"))
        sent.destroy()  # what it found is written
    best = F.max(F.struct("longest_match", (-F.col("longest_at")).alias("back")))
    spans = F.aggregate(F.collect_set("hit_spans"), F.lit(b""), lambda a, b: F.concat(a, b))
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy("__text")
        .agg(spans.alias("hit_spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"), best.alias("best"))
        .select("__text", "hit_spans", "items", F.col("best.longest_match").alias("longest_match"), (-F.col("best.back")).alias("longest_at"))
    )


def find_overlaps(documents: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW) -> DataFrame:
    """Columns ``keep`` of every document, then n_words, n_hit (words inside occurring windows), hit_spans
    (their maximal intervals, pairs of little-endian 64-bit numbers), items (ids with occurring windows,
    sorted), longest_match (words of the longest verbatim match) and longest_at (its first word)."""
    needed = [*keep, *(["text"] if "text" not in keep else [])]
    *others, last = _slices_of(benchmark)
    state = _with_state(documents, needed)
    if others:
        known = _earlier(documents, others, window)
        joined = documents.select(*needed, _text_key().alias("__text")).join(known, "__text", "left")
        state = joined.select(*needed, *(F.coalesce(F.col(c), empty).alias(c) if c in known.columns else empty.alias(c) for c, empty in _no_findings().items()))
    sent = documents.sparkSession.sparkContext.broadcast([(r["id"], bytes(r["text"])) for r in last.collect()])
    return _passed(state, sent, keep, window, False)


def _contaminated():
    return (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    return find_overlaps(documents, benchmark, ["doc_id"]).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        _contaminated().alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that are not contaminated, with their own columns."""
    packed = documents.select(F.struct(*(c for c in documents.columns if c != "text")).alias("__row"), "text")
    kept = find_overlaps(packed, benchmark, ["__row", "text"]).where(~_contaminated())
    return kept.select(*(F.col("text") if c == "text" else F.col("__row")[c].alias(c) for c in documents.columns))
