"""Repeated passages: Rabin-Karp hashes of every window of words, counted over the corpus.

1. Each task hashes the words of a block of documents (polynomials over 64-bit numbers, in numpy) and rolls
   a second polynomial over ``window`` words. Windows repeated inside the block are settled at once; of each
   hash one entry leaves the block, so a very common window sends one entry a block, whatever its count.
2. Entries go to buckets of the hash range, packed: seven bytes of hash (the bucket implies the eighth), two
   bytes of a second polynomial, and the gap to the bucket's previous window of the block. Buckets follow the size of the corpus. A bucket
   counts its hashes and answers each block with the windows that also start elsewhere. Where a corpus needs more
   than ``FIRST`` buckets, a block would send each but a few windows: entries then go to ``FIRST`` ranges first, are
   regrouped there over many blocks into rows for the final buckets, and answers come back the same way, so packed
   rows stay long at any size.
3. A block turns the answers into maximal intervals per document, which meet the texts again by row key.

Two different windows pass for equal with probability 2**-80 a pair: 0.0001 expected for 10**10 windows.

* NULL, empty or short text (fewer words than a window): nothing is removed.
* Equal texts and repeated rows: every window starts elsewhere too, so all copies lose the same words.
* Very long texts are hashed in pieces of bounded size. An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import materialize, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 35
#: Bytes of text in a block, and in one piece of hashing.
BLOCK = 8 << 20
PIECE = 1 << 20
#: Windows in a bucket, about; buckets come in multiples of 256, so that a bucket implies the highest byte.
BUCKET = 4_000_000
#: Buckets a block deals its windows to itself (a multiple of 256), and windows regrouped at once beyond that.
FIRST, REGROUPED = 4096, 8_000_000
_BYTE_BASE, _WORD_BASE, _SECOND_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA0761D6478BD642F  # odd, so they have inverses
_ENTRY = 9  # bytes: seven of the hash, two of the second
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_REPEATED, _SINGLE, _LOCAL, _ROWS = range(4)  # kinds of packed rows
_PACKED = "bucket int, block long, kind int, hashes binary, gaps binary, keys array<string>, runs binary"
_ANSWERS = "bucket int, block long, kind int, gaps binary, keys array<string>, runs binary"
_TYPES = {"bucket": pa.int32(), "block": pa.int64(), "kind": pa.int32(), "hashes": pa.binary(), "gaps": pa.binary(), "keys": pa.list_(pa.string()), "runs": pa.binary()}
_ENTRY_ROW = ("bucket", "block", "kind", "hashes", "gaps", "keys", "runs")
_ANSWER_ROW = ("bucket", "block", "kind", "gaps", "keys", "runs")


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i below ``count``."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        series = np.full(count, b, np.uint64)
        series[:1] = 1
        out.append(np.cumprod(series, dtype=np.uint64))
    return out[0], out[1]


class Hasher:
    """Word and window hashes of concatenated texts."""

    def __init__(self, window: int):
        self.window = window
        self.bytes = powers(_BYTE_BASE, PIECE + 1)
        self.words = [powers(base, PIECE + window + 1) for base in (_WORD_BASE, _SECOND_BASE)]

    def words_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First bytes and hashes of the words."""
        blank = np.concatenate([[True], _SPACE[codes], [True]])
        starts, ends = np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])
        hashes = np.zeros(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            upto = max(int(np.searchsorted(ends, starts[at] + PIECE, side="right")), at + 1)
            first, last = starts[at], ends[upto - 1]
            up, down = self.bytes if last - first <= PIECE else powers(_BYTE_BASE, last - first + 1)
            terms = np.cumsum((codes[first:last].astype(np.uint64) + np.uint64(1)) * up[: last - first], dtype=np.uint64)
            sums = np.concatenate([np.zeros(1, np.uint64), terms])
            s, e = starts[at:upto] - first, ends[at:upto] - first
            hashes[at:upto] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
            at = upto
        return starts, hashes

    def windows_of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash, and second hash of 16 bits, of the window that starts at each word, as far as one fits."""
        count, out = len(hashes) - self.window + 1, ([np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)])
        for at in range(0, max(count, 0), PIECE):
            part = hashes[at : min(at + PIECE + self.window - 1, len(hashes))]
            n = len(part) - self.window + 1
            for (up, down), kept in zip(self.words, out):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[: len(part)], dtype=np.uint64)])
                kept.append(mixed((sums[self.window :] - sums[:n]) * down[:n]).astype(kept[0].dtype))
        return np.concatenate(out[0]), np.concatenate(out[1])


def pack_places(places: np.ndarray, starts: np.ndarray | None = None) -> bytes:
    """Ascending numbers (ascending anew from each of ``starts``) as gaps, two bytes each (four if a gap needs it),
    byte by byte, compressed."""
    gaps = np.diff(places, prepend=0)
    if starts is not None:
        gaps[starts] = places[starts]
    wide = bool(len(gaps) and gaps.max() >= 1 << 16)
    planes = gaps.astype("<u4" if wide else "<u2").view(np.uint8).reshape(len(gaps), 4 if wide else 2).T
    return bytes([wide]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_places(data: bytes, starts: np.ndarray | None = None) -> np.ndarray:
    width = 4 if data[0] else 2
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(width, -1)
    gaps = np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)
    places = np.cumsum(gaps)
    if starts is not None and len(places):
        places -= np.repeat(places[starts] - gaps[starts], np.diff(np.append(starts, len(places))))
    return places


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = zip(*rows) if rows else ((),) * len(names)
    return pa.table({n: pa.array(c, _TYPES[n]) for n, c in zip(names, columns)})


def _runs(owner: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Where the windows of the next block begin, and (block, windows) of each run."""
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    pairs = np.stack([blocks[owner[starts]], np.diff(np.append(starts, len(owner)))], axis=1)
    return starts, pairs.astype("<i8").tobytes()


def _read_runs(runs: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of the runs, their numbers of windows, and where they start."""
    blocks, counts = np.frombuffer(runs, "<i8").reshape(-1, 2).T
    return blocks, counts, np.cumsum(counts) - counts


def _values(entries: np.ndarray, top: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, of highest byte ``top``, and second hashes of packed entries."""
    wide = np.full((len(entries), 8), top, np.uint8)
    wide[:, :7] = entries[:, :7]
    return wide.view("<u8").ravel(), np.ascontiguousarray(entries[:, 7:]).view("<u2").ravel()


def _buckets_of(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((values >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _dealt_on(rows: list[dict], coarse: int, first: int, fine: int) -> Iterator[tuple]:
    """Rows of one first bucket, of many blocks, as rows of its final buckets."""
    for kind in (_REPEATED, _SINGLE):
        held = [r for r in rows if r["kind"] == kind]
        if not held:
            continue
        entries = np.frombuffer(b"".join(r["hashes"] for r in held), np.uint8).reshape(-1, _ENTRY)
        blocks = np.array([r["block"] for r in held])
        owner = np.repeat(np.arange(len(held)), [len(r["hashes"]) // _ENTRY for r in held])
        places = np.concatenate([unpack_places(r["gaps"]) for r in held]) if kind == _SINGLE else None
        bucket = _buckets_of(_values(entries, coarse * 256 // first)[0], first * fine)
        by = np.argsort(bucket, kind="stable")
        for chosen in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
            starts, runs = _runs(owner[chosen], blocks)
            gaps = b"" if places is None else pack_places(places[chosen], starts)
            yield int(bucket[chosen[0]]), int(blocks[owner[chosen[0]]]), kind, entries[chosen].tobytes(), gaps, None, runs


def _brought_back(rows: list[dict]) -> Iterator[tuple]:
    """Answers of many final buckets to many blocks, as one row a block."""
    blocks, places = [], []
    for r in rows:
        of, counts, starts = _read_runs(r["runs"])
        blocks.append(np.repeat(of, counts))
        places.append(unpack_places(r["gaps"], starts))
    block, place = np.concatenate(blocks), np.concatenate(places)
    order = np.lexsort((place, block))
    for chosen in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
        yield 0, int(block[chosen[0]]), _SINGLE, pack_places(place[chosen]), None, None


def _regrouped(frame: DataFrame, group: list[Column], size, regroup, names: tuple[str, ...], schema: str) -> DataFrame:
    """Rows that ``size`` gives a number of windows, brought together by ``group`` and handed to ``regroup``, about
    ``REGROUPED`` windows at a time; the others pass."""
    most = REGROUPED

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, windows = [], None, 0
        for batch in batches:
            passing = []
            for row in batch.to_pylist():
                n, at = size(row), row.pop("__group")
                if not n:
                    passing.append(tuple(row[c] for c in names))
                    continue
                if held and (at != key or windows >= most):
                    yield from _table(list(regroup(held)), names).to_batches()
                    held, windows = [], 0
                held.append(row)
                key, windows = at, windows + n
            yield from _table(passing, names).to_batches()
        if held:
            yield from _table(list(regroup(held)), names).to_batches()

    grouped = frame.withColumn("__group", F.concat_ws(":", *group)).repartition("__group").sortWithinPartitions("__group")
    return grouped.mapInArrow(step, schema)


def _equal_to_next(hashes: np.ndarray, seconds: np.ndarray) -> np.ndarray:
    return (hashes[1:] == hashes[:-1]) & (seconds[1:] == seconds[:-1])


def _block_rows(texts: list[bytes], keys: list[str], buckets: int, hasher: Hasher) -> Iterator[tuple]:
    """Packed rows of one block: entries by bucket, windows settled here, and the rows it holds."""
    block = xxhash.xxh64_intdigest("\n".join(keys)) >> 1
    codes = np.frombuffer(b"\n".join(texts), np.uint8)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts, words = hasher.words_of(codes)
    first = np.searchsorted(starts, offsets)
    hashes, seconds = hasher.windows_of(words)
    owner_end = np.repeat(first[1:], np.diff(first))[: len(hashes)]
    places = np.flatnonzero(np.arange(len(hashes)) + hasher.window <= owner_end)
    hashes, seconds = hashes[places], seconds[places]
    if not len(places):
        return
    order = np.lexsort((seconds, hashes))
    new = np.concatenate([[True], ~_equal_to_next(hashes[order], seconds[order])])
    counts = np.diff(np.concatenate([np.flatnonzero(new), [len(order)]]))
    alone = np.repeat(counts == 1, counts)
    home = block % buckets
    yield home, block, _ROWS, b"", pack_places(first), keys, None
    if not alone.all():
        yield home, block, _LOCAL, b"", pack_places(np.sort(places[order[~alone]])), None, None
    for kind, chosen in ((_SINGLE, order[alone]), (_REPEATED, order[new & ~alone])):
        chosen = np.sort(chosen)  # by place
        values = hashes[chosen]
        bucket = _buckets_of(values, buckets)
        by = np.argsort(bucket, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[by])) + 1, [len(by)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            rows = by[a:b]
            if len(rows):
                entries = np.zeros((len(rows), _ENTRY), np.uint8)
                entries[:, :7] = values[rows].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]
                entries[:, 7:] = seconds[chosen[rows]].astype("<u2").view(np.uint8).reshape(-1, 2)
                yield int(bucket[rows[0]]), block, kind, entries.tobytes(), pack_places(places[chosen[rows]]) if kind == _SINGLE else b"", None, None


def _answers(table: pa.Table, fine: int = 1) -> pa.Table:
    """For one bucket: (block, places) of single windows that also start elsewhere; other rows pass."""
    columns = {c: table.column(c).to_pylist() for c in ("bucket", "block", "kind", "hashes", "gaps", "keys", "runs")}
    out: list[tuple] = [r for r in zip(*(columns[c] for c in _ANSWER_ROW)) if r[2] in (_LOCAL, _ROWS)]
    held = [i for i, k in enumerate(columns["kind"]) if k in (_SINGLE, _REPEATED)]
    if held:
        sizes = np.array([len(columns["hashes"][i]) // _ENTRY for i in held])
        values, seconds = _values(np.frombuffer(b"".join(columns["hashes"][i] for i in held), np.uint8).reshape(-1, _ENTRY))
        order = np.lexsort((seconds, values))
        same = _equal_to_next(values[order], seconds[order])
        elsewhere = np.zeros(len(values), bool)
        elsewhere[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        ends = np.cumsum(sizes)
        for i, a, b in zip(held, (ends - sizes).tolist(), ends.tolist()):
            if columns["kind"][i] != _SINGLE or not elsewhere[a:b].any():
                continue
            gaps, runs, found = columns["gaps"][i], columns["runs"][i], elsewhere[a:b]
            if runs is None:
                out.append((0, columns["block"][i], _SINGLE, pack_places(unpack_places(gaps)[found]), None, None))
            else:
                blocks, counts, starts = _read_runs(runs)
                at, kept = _runs(np.repeat(np.arange(len(blocks)), counts)[found], blocks)
                out.append((columns["bucket"][i] // fine, columns["block"][i], _SINGLE, pack_places(unpack_places(gaps, starts)[found], at), None, kept))
    return _table(out, _ANSWER_ROW)


def _intervals(table: pa.Table, window: int) -> pa.Table:
    """For one block: row key and the maximal intervals of words to remove, as pairs of 64-bit numbers."""
    rows = list(zip(table.column("kind").to_pylist(), table.column("gaps").to_pylist(), table.column("keys").to_pylist()))
    keys, spans = [], []
    places = np.unique(np.concatenate([np.zeros(0, np.int64), *(unpack_places(g) for k, g, _ in rows if k != _ROWS)]))
    held = next(((unpack_places(g), names) for k, g, names in rows if k == _ROWS), None)
    if held is not None and len(places):
        first, names = held
        owner = np.searchsorted(first, places, side="right") - 1
        new = np.concatenate([[True], (np.diff(places) > window) | (np.diff(owner) != 0)])
        heads = np.flatnonzero(new)
        tails = np.concatenate([heads[1:] - 1, [len(places) - 1]])
        pairs = np.stack([places[heads], places[tails] + window], axis=1) - first[owner[heads]][:, None]
        cuts = np.flatnonzero(np.diff(owner[heads])) + 1
        for docs, part in zip(np.split(owner[heads], cuts), np.split(pairs, cuts)):
            keys.append(names[docs[0]])
            spans.append(part.astype("<i8").tobytes())
    return pa.table({"key": pa.array(keys, pa.string()), "removed": pa.array(spans, pa.binary())})


def _key() -> Column:
    """Rows of one key are equal in id and text, so they have one result."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.hex(F.xxhash64("text")))


def repeated_intervals(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, removed): intervals of words covered by windows that start more than once."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 256 * max(1, -(-size // (6 * 256 * BUCKET)))
    first, fine = (buckets, 1) if buckets <= FIRST else (FIRST, -(-buckets // FIRST))
    salts = max(1, -(-size // (6 * first * REGROUPED)))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(window)
        for batch in slices(batches, "text", BLOCK):
            rows = list(_block_rows([t or b"" for t in batch.column("text").to_pylist()], batch.column("key").to_pylist(), first, hasher))
            if rows:
                yield from _table(rows, _ENTRY_ROW).to_batches()

    entries = documents.select(_key().alias("key"), F.col("text").cast("binary").alias("text")).mapInArrow(packed, _PACKED)
    salt = F.pmod(F.col("block"), F.lit(salts))  # of rows of several blocks, any one: all have the same
    if fine > 1:
        # the first buckets' rows, then the final buckets', so that several blocks share a row
        def deal(rows: list[dict]) -> Iterator[tuple]:
            return _dealt_on(rows, rows[0]["bucket"], first, fine)

        entries = _regrouped(
            entries.withColumn("bucket", F.when(F.col("kind").isin(_ROWS, _LOCAL), F.col("bucket") * fine).otherwise(F.col("bucket"))),
            [F.col("kind").isin(_ROWS, _LOCAL).cast("string"), F.col("bucket").cast("string"), salt.cast("string")],
            lambda r: len(r["hashes"]) // _ENTRY, deal, _ENTRY_ROW, _PACKED,
        )
    answers = entries.groupBy("bucket").applyInArrow(lambda t: _answers(t, fine), _ANSWERS)
    if fine > 1:
        answers = _regrouped(
            answers,
            [F.col("runs").isNull().cast("string"), F.col("bucket").cast("string"), salt.cast("string")],
            lambda r: len(r["runs"]) // 16 if r["runs"] else 0, _brought_back, _ANSWER_ROW, _ANSWERS,
        )
    found = answers.groupBy("block").applyInArrow(lambda t: _intervals(t, window), "key string, removed binary")
    return found.groupBy("key").agg(F.first("removed").alias("removed"))


def without_repeats(documents: DataFrame, keep: list[str], window: int = WINDOW) -> DataFrame:
    """Columns ``keep`` of every document, n_words, n_removed, kept (words left, joined by one space) and
    removed (the intervals, pairs of little-endian 64-bit numbers; NULL where nothing is removed)."""
    intervals = materialize(repeated_intervals(documents, window), "intervals")
    joined = documents.withColumn("__key", _key()).join(intervals.withColumnRenamed("key", "__key").hint("shuffle_hash"), "__key", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, gone, kept = [], [], []
            for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("removed").to_pylist()):
                words, at, left = (text or b"").split(), 0, []
                for a, b in np.frombuffer(spans or b"", "<i8").reshape(-1, 2).tolist():
                    left += words[at:a]
                    at = b
                left += words[at:]
                sizes.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left))
            new = [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), batch.column("removed")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *new], [*keep, "n_words", "n_removed", "kept", "removed"])

    zero = F.lit(0).cast("long")
    schema = documents.select(*keep, zero.alias("n_words"), zero.alias("n_removed"), F.lit("").alias("kept"), F.lit(None).cast("binary").alias("removed")).schema
    return joined.select(*keep, "text", "removed").mapInArrow(cut, schema)


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256."""
    cut = without_repeats(documents.select("doc_id", "text"), ["doc_id"])
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
