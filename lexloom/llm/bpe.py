"""Byte-pair encoding and decoding with a given vocabulary of word pieces.

A text is cut at white space and at the special tokens; each piece is brought to its normal form (NFC,
lower case), split into words, and a word's byte symbols are merged: the parts and the ranks of adjacent
parts lie in one row each, the smallest rank is looked for, its boundary goes, and the two ranks beside
it are refreshed. The rows of many words are worked on side by side. Words over ``SHORT`` symbols take the
same merges in the same order from a heap.
Nothing is trained and nothing shuffled; the vocabulary file is read by the driver and sent to the tasks.

* NULL and empty text: no ids, decoded to an empty text.
* Equal texts get equal ids; repeated rows stay. An empty table gives an empty result.
* Very long texts and words are encoded whole; the memory of pieces seen is bounded.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHORT = 48
#: Pieces whose ids a task remembers.
REMEMBERED = 150_000
#: Pieces looked up, and bytes of text taken, at once.
AT_ONCE, SLICE = 200_000, 2 << 20
_BITS, _MASK, _NONE = 24, (1 << 24) - 1, 1 << 60
# White space of Unicode, without the four separators 1C to 1F that Python counts as such.
_WHITE = r"\t-\r\x20\x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_ODD = re.compile(r"[\x1c-\x1f]")
_GAPS = re.compile(rf"[{_WHITE}]+")
_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_WHITE}\p{{L}}\p{{N}}]+"
_END = "</w>"
#: The settings of a tokenizer file that this module follows; any other would give other ids.
_SETTINGS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "decoder": None,
}
_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": _END, "byte_fallback": False, "ignore_merges": False}


def byte_symbols() -> list[str]:
    """A visible character for each byte: itself where it is one, else the next from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Ids, merges and special tokens of a tokenizer file."""

    def __init__(self, spec: dict):
        self.ids: dict[str, int] = dict(spec["model"]["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        #: left id, right id -> rank, id of both together; two numbers in one, so that the smallest has the least rank
        self.merges = {self.ids[a] << _BITS | self.ids[b]: rank << _BITS | self.ids[a + b] for rank, (a, b) in enumerate(spec["model"]["merges"])}
        self.names = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        symbols = byte_symbols()
        self.inner = [self.ids.get(s) for s in symbols]
        self.final = [self.ids.get(s + _END) for s in symbols]


class Ranks:
    """Rank and result of any pair of parts, for whole arrays of pairs."""

    def __init__(self, merges: dict[int, int]):
        self.pairs = np.array(sorted(merges), np.int64)
        self.made = np.append(np.array([merges[p] for p in self.pairs.tolist()], np.int64), _NONE)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.full(left.shape, _NONE)
        pair = left << _BITS | right
        at = np.searchsorted(self.pairs, pair)
        found = (left >= 0) & (right >= 0) & (self.pairs[np.minimum(at, len(self.pairs) - 1)] == pair)
        return self.made[np.where(found, at, len(self.pairs))]


def merge_short(parts: np.ndarray, ranks: Ranks) -> np.ndarray:
    """Merge the parts of many words, one word a row, -1 behind its last part and in the last column.

    Beside the parts lie the ranks of adjacent parts. In every round each word loses the boundary with the
    smallest rank, the leftmost of equals: what follows moves up, and the ranks on both sides of the new
    part are looked up again. A word without any rank left is done.
    """
    width = parts.shape[1] - 1
    near = np.concatenate([ranks.of(parts[:, :-1], parts[:, 1:]), np.full((len(parts), 1), _NONE)], axis=1)
    done, live, columns = parts.copy(), np.arange(len(parts)), np.arange(width + 1)
    while len(live):
        i = near.argmin(1)
        least = near[np.arange(len(live)), i]
        ended = least == _NONE
        if ended.any():
            done[live[ended]] = parts[ended]
            live, parts, near, i, least = (x[~ended] for x in (live, parts, near, i, least))
        rows = np.arange(len(live))
        parts[rows, i] = least & _MASK
        parts = np.take_along_axis(parts, np.minimum(columns + (columns > i[:, None]), width), axis=1)
        near = np.take_along_axis(near, np.minimum(columns + (columns >= i[:, None]), width), axis=1)
        before = np.maximum(i - 1, 0)
        near[rows, i] = ranks.of(parts[rows, i], parts[rows, np.minimum(i + 1, width)])
        near[rows, before] = np.where(i > 0, ranks.of(parts[rows, before], parts[rows, i]), near[rows, before])
    return done


def merge_long(parts: list[int], merges: dict[int, int]) -> list[int]:
    """The same merges from a heap of (rank, place); outdated entries are passed over."""
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(merges[p], i, p) for i, p in enumerate(a << _BITS | b for a, b in zip(parts, parts[1:])) if p in merges]
    heapq.heapify(heap)
    alive = [True] * len(parts)
    while heap:
        made, i, pair = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= len(parts) or parts[i] << _BITS | parts[j] != pair:
            continue
        parts[i], alive[j], after[i] = made & _MASK, False, after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        for left in (before[i], i):
            if left >= 0 and after[left] < len(parts) and (p := parts[left] << _BITS | parts[after[left]]) in merges:
                heapq.heappush(heap, (merges[p], left, p))
    return [p for p, kept in zip(parts, alive) if kept]


def load(path: str) -> dict:
    """The parsed file: plain data, which any task can unpack. A file of other settings is refused (ValueError)."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec.get("model", {})
    other = [name for name, value in _SETTINGS.items() if spec.get(name) != value]
    other += [f"model.{name}" for name, value in _MODEL.items() if (model.get(name) or None) != (value or None)]
    if any(t.get(flag) for t in spec.get("added_tokens", []) for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        other.append("added_tokens")
    if other:
        raise ValueError(f"{path}: settings this encoder does not follow: {', '.join(other)}")
    return spec


class Encoder:
    """Encodes texts and remembers the ids of pieces (text without white space); forgets all when full."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.ranks = vocabulary, Ranks(vocabulary.merges)
        self.inner, self.final = (np.array([-1 if i is None else i for i in t], np.int64) for t in (vocabulary.inner, vocabulary.final))
        self.pieces: dict[str, bytes] = {}  # ids as packed 32-bit numbers
        self.cut = regex.compile(_WORDS + r"|\n").findall
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each whole text; texts are looked up together, about ``AT_ONCE`` pieces at a time."""
        cut = [_GAPS.split(t) if t and _ODD.search(t) else (t or "").split() for t in texts]
        out: list[bytes] = []
        while len(out) < len(cut):
            upto, held = len(out), 0
            while upto < len(cut) and (held == 0 or held + len(cut[upto]) <= AT_ONCE):
                held += len(cut[upto])
                upto += 1
            if held <= AT_ONCE:
                self._learn({p for pieces in cut[len(out) : upto] for p in pieces})
                out += [b"".join(map(self.pieces.__getitem__, pieces)) for pieces in cut[len(out) : upto]]
            else:  # one text of more pieces than that
                out += [b"".join(self._in_order(pieces)) for pieces in cut[len(out) : upto]]
        return out

    def _in_order(self, pieces: list[str]) -> Iterator[bytes]:
        for at in range(0, len(pieces), AT_ONCE):
            part = pieces[at : at + AT_ONCE]
            self._learn(set(part))
            yield b"".join(map(self.pieces.__getitem__, part))

    def _learn(self, needed: set[str]) -> None:
        """Make the ids of all needed pieces known."""
        new = needed - self.pieces.keys()
        if len(self.pieces) + len(new) > REMEMBERED:
            self.pieces.clear()
            new = needed
        mixed = [p for p in new if "<" in p and self.special and self.special.search(p)]
        plain = list(new.difference(mixed))
        self.pieces.update(zip(plain, self._encoded(plain)))
        for piece in mixed:
            around = self.special.split(piece)
            texts = self._encoded(around[::2])
            marks = [array("i", [self.vocabulary.special[t]]).tobytes() for t in around[1::2]]
            self.pieces[piece] = b"".join(t + m for t, m in zip(texts, [*marks, b""]))

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces without special tokens: all pieces as one text, its distinct words merged together."""
        if not pieces:
            return []
        text = "\n".join(pieces)
        found = self.cut(text.lower() if text.isascii() else lowered(unicodedata.normalize("NFC", text)))
        index = {w: i for i, w in enumerate(dict.fromkeys(found))}
        end = index.get("\n", -1)
        ids, starts, counts = self._merged(list(index))
        words = np.fromiter(map(index.__getitem__, found), np.int64, len(found))
        size = np.where(words == end, 0, counts[words]) if len(words) else words
        upto = np.concatenate([[0], np.cumsum(size)])
        packed = ids[np.repeat(starts[words] - upto[:-1], size) + np.arange(upto[-1])].astype("<i4").tobytes()
        cuts = [0, *(4 * upto[np.flatnonzero(words == end)]).tolist(), len(packed)]
        return [packed[a:b] for a, b in zip(cuts, cuts[1:])]

    def _merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and where in them each word begins and how many it has."""
        codes = np.frombuffer(("\n".join(w if w != "\n" else "" for w in words) + "\n").encode("utf-8", "surrogatepass"), np.uint8)
        breaks = codes == 10
        last = np.concatenate([breaks[1:], [False]])
        parts = np.where(last, self.final[codes], self.inner[codes])
        owner = np.cumsum(breaks) - breaks
        kept = ~breaks & (parts >= 0)
        parts, owner = parts[kept], owner[kept]
        size = np.bincount(owner, minlength=len(words))
        first = np.cumsum(size) - size
        out, counts = [], np.zeros(len(words), np.int64)
        by_size = np.argsort(size, kind="stable")
        short = by_size[: int((size <= SHORT).sum())]
        for rows in (short[at : at + 8192] for at in range(0, len(short), 8192)):
            width = int(size[rows].max()) + 1
            held = np.arange(width) < size[rows][:, None]
            matrix = np.full((len(rows), width), -1, np.int64)
            matrix[held] = parts[(first[rows][:, None] + np.arange(width))[held]]
            matrix = merge_short(matrix, self.ranks)
            out.append(matrix[matrix >= 0])
            counts[rows] = (matrix >= 0).sum(1)
        for w in by_size[len(short) :].tolist():
            out.append(np.array(merge_long(parts[first[w] : first[w] + size[w]].tolist(), self.vocabulary.merges), np.int64))
            counts[w] = len(out[-1])
        starts = np.zeros(len(words), np.int64)
        starts[by_size] = np.cumsum(counts[by_size]) - counts[by_size]
        return np.concatenate(out) if out else np.zeros(0, np.int64), starts, counts


def lowered(text: str) -> str:
    """Lower case of each character by itself: a final sigma is no special case."""
    return text.replace("Σ", "σ").lower()


def _ids(packed: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))


class Decoder:
    """Ids to text: the tokens, special ones too, joined by one space; unknown ids are left out.

    The vocabulary names no decoder, so the pieces keep their word ends.
    """

    def __init__(self, vocabulary: Vocabulary):
        names = vocabulary.names
        self.table = np.array([names.get(i) for i in range(max(names) + 2)], object)  # the last stands for unknown ids

    def decode(self, ids: np.ndarray) -> str:
        known = np.where((ids >= 0) & (ids < len(self.table)), ids, len(self.table) - 1).astype(np.int64)
        tokens = self.table[known].tolist()
        return " ".join(tokens if None not in tokens else [t for t in tokens if t is not None])


def encode(documents: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every document, and ``ids``: array<int> of its whole text."""
    sent = documents.sparkSession.sparkContext.broadcast(load(path))
    needed = [*keep, *(["text"] if "text" not in keep else [])]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(sent.value))
        for batch in slices(batches, "text", SLICE):
            ids = _ids(encoder.encode(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], [*keep, "ids"])

    schema = documents.select(*keep, F.array().cast("array<int>").alias("ids")).schema
    return documents.select(*needed).mapInArrow(encoded, schema)


def decode(encoded: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every row, and ``decoded``: the text of its ``ids`` (none for NULL)."""
    sent = encoded.sparkSession.sparkContext.broadcast(load(path))
    needed = [*keep, *(["ids"] if "ids" not in keep else [])]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Vocabulary(sent.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [decoder.decode(np.zeros(0, int) if i.values is None else i.values.to_numpy(zero_copy_only=False)) for i in part.column("ids")]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(texts, pa.string())], [*keep, "decoded"])

    schema = encoded.select(*keep, F.lit("").alias("decoded")).schema
    return encoded.select(*needed).mapInArrow(decoded, schema)


def round_trip(documents: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """Columns ``keep``, ``ids`` and ``decoded``: ``encode``, then ``decode`` of these ids, in one pass.

    One Python worker a task holds the vocabulary, not two.
    """
    sent = documents.sparkSession.sparkContext.broadcast(load(path))
    needed = [*keep, *(["text"] if "text" not in keep else [])]

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(sent.value)
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for batch in slices(batches, "text", SLICE):
            packed = encoder.encode(batch.column("text").to_pylist())
            texts = pa.array([decoder.decode(np.frombuffer(p, "<i4")) for p in packed], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), _ids(packed), texts], [*keep, "ids", "decoded"])

    schema = documents.select(*keep, F.array().cast("array<int>").alias("ids"), F.lit("").alias("decoded")).schema
    return documents.select(*needed).mapInArrow(both, schema)


def digests(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    both = round_trip(documents.select("doc_id", "text"), path, ["doc_id"])
    written = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(written.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def encoded_documents(documents: DataFrame, path: str) -> DataFrame:
    """Own columns without the text, then n_tokens, ids and decoded_sha256.

    Own columns named ids, decoded, n_tokens or decoded_sha256 give way to the results.
    """
    own = [c for c in documents.columns if c not in ("text", "ids", "decoded", "n_tokens", "decoded_sha256")]
    both = round_trip(documents, path, own)
    return both.select(*own, F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
