"""Quality of documents: boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled rows, one row an id, and applied to every whole text
inside the tasks; only the sample is shuffled. Scores depend on the text alone.

* NULL and empty text: statistics of an empty text, scored like any other.
* Equal texts get equal scores; repeated rows stay repeated. An empty table gives an empty result.
* Very long texts are read whole, one at a time.
* No usable label at all: every score is the prior, one half.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm import boosting
from lexloom.llm.common import held_out, labelled_sample, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled rows the trees are fitted on, at most (about).
FIT_ROWS = 12_000
#: From this score on a document counts as good.
ACCEPT = 0.3

FEATURES = (
    "log_bytes", "log_words", "bytes_per_word", "log_lines", "words_per_line", "upper_share", "lower_share",
    "digit_share", "space_share", "symbol_share", "wide_share", "mark_share", "bar_share", "bang_share",
    "distinct_words", "distinct_lines", "longest_word", "words_with_letters", "words_ending_in_symbol", "repeated_symbols",
)

_KIND = np.full(256, 4, np.uint8)  # 4: other symbols
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:], _KIND[[9, 10, 11, 12, 13, 32]] = 0, 1, 2, 5, 3
_SYMBOL = _KIND == 4


def statistics(text: bytes | None) -> list[float]:
    """One value per name of ``FEATURES``, from the UTF-8 bytes of a text."""
    data = text or b""
    codes = np.frombuffer(data, np.uint8)
    words, lines = data.split(), [line for line in data.split(b"\n") if line.strip()]
    n, w = max(len(data), 1), max(len(words), 1)
    kinds = np.bincount(_KIND[codes], minlength=6) / n
    ends = np.frombuffer(b"".join(x[-1:] for x in words), np.uint8)
    marks = sum(map(data.count, (b".", b",", b";", b":", b"?"))) / n
    symbol = _SYMBOL[codes]
    doubled = np.count_nonzero(symbol[1:] & (codes[1:] == codes[:-1])) / n if len(codes) > 1 else 0.0
    return [
        np.log1p(len(data)), np.log1p(len(words)), len(data) / w, np.log1p(len(lines)), len(words) / max(len(lines), 1),
        *kinds, marks, data.count(b"|") / n, data.count(b"!") / n, len(set(words)) / w,
        len(set(lines)) / max(len(lines), 1), max(map(len, words), default=0), sum(map(bytes.isalpha, words)) / w,
        np.count_nonzero(_SYMBOL[ends]) / w, doubled,
    ]


def _matrix(texts: list[bytes | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(len(texts), len(FEATURES))


def train(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> boosting.Forest:
    """Fit on about ``rows`` labelled rows; only their statistics reach the driver."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = _matrix(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column("label")], ["x", "label"])

    sample = labelled_sample(documents, labels, "quality", rows).withColumn("text", F.col("text").cast("binary"))
    got = sample.mapInArrow(measured, "x array<double>, label int").toPandas()
    x = np.stack(got["x"]) if len(got) else np.zeros((0, len(FEATURES)))
    order = np.lexsort(x.T) if len(x) else np.zeros(0, int)  # the same trees whatever order the rows came in
    return boosting.fit(x[order], got["label"].to_numpy(float)[order])


def score(documents: DataFrame, forest: boosting.Forest, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all, if not given) and ``quality_score``, between 0 and 1; replaces a column of that name."""
    kept = [c for c in keep or documents.columns if c != "quality_score"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = pa.array(forest.score(_matrix(batch.column("text").cast(pa.binary()).to_pylist())))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), values], [*kept, "quality_score"])

    schema = documents.select(*kept, F.lit(0.0).alias("quality_score")).schema
    return documents.select(*kept, *(["text"] if "text" not in kept else [])).mapInArrow(scored, schema)


def predictions(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= ``ACCEPT``) of every document."""
    marked = documents.select("doc_id", held_out().alias("held_out"), "text")
    scored = score(marked, train(documents, labels, rows), ["doc_id", "held_out"]).withColumnRenamed("quality_score", "score")
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def accepted(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """Documents whose quality is at least ``ACCEPT``, with their own columns."""
    scored = score(documents, train(documents, labels, rows))
    return scored.where(F.col("quality_score") >= ACCEPT).drop("quality_score")
