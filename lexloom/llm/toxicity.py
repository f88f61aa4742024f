"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text.

Folding lowers case, maps look-alike letters of other scripts (capitals by the look of the capital), accented,
full-width, circled, squared or styled forms, and digits or symbols standing for letters, to plain ones;
combining marks go, everything else that is no letter becomes one blank. ``l`` and ``i`` fold to one letter, because ``1`` may stand for either. The lexicon is folded too.

The lexicon holds words and word beginnings, learned from a bounded sample of labelled rows that are not
held out: those whose share of toxic texts is surely above the average (Chernoff bound over all terms
tried), weighted by the log odds. A word counts with its heaviest entry. Phrases of two words with a lexicon
word that are surely clean more often than not are exceptions: words inside them do not count.
A text's weight sum and its weight per word go through a logistic curve fitted on the same sample.

* NULL and empty text: no hits, scored like a text without hits.
* Equal texts get equal scores; repeated rows stay. An empty table gives an empty result.
* Very long texts are folded and matched whole, one at a time.
* No usable label, or one class only: an empty lexicon; every score is the prior.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import held_out, labelled_sample, materialize, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled rows the lexicon is learned from, at most (about).
FIT_ROWS = 12_000
#: Evidence needed besides the logarithm of the number of terms tried: error probability exp(-SURE).
SURE = 3.0
#: A beginning gives way to a longer entry that holds at least this share of its toxic texts.
WHOLE = 0.8
#: Lengths of the word beginnings tried.
STEMS = range(3, 9)

#: Small and capital look-alikes of other scripts, and the letters they look like.
HOMOGLYPHS = dict(zip("аеорсухівкмтѕјԁɡһ", "aeopcyxibkmtsjdgh")) | dict(zip("αορικνχτυ", "aopikvxtu")) | {"ı": "i"}
CAPITALS = dict(zip("АВЕЅІЈКМНОРСТУХ", "abesijkmhopctyx")) | dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "abezhikmnoptyx"))
#: Digits and symbols that stand for letters, and symbols that do so at the start of a word.
SUBSTITUTES = dict(zip("013456789", "oieasgtbg")) | {"@": "a", "$": "s", "!": "i", "|": "i"}
LEADING = "@$"
_BLANK = 32
_TOP = 0x20000  # the planes above hold ideographs, which stay, and then no letters
_IDEOGRAPHS = 0x40000


def _letter(char: str) -> str:
    """Plain form of a character; a blank where it is no letter, nothing for marks and format characters."""
    kind = unicodedata.category(char)
    if kind[0] == "M" or kind == "Cf":
        return ""
    plain = unicodedata.normalize("NFKD", char)
    # A base with its marks, or a styled form; other decompositions (syllables into their parts) are left alone.
    if len(plain) > 1 and not unicodedata.decomposition(char).startswith("<") and any(unicodedata.category(c)[0] != "M" for c in plain[1:]):
        plain = char
    letters = [c for c in plain if unicodedata.category(c)[0] == "L"]
    if not letters or (kind[0] != "L" and not unicodedata.decomposition(char).startswith("<")):
        return " "
    small = letters[0].lower()[0]
    base = CAPITALS.get(letters[0]) or HOMOGLYPHS.get(small, small)
    return "i" if base == "l" else base


_FOLD = np.array([ord(_letter(chr(c)) or "\0") for c in range(_TOP)] + [_BLANK], np.uint32)
_STANDS = np.zeros(_TOP + 1, np.uint32)
for _c, _to in SUBSTITUTES.items():
    _STANDS[ord(_c)] = ord(_to)
_LEADS = np.isin(np.arange(_TOP + 1), [ord(c) for c in LEADING])


def fold(text: str | None) -> str:
    """Folded words, each with one blank before and after it."""
    given = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.minimum(given, _TOP)
    letters = np.where((given >= _TOP) & (given < _IDEOGRAPHS), given, _FOLD[codes])
    codes, letters = codes[letters > 0], letters[letters > 0]
    if not len(letters):
        return " "
    # A digit stands for a letter beside one (or beside a digit that is), a symbol between two letters or digits;
    # some symbols also at the start of a word, before a letter.
    letter = np.concatenate([[False] * 2, letters != _BLANK, [False] * 2])
    digit = np.concatenate([[False] * 2, (codes >= 48) & (codes < 58), [False] * 2])
    beside = letter[1:-3] | letter[3:-1] | (digit[1:-3] & letter[:-4]) | (digit[3:-1] & letter[4:])
    solid = letter | digit
    between = solid[3:-1] & (solid[1:-3] | (_LEADS[codes] & letter[3:-1]))
    stands = (_STANDS[codes] > 0) & np.where(digit[2:-2], beside, between)
    letters = np.where(stands, _STANDS[codes], letters)
    blank = letters == _BLANK
    letters = letters[~(blank & np.concatenate([[True], blank[:-1]]))]
    return " " + letters.astype("<u4").tobytes().decode("utf-32-le", "replace") + " "


@dataclass
class Model:
    """Weights of " word " and " beginning", exceptions as " two words ", and the curve's coefficients."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)


class Matcher:
    """Aho-Corasick automaton of a lexicon and its exceptions, over folded texts."""

    def __init__(self, model: Model):
        self.curve = model.curve
        self.automaton = ahocorasick.Automaton()
        for entry, weight in model.weights.items():
            self.automaton.add_word(entry, (len(entry), entry[-1] == " ", weight))
        for phrase in model.exceptions:
            self.automaton.add_word(phrase, (len(phrase), True, None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> float:
        """Sum over the words outside exceptions of the heaviest entry found there."""
        if not len(self.automaton):
            return 0.0
        found: dict[int, float] = {}
        covered = []
        for end, (size, whole, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                covered.append((start, end))
            elif whole or folded[end + 1] != " ":  # a beginning is followed by more of the word
                found[start] = max(found.get(start, weight), weight)
        at, upto, total = 0, -1, 0.0
        for start in sorted(found):
            while at < len(covered) and covered[at][0] <= start:  # two words each: in the order of their starts
                upto = max(upto, covered[at][1])
                at += 1
            total += 0.0 if start < upto else found[start]
        return total

    def measures(self, text: str | None) -> tuple[float, float]:
        """Log of the weight sum, and log of the weight per hundred words."""
        folded = fold(text)
        total = self.hits(folded)
        return float(np.log1p(total)), float(np.log1p(100 * total / max(folded.count(" ") - 1, 1)))

    def score(self, text: str | None) -> float:
        a, b, c = self.curve
        x, y = self.measures(text)
        return float(1 / (1 + np.exp(-(a + b * x + c * y))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Coefficients, constant first, by Newton steps."""
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w = np.zeros(x.shape[1])
    keep = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep + 1e-6 * np.eye(x.shape[1]), x.T @ (y - p) - keep @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _terms(word: str) -> list[str]:
    """Entries that would find a word: itself, and its proper beginnings."""
    return [f" {word} ", *(" " + word[:n] for n in STEMS if n < len(word))]


def _counted(sample: DataFrame) -> DataFrame:
    """(term, toxic, clean): texts of either class that hold a term; added up per batch first."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts: tuple[Counter, Counter] = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                counts[label > 0].update({t for w in set(fold(text).split()) for t in _terms(w)})
            names = list(counts[0] | counts[1])
            columns = [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in (counts[1], counts[0]))]
            yield pa.RecordBatch.from_arrays(columns, ["term", "toxic", "clean"])

    rows = sample.mapInArrow(listed, "term string, toxic long, clean long")
    return rows.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _surroundings(sample: DataFrame, places) -> DataFrame:
    """(term, toxic, clean, all_toxic, all_clean): in how many different surroundings the texts of either
    class show a term, at its first place in the text and at all places.

    ``places`` lists (term, first word, number of words) of a list of words, in order. Copies of a passage
    are one piece of evidence, however often they occur.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                words, met = ["", *fold(text).split(), ""], set()
                for term, i, n in places(words[1:-1]):
                    found.append((term, f"{words[i]} {words[i + n + 1]}", label, int(term not in met)))
                    met.add(term)
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int32(), pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["term", "beside", "label", "first"])

    rows = sample.mapInArrow(listed, "term string, beside string, label int, first int")
    rows = rows.groupBy("term", "beside", "label").agg(F.max("first").alias("first"))
    toxic, clean = F.col("label"), 1 - F.col("label")
    return rows.groupBy("term").agg(
        F.sum(toxic * F.col("first")).alias("toxic"), F.sum(clean * F.col("first")).alias("clean"), F.sum(toxic).alias("all_toxic"), F.sum(clean).alias("all_clean")
    )


def _evidence(rate: float, above: bool):
    """Chernoff exponent: how surely the toxic share of a term lies above (below) ``rate``; else 0."""
    n = (F.col("toxic") + F.col("clean")).cast("double")
    share = F.col("toxic") / n
    terms = F.when(F.col("toxic") > 0, F.col("toxic") * F.log(share / rate)).otherwise(0.0) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - rate))
    ).otherwise(0.0)
    return F.when(share > rate if above else share < rate, terms).otherwise(0.0)


def train(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Learn from about ``rows`` labelled rows; counts are made in Spark, the driver gets the chosen entries."""
    sample = materialize(labelled_sample(documents, labels, "toxic", rows), "sample")
    toxic, clean = (sample.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()[i] or 0 for i in (0, 1))
    prior = float(np.log((toxic + 0.5) / (clean + 0.5)))
    if not toxic or not clean:
        return Model(curve=(prior, 0.0, 0.0))

    rate = toxic / (toxic + clean)

    def chosen(counts: DataFrame, evidence, tried: int) -> list:
        """All terms whose evidence holds among ``tried`` ones: at most those of the sample."""
        least = float(np.log(max(tried, 1))) + SURE
        return counts.withColumn("evidence", evidence).where(F.col("evidence") > least).orderBy(F.desc("evidence"), "term").collect()

    counts = materialize(_counted(sample), "terms")
    tried = counts.count()
    likely = {r["term"]: r["toxic"] for r in chosen(counts, _evidence(rate, True), tried)}
    vague = {t[:n] for t, held in likely.items() for n in range(2, len(t)) if held >= WHOLE * likely.get(t[:n], np.inf)}
    sought = set(likely) - vague
    around = _surroundings(sample, lambda words: [(t, i, 1) for i, w in enumerate(words) for t in _terms(w) if t in sought])
    sure = chosen(around, _evidence(rate, True), tried)
    weights = {r["term"]: float(np.log((r["all_toxic"] + 0.5) / (r["all_clean"] + 0.5)) - prior) for r in sure}
    weights = {t: w for t, w in weights.items() if w > 0}

    def phrases(words: list[str]) -> list[tuple[str, int, int]]:
        known = [any(t in weights for t in _terms(w)) for w in words]
        return [(f" {words[i]} {words[i + 1]} ", i, 2) for i in range(len(words) - 1) if known[i] or known[i + 1]]

    pairs = materialize(_surroundings(sample, phrases), "phrases")
    model = Model(weights, [r["term"] for r in chosen(pairs, _evidence(0.5, False), pairs.count())])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in slices(batches, "text"):
            x, y = zip(*map(matcher.measures, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), batch.column("label")], ["x", "y", "label"])

    got = sample.mapInArrow(measured, "x double, y double, label int").toPandas().sort_values(["x", "y", "label"])
    model.curve = tuple(map(float, logistic(got[["x", "y"]].to_numpy(), got["label"].to_numpy(float))))
    return model


def score(documents: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all, if not given) and ``toxicity``, between 0 and 1; replaces a column of that name."""
    kept = [c for c in keep or documents.columns if c != "toxicity"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in slices(batches, "text"):
            values = pa.array(map(matcher.score, batch.column("text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), values], [*kept, "toxicity"])

    schema = documents.select(*kept, F.lit(0.0).alias("toxicity")).schema
    return documents.select(*kept, *(["text"] if "text" not in kept else [])).mapInArrow(scored, schema)


def predictions(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.5) of every document."""
    marked = documents.select("doc_id", held_out().alias("held_out"), "text")
    scored = score(marked, train(documents, labels, rows), ["doc_id", "held_out"]).withColumnRenamed("toxicity", "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
