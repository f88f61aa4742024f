"""Near-duplicates by sketches against exact similarities of all pairs."""

import random
from collections import Counter

import pytest

from lexloom.llm import minhash
from tests.llm import brute
from tests.llm.test_operators import CLASH, HARD, LONG, given, rows, run  # noqa: F401

COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def varied(seed, centres, copies, words, edits, common=0):
    """Texts around few centres, some words of each changed; all may begin with one passage."""
    draw = random.Random(seed)
    start = [f"c{i}" for i in range(common)]
    out = []
    for c in range(centres):
        base = start + [f"w{draw.randrange(10**9)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(draw.randrange(edits + 1)):
                text[draw.randrange(len(text))] = f"e{draw.randrange(10**9)}"
            if draw.random() < 0.2:
                text = text[: draw.randrange(len(text) // 2, len(text))]
            out.append(" ".join(text))
    draw.shuffle(out)
    return [(i, t) for i, t in enumerate(out)]


def test_hard_cases(spark):
    docs = [*HARD, (20, LONG[: len(LONG) * 9 // 10]), (21, "A b"), (22, "a  B\n"), (23, "a b c d"), (24, "A B C D"), (None, "a b c d"), (None, "none of these here at all")]
    df = spark.createDataFrame([(i, t, 0.5, 1, "x", "y", 1, 1, 1, 0.1, 0.1, 1, 1) for i, t in docs], CLASH).repartition(3)
    got = rows(minhash.report(df), *COLUMNS)
    want = Counter((i, n, c, i == c) for i, n, c, _ in brute.jaccard_components(docs))
    assert got == want
    assert minhash.report(df.limit(0)).collect() == []


def test_table(spark, given):  # noqa: F811
    assert rows(run(spark, "op11_minhash_near_dedup"), *COLUMNS) == Counter(brute.jaccard_components(given["documents"]))


@pytest.mark.parametrize("longest", (1, 64))
def test_groups_in_small_tiles(spark, monkeypatch, longest):
    """Short lists alone would do; with none, regions cut into many tiles find the same links."""
    monkeypatch.setattr(minhash, "LIST", longest)
    monkeypatch.setattr(minhash, "HOMES", 1500)
    monkeypatch.setattr(minhash, "OTHERS", 3000)
    docs = varied(3, 6, 25, 120, 5, common=30) + [(1000 + i, t) for i, t in varied(4, 20, 4, 30, 2)] + [(2000 + i, t) for i, t in varied(5, 2, 8, 900, 30)]
    got = rows(minhash.report(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)), *COLUMNS)
    assert got == Counter(brute.jaccard_components(docs))


def test_one_crowded_group(spark):
    """More near copies than a list may hold pairs of, most pairs around the limit."""
    docs = varied(6, 1, 300, 100, 8)
    got = rows(minhash.report(spark.createDataFrame(docs, "doc_id long, text string").repartition(7)), *COLUMNS)
    assert got == Counter(brute.jaccard_components(docs))


def test_shared_values_of_linked_sketches():
    assert minhash.least_shared(64) == 30
    assert minhash.least_shared(64, 1e-3) > 30
