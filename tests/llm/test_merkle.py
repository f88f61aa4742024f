"""Manifest against a tree built in one list per language."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from lexloom.llm import merkle
from tests.llm import brute
from tests.llm.test_operators import LONG, SF_DIR, rows, run

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, path string, row int, tree string, altered int, block int"


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "p", 2, "t", 3, 4) for d in docs], SCHEMA).repartition(3)


HARD = [
    (1, "s", "en", 3, "abc"), (1, "s", "en", 3, "abc"), (1, "s", "en", 4, "abcd"), (None, "s", "en", 3, "abc"), (None, None, None, None, None),
    (2, "", "", 0, ""), (-5, "s", "é", 1, "é"), (3, "s", None, 3, "字"), (7, "s", "z", 5, LONG), (9, "s", "Z", None, "x"), (10**12, "s", "-", 1, "="),
] + [(i, f"s{i % 3}", "en", i, f"text {i}") for i in range(100, 177)] + [(i, "s", "fr", i, "t") for i in range(33)]


@pytest.mark.parametrize("block, step", ((12, 4), (0, 1), (1, 2), (2, 1), (3, 4)))
def test_hard_cases(spark, monkeypatch, block, step):
    """Blocks of one leaf upwards, so that many rounds of the exchange run, with unfilled last subtrees."""
    monkeypatch.setattr(merkle, "BLOCK", block)
    monkeypatch.setattr(merkle, "STEP", step)
    assert rows(merkle.report(frame(spark, HARD)), *COLUMNS) == Counter(brute.merkle(HARD))


@pytest.mark.parametrize("count", (1, 2, 3, 5, 9, 17, 31))
def test_unfilled_trees(spark, monkeypatch, count):
    monkeypatch.setattr(merkle, "BLOCK", 1)
    monkeypatch.setattr(merkle, "STEP", 1)
    docs = [(i, "s", "en", i, "t") for i in range(count)]
    assert rows(merkle.report(frame(spark, docs)), *COLUMNS) == Counter(brute.merkle(docs))


def test_wider_trees(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 1)
    monkeypatch.setattr(merkle, "STEP", 1)
    got = merkle.manifest(frame(spark, HARD), ["doc_id", "row"], 3)
    assert got.columns == ["doc_id", "row", "leaf", "subroot", "root", "path"]
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    found = got.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof"), (merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"))
    want = Counter((*r[:5], True) for r in brute.merkle(HARD, 3))
    assert rows(found, "doc_id", "leaf", "subroot", "root", "proof", "ok") == want


def test_repeated_row_is_spread(spark):
    docs = [(5, "s", "en", 1, "t")] * 500 + [(i, "s", "en", 1, "t") for i in range(10)]
    assert rows(merkle.report(frame(spark, docs)), *COLUMNS) == Counter(brute.merkle(docs))


def test_empty_table(spark):
    empty = frame(spark, HARD).limit(0)
    assert merkle.report(empty).collect() == []
    assert merkle.report(empty).columns == list(COLUMNS)


def test_table(spark):
    docs = duckdb.connect().execute(f"SELECT doc_id, source, lang, n_chars, text FROM '{os.path.join(SF_DIR, 'documents.parquet')}'").fetchall()
    assert rows(run(spark, "op13_merkle_manifest"), *COLUMNS) == Counter(brute.merkle(docs))
