"""The stages one after another against plain Python on what each was given."""

import pytest

import corpus_pipeline
from lexloom.llm import common, quality
from lexloom.llm.queries import tokenizer_path
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(common.materialize(stage(spark, out[-1], SF_DIR), name))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_stay_until_the_last(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "encoding"]


def test_quality_stage_keeps_good_rows(steps, spark):
    scores = quality.predictions(steps[0], spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()
    assert set(texts(steps[1])) == {r["doc_id"] for r in scores if r["score"] >= 0.3}


def test_one_of_each_group_stays(steps):
    given = list(texts(steps[1]).items())
    assert set(texts(steps[2])) == {c for _, _, c in brute.components(given)}


def test_contaminated_rows_go(steps, spark):
    given = list(texts(steps[2]).items())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert set(texts(steps[3])) == {r[0] for r in brute.contamination(given, items) if not r[5]}


def test_personal_data_goes(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert set(before) == set(after)
    for i, text in before.items():
        spans = brute.personal(text)
        assert (text == after[i]) or spans or "<" in after[i]
        assert all(text[a:b] not in after[i] for k, a, b in spans if k == "email")


def test_encoding_of_what_is_left(steps):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path())
    left = texts(steps[4])
    got = {r["doc_id"]: (list(r["ids"]), r["decoded_sha256"]) for r in steps[5].collect()}
    assert set(got) == set(left)
    for i, text in left.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i] == (ids, brute.sha(library.decode(ids, skip_special_tokens=False)))


def test_run_gives_the_last_stage(spark, steps):
    assert corpus_pipeline.run(spark, SF_DIR).count() == steps[-1].count()


HARD = [
    (None, None, None), (1, None, 5), (1, None, 5), (2, "", 1), (2, "", 2), (3, " \t ", None), (None, "of the people by mail a@b.co", 3),
    (4, "word " * 200_000, 4), (4, "word " * 200_000, 4), (5, "Call +1 (212) 555-0100 or DE89 3704 0044 0532 0130 00.", None), (6, "\u00e9\u4e2d\U0001f600 " * 9, 6),
]


def through(spark, docs, monkeypatch):
    """Every stage on what the one before kept; the classifier lets all pass, so that each meets the hard rows."""
    accept = lambda docs, labels: docs
    out = [docs]
    with monkeypatch.context() as m:
        m.setattr(quality, "accepted", accept)
        for name, stage in corpus_pipeline.STAGES:
            out.append(common.materialize(stage(spark, out[-1], SF_DIR), name))
    return out


def test_hard_rows_and_own_columns_pass_all_stages(spark, monkeypatch):
    docs = spark.createDataFrame(HARD, "doc_id long, text string, ids long").selectExpr("*", "ids as key", "'x' as component_id", "1 as part", "2 as score", "3 as n_hit", "doc_id as items")
    steps = through(spark, docs, monkeypatch)
    assert all(s.columns == docs.columns for s in steps[:-1])
    given = [(r["doc_id"], r["text"]) for r in steps[1].collect()]
    groups = {c if c is not None else f for _, f, c in brute.components(given)}
    assert steps[2].count() == len(groups)
    assert {r["text"] for r in steps[2].collect()} <= {t for _, t, _ in HARD}
    assert steps[4].count() == steps[3].count() == steps[2].count()
    last = steps[5]
    assert last.columns == ["doc_id", "key", "component_id", "part", "score", "n_hit", "items", "n_tokens", "ids", "decoded_sha256"]
    assert last.count() == steps[4].count() and last.where("n_tokens is null or ids is null").count() == 0
    assert quality.accepted(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")).columns == docs.columns


def test_empty_table_passes_all_stages(spark, monkeypatch):
    none = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    assert [s.count() for s in through(spark, none, monkeypatch)] == [0] * 6
