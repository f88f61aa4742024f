from datetime import date

from lexloom.operators import corpus as C
from lexloom.operators import lookup as L

DOCS = "id BIGINT, document_number STRING, document_type STRING, issuing_authority STRING, issue_date DATE"


def docs(spark):
    return spark.createDataFrame(
        [
            (1, "A", "QĐ", "Bộ", date(2020, 1, 1)), (2, "A", None, "Bộ", None),
            (3, "B", "TT", None, date(2021, 1, 1)), (4, "Z", "TT", "Sở", date(2021, 1, 1)),
        ],
        DOCS,
    )


def keys(spark, values=("A", "B", "A", "C")):
    return spark.createDataFrame(list(enumerate(values)), "pos BIGINT, document_number STRING")


def test_list_lookup(spark):
    k, d = keys(spark), docs(spark)
    found = L.in_list_order(L.found_documents(k, d)).collect()
    assert [(r.pos, r.id) for r in found] == [(0, 1), (0, 2), (1, 3), (2, 1), (2, 2)]
    assert [(r.pos, r.document_number) for r in L.not_found(k, d).collect()] == [(3, "C")]
    by_number = {r.document_number: r.n_documents for r in L.documents_by_number(k, d).collect()}
    assert by_number == {"A": 2, "B": 1}
    assert [r.document_number for r in L.numbers_with_duplicates(L.documents_by_number(k, d)).collect()] == ["A"]
    assert {r.document_type: r.n_documents for r in L.by_type(k, d).collect()} == {"QĐ": 2, None: 2, "TT": 1}
    assert {r.issuing_authority: r.n_documents for r in L.by_authority(k, d).collect()} == {"Bộ": 4, None: 1}
    assert {r.year: r.n_documents for r in L.by_year(k, d).collect()} == {"2020": 2, "Không xác định": 2, "2021": 1}
    c = L.coverage(k, d).first()
    assert (c.total_searched, c.total_found, c.found_numbers, c.not_found_count) == (4, 5, 2, 1)
    assert (c.found_percent, c.not_found_percent) == (50.0, 25.0)
    assert [(r.document_number, r.pos) for r in L.top_duplicates(k, d).collect()] == [("A", 0)]


def test_summaries_agree_with_single_ones(spark):
    rows = {(r.dimension, r.value): r.n_documents for r in L.summaries(keys(spark), docs(spark)).collect()}
    assert rows[("document_type", None)] == 2 and rows[("issuing_authority", None)] == 1
    assert rows[("year", "Không xác định")] == 2 and rows[("document_type", "QĐ")] == 2
    assert len(rows) == 8


def test_empty_list(spark):
    c = L.coverage(keys(spark).limit(0), docs(spark)).first()
    assert (c.total_searched, c.found_percent, c.not_found_percent) == (0, None, None)


def test_lookup_ids_are_stable(spark):
    rows = [L.lookup_ids(L.found_documents(keys(spark), docs(spark))).collect() for _ in range(2)]
    assert sorted(map(str, rows[0])) == sorted(map(str, rows[1]))
    ids = [r._id["$oid"] for r in rows[0]]
    assert len(set(ids)) == 5 and all(len(i) == 24 for i in ids)


def test_duplicates(spark):
    assert [(r.document_number, r["count"]) for r in C.duplicate_numbers(docs(spark)).collect()] == [("A", 2)]
    assert sorted(r.id for r in C.duplicate_details(docs(spark)).collect()) == [1, 2]


def test_listing(spark):
    d = docs(spark)
    assert [r.id for r in C.listing(d, 1, 2).collect()] == [2, 3]
    assert [r.id for r in C.listing_after(d, 2, 5).collect()] == [3, 4]
    assert C.first_by_number(d, "A").first().id == 1
    assert C.first_by_number(d, "nope").count() == 0
    assert C.random_rows(d, 3).count() == 3


def test_validation_reports_first_fault(spark):
    rows = [
        ("A", "QĐ", "Bộ", "2020-01-01"), ("A", "", "Bộ", "x"), ("A" * 256, "QĐ", "Bộ", "2020-01-01"),
        ("A", "QĐ", "Bộ", "31/02/2020"), (None, None, None, None), ("A", "QĐ", "Bộ", None),
    ]
    df = spark.createDataFrame(rows, "document_number STRING, document_type STRING, issuing_authority STRING, issue_date STRING")
    got = [r.error for r in C.validate(df).collect()]
    assert got == [
        None, "Missing required field: document_type", "Document number exceeds maximum length",
        "Invalid date format for issue_date", "Missing required field: document_number",
        "Missing required field: issue_date",
    ]
    good, bad = C.split_valid(C.validate(df))
    assert (good.count(), bad.count()) == (1, 5)


def test_children(spark):
    kids = spark.createDataFrame([(1, "x"), (1, "y")], "doc BIGINT, v STRING")
    got = {r.id: r.n for r in C.with_children(docs(spark), kids, "id", "doc", "n").collect()}
    assert got == {1: 2, 2: 0, 3: 0, 4: 0}
    assert C.child_rows(docs(spark), kids, "id", "doc").count() == 5
