"""Each operator against its plain form: hard cases on small tables, and whole given tables."""

import json
import os
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lexloom.llm import boosting, bpe, chat, common, decontaminate, graph, neighbours, pii, quality, sharding, simhash, substrings, toxicity
from lexloom.llm.queries import tokenizer_path
from lexloom.llm.sql import PERSONAL
from tests.llm import brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
MAIL = "mail a@b.co now, or call +1 (234) 567-8901 or pay 4111 1111 1111 1111 from 10.0.0.1"

HARD = [
    (1, "One two three four five six seven"), (2, "one TWO three four five six seven"), (3, None), (4, ""), (5, " \t\n "),
    (6, "short"), (7, "short"), (8, LONG), (9, LONG + " end"), (10, f"a {PASSAGE} b"), (11, f"{PASSAGE} c {PASSAGE}"),
    (12, MAIL), (12, MAIL), (None, "no id here"), (None, "no id here"), (13, "É́ñ 字 \U0001f600 x@y.zz   " + MAIL),
    (14, "x" * 5000), (15, "1" * 3000 + " " + "1.2.3.4.5.6.7.8 999.1.1.1 00255.0.0.1"), (16, "you are an idiot"), (17, "Σίσυφος ΟΔΟΣ İstanbul don't <|endoftext|>A<|startoftext|>"),
]
CLASH = "doc_id long, text string, score double, label int, ids string, spans string, n_words int, part int, shard int, quality_score double, toxicity double, removed int, kept int"


@pytest.fixture(scope="module")
def hard(spark):
    """The cases with extra columns whose names the operators use as well."""
    return spark.createDataFrame([(i, t, 0.5, 1, "x", "y", 1, 1, 1, 0.1, 0.1, 1, 1) for i, t in HARD], CLASH).repartition(3)


@pytest.fixture(scope="module")
def none(hard):
    return hard.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i == 16), "t") for i in range(1, 18)] + [(None, 1, 1, "t"), (1, None, None, "t"), (1, 1, 0, "t")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def table(con, name):
    return con.execute(f"SELECT * FROM '{SF_DIR}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def given():
    con = duckdb.connect()
    return {n: con.execute(f"SELECT {c} FROM '{SF_DIR}/{n}.parquet'").fetchall() for n, c in (("documents", "doc_id, text"), ("benchmark", "item_id, text"), ("labels", "doc_id, quality, toxic"), ("embeddings", "vec_id, embedding"), ("conversations", "conv_id, turn, role, text"))}


def rows(df, *columns):
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.select(*columns).collect())


def run(spark, name):
    return entry.queries()[name](spark, SF_DIR)


# --- SimHash ---


def test_components_of_hard_cases(hard):
    assert rows(simhash.fingerprint_components(hard), "doc_id", "fingerprint", "component_id") == Counter(brute.components(HARD))


def test_components_of_table(spark, given):
    assert rows(run(spark, "op3_simhash_near_dedup"), "doc_id", "fingerprint", "component_id") == Counter(brute.components(given["documents"]))


def test_links_of_crowded_prints_meet(spark, monkeypatch):
    """Chains of fingerprints around few centres, in many small cells."""
    monkeypatch.setattr(simhash, "CELL", 16)
    monkeypatch.setattr(simhash, "REPLICAS", 64)
    draw = random.Random(5)
    prints = []
    for _ in range(12):
        p = draw.getrandbits(64)
        for _ in range(30):
            prints.append(p)
            for b in draw.sample(range(64), draw.choice((1, 2, 4, 5, 7))):
                p ^= 1 << b
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {r["node"]: r["root"] for r in graph.components(simhash._links(spark.createDataFrame([(s,) for s in signed], "print long"), 4)).collect()}
    groups = defaultdict(set)
    for s, r in zip(signed, brute.linked(prints)):
        groups[r].add(s)
    want = {s: min(g) for g in groups.values() if len(g) > 1 for s in g}
    assert got == want


def test_code_covers_within_radius():
    """Every word has an anchor; replicas reach the home of any link."""
    code, random_ = simhash.anchors(), np.random.default_rng(1)
    x = random_.integers(0, 2**64, 300, dtype=np.uint64)
    for flips in (1, 4):
        y = x.copy()
        for i in range(len(y)):
            for b in random_.choice(64, flips, replace=False):
                y[i] ^= np.uint64(1) << np.uint64(b)
        dx, dy = (np.bitwise_count(v[:, None] ^ code[None, :]) for v in (x, y))
        low, high = np.where((dx.min(1) <= dy.min(1))[:, None], dx, dy), np.where((dx.min(1) <= dy.min(1))[:, None], dy, dx)
        assert (high[np.arange(300), low.argmin(1)] <= high.min(1) + flips).all()


def test_one_of_each_component_stays(hard):
    kept = simhash.one_per_component(hard)
    assert kept.columns == hard.columns
    comps = {c if c is not None else f for _, f, c in brute.components(HARD)}
    got = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    assert len(got) == len(comps) and set(got) <= set(HARD)


def test_choice_among_rows_of_one_id(spark):
    """Rows equal in id and text but not in other columns: the same one stays however the rows are dealt."""
    data = [(1, "one two three four five six", f"s{i}") for i in range(40)] + [(None, "x y z", f"s{i}") for i in range(5)]
    stay = {tuple(sorted(map(str, simhash.one_per_component(spark.createDataFrame(data[::step], "doc_id long, text string, source string").repartition(n)).collect()))) for n, step in ((1, 1), (7, 1), (3, -1))}
    assert len(stay) == 1 and len(stay.pop()) == 2


def test_texts_of_the_chosen_are_shuffled_once(spark, hard):
    plan = simhash.one_per_component(hard.withColumn("big", F.lit("x")))._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(__key" in line]
    assert len(moved) == 2  # the documents and the chosen keys


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1400)}}


# --- decontamination ---

ITEMS = [(1, " ".join(PASSAGE.split()[5:30])), (2, "three four five"), (3, None), (4, ""), (None, "short"), (1, " ".join(PASSAGE.split()[5:30])), (10, LONG[-300:]), (2, "end")]


def test_contamination_of_hard_cases(spark, hard, monkeypatch):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, doc_id int")
    want = Counter(brute.contamination(HARD, ITEMS))
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows(decontaminate.contamination(hard, items), *columns) == want
    monkeypatch.setattr(decontaminate, "SLICE", 100)  # several passes
    assert rows(decontaminate.contamination(hard, items), *columns) == want
    kept = decontaminate.clean(hard, items)
    assert kept.columns == hard.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r in want.elements() if not r[5])
    assert rows(decontaminate.contamination(hard, items.limit(0)), "n_hit") == Counter({(0,): len(HARD)})


def test_longest_match_and_place(spark):
    docs = spark.createDataFrame([(1, "zz " + " ".join(PASSAGE.split()[3:33]) + " yy " + " ".join(PASSAGE.split()[:15]))], "doc_id long, text string")
    items = spark.createDataFrame([(7, PASSAGE)], "item_id long, text string")
    got = decontaminate.find_overlaps(docs, items, ["doc_id"]).first()
    assert (got["longest_match"], got["longest_at"], got["n_hit"]) == (30, 1, 45)


def test_slices_and_chunks_change_nothing(spark, monkeypatch):
    """A template that all items share, items longer than the window, spans and matches across slices."""
    draw = random.Random(4)
    shared = " ".join(f"t{i}" for i in range(20))
    items = [(i, f"{shared} " + " ".join(f"q{i}x{draw.randrange(5)}" for _ in range(draw.randrange(30)))) for i in range(40)]
    texts = [f"a b {t} c d {shared} e" for _, t in items] + [f"{t} {u}" for (_, t), (_, u) in zip(items, items[3:])] + ["clean words only", ""]
    docs = spark.createDataFrame([(i % 70, t) for i, t in enumerate(texts * 2)], "doc_id long, text string")
    sought = spark.createDataFrame(items, "item_id long, text string")
    columns = ("doc_id", "n_words", "n_hit", "hit_spans", "items", "longest_match", "longest_at")
    listed = lambda: sorted(tuple(map(str, r)) for r in decontaminate.find_overlaps(docs, sought, ["doc_id"]).select(*columns).collect())
    want = listed()
    monkeypatch.setattr(decontaminate, "SLICE", 3000)
    assert listed() == want
    windows = [t.split()[a : a + 13] for _, t in items for a in range(len(t.split()) - 12)]
    best = max(len(t.split()) for _, t in items)
    assert max(int(r[5]) for r in want) == best and len(windows) > 40
    numbers = decontaminate.probe([(str(i), t.encode()) for i, t in items])
    assert len(numbers.tokens) == len({tuple(w) for w in windows}) and numbers.first[-1] == len(windows)
    batch = pa.RecordBatch.from_pylist([{"text": t, "hit_spans": b"", "items": [], "longest_match": 0, "longest_at": 0} for t in texts])
    whole = decontaminate._searched(batch, numbers)
    monkeypatch.setattr(decontaminate, "PAIRS", 50)
    monkeypatch.setattr(decontaminate, "SOUGHT", 7)
    assert decontaminate._searched(batch, numbers) == whole


def test_suffix_array_is_sorted():
    draw = np.random.default_rng(2)
    tokens = draw.integers(1, 4, 300).astype(np.int32)
    order = decontaminate.suffix_array(np.concatenate([tokens, np.zeros(301, np.int32)]), np.arange(300), 300)
    suffixes = [tokens[i:].tolist() for i in order]
    assert suffixes == sorted(suffixes)


# --- substrings ---


def test_repeats_of_hard_cases(hard, monkeypatch):
    want = Counter(brute.without_repeats(HARD))
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows(substrings.report(hard), *columns) == want
    monkeypatch.setattr(substrings, "BLOCK", 20_000)  # many blocks
    monkeypatch.setattr(substrings, "PIECE", 1000)
    assert rows(substrings.report(hard), *columns) == want
    monkeypatch.setattr(substrings, "BUCKET", 10)  # more buckets than a block deals to: rows are regrouped over blocks
    monkeypatch.setattr(substrings, "FIRST", 256)
    assert rows(substrings.report(hard), *columns) == want
    monkeypatch.setattr(substrings, "REGROUPED", 50)  # several salts, and several rows of a bucket and salt
    assert rows(substrings.report(hard), *columns) == want


def test_places_round_trip():
    for places in ([], [0], [5, 70_000, 70_001], list(range(0, 3000, 3))):
        assert substrings.unpack_places(substrings.pack_places(np.array(places, np.int64))).tolist() == places
    places, starts = np.array([5, 9, 70_000, 0, 3, 2], np.int64), np.array([0, 3, 5])
    assert substrings.unpack_places(substrings.pack_places(places, starts), starts).tolist() == places.tolist()


# --- personal data ---


def test_pii_of_hard_cases(hard):
    columns = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert rows(pii.report(hard), *columns) == Counter(brute.pii(HARD))


def test_pii_of_table(spark, given):
    columns = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert rows(run(spark, "op10_pii"), *columns) == Counter(brute.pii(given["documents"]))


def test_pii_of_random_strings(spark):
    draw = random.Random(3)
    docs = [(i, "".join(draw.choice("1234567890 .-+@ab()") for _ in range(draw.randrange(120)))) for i in range(400)]
    docs += [(1000, " ".join(f"+12345678{i % 10}" for i in range(700)) + " " + "a.b@c.d@e.f+g@h.i " * 70)]
    columns = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert rows(pii.report(spark.createDataFrame(docs, "doc_id long, text string")), *columns) == Counter(brute.pii(docs))


def test_pii_added_kinds_and_scores(spark):
    texts = ["iban GB82WEST12345698765432 here", "no GB82WEST12345698765433", "my ssn is 123-45-6789", "part 123-45-6789 in stock", "mail me: a@b.co", "a@b.co"]
    got = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ["doc_id"]).orderBy("doc_id").collect()
    assert [[(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in got] == [[(4, 5, 27)], [], [(5, 10, 21)], [], [(0, 9, 15)], [(0, 0, 6)]]
    assert got[4]["spans"][0]["score"] == 1.0 and got[5]["spans"][0]["score"] == 0.9


def test_pii_context_lies_behind_other_matches(spark):
    """The window is NEAR code points of the text, whatever matches lie in it; as in the SQL."""
    ids = [f"{100 + i}-45-{6000 + i}" for i in range(8)]
    texts = [
        "ssn 123-45-6789 987-65-4321", "123-45-6789, 987-65-4321: identity", "ssn " + " ".join(ids) + " stock", "stock " + ",".join(ids) + " social",
        "visa 11 22 4111 1111 1111 1111", "visa 11, 22, 33; 4111 1111 1111 1111", "4111111111111111, 12, 13, 14 card", "1a23;" * 9 + "4111111111111111;" + "1b23;" * 9 + "card",
        "pay " + "1a23;" * 7 + "4111111111111111", "a@b.co, é😀@c.de, x@y.zz mail", "write to a@b.co c@d.ef g@h.ij k@l.mn o@p.qr s@t.uv", "host 1.2.3.4 5.6.7.8 999.1.1.1 9.9.9.9",
        "tel +12345678901 x +123 +12345678902; +12345678903", "bank GB82WEST12345698765432 GB82WEST12345698765433 GB82WEST12345698765432", "ssn" + " " * 37 + "123-45-6789",
        "pay DE89 3704 0044 0532 0130 00 from de89370400440532013000 or gb82 west 1234 5698 7654 32", "DE89 3704 0044 0532 0130 01", "xDE89 3704 0044 0532 0130 00, FR76 3000 6000 0112 3456 7890 189 soon",
        "no GB82 WEST 1234 5698 765432", "_DE89370400440532013000 DE89370400440532013000_", "ES91 2100 0418 4502 0005 1332 next word Be68 5390 0754 7034.",
        "ssn" + " " * 36 + "123-45-6789", "ssn 12345678901 " + "é" * 23 + " 123-45-6789", "123-45-6789" + " 1-2" * 9 + " ssn", "123-45-6789 000-00-0000" + " " * 13 + "identity",
    ]
    docs = [(i, t) for i, t in enumerate(texts)]
    got = pii.report(spark.createDataFrame(docs, "doc_id long, text string"))
    base = duckdb.connect()
    base.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    base.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    columns = ["doc_id", *(f"n_{k.name}" for k in pii.KINDS), "base_sha256", "spans"]
    found = {r[0]: r for r in base.execute(f"SELECT {', '.join(columns)}, round(lowest_score, 9) FROM ({PERSONAL})").fetchall()}
    assert {r["doc_id"]: (*(r[c] for c in columns), r["lowest_score"] and round(r["lowest_score"], 9)) for r in got.collect()} == found
    assert [found[i][6] for i in (0, 1)] == [2, 2]
    printed = next(i for i, t in enumerate(texts) if t.startswith("pay DE89"))
    assert [found[i][5] for i in range(printed, printed + 6)] == [3, 0, 1, 0, 0, 2]
    accounts = spark.createDataFrame([(1, texts[printed])], "doc_id long, text string")
    assert pii.redact(accounts).first()["text"] == "pay <IBAN> from <IBAN> or <IBAN>"
    both = spark.createDataFrame([(1, texts[1])], "doc_id long, text string")
    assert pii.redact(both).first()["text"] == "<NATIONAL_ID>, <NATIONAL_ID>: identity"


def test_redaction(spark, hard):
    docs = spark.createDataFrame([(1, MAIL, 3), (2, None, 4), (3, "+1 234 567 8901@mail.com z", 5)], "doc_id long, text string, n_chars int")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.redact(docs).collect()}
    text = "mail <EMAIL> now, or call <PHONE> or pay <CARD> from <IP>"
    assert got == {1: (text, len(text)), 2: (None, 4), 3: ("<PHONE> z", 9)}
    assert pii.redact(hard).columns == hard.columns


def test_pii_time_grows_with_the_matches(spark):
    """A text of very many matches: twice as many take about twice the time, redaction included."""
    seconds = {}
    for count in (8_000, 128_000, 256_000):
        text = "12, " * (count - 1) + "4111 1111 1111 1111 " + "a@b.co " * (count // 8)
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        assert pii.report(df).first()["n_card"] == 1
        assert pii.redact(df).first()["text"] == "12, " * (count - 1) + "<CARD> " + "<EMAIL> " * (count // 8)
        seconds[count] = time.perf_counter() - start
    assert seconds[256_000] < 2.6 * seconds[128_000] + 2


# --- encoding ---


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path())


def encodings(library, docs):
    out = Counter()
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        out[(i, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids, skip_special_tokens=False)))] += 1
    return out


COLUMNS = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def test_bpe_of_hard_cases(hard, library):
    assert rows(bpe.digests(hard, tokenizer_path()), *COLUMNS) == encodings(library, HARD)


def test_bpe_of_table(spark, given, library):
    assert rows(run(spark, "op2_bpe"), *COLUMNS) == encodings(library, given["documents"])


def test_bpe_of_random_strings(library, monkeypatch):
    draw = random.Random(4)
    alphabet = "abcdeth'sSTE 019.,<|>\t\n\x1c\x1f\x85  éÉñß字ΣσİIıﬁ̧́‍\U0001f600\x00-_#"
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(3000)]
    texts += ["<|endoftext|>", "x<|endoftext|>y", "<|ENDOFTEXT|>", "the" * 400, "don't we'll I'M", "é" * 80]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    vocabulary = bpe.Vocabulary(bpe.load(tokenizer_path()))
    assert [np.frombuffer(p, "<i4").tolist() for p in bpe.Encoder(vocabulary).encode(texts)] == want
    monkeypatch.setattr(bpe, "AT_ONCE", 7)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    monkeypatch.setattr(bpe, "SHORT", 3)
    assert [np.frombuffer(p, "<i4").tolist() for p in bpe.Encoder(vocabulary).encode(texts)] == want


def test_files_of_other_settings_are_refused(tmp_path):
    with pytest.raises(ValueError, match="normalizer"):
        bpe.load(tokenizer_path().replace("word_bpe_49k", "byte_bpe_50k"))
    spec = bpe.load(tokenizer_path())
    for name, change in (("model.end_of_word_suffix", {"model": {**spec["model"], "end_of_word_suffix": "@@"}}), ("added_tokens", {"added_tokens": [{**spec["added_tokens"][0], "lstrip": True}]})):
        (tmp_path / "other.json").write_text(json.dumps({**spec, **change}))
        with pytest.raises(ValueError, match=name):
            bpe.load(str(tmp_path / "other.json"))


def test_encode_and_decode_are_the_round_trip(hard):
    ids = bpe.encode(hard, tokenizer_path(), ["doc_id", "label"])
    apart = bpe.decode(ids, tokenizer_path(), ["doc_id", "ids"])
    assert rows(apart, "doc_id", "ids", "decoded") == rows(bpe.round_trip(hard, tokenizer_path(), ["doc_id"]), "doc_id", "ids", "decoded")


# --- sharding ---


def test_shards_of_hard_cases(hard):
    for shards in (1, 3, 24):
        got = sharding.balanced_shards(hard, shards).collect()
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in HARD)
        by = defaultdict(list)
        for r in got:
            by[r["shard"]].append(r)
        assert set(by) <= set(range(shards))
        at, total = 0, sum(r["size"] for r in got)
        for s in sorted(by):
            assert sorted(r["slot"] for r in by[s]) == list(range(len(by[s])))
            for r in sorted(by[s], key=lambda r: r["slot"]):
                assert s == (2 * at + r["size"]) * shards // (2 * total)  # contiguous, by the middle byte
                at += r["size"]
        order = [r["doc_id"] for s in sorted(by) for r in sorted(by[s], key=lambda r: r["slot"])]
        assert order == sorted(order, key=lambda i: -1 if i is None else i)


def test_copies_of_one_row_are_listed_in_runs(hard, monkeypatch):
    want = Counter(map(tuple, sharding.report(hard.unionByName(hard)).collect()))
    for copies in (1, 3):
        monkeypatch.setattr(sharding, "COPIES", copies)
        assert Counter(map(tuple, sharding.report(hard.unionByName(hard)).collect())) == want


def test_shards_of_table_are_near_equal(spark, given):
    got = run(spark, "op7_sharding").toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(got) == len(given["documents"]) and len(sizes) == 24 and sizes.max() - sizes.min() <= 2 * got["size"].max()
    assert set(got["law"]) == {"bytes"} and got["grown_shard"].isna().all()


# --- chat ---


def chats(df):
    cost, text = Counter(), defaultdict(str)
    for r in sorted(df.collect(), key=lambda r: (r["turn"], r["role"] or "", r["text"] or "")):
        cost[r["conv_id"]] += r["cost"]
        text[r["conv_id"]] += r["piece"]
    return cost, text


def legal(text):
    roles = "".join(m[0] for m in re.findall(r"<\|(system|user|assistant)\|>\n", text))
    return re.fullmatch("s?(ua)+", roles) and text.count("<|end|>\n") == len(roles) and text.endswith("<|end|>\n")


def test_chat_repairs_cost_least(spark, monkeypatch):
    draw = random.Random(6)
    convs = {c: [draw.choice(("system", "user", "assistant", "User ", "tool", None)) for _ in range(draw.randrange(1, 9))] for c in range(300)}
    convs[999] = [draw.choice(("user", "assistant", "user", "system")) for _ in range(500)]
    data = [(c, t, r, f"{c}/{t}") for c, rs in convs.items() for t, r in enumerate(rs)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    want = {c: brute.repair_cost(rs) for c, rs in convs.items()}
    cost, text = chats(chat.repair(df))
    assert cost == Counter(want) and all(map(legal, text.values()))
    monkeypatch.setattr(chat, "BLOCK", 4)  # several levels of blocks
    monkeypatch.setattr(chat, "FAN", 3)
    again, text = chats(chat.repair(df))
    assert again == Counter(want) and all(map(legal, text.values()))
    assert text[999].count("999/") == 500


def test_chat_hard_cases(spark):
    data = [(1, 0, "user", "a", 1), (1, 0, "user", "a", 1), (1, 1, "assistant", None, 1), (None, 0, "user", "x", 1), (2, None, "assistant", "y", 1), (None, None, None, None, 1), (3, 0, "user", "", 1)]
    df = spark.createDataFrame(data, "conv_id long, turn int, role string, text string, key int")
    got = chat.repair(df).collect()
    assert len(got) == 6 and all(legal(r["piece"]) for r in got if r["conv_id"] != 1)
    assert "".join(r["piece"] for r in sorted((r for r in got if r["conv_id"] == 1), key=lambda r: r["turn"])) == "<|user|>\na<|end|>\n<|assistant|>\n<|end|>\n"
    assert chat.repair(df.limit(0)).count() == 0


def test_chat_turns_of_any_number(spark, monkeypatch):
    """Negative, huge, shared and missing turn numbers; many blocks of one conversation, of one turn even."""
    monkeypatch.setattr(chat, "BLOCK", 8)
    monkeypatch.setattr(chat, "FAN", 2)
    draw = random.Random(8)
    role = lambda: draw.choice(("system", "user", "assistant", "tool"))
    data = [(1, t, role(), f"1/{t}") for t in (-(2**62), -300, -1, 0, 1, 255, 256, 2**62)]
    data += [(2, 0, role(), f"2/{i}") for i in range(120)] + [(3, -i, role(), f"3/{i}") for i in range(70)] + [(4, None, role(), f"4/{i}") for i in range(3)]
    got = chat.repair(spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(5)).collect()
    assert Counter((r["conv_id"], r["turn"], r["role"], r["text"]) for r in got) == Counter(data)
    order = {"assistant": 0, "system": 1, "tool": 2, "user": 3}
    cost = Counter()
    for r in got:
        cost[r["conv_id"]] += r["cost"]
    for c in (1, 2, 3):
        rows_ = sorted((d for d in data if d[0] == c), key=lambda d: (d[1], order[d[2]]))
        assert cost[c] == brute.repair_cost([d[2] for d in rows_])


def test_chat_of_table(spark, given):
    roles = defaultdict(list)
    for c, t, r, x in sorted(set(given["conversations"])):
        roles[c].append(r)
    cost, text = chats(run(spark, "op8_chat_formatting"))
    assert dict(cost) == {c: brute.repair_cost(r) for c, r in roles.items() if brute.repair_cost(r)} | {c: 0 for c in cost if not cost[c]}
    assert set(text) == set(roles) and all(map(legal, text.values()))


# --- neighbours ---


def nearest(vectors, k=20, every=20):
    ids, x = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], np.float64)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        s = neighbours.inner_products(np.repeat(x[q : q + 1], len(x), 0), x)
        order = [j for j in np.lexsort((ids, -s)) if j != q][:k]
        out[int(ids[q])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def answers(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_nearest_of_hard_cases(spark):
    bad = [(20, None), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (80, [None, 1.0]), (100, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (120, [float("inf"), 1.0])]
    good = [(i, [1.0, 0.5]) for i in range(300, 360)] + [(i, [float(i % 3), 1.0]) for i in range(8)]
    df = spark.createDataFrame([(i, v, "e") for i, v in bad + good], "vec_id long, embedding array<double>, part string")
    assert answers(neighbours.search(df)) == nearest(good)
    few = spark.createDataFrame([(i, v) for i, v in good[-3:]] + [(20, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert answers(neighbours.search(few)) == nearest(good[-3:] + [(20, [1.0, 1.0])])
    assert neighbours.search(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(20, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.5, 0.0])], "vec_id long, embedding array<double>")
    assert answers(neighbours.search(twice)) == {20: [(20, 1.0), (3, 0.5)]}


def test_nearest_of_many_equal_vectors(spark, monkeypatch):
    """A third of the rows are one vector; small cells."""
    monkeypatch.setattr(neighbours, "CELL", 50)
    monkeypatch.setattr(neighbours, "QUERIES", 10)
    draw = np.random.default_rng(7)
    same = draw.standard_normal(8)
    vectors = [(i, (same if i % 3 == 0 else draw.standard_normal(8)).tolist()) for i in range(900)]
    got, want = answers(neighbours.search(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"))), nearest(vectors)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    assert got[60] == want[60]


def test_large_parts_are_cut_again(spark, monkeypatch):
    """Parts of clustered vectors get parts of their own; few leaves are looked into, nearly all neighbours met."""
    draw = np.random.default_rng(9)
    centres = draw.standard_normal((150, 24))
    vectors = [(i, (centres[i % 150] + 0.2 * draw.standard_normal(24)).tolist()) for i in range(9000)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(8)
    monkeypatch.setattr(neighbours, "PARTS", 8)
    monkeypatch.setattr(neighbours, "LEAF", 300)
    trees, sought = [], []
    routed = neighbours._routed

    def watched(entries, tree, *rest):
        out = routed(entries, tree, *rest)
        trees.append(tree), sought.append(out)
        return out

    monkeypatch.setattr(neighbours, "_routed", watched)
    got = answers(neighbours.nearest(df, df.where("vec_id % 100 = 0"), rows=1500))
    want = nearest(vectors, every=100)
    assert set(got) == set(want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    leaves = int(trees[0].firsts()[-1])
    assert len(trees[0].below) >= 2 and leaves > trees[0].root.w2.shape[1]
    assert sought[0].count() < 0.5 * leaves * len(want)


def test_leaves_of_vectors_agree_with_their_order():
    draw = np.random.default_rng(10)
    x = draw.standard_normal((400, 6))
    root = neighbours.learn(x, 4)
    tree = neighbours.Tree(root, {1: neighbours.learn(x[root.logits(x).argmax(1) == 1], 2)})
    likely, first = tree.probabilities(x), tree.firsts()
    assert likely.shape[1] == first[-1] and np.allclose(likely.sum(1), 1)
    part, leaf = root.logits(x).argmax(1), tree.homes(x)
    assert (first[part] <= leaf).all() and (leaf < first[part + 1]).all()


def test_recall_on_table(spark, given):
    got, want = answers(run(spark, "op5_ann")), nearest(given["embeddings"])
    assert set(got) == set(want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    table_ = dict(given["embeddings"])
    for q, hits in got.items():
        for i, s in hits:
            assert abs(s - float(np.dot(np.array(table_[q], np.float64), np.array(table_[i], np.float64)))) < 1e-12


def test_parts_are_balanced():
    x = np.random.default_rng(8).standard_normal((640, 16))
    part = neighbours.balanced_parts(neighbours.neighbour_graph(x, 8), 16)
    assert np.bincount(part).tolist() == [40] * 16


# --- scores ---


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize("score", [quality.predictions, toxicity.predictions])
def test_scores_of_hard_cases(score, hard, labels, none):
    got = score(hard, labels).collect()
    assert Counter((r["doc_id"], r["held_out"]) for r in got) == Counter((i, held(i)) for i, _ in HARD)
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (6, 7)}) == 1
    assert score(none, labels).count() == 0
    assert {0 < r["score"] < 1 for r in score(hard, labels.limit(0)).collect()} == {True}


@pytest.mark.parametrize(("name", "label"), [("op9_quality_classifier", 1), ("op1_toxicity", 2)])
def test_held_out_accuracy(spark, name, label):
    path = "/root/testdata/sf0.1"
    if not os.path.isdir(path):
        pytest.skip("no table large enough")
    known = {r[0]: r[label] for r in duckdb.execute(f"SELECT doc_id, quality, toxic FROM '{path}/labels.parquet'").fetchall()}
    got = [(r["predicted"], known[r["doc_id"]]) for r in entry.queries()[name](spark, path).where("held_out").collect() if r["doc_id"] in known]
    assert np.mean([a == b for a, b in got]) >= 0.95
    assert np.mean([a == b for a, b in got if b == (label == 2)]) >= 0.85  # the rarer class


def test_sample_takes_one_row_of_an_id(spark, labels):
    ids = [i for i in range(1, 18) if zlib.crc32(str(i).encode()) % 5]
    docs = [(i, f"text {i}") for i in ids[1:]] + [(ids[0], f"hot {k % 7}") for k in range(500)] + [(None, "none"), (99, "no label")]
    got = [rows(common.labelled_sample(spark.createDataFrame(docs, "doc_id long, text string").repartition(n), labels, "quality", 1000), "text", "label") for n in (1, 7)]
    assert got[0] == got[1] and sorted(t.split()[0] for t, _ in got[0].elements()) == ["hot"] + ["text"] * (len(ids) - 1)


def test_scored_columns_stay(hard, labels):
    forest = quality.train(hard, labels)
    assert set(quality.score(hard, forest).columns) == set(hard.columns) and quality.accepted(hard, labels).columns == [c for c in hard.columns if c != "quality_score"]
    assert set(toxicity.score(hard, toxicity.Model()).columns) == set(hard.columns)


def test_forest_matches_its_trees():
    draw = np.random.default_rng(9)
    x = draw.standard_normal((500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = boosting.fit(x, y, trees=30, depth=3)
    assert ((forest.score(x) > 0.5) == y).mean() > 0.97

    def walk(row):
        total = forest.base
        for f, t, v in zip(forest.feature, forest.threshold, forest.value):
            node = 0
            for _ in range(forest.depth):
                node = 2 * node + (1 if row[f[node]] <= t[node] else 2)
            total += v[node]
        return total

    assert np.allclose(forest.margin(x[:50]), [walk(r) for r in x[:50]])


def test_folding_and_exceptions():
    model = toxicity.Model({" idiot ": 3.0, " boco": 2.0, " idi": 1.0}, [" idiot proof "], (-2.0, 1.0, 1.0))
    m = toxicity.Matcher(model)
    for text in ("an idiot", "AN 1D10T!", "an іdіоt.", "ｉｄｉｏｔ", "id́iot​", "idiot$$$", "ídiot", "ⓘⓓⓘⓞⓣ", "🄸🄳🄸🄾🅃", "𝐢𝐝𝐢𝐨𝐭"):
        assert m.hits(toxicity.fold(text)) == 3.0, text
    assert m.hits(toxicity.fold("idiot proof idiot")) == 3.0  # the first is an exception
    assert m.hits(toxicity.fold("bocö")) == 0.0 and m.hits(toxicity.fold("bocösa idiots")) == 3.0  # beginnings are proper
    assert m.hits(toxicity.fold(None)) == 0.0 and toxicity.fold("1 2 3") == "  "
    same = {"ΚILLΕR": "kiiier", "НATE": "hate", "ΗΑΤΕ": "hate", "$tupid": "stupid", "@ss": "ass", "a $5 b": "a b", "$ x": "x", "х@ppу": "xappy", "한국어 가": "한국어 가", "日本𠮷𠀀": "日本𠮷𠀀", "Ångström": "angstrom", "ﬁne": "fne"}
    assert {t: toxicity.fold(t).strip() for t in same} == same


def test_matcher_against_every_entry():
    """Random lexicons and texts: each word tried with each entry."""
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abi") for _ in range(draw.randrange(1, 6)))
    for _ in range(300):
        weights = {draw.choice((" {} ", " {}")).format(word()): draw.choice((0.5, 1.0, 2.0)) for _ in range(draw.randrange(1, 9))}
        exceptions = [f" {word()} {word()} " for _ in range(draw.randrange(6))]
        words = [word() for _ in range(draw.randrange(25))]
        got = toxicity.Matcher(toxicity.Model(weights, exceptions)).hits(toxicity.fold(" ".join(words)))
        assert got == brute.lexicon_hits(weights, exceptions, words), (weights, exceptions, words)


# --- empty tables, own columns ---


def test_empty_tables(none, spark, labels):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for df in (
        simhash.fingerprint_components(none), simhash.one_per_component(none), decontaminate.contamination(none, items), substrings.report(none), pii.report(none),
        pii.redact(none), bpe.digests(none, tokenizer_path()), sharding.report(none), quality.accepted(none, labels),
    ):
        assert df.count() == 0
