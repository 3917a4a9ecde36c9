"""Customers, vocabulary, documents and windows against plain Python on small tables."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketlens.operators import customers, documents, vocabulary, windows
from tests.helpers import lines, purchases, rows, scattered


@pytest.fixture(scope="module")
def trade(spark):
    random.seed(3)
    data = [
        (f"C{random.randrange(40)}", f"B{i // 3}", f"P{int(random.paretovariate(0.6)) % 60}") for i in range(1500)
    ]
    # One customer and one product hold a third of all lines, some lines are anonymous or have no product.
    data += [("HOT", f"H{i}", f"P{i % 70}") for i in range(800)]
    data += [(f"C{i % 40}", f"B{i}", "P1") for i in range(800)]
    data += [(None, "B1", "P5"), (None, "B2", "P6"), ("C1", "B3", None), ("ONLYNULL", "B4", None)]
    return purchases(spark, data), [d for d in data if d[0] is not None]


def python_documents(data, num_prods):
    counts = Counter(p for _, _, p in data if p is not None)
    order = sorted(counts, key=lambda p: (-counts[p], p))[: num_prods - 1]
    index = {p: i + 1 for i, p in enumerate(order)}
    docs = {}
    for c, _, p in data:
        docs.setdefault(c, set())
        if p is not None:
            docs[c].add(p)
    return index, counts, {c: sorted(index.get(p, 0) for p in ps) for c, ps in docs.items()}


def whole(docs):
    return {r[0]: r[1] for r in docs.select("CUST_CODE", documents.sequence()).collect()}


@pytest.mark.parametrize("num_prods", [1, 2, 10, 1000])
def test_vocabulary_and_documents(trade, num_prods):
    df, data = trade
    index, counts, want = python_documents(data, num_prods)
    for table in (df, scattered(df)):
        vocab = vocabulary.vocabulary(table, num_prods)
        assert {r["PROD_CODE"]: (r["prod_idx"], r["n_rows"]) for r in vocab.collect()} == {
            p: (i, counts[p]) for p, i in index.items()
        }
        assert whole(documents.customer_documents(table, vocab, num_prods)) == want
        unknown = sum(d.count(0) for d in want.values())
        assert rows(vocabulary.oov_summary(table, vocab, num_prods)) == [(sum(map(len, want.values())), unknown)]


def test_no_broadcast_is_forced(trade):
    df, data = trade
    docs = documents.customer_documents(df, vocabulary.vocabulary(df, 10), 10)
    assert "ResolvedHint (strategy=broadcast)" not in docs._jdf.queryExecution().analyzed().toString()


def test_anonymous_lines_on_request(spark):
    df = purchases(spark, [("C", "B", "A"), (None, "B2", "A"), (None, "B3", "Z")])
    vocab = vocabulary.vocabulary(df, 3, keep_anonymous=True)
    assert rows(vocabulary.oov_summary(df, vocab, 3, keep_anonymous=True)) == [(3, 0)]
    assert rows(vocabulary.oov_summary(df, vocab, 3)) == [(1, 0)]
    assert rows(customers.customer_index(df, keep_anonymous=True), "cust_idx", "CUST_CODE") == [(0, None), (1, "C")]
    assert rows(customers.customer_index(df)) == [("C", 0)]


def test_placeholder_word_is_an_ordinary_product(spark):
    df = purchases(spark, [("C", "B", "UNK"), ("C", "B", "UNK"), ("C", "B", "A"), ("C", "B", "Z")])
    vocab = vocabulary.vocabulary(df, 3)
    assert rows(vocab) == [("A", 2, 1), ("UNK", 1, 2)]
    assert whole(documents.customer_documents(df, vocab, 3)) == {"C": [0, 1, 2]}


def test_empty_vocabulary_is_an_error(trade):
    with pytest.raises(ValueError):
        vocabulary.vocabulary(trade[0], 0)


def test_document_of_a_hot_customer_stays_within_the_vocabulary(spark):
    df = purchases(spark, [("HOT", "B", f"P{i:05}") for i in range(5000)])
    docs = documents.customer_documents(df, vocabulary.vocabulary(df, 10), 10)
    row = docs.first()
    assert (row["n_unknown"], row["prod_idxs"]) == (4991, list(range(1, 10)))


def one_document(spark, n, num_prods=100):
    df = purchases(spark, [("C", "B", f"P{i:02}") for i in range(n)])
    return documents.customer_documents(df, vocabulary.vocabulary(df, num_prods), num_prods)


def test_window_boundary(spark):
    assert windows.dm_pairs(one_document(spark, 8), 8).count() == 0
    assert windows.dbow_pairs(one_document(spark, 8), 8).count() == 0
    assert rows(windows.dm_pairs(one_document(spark, 9), 8)) == [("C", 4, [1, 2, 3, 4, 6, 7, 8, 9], 5)]
    assert rows(windows.dbow_pairs(one_document(spark, 9), 8)) == [("C", 0, list(range(1, 9)))]
    assert rows(windows.dbow_pairs(one_document(spark, 9), 8, include_last=True)) == [
        ("C", 0, list(range(1, 9))),
        ("C", 1, list(range(2, 10))),
    ]


@pytest.mark.parametrize("window", [2, 4, 8])
@pytest.mark.parametrize("num_prods", [5, 40])
def test_all_windows(trade, window, num_prods):
    df, data = trade
    docs = documents.customer_documents(df, vocabulary.vocabulary(df, num_prods), num_prods)
    want = python_documents(data, num_prods)[2]
    half = window // 2
    dm, dbow = [], []
    for c, d in want.items():
        if len(d) > window:
            dm += [(c, t, d[t - half : t] + d[t + 1 : t + half + 1], d[t]) for t in range(half, len(d) - half)]
            dbow += [(c, s, d[s : s + window]) for s in range(len(d) - window)]
    assert rows(windows.dm_pairs(docs, window)) == rows_of(dm)
    assert rows(windows.dbow_pairs(docs, window)) == rows_of(dbow)


def rows_of(data):
    return sorted(data, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_epoch_sample_draws_one_window_each(trade):
    df, _ = trade
    docs = documents.customer_documents(df, vocabulary.vocabulary(df, 40), 40)
    pairs = {(c, p): (x, t) for c, p, x, t in rows(windows.dm_pairs(docs, 4))}
    eligible = {c for c, _ in pairs}
    seen = {}
    for epoch in range(6):
        sample = windows.epoch_sample(docs, 4, "dm", epoch, seed=9)
        assert rows(sample) == rows(windows.epoch_sample(scattered(docs), 4, "dm", epoch, seed=9))
        got = {r["CUST_CODE"]: (r["pos"], r["context"], r["target"]) for r in sample.collect()}
        assert set(got) == eligible
        for c, (p, x, t) in got.items():
            assert pairs[c, p] == (x, t)
            seen.setdefault(c, set()).add(p)
    assert len(seen["HOT"]) > 1


def test_bad_windows(trade):
    docs = one_document(trade[0].sparkSession, 3)
    with pytest.raises(ValueError):
        windows.dm_pairs(docs, 3)
    with pytest.raises(ValueError):
        windows.dbow_pairs(docs, 0)
    with pytest.raises(ValueError):
        windows.epoch_sample(docs, 2, "other")


def test_sample_keeps_whole_customers(trade):
    df, data = trade
    names = {c for c, _, _ in data}
    chosen = {c for c in names if int(hashlib.md5(f"42:{c}".encode()).hexdigest()[:8], 16) < 0.5 * 2**32}
    assert 0 < len(chosen) < len(names)
    for table in (df, scattered(df)):
        assert rows(customers.sample_customers(table, 0.5), "CUST_CODE", "BASKET_ID", "PROD_CODE") == rows_of(
            [d for d in data if d[0] in chosen]
        )
    assert customers.sample_customers(df, 0.0).count() == 0
    assert customers.sample_customers(df, 1.0).count() == len(data)
    with pytest.raises(ValueError):
        customers.sample_customers(df, 1.5)


@pytest.mark.parametrize("digits", [1, 3])
def test_customer_index_is_dense_and_stable(trade, digits):
    df, data = trade
    index = customers.customer_index(df, digits)
    names = {c for c, _, _ in data}
    got = rows(index)
    assert sorted(i for _, i in got) == list(range(len(names))) and {c for c, _ in got} == names
    assert rows(customers.customer_index(scattered(df), digits)) == got
    docs = documents.customer_documents(df, vocabulary.vocabulary(df, 10), 10)
    assert rows(customers.to_code(customers.to_index(docs, index), index).select(docs.columns)) == rows(docs)


def test_anonymous_lines_are_kept_on_request(spark):
    df = lines(spark, [{"CUST_CODE": None, "PROD_CODE": "A"}, {"CUST_CODE": "C", "PROD_CODE": "A"}])
    assert rows(vocabulary.vocabulary(df, 2)) == [("A", 1, 1)]
    assert rows(vocabulary.vocabulary(df, 2, keep_anonymous=True)) == [("A", 1, 2)]


@pytest.mark.parametrize("unfold, column", [(windows.dm_pairs, "target_pos"), (windows.dbow_pairs, "start_pos")])
def test_windows_of_a_very_long_document_are_spread(spark, unfold, column):
    docs = spark.createDataFrame([("HOT", 1_000_000, [1, 2]), ("C", 3, [4, 5, 6])], "CUST_CODE string, n_unknown int, prod_idxs array<int>")
    pairs = unfold(docs, 4).withColumn("task", F.spark_partition_id())
    got = pairs.groupBy("CUST_CODE").agg(F.count("*").alias("n"), F.countDistinct("task").alias("tasks"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
    found = {r["CUST_CODE"]: r for r in got}
    assert found["HOT"]["n"] == found["HOT"]["high"] - found["HOT"]["low"] + 1 == 1_000_002 - 4
    assert found["C"]["n"] == 2 and found["HOT"]["tasks"] > 1


def test_windows_of_one_pass_are_those_of_the_epochs(spark):
    docs = spark.createDataFrame([("A", 2, [1, 2, 3, 4, 7, 9]), ("B", 0, [1, 2, 3, 5, 8])], "CUST_CODE string, n_unknown int, prod_idxs array<int>")
    for method in windows.METHODS:
        got = {r["CUST_CODE"]: r for r in windows.epoch_windows(docs, 4, method, 2, 1, 3).collect()}
        for i in range(3):
            for r in windows.epoch_sample(docs, 4, method, 6 + i, 1).collect():
                assert got[r["CUST_CODE"]]["contexts"][4 * i : 4 * i + 4] == r["context"]
                assert r["target"] is None or got[r["CUST_CODE"]]["targets"][i] == r["target"]


def dated(spark):
    random.seed(8)
    data = [(f"C{random.randrange(9)}", f"P{random.randrange(30)}", random.choice([None, *range(12)])) for _ in range(400)]
    data += [("HOT", f"P{i % 3000:04}", (i * 7) % 1000) for i in range(9000)] + [("NONE", None, 3), (None, "P1", 1), ("C1", None, 0)]
    return spark.createDataFrame(data, "CUST_CODE string, PROD_CODE string, day int"), data


def python_dated(data, index):
    first = {}
    for c, p, day in data:
        if c is not None:
            docs = first.setdefault(c, {})
            if p is not None:
                docs[p] = min(docs.get(p, 10**9), 10**9 if day is None else day)
    return {c: [index.get(p, 0) for p in sorted(d, key=lambda p: (d[p], p))] for c, d in first.items()}


def test_documents_by_first_purchase(spark, monkeypatch):
    """Also of a customer with thousands of unknown products, and in blocks that are far shorter than its document."""
    df, data = dated(spark)
    vocab = vocabulary.vocabulary(df, 20)
    index = {r["PROD_CODE"]: r["prod_idx"] for r in vocab.collect()}
    want = python_dated(data, index)
    docs = documents.customer_documents(df, vocab, 20, order_by="day").cache()
    got = {r[0]: r[1] for r in docs.select("CUST_CODE", documents.sequence(ordered=True)).collect()}
    assert got == want and got["NONE"] == []
    for r in docs.collect():
        assert r["n_unknown"] == want[r["CUST_CODE"]].count(0) and len(r["unknown_runs"]) <= len(r["prod_idxs"]) + 1 <= 21
    monkeypatch.setattr(windows, "BLOCK", 64)
    pairs = Counter((r[0], r[1], tuple(r[2]), r[3]) for r in windows.dm_pairs(docs, 4).collect())
    assert pairs == Counter((c, p, (*d[p - 2 : p], *d[p + 1 : p + 3]), d[p]) for c, d in want.items() if len(d) > 4 for p in range(2, len(d) - 2))
    ahead = Counter((r[0], r[1], tuple(r[2])) for r in windows.dbow_pairs(docs, 4, include_last=True).collect())
    assert ahead == Counter((c, p, tuple(d[p : p + 4])) for c, d in want.items() if len(d) > 4 for p in range(len(d) - 3))
    for r in windows.epoch_sample(docs, 4, "dm", 2).collect():
        d = want[r["CUST_CODE"]]
        assert r["target"] == d[r["pos"]] and r["context"] == d[r["pos"] - 2 : r["pos"]] + d[r["pos"] + 1 : r["pos"] + 3]
    docs.unpersist()


def test_unknown_products_are_counted_before_lists_are_gathered(spark):
    lines = [(c, f"P{i}") for c, n in (("A", 300), ("B", 2), ("E", 3)) for i in range(n)] * 2
    lines += [("A", None), ("D", None), (None, "P1"), ("E", "X")]
    df = spark.createDataFrame(lines, "CUST_CODE string, PROD_CODE string")
    vocab = spark.createDataFrame([("P0", 2), ("P1", 1), ("X", 2)], "PROD_CODE string, prod_idx int")  # two codes of one index
    docs = documents.customer_documents(df, vocab, 3)
    assert {r[0]: tuple(r)[1:] for r in docs.collect()} == {"A": (298, [1, 2]), "B": (0, [1, 2]), "D": (0, []), "E": (1, [1, 2, 2])}
    assert docs.dtypes == [("CUST_CODE", "string"), ("n_unknown", "int"), ("prod_idxs", "array<int>")]
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[CUST_CODE#\d+, prod_idx#\d+\]", plan)
