"""WARC, vectors, components and the pipeline."""

import base64
import gzip
import hashlib
import io
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketlens.llm import ann, embdedup, warc
from basketlens.llm.common import store
from basketlens.llm.components import components
from tests.conftest import TESTDATA
from tests.llm.fixtures import documents

SF = str(TESTDATA / "sf0.001")


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_warc_round_trip(spark):
    rows = [(3, "http://x/ a", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "http://x/", None), (5, "u", ""), (4, "u", "\r\n\r\nWARC/1.1\r\n" * 50), (7, "u", "x" * 300_000), (None, "u", "alone"), (4, "u", "\r\n\r\nWARC/1.1\r\n" * 50)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, path string")
    got = warc.round_trip(pages).collect()
    first = {}
    for i, _, html in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(html or "", i)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        rep = first.get(html or "", i)
        want.append((i, len(data), digest(data), "response" if rep == i else "revisit", None if rep == i else rep))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_normalising_leaves_its_input(spark):
    """A repeated attempt finds every file again; archive() deletes them once the index is written."""
    pages = spark.createDataFrame([(i, "u", "x" * i) for i in range(20)], "page_id long, url string, html string")
    files = warc.write_monolithic(warc.decided(pages), warc.shared_folder(spark, "warc-raw"), file_bytes=2000)
    both = [warc.normalise(files, warc.shared_folder(spark, "warc")) for _ in range(2)]
    first, again = (sorted(tuple(r) for r in warc.read_records(archives).drop("content").collect()) for archives in both)
    assert first == again and [r[0] for r in first] == list(range(20))


def test_archives_and_sidecars_are_enough(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 700)  # several ranges of an archive, records across their borders
    rng = np.random.default_rng(2)
    pages = spark.createDataFrame([(i, "u", rng.bytes(i * 20).hex()) for i in range(40)], "page_id long, url string, html string")
    folder = warc.shared_folder(spark, "warc")
    written = warc.normalise(warc.write_monolithic(warc.decided(pages), warc.shared_folder(spark, "warc-raw"), file_bytes=9000), folder)
    found = warc.archives_in(spark, folder)
    assert {r["bytes"] for r in found.collect()} == {r["bytes"] for r in written.collect()} and written.agg(F.sum("n_records")).first()[0] == 40
    got = {r["page_id"]: bytes(r["content"]) for r in warc.read_records(found).collect()}
    assert got == {r["page_id"]: r["html"].encode() for r in pages.collect()}
    fs, path = store(found.first()["path"])
    fs.delete_file(path.replace(warc.ARCHIVE, warc.SIDECAR))
    with pytest.raises(Exception, match="(?i)no such file|not exist|FileNotFound"):
        warc.read_records(found).collect()


def test_streams_of_any_cut():
    records = [warc.record(i, "http://x", b"y" * n) for i, n in enumerate((0, 10, 3_000_000))]
    whole = gzip.compress(b"".join(records[:2])) + gzip.compress(records[2])
    assert list(warc.split_records(warc.Inflated(io.BytesIO(whole)))) == records
    with pytest.raises(ValueError):
        list(warc.split_records(warc.Inflated(io.BytesIO(whole[:-2000]))))


def vectors(spark, n=600, dim=16):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[100:140] = x[100] + rng.normal(size=(40, dim)) * 0.05
    x[200:230] = x[200]
    x[300] = 3 * x[301]
    rows = [(i, [float(v) for v in r], i % 3) for i, r in enumerate(x)]
    rows += [(n, None, 0), (n + 1, [0.0] * dim, 0), (n + 2, [float("nan")] * dim, 0), (n + 3, [1.0, None] * (dim // 2), 0), (n + 4, [1.0], 0), rows[7]]
    return x.astype(np.float64), spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)


def test_nearest(spark):
    x, table = vectors(spark)
    got = ann.nearest(table, table.where("vec_id % 20 = 0"), 20).collect()
    asked = range(0, len(x), 20)
    products = np.array([[reduce(lambda s, p: s + p[0] * p[1], zip(x[q].tolist(), v), 0.0) for v in x.tolist()] for q in asked])
    found, want = set(), set()
    for q, row in zip(asked, products):
        order = [i for i in sorted(range(len(x)), key=lambda i: (-row[i], i)) if i != q][:20]
        want |= {(q, i) for i in order}
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        assert all(r["score"] == row[r["vec_id"]] for r in mine)
        found |= {(q, r["vec_id"]) for r in mine}
    assert {r["query_id"] for r in got} == set(asked)
    assert len(found & want) >= 0.9 * len(want)
    assert ann.nearest(table.limit(0), table, 5).count() == 0
    assert sorted(r["vec_id"] for r in ann.nearest(table.where("vec_id < 4"), table.where("vec_id = 1"), 20).collect()) in ([0, 2, 3], [0, 2], [2, 3], [0, 3])


def test_all_candidates_where_there_are_few(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 4)  # several blocks
    x, table = vectors(spark)
    for n in (4, 10, 21):
        got = ann.nearest(table.where(f"vec_id < {n}"), table.where(f"vec_id < {n}"), 20).collect()
        for q in range(n):
            order = sorted((i for i in range(n) if i != q), key=lambda i: (-reduce(lambda s, p: s + p[0] * p[1], zip(x[q].tolist(), x[i].tolist()), 0.0), i))[:20]
            assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == order


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    x = np.array([r["embedding"] for r in table.orderBy("vec_id").collect()], np.float64)
    got = {(r["query_id"], r["vec_id"]) for r in ann.nearest(table, table.where("vec_id % 20 = 0"), 20).collect()}
    want = set()
    for q in range(0, len(x), 20):
        row = x @ x[q]
        row[q] = -9
        want |= {(q, int(i)) for i in np.argsort(-row)[:20]}
    assert len(got & want) >= 0.9 * len(want)


def test_embedding_groups(spark, monkeypatch):
    monkeypatch.setattr(embdedup, "BLOCK", 25)  # several blocks in a cell
    x, table = vectors(spark)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    got = embdedup.near_groups(table)
    assert got.count() == table.count()
    rows = {r["vec_id"]: r for r in got.collect()}
    linked = [i for i in range(len(x)) if near[i].any()]
    assert sum(rows[i]["n_links"] for i in linked) >= 0.99 * near.sum()
    assert all(rows[i]["n_links"] <= near[i].sum() for i in range(len(x)))
    assert np.mean([rows[i]["component_id"] == label[i] for i in linked]) >= 0.99
    for i in range(len(x), len(x) + 5):
        assert tuple(rows[i]) == (i, 0, i, True)
    assert embdedup.near_groups(table.limit(0)).count() == 0


def test_links_of_a_large_near_group_are_whole(spark, tmp_path):
    """A third of the rows lies in one near group of different vectors, which k-means spreads over many cells."""
    rng = np.random.default_rng(5)
    n, dim, hot = 30_000, 64, 10_000
    x = rng.normal(size=(n, dim))
    x[:hot] = rng.normal(size=dim) + rng.normal(size=(hot, dim)) * 0.29
    x = x.astype(np.float32).astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = np.concatenate([(unit[i : i + 1000] @ unit.T >= 0.9).sum(axis=1) - 1 for i in range(0, n, 1000)])
    assert 5_000 * hot < want.sum() < hot * hot
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": list(x.astype(np.float32))}), tmp_path / "x.parquet")
    got = embdedup.near_groups(spark.read.parquet(str(tmp_path / "x.parquet")).repartition(8)).orderBy("vec_id").toPandas()
    assert (got["n_links"].to_numpy() == want).all()
    assert (got["component_id"].to_numpy()[:hot][want[:hot] > 0] == 0).all()


def test_a_chain_over_slices_is_one_group():
    """Links of one block that are found in different slices of rows."""
    angle = np.zeros(600)
    angle[[0, 300, 500]] = 0.0, 0.4, 0.8
    x = np.zeros((600, 602))
    x[np.arange(600), np.arange(600) + 2] = 1.0
    for i in (0, 300, 500):
        x[i] = 0
        x[i, :2] = np.cos(angle[i]), np.sin(angle[i])
    ids = np.arange(600) + 10
    ids[[0, 300, 500]] = 5, 7, 3
    found = {i: (n, label) for i, n, label in zip(*(v.tolist() for v in embdedup.meet((ids, np.ones(600, np.int64), x), None, 0.9)))}
    assert found == {5: (1, 3), 7: (2, 3), 3: (1, 3)}


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 9), (9, 9), (20, 21), (21, 22), (22, 20), (None, 3), (7, None)] + [(100 + i, 101 + i) for i in range(40)] + [(1000, 2000 + i) for i in range(30)]
    got = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {3: 3, 4: 3, 5: 3, 9: 3, 20: 20, 21: 20, 22: 20, 1000: 1000} | {100 + i: 100 for i in range(41)} | {2000 + i: 1000 for i in range(30)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark):
    """Each stage over what the one before kept; the last gives a row per row of the mix."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).persist()
        assert out.columns == docs.columns, name
        kept = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert kept <= ids and kept
        if name == "quality":
            good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
            assert len(good - kept) <= 0.02 * len(good)
        if name == "line_dedup":
            assert out.count() == docs.count()
        ids, docs = kept, out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() and last.where("n_tokens = 0").count() <= docs.where(F.trim("text") == "").count()


def test_stages_take_odd_and_empty_tables(spark):
    for table in (documents(spark, n=6), documents(spark).limit(0)):
        docs = table
        for name, stage in corpus_pipeline.STAGES[1:]:
            docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert (docs.count() == 0) == table.isEmpty()
