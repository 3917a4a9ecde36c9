import hashlib

import numpy as np
import pytest

from basketlens.operators import segments, sweep
from basketlens.operators.customers import sample_customers
from tests.conftest import TESTDATA
from tests.helpers import rows, scattered


@pytest.fixture(scope="module")
def features(spark):
    table = spark.read.parquet(str(TESTDATA / "sf0.001" / "embeddings.parquet"))
    vectors = table.selectExpr("concat('C', vec_id) as CUST_CODE", "embedding as vector")
    table = segments.assemble(vectors).cache()
    table.count()
    return table


def points(features):
    data = features.orderBy("CUST_CODE").collect()
    return [r[0] for r in data], np.array([r[1].toArray() for r in data])


def test_scoring_picks_the_nearest_centre(features):
    model = segments.fit_segments(features, k=5)
    names, x = points(features)
    centres = np.array(model.clusterCenters())
    nearest = ((x[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
    assert dict(rows(segments.score_segments(features, model))) == dict(zip(names, nearest.tolist()))


@pytest.mark.parametrize("partitions", [None, 4])
def test_labels_do_not_depend_on_the_layout(features, partitions):
    first = rows(segments.score_segments(features, segments.fit_segments(features, 6, partitions=partitions)))
    for parts in (1, 3, 11):
        other = scattered(features, parts)
        assert rows(segments.score_segments(other, segments.fit_segments(other, 6, partitions=partitions))) == first


def test_partitions_do_not_follow_the_rows(features):
    for table in (features, features.limit(1)):
        assert segments.canonical(table).rdd.getNumPartitions() == segments.PARTITIONS
    assert segments.canonical(features, partitions=5).rdd.getNumPartitions() == 5


def test_model_and_scores_are_saved(spark, features, tmp_path):
    path, out = str(tmp_path / "model"), str(tmp_path / "scores")
    model = segments.fit_segments(features, 4, save_path=path)
    scored = segments.score_segments(features, segments.load_segments(path), save_path=out)
    assert scored.columns == ["CUST_CODE", "CLUSTER_NUM"]
    assert rows(scored) == rows(segments.score_segments(features, model)) == rows(spark.read.parquet(out))
    segments.fit_segments(features, 3, save_path=path)
    assert len(segments.load_segments(path).clusterCenters()) == 3


def python_silhouette(x, labels):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    scores = []
    for i, label in enumerate(labels):
        same = labels == label
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == o].mean() for o in set(labels.tolist()) - {label})
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


def plain_lloyd(x, centres, max_iter=20, tolerance=1e-4):
    for _ in range(max_iter):
        at = ((x[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[at == c].mean(axis=0) if (at == c).any() else centres[c] for c in range(len(centres))])
        moved = ((new - centres) ** 2).sum(axis=1).max()
        centres = new
        if moved <= tolerance**2:
            break
    return centres


def test_sweep(spark, features):
    """Every k as a fit of its own from the same starts."""
    renamed = features.withColumnRenamed("features", "x")
    before = cached(spark)
    result = {r["k"]: r for r in segments.kmeans_sweep(renamed, k_max=5, features="x").collect()}
    assert sorted(result) == [2, 3, 4, 5]
    names, x = points(features)
    inside = {r["CUST_CODE"] for r in sample_customers(features, 0.5, seed=1).collect()}
    order = sorted(inside, key=lambda c: (int(hashlib.md5(f"1:{c}".encode()).hexdigest()[:8], 16), c))
    starts = sweep.spread_starts(np.array([x[names.index(c)] for c in order[: sweep.START_ROWS]]), 5, 1)
    sampled = np.array([n in inside for n in names])
    for k, row in result.items():
        centres = plain_lloyd(x[sampled], starts[:k])
        distance = ((x[:, None, :] - centres) ** 2).sum(axis=2)
        assert row["silhouette"] == pytest.approx(python_silhouette(x, distance.argmin(axis=1)), abs=1e-6)
        assert row["training_cost"] == pytest.approx(distance.min(axis=1)[sampled].sum())
    assert rows(segments.kmeans_sweep(scattered(renamed), k_max=5, features="x")) == rows_of(result)
    assert cached(spark) == before


def test_sweep_of_few_and_equal_vectors(spark):
    same = spark.createDataFrame([(f"C{i}", [1.0, 2.0]) for i in range(30)], "CUST_CODE string, vector array<double>")
    got = segments.kmeans_sweep(segments.assemble(same), k_max=3).collect()
    assert [tuple(r) for r in got] == [(2, 0.0, 0.0), (3, 0.0, 0.0)]
    assert segments.kmeans_sweep(segments.assemble(same.limit(0)), k_max=3).count() == 0


def test_starts_are_spread():
    rows_ = np.array([[0.0, 0.0]] * 50 + [[9.0, 9.0]] * 50 + [[0.0, 9.0]])
    assert {tuple(r) for r in sweep.spread_starts(rows_, 3, 1)} == {(0.0, 0.0), (9.0, 9.0), (0.0, 9.0)}
    assert len(sweep.spread_starts(rows_, 5, 2)) == 5


def test_nearest_centroid_and_closed_silhouettes(spark):
    random = np.random.default_rng(3)
    x = random.normal(size=(60, 4)).astype(np.float32)
    labels = random.integers(0, 4, 60)
    labels[7] = 9
    data = [(f"C{i}", x[i].tolist(), int(labels[i])) for i in range(60)]
    table = spark.createDataFrame(data, "CUST_CODE string, vector array<float>, CLUSTER_NUM int")
    means = segments.centroids(table)
    known = {r["CLUSTER_NUM"]: np.array(r["vector"]) for r in means.collect()}
    for c, mean in known.items():
        np.testing.assert_allclose(mean, x[labels == c].mean(axis=0), rtol=1e-5)
    order = sorted(known)
    distance = np.array([((x - known[c]) ** 2).sum(axis=1) for c in order])
    assert dict(rows(segments.nearest_centroid(table, means))) == {f"C{i}": order[distance[:, i].argmin()] for i in range(60)}
    missing = spark.createDataFrame([("N", None)], "CUST_CODE string, vector array<float>")
    assert [tuple(r) for r in segments.nearest_centroid(missing, means).collect()] == [("N", None)]
    scored = segments.silhouettes(table)
    assert scored.columns == [*table.columns, "silhouette"]
    mean = scored.agg({"silhouette": "avg"}).first()[0]
    assert mean == pytest.approx(python_silhouette(x.astype(float), labels), abs=1e-9)
    assert {r["CLUSTER_NUM"]: r["n_rows"] for r in segments.silhouette_by_segment(table).collect()}[9] == 1
    one = segments.silhouettes(table.where("CLUSTER_NUM = 1"))
    assert {r["silhouette"] for r in one.collect()} == {0.0}


def cached(spark):
    return spark.sparkContext._jsc.sc().getPersistentRDDs().size()


def rows_of(sweep):
    return sorted((tuple(r) for r in sweep.values()), key=lambda r: tuple((False, str(v)) for v in r))
