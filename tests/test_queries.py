"""Every registered query against its SQL counterpart, on whole tables."""

import inspect
import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from basketlens.operators import vectors
from basketlens.plans.stages import Settings
from tests.compare import compare, connect
from tests.conftest import TESTDATA

SF = TESTDATA / "sf0.001"
SQL = __spark_entry__.oracle_sql()
QUERIES = __spark_entry__.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_exact(spark, duck, name):
    assert compare(QUERIES[name](spark, str(SF)), duck, SQL[name]) > 0


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert 0 < len(rows) <= 7
    known = __spark_entry__.queries()["customer_total"](spark, str(SF)).first()[0]
    assert sum(r["TOT_CUSTS"] for r in rows) == known


@pytest.mark.parametrize(
    "name, dim", [("customer_vectors_dbow", 32), ("customer_vectors_dm", 32), ("product_vectors_dm", 32), ("customer_vectors_full_size", 256)]
)
def test_vectors_are_whole_and_finite(spark, name, dim):
    table = QUERIES[name](spark, str(SF)).persist()
    key = table.columns[0]
    bad = F.exists("vector", lambda x: F.isnan(x) | x.isNull() | (F.abs(x) > 1e6))
    assert table.where(bad | (F.size("vector") != dim)).count() == 0
    assert table.select(key).distinct().count() == table.count()
    if key == "CUST_CODE":
        assert table.count() == QUERIES["customer_documents"](spark, str(SF)).count()
    table.unpersist()


def test_training_history_falls(spark):
    loss = [r["loss"] for r in QUERIES["training_history"](spark, str(SF)).orderBy("epoch").collect()]
    assert len(loss) == 4 and loss[-1] < loss[0] <= math.log(500) * 1.1


def test_kmeans_queries(spark):
    scored = QUERIES["kmeans_segments"](spark, str(SF)).collect()
    assert len(scored) == 500 and {r["CLUSTER_NUM"] for r in scored} <= set(range(7))
    sweep = QUERIES["kmeans_sweep"](spark, str(SF)).orderBy("k").collect()
    assert [r["k"] for r in sweep] == list(range(2, 26))
    assert all(-1 <= r["silhouette"] <= 1 and r["training_cost"] > 0 for r in sweep)


def test_learned_segments_take_the_sizes_of_the_standard_run(spark, monkeypatch):
    """The training is asked for, not run: it takes 250 epochs."""

    class Asked(Exception):
        pass

    def asked(*args, **kwargs):
        raise Asked({k: v for k, v in signature.bind(*args, **kwargs).arguments.items() if k != "docs"})

    signature, run = inspect.signature(vectors.train_vectors), Settings()
    monkeypatch.setattr(vectors, "train_vectors", asked)
    with pytest.raises(Asked) as found:
        QUERIES["learned_segment_kpis"](spark, str(SF))
    sizes = {name: getattr(run, name) for name in ("num_prods", "window", "dim", "epochs", "patience")}
    assert found.value.args[0] == sizes | {"method": "dbow"}
    assert (run.num_prods, run.dim, run.epochs) == (4000, 256, 250)
