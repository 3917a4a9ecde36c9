"""The trainer: gradients, equality with one plain sequential run, rounds of blocks, combined copies, and the loop."""

import hashlib
import math
import pathlib
import urllib.parse

import numpy as np
import pyarrow as pa
import pytest
from pyarrow import parquet
from pyspark.sql import functions as F

from basketlens.operators import rotation, sgd, vectors, windows
from tests.helpers import left_over, rows, scattered, shuffle_files

WINDOW, PRODS, DIM = 4, 12, 6
SMALL = {"window": WINDOW, "dim": DIM, "rate": 0.05}


@pytest.fixture(scope="module")
def docs(spark):
    """Two kinds of customers, each buying from its own half of the vocabulary; one has too few products."""
    random = np.random.default_rng(5)
    data = [("SHORT", 1, [3])]
    for i in range(150):
        half = range(1, 7) if i % 2 else range(6, 12)
        items = sorted(random.choice(list(half), 5, replace=False).tolist())
        data.append((f"C{i:03}", int(random.integers(0, 3)), items))
    return spark.createDataFrame(data, "CUST_CODE string, n_unknown int, prod_idxs array<int>").cache()


def batch(method, n=7):
    random = np.random.default_rng(1)
    model = {
        "W": random.normal(size=(PRODS, DIM)),
        "b": random.normal(size=PRODS),
        "E": random.normal(size=(PRODS, DIM)),
    }
    inputs = random.integers(0, PRODS, (n, WINDOW)) if method == "dm" else None
    targets = random.integers(0, PRODS, (n, 1 if method == "dm" else WINDOW))
    return model, random.normal(size=(n, DIM)), inputs, targets


def loss_of(model, vectors_, inputs, targets):
    total = 0.0
    for i, v in enumerate(vectors_):
        h = v if inputs is None else np.mean([v, *model["E"][inputs[i]]], axis=0)
        z = model["W"] @ h + model["b"]
        total += np.mean([math.log(np.exp(z).sum()) - z[t] for t in targets[i]])
    return total / len(vectors_)


@pytest.mark.parametrize("method", ["dm", "dbow"])
def test_gradients_and_loss(method):
    model, v, inputs, targets = batch(method)
    rate, eps = 1.0, 1e-6
    new = {k: a.copy() for k, a in model.items()}
    speed = {k: np.zeros_like(a) for k, a in model.items()}
    rule = sgd.Nesterov(rate, 0.0)
    v_new = v.copy()
    loss, _ = sgd.train_batch(new, speed, rule, v_new, np.zeros_like(v), inputs, targets)
    assert loss / len(v) == pytest.approx(loss_of(model, v, inputs, targets))

    def slope(array, where):
        array[where] += eps
        up = loss_of(model, v, inputs, targets)
        array[where] -= 2 * eps
        down = loss_of(model, v, inputs, targets)
        array[where] += eps
        return (up - down) / (2 * eps)

    for name in ("W", "E") if method == "dm" else ("W",):
        for where in [(0, 0), (3, 2), (11, 5), (7, 1)]:
            assert model[name][where] - new[name][where] == pytest.approx(slope(model[name], where), abs=1e-6)
    for where in range(PRODS):
        assert model["b"][where] - new["b"][where] == pytest.approx(slope(model["b"], where), abs=1e-6)
    for where in [(0, 0), (6, 5), (2, 3)]:
        assert v[where] - v_new[where] == pytest.approx(slope(v, where), abs=1e-6)


def test_nesterov_step():
    value, velocity = np.array([1.0]), np.array([2.0])
    sgd.Nesterov(0.1, 0.5).step(value, velocity, np.array([3.0]))
    assert velocity == pytest.approx(0.5 * 2 - 0.1 * 3)
    assert value == pytest.approx(1 + 0.5 * velocity - 0.1 * 3)


def test_minibatches_ignore_the_incoming_sizes():
    def split(sizes):
        start = 0
        for s in sizes:
            yield pa.RecordBatch.from_pydict({"x": pa.array(range(start, start + s), pa.int64())})
            start += s

    for sizes in ([10], [3, 0, 7], [1] * 10):
        assert [t["x"].to_pylist() for t in sgd.minibatches(split(sizes), 4)] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
    assert list(sgd.minibatches(split([]), 4)) == []


def plain_run(docs, method, epochs, seed=1, batch_size=32):
    """The same training as one loop over customers in code order."""
    shared = vectors._start_shared(PRODS, DIM, method, seed)
    speed = {k: np.zeros_like(a) for k, a in shared.items()}
    start = docs.select("CUST_CODE", vectors.start_vector(DIM, seed).alias("v")).collect()
    v = {r[0]: np.array(r[1], np.float32) for r in start}
    velocity = {c: np.zeros(DIM, np.float32) for c in v}
    rule = sgd.Nesterov(np.float32(SMALL["rate"]), np.float32(0.9))
    losses = []
    for epoch in range(epochs):
        examples = windows.epoch_sample(docs, WINDOW, method, epoch, seed).orderBy("CUST_CODE").collect()
        total = 0.0
        for i in range(0, len(examples), batch_size):
            part = examples[i : i + batch_size]
            names = [r["CUST_CODE"] for r in part]
            context = np.array([r["context"] for r in part])
            inputs, targets = (context, np.array([[r["target"]] for r in part])) if method == "dm" else (None, context)
            a, b = np.stack([v[c] for c in names]), np.stack([velocity[c] for c in names])
            loss, _ = sgd.train_batch(shared, speed, rule, a, b, inputs, targets, batch_size)
            v.update(zip(names, a))
            velocity.update(zip(names, b))
            total += loss
        losses.append(total / len(examples))
    return v, shared, losses


@pytest.mark.parametrize("method", ["dm", "dbow"])
def test_one_partition_equals_a_plain_run(docs, method):
    v, shared, losses = plain_run(docs, method, 3)
    model = vectors.train_vectors(docs, PRODS, method, epochs=3, partitions=1, **SMALL)
    got = dict(rows(model.customer_vectors))
    assert set(got) == set(v)
    for c in v:
        np.testing.assert_allclose(got[c], v[c], rtol=1e-4, atol=1e-6)
    weights = {r["prod_idx"]: r for r in model.output_weights.collect()}
    np.testing.assert_allclose([weights[i]["vector"] for i in range(PRODS)], shared["W"], rtol=1e-4, atol=1e-6)
    np.testing.assert_allclose([weights[i]["bias"] for i in range(PRODS)], shared["b"], rtol=1e-4, atol=1e-6)
    products = {r["prod_idx"]: r["vector"] for r in model.product_vectors.collect()}
    if method == "dm":
        np.testing.assert_allclose([products[i] for i in range(PRODS)], shared["E"], rtol=1e-4, atol=1e-6)
    else:
        assert products == {}
    history = model.history.orderBy("epoch").collect()
    np.testing.assert_allclose([r["loss"] for r in history], losses, rtol=1e-4)
    assert [r["n_examples"] for r in history] == [150] * 3 and all(0 <= r["accuracy"] <= 1 for r in history)


@pytest.mark.parametrize("method", ["dm", "dbow"])
def test_no_null_lists_go_to_a_task(many, method, monkeypatch):
    shaped, lists = rotation._shaped, []

    def shape(table, **columns):
        made = shaped(table, **columns)
        lists.extend(made.agg(*[F.count(F.when(F.col(c).isNull(), 1)) for c, t in made.dtypes if t.startswith("array")]).first())
        return made

    monkeypatch.setattr(rotation, "_shaped", shape)
    vectors.train_vectors(many, 120, method, window=WINDOW, dim=DIM, epochs=1, partitions=2)
    assert lists and not any(lists)


@pytest.mark.parametrize("method", ["dm", "dbow"])
def test_combining_partitions(docs, method):
    """Loss falls with several partitions too, and neither layout nor repetition changes the result."""
    how = {**SMALL, "rate": 0.2, "batch_size": 8, "epochs": 8, "partitions": 4, "combine": "sum"}
    model = vectors.train_vectors(docs, PRODS, method, **how)
    loss = [r["loss"] for r in model.history.orderBy("epoch").collect()]
    assert loss[-1] < loss[0] - 0.2
    again = vectors.train_vectors(scattered(docs), PRODS, method, **how)
    got, repeated = dict(rows(model.customer_vectors)), dict(rows(again.customer_vectors))
    assert set(got) == set(repeated)
    for c in got:
        np.testing.assert_allclose(got[c], repeated[c], rtol=1e-3, atol=1e-5)


def whole_loss(model, docs, method, num_prods):
    """Mean softmax loss over all products and all windows, of the model's tables."""
    v = {r[0]: np.array(r[1]) for r in model.customer_vectors.collect()}
    weights = sorted((r["prod_idx"], r["vector"], r["bias"]) for r in model.output_weights.collect())
    assert [w[0] for w in weights] == list(range(num_prods))
    W, b = np.array([w[1] for w in weights]), np.array([w[2] for w in weights])
    E = np.array([r[1] for r in sorted(model.product_vectors.select("prod_idx", "vector").collect())])
    total = []
    for code, unknown, known in (tuple(r) for r in docs.collect()):
        items, half = [0] * unknown + known, WINDOW // 2
        for p in range(len(items) - WINDOW):
            around = items[p : p + half] + items[p + half + 1 : p + WINDOW + 1]
            h = (v[code] + E[around].sum(axis=0)) / (1 + WINDOW) if method == "dm" else v[code]
            z = W @ h + b
            targets = [items[p + half]] if method == "dm" else items[p : p + WINDOW]
            total.append(np.log(np.exp(z).sum()) - np.mean(z[targets]))
    return float(np.mean(total))


@pytest.fixture(scope="module")
def many(spark):
    """Two kinds of customers over 120 products; a tenth of all purchases is unknown."""
    random = np.random.default_rng(5)
    data = []
    for i in range(150):
        half = range(1, 70) if i % 2 else range(50, 120)
        data.append((f"C{i:03}", int(random.integers(0, 3)), sorted(random.choice(list(half), 8, replace=False).tolist())))
    return spark.createDataFrame(data, "CUST_CODE string, n_unknown int, prod_idxs array<int>").cache()


@pytest.mark.parametrize("method", ["dm", "dbow"])
def test_loss_does_not_depend_on_the_number_of_partitions(many, method):
    """Sixteen blocks of about seven products and a hot one lose what one block does, in as many steps."""
    how = {"window": WINDOW, "dim": DIM, "rate": 0.2, "batch_size": 4, "epochs": 1, "steps_per_epoch": 150}
    whole, estimates, before = [], [], math.log(120)
    for partitions in (1, 4, 16):
        model = vectors.train_vectors(many, 120, method, partitions=partitions, **how)
        last = model.history.first()
        assert last["n_examples"] == 600
        whole.append(whole_loss(model, many, method, 120))
        estimates.append(last["loss"])
    assert max(whole) <= 1.1 * min(whole) and max(whole) < before - 0.02, whole
    assert max(estimates) <= 1.1 * min(estimates), estimates


def test_hot_products_are_known_to_every_block(spark, many):
    counts = spark.createDataFrame([(0, 400.0), (1, 350.0), (2, 250.0), (3, 0.0)], "prod_idx int, weight double")
    assert [rotation.hot_products(counts, n) for n in (1, 2, 3, 4, 5)] == [[], [], [0, 1], [0, 1], [0, 1, 2]]
    docs = many.withColumn("n_unknown", F.lit(30))
    model = vectors.train_vectors(docs, 120, "dbow", partitions=3, window=WINDOW, dim=DIM, rate=0.2, batch_size=8, epochs=1)
    assert [r["prod_idx"] for r in model.output_weights.orderBy("prod_idx").collect()] == list(range(120))
    bias = {r["prod_idx"]: r["bias"] for r in model.output_weights.collect()}
    assert bias[0] == max(bias.values()) and bias[0] > 0.1


@pytest.mark.parametrize("method, optimizer", [("dm", "nesterov"), ("dm", "adagrad"), ("dbow", "adagrad")])
def test_training_goes_on_from_a_saved_model(spark, docs, tmp_path, method, optimizer):
    how = {**SMALL, "batch_size": 8, "partitions": 2, "steps_per_epoch": 30, "optimizer": optimizer}
    whole = vectors.train_vectors(docs, PRODS, method, epochs=2, **how)
    vectors.train_vectors(scattered(docs), PRODS, method, epochs=1, save_path=str(tmp_path / "half"), **how)
    half = vectors.VectorModel.load(spark, str(tmp_path / "half"))
    second = vectors.train_vectors(docs, PRODS, method, epochs=1, start=half, **how)
    # Sums of the copies' changes differ in their last digits with the order of tasks.
    for name in vars(whole):
        for x, y in zip(rows(getattr(second, name)), rows(getattr(whole, name)), strict=True):
            for u, v in zip(x, y, strict=True):
                assert u == v or np.allclose(u, v, rtol=1e-3, atol=1e-6), name
    loss = [r["loss"] for r in second.history.orderBy("epoch").collect()]
    assert len(loss) == 2 and loss[1] < loss[0] + 0.05


def test_training_of_copies_goes_on_from_a_saved_model(spark, docs, tmp_path):
    how = {**SMALL, "batch_size": 8, "partitions": 3, "steps_per_epoch": 30, "combine": "sum"}
    whole = vectors.train_vectors(docs, PRODS, "dm", epochs=4, **how)
    vectors.train_vectors(docs, PRODS, "dm", epochs=2, save_path=str(tmp_path / "half"), **how)
    second = vectors.train_vectors(docs, PRODS, "dm", epochs=2, start=vectors.VectorModel.load(spark, str(tmp_path / "half")), **how)
    for x, y in zip(rows(second.customer_vectors), rows(whole.customer_vectors), strict=True):
        assert x[0] == y[0] and np.allclose(x[1], y[1], rtol=1e-3, atol=1e-6)


def test_adagrad_step():
    value, squares = np.array([1.0]), np.array([0.5])
    sgd.Adagrad(0.1).step(value, squares, np.array([3.0]))
    assert squares == pytest.approx(9.5) and value == pytest.approx(1 - 0.1 * 3 / math.sqrt(9.5))


def test_parts_of_a_step_add_up_to_it():
    rule, parts = sgd.Nesterov(0.1, 0.9), [np.array([[1.0, -2.0]]), np.array([[0.5, 3.0]]), np.array([[-4.0, 0.25]])]
    value, velocity = np.array([[1.0, 2.0]]), np.array([[0.3, -0.6]])
    once, speed = value.copy(), velocity.copy()
    rule.step(once, speed, sum(parts))
    for i, part in enumerate(parts):
        rule.step(value, velocity, part.copy(), np.array([i == 0]))
    np.testing.assert_allclose(value, once)
    np.testing.assert_allclose(velocity, speed)


def test_alias_table_draws_by_weight():
    weights = np.array([0.0, 5.0, 1.0, 1.0, 3.0])
    alias = sgd.Alias(weights)
    drawn = np.bincount(alias.draw(np.random.default_rng(1), 200_000), minlength=5) / 200_000
    np.testing.assert_allclose(drawn, weights / 10, atol=0.005)
    np.testing.assert_allclose(alias.chance.sum(), 1)
    assert set(sgd.Alias(np.zeros(3)).draw(np.random.default_rng(1), 100)) == {0, 1, 2}


@pytest.mark.parametrize("method", ["dm", "dbow"])
def test_sampled_gradient_equals_the_whole_one_in_expectation(method):
    model, v, inputs, targets = batch(method)
    n, weights = len(v), np.arange(1.0, PRODS + 1)

    def moved(negatives, seed):
        values = np.column_stack([model["W"], model["b"]]) * 0.3
        table = sgd.Inputs(model["E"].copy(), np.zeros((PRODS, DIM)), np.arange(PRODS), PRODS) if method == "dm" else None
        block = sgd.Block(values.copy(), np.zeros_like(values), PRODS, PRODS, negatives, weights, seed)
        vectors_ = v.copy()
        loss, _, seen = block.train(sgd.Nesterov(1.0, 0.0), vectors_, np.zeros_like(v), table, inputs, targets, n)
        return loss / seen, values - block.values, v - vectors_, model["E"] - table.values if table else np.zeros(1)

    whole = moved(None, 0)
    draws = [moved(300, i) for i in range(300)]
    for i, want in enumerate(whole):
        np.testing.assert_allclose(np.mean([d[i] for d in draws], axis=0), want, atol=0.01)
    few = moved(3, 1)[1]
    assert 0 < np.count_nonzero(few.any(axis=1)) <= 3 + len(np.unique(targets))
    # A block that holds a part of the products estimates the loss over all of them.
    parts = []
    for seed in range(400):
        own = np.random.default_rng(seed).permutation(PRODS)[: PRODS // 2]
        place = np.full(PRODS, -1)
        place[own] = np.arange(len(own))
        wanted = place[targets]
        if not (wanted >= 0).any():
            continue
        values = (np.column_stack([model["W"], model["b"]]) * 0.3)[own]
        table = sgd.Inputs(model["E"].copy(), np.zeros((PRODS, DIM)), np.arange(PRODS), PRODS) if method == "dm" else None
        found = sgd.Block(values, np.zeros_like(values), len(own), PRODS).train(
            sgd.Nesterov(0.0, 0.0), v.copy(), np.zeros_like(v), table, inputs, wanted, n
        )
        parts.append(found[::2])
    assert sum(p[0] for p in parts) / sum(p[1] for p in parts) == pytest.approx(whole[0], rel=0.03)


def test_large_vocabulary_with_drawn_products(spark, many):
    """Of 100,000 products a step touches its targets and the drawn ones; no task, nor the driver, holds all."""
    how = {"window": WINDOW, "dim": 4, "rate": 0.2, "batch_size": 16, "epochs": 1, "partitions": 4, "negatives": 20}
    docs = many.withColumn("prod_idxs", F.transform("prod_idxs", lambda x: x * 800))
    model = vectors.train_vectors(docs, 100_000, "dm", **how)
    start = spark.range(100_000).select(F.col("id").cast("int").alias("prod_idx"))
    limit = vectors.output_limit(100_000, 4)
    start = start.withColumn("start", vectors.start_vector(4, 1, "output", "prod_idx", limit))
    changed = model.output_weights.join(start, "prod_idx").where("vector != start or bias != 0").count()
    assert model.output_weights.count() == 100_000 and 50 < changed < 2_000
    assert model.history.first()["n_examples"] == 150
    assert vectors.train_vectors(docs, 100_000, "dbow", **{**how, "partitions": 2}).history.count() == 1


def test_vectors_separate_the_two_kinds_of_customers(docs):
    model = vectors.train_vectors(
        docs, PRODS, "dbow", epochs=25, partitions=2, batch_size=8, combine="sum", **{**SMALL, "rate": 0.2}
    )
    got = dict(rows(model.customer_vectors))
    kinds = [np.array([got[f"C{i:03}"] for i in range(k, 150, 2)]) for k in (0, 1)]
    between = np.linalg.norm(kinds[0].mean(axis=0) - kinds[1].mean(axis=0))
    within = max(np.linalg.norm(k - k.mean(axis=0), axis=1).mean() for k in kinds)
    assert between > within


@pytest.mark.parametrize("how", [{"partitions": 2}, {"partitions": 1, "combine": "sum"}])
def test_anonymous_lines_kept_as_one_customer(spark, docs, how):
    known = docs.union(spark.createDataFrame([(None, 2, [1, 2, 3, 4])], docs.schema))
    model = vectors.train_vectors(known, PRODS, "dm", epochs=2, **{**SMALL, **how})
    got = dict(map(tuple, model.customer_vectors.collect()))
    assert len(got) == docs.count() + 1 and None in got
    assert all(np.isfinite(v).all() for v in got.values())
    assert [r["n_examples"] for r in model.history.collect()] == [151, 151]
    again = vectors.train_vectors(known, PRODS, "dm", epochs=1, start=model, **{**SMALL, **how}) if how["partitions"] == 2 else model
    assert again.customer_vectors.where("CUST_CODE is null").count() == 1


def test_vectors_are_never_broadcast(spark, docs, tmp_path):
    """Start vectors look as small as the documents they are made from; broadcast, all would come to the driver."""
    docs.write.parquet(str(tmp_path / "docs"))
    written = spark.read.parquet(str(tmp_path / "docs"))
    vectors_ = written.select("CUST_CODE", vectors.start_vector(256, 1).alias("vector"))
    for how in ("inner", "left"):
        plan = rotation.by_customer(written, vectors_, how)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_start_vectors_are_hashed_by_batch(spark):
    """The first 4 bytes of an md5 per number, made without an interpreted expression per number."""
    codes = ["C1", None, "", "Ü|7"]
    table = spark.createDataFrame([(c,) for c in codes], "CUST_CODE string").withColumn("vector", vectors.start_vector(5, 3))

    def value(code, i):
        unit = int(hashlib.md5(f"3:customer:{code or ''}:{i}".encode()).hexdigest()[:8], 16) / 2**32
        return float(np.float32((unit * 2 - 1) * vectors.INIT_RANGE))

    assert dict(rows(table)) == {c: [value(c, i) for i in range(5)] for c in codes}
    assert table.where("false").count() == 0 and dict(table.dtypes)["vector"] == "array<float>"
    assert "md5(" not in table._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("combine", ["rotate", "sum"])
def test_vectors_are_written_without_a_dictionary(docs, combine):
    model = vectors.train_vectors(docs, PRODS, "dbow", epochs=1, partitions=2, combine=combine, **SMALL)
    found = []
    for name in model.customer_vectors.inputFiles():
        meta = parquet.read_metadata(urllib.parse.unquote(urllib.parse.urlparse(name).path))
        groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
        found += [g.column(i) for g in groups for i in range(meta.num_columns) if g.column(i).path_in_schema.split(".")[0] in ("vector", "state", "velocity")]
    assert len(found) >= 2 and not any(c.has_dictionary_page for c in found)


def test_short_documents_keep_their_start_vector(docs):
    model = vectors.train_vectors(docs, PRODS, "dbow", epochs=1, **SMALL)
    start = dict(rows(docs.select("CUST_CODE", vectors.start_vector(DIM, 1))))
    got = dict(rows(model.customer_vectors))
    assert got["SHORT"] == start["SHORT"] and got["C000"] != start["C000"]
    assert all(abs(x) <= vectors.INIT_RANGE for v in start.values() for x in v)


def test_early_stop_save_and_snapshots(spark, docs, tmp_path):
    path, shots = str(tmp_path / "model-{epoch}"), str(tmp_path / "shot-{epoch}")
    model = vectors.train_vectors(
        docs, PRODS, "dm", epochs=50, patience=2, save_path=path, save_period=2,
        snapshot_path=shots, snapshot_period=3, window=WINDOW, dim=DIM, rate=0.0, partitions=1,
    )
    # With a rate of 0 the loss changes by the drawn windows only; it stops two epochs after its best.
    loss = [r["loss"] for r in model.history.orderBy("epoch").collect()]
    best = next(i for i in range(len(loss)) if loss[i] == min(loss))
    assert len(loss) == best + 3 < 50
    n = len(loss)
    names = {p.name for p in pathlib.Path(tmp_path).iterdir()}
    assert names == {f"model-{e}" for e in range(1, n, 2)} | {f"model-{n}"} | {f"shot-{e}" for e in {*range(0, n, 3), n}}
    loaded = vectors.VectorModel.load(spark, str(tmp_path / f"model-{n}"))
    for name in vars(model):
        assert rows(getattr(loaded, name)) == rows(getattr(model, name))


def test_nothing_to_train_on(docs):
    with pytest.raises(ValueError, match="no document"):
        vectors.train_vectors(docs, PRODS, "dm", window=20, dim=DIM)
    with pytest.raises(ValueError, match="even"):
        vectors.train_vectors(docs, PRODS, "dm", window=3, dim=DIM)
    with pytest.raises(ValueError, match="epochs"):
        vectors.train_vectors(docs, PRODS, "dm", epochs=0)
    with pytest.raises(ValueError, match="combine"):
        vectors.train_vectors(docs, PRODS, "dm", combine="max")
    with pytest.raises(ValueError, match="optimizer"):
        vectors.train_vectors(docs, PRODS, "dm", optimizer="newton")
    with pytest.raises(ValueError, match="rotate"):
        vectors.train_vectors(docs, PRODS, "dm", combine="sum", negatives=5)


def test_mean_of_many_copies_is_stable_at_a_high_rate(docs):
    how = {**SMALL, "batch_size": 4, "epochs": 3, "steps_per_epoch": 150, "partitions": 16, "combine": "mean"}
    history = vectors.train_vectors(docs, PRODS, "dm", **how).history.orderBy("epoch").collect()
    assert history[-1]["loss"] < history[0]["loss"]


def test_mini_batches_of_a_task_are_read_and_written_together(monkeypatch):
    """The steps are those of single mini-batches, but their rows come out in a few batches."""
    random, n = np.random.default_rng(4), 200
    none = dict.fromkeys(name for name, _ in rotation._parts(rotation._ROW))
    types = {"int": pa.int32(), "string": pa.string(), "double": pa.float64(), "array<int>": pa.list_(pa.int32()), "array<float>": pa.list_(pa.float32())}
    schema = pa.schema([(name, types[sql]) for name, sql in rotation._parts(rotation._ROW)])

    def numbers(size):
        return random.normal(size=size).tolist()

    given = [none | {"kind": rotation.OUTPUT, "prod_idx": p, "weight": 1.0, "vector": numbers(DIM + 1), "state": [0.0] * (DIM + 1)} for p in range(0, PRODS, 2)]
    for i in range(n):
        seen = {"contexts": random.integers(0, PRODS, WINDOW).tolist(), "firsts": [0], "visits": [0, 3][: 1 + i % 2]}
        given.append(none | seen | {"kind": rotation.CUSTOMERS, "CUST_CODE": f"C{i}", "vector": numbers(DIM), "state": [0.0] * DIM})
    batches = pa.Table.from_pylist(given, schema).to_batches(max_chunksize=70)

    def trained():
        task = rotation._task(1, "dbow", WINDOW, PRODS, 0, 8, sgd.Nesterov(np.float32(0.05), np.float32(0.9)), None, 1)
        return list(task(iter(batches)))

    together = trained()
    monkeypatch.setattr(rotation, "GROUP", 1)
    single = trained()
    assert pa.Table.from_batches(together).to_pylist() == pa.Table.from_batches(single).to_pylist()
    assert sum(b["kind"][0].as_py() == "customer" for b in together) == 1
    assert sum(b["kind"][0].as_py() == "customer" for b in single) == n / 8


def test_rounds_leave_no_shuffle_behind(spark, docs, monkeypatch):
    left, write = [], rotation.Rotation._write

    def seen(training, *args):
        before = shuffle_files(spark)
        write(training, *args)
        left.append(left_over(spark, before))

    monkeypatch.setattr(rotation.Rotation, "_write", seen)
    vectors.train_vectors(docs, PRODS, "dbow", epochs=1, partitions=2, **SMALL)
    assert left == [set()] * 3
