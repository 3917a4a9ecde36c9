"""Customer vectors: a softmax product predictor, trained by mini-batch steps inside Spark tasks.

A customer's vector is touched by that customer's examples only, so vectors live in a partitioned
table and never leave the executors. What all customers share, the output layer and, for "dm", the
product vectors, is dealt to tasks by product and goes round (``rotation``). For a vocabulary that fits
every task there is a cheaper way: the layer is broadcast at the start of an epoch, every partition trains
on its own copy, and the changes of all copies are added up, or averaged, which moves less with every
further copy but stays stable at high rates.
"""

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.operators import rotation, sgd
from basketlens.operators.documents import length
from basketlens.operators.vocabulary import UNKNOWN
from basketlens.operators.windows import RUNS, check_window, eligible, epoch_sample, epoch_windows
from basketlens.schema import CUSTOMER
from basketlens.sources.storage import materialize, read_table, scratch_path, write_table

# The update rule and the tasks travel to the executors, they need no installed copy of them.
cloudpickle.register_pickle_by_value(sgd)
cloudpickle.register_pickle_by_value(rotation)

# Start range of vectors, and the defaults of a run.
INIT_RANGE = 0.05
WINDOW, DIM, EPOCHS, RATE, MOMENTUM, BATCH = 8, 300, 250, 0.01, 0.9, 32

# Tasks that train side by side. The model depends on the number, so it is a parameter and does not follow the number
# of customers. More tasks use more cores, and need as many rounds.
PARTITIONS = 4

_EPOCH_ROW = (
    f"kind string, {CUSTOMER} string, n_unknown int, prod_idxs array<int>, prod_idx int, "
    "vector array<float>, velocity array<float>, weight double, loss double, hits double"
)


@dataclass
class VectorModel:
    """A trained model as tables.

    customer_vectors (CUST_CODE, vector), product_vectors (prod_idx, vector; empty for dbow),
    output_weights (prod_idx, vector, bias), history (epoch, loss, accuracy, n_examples), and for training
    on: velocities (kind, CUST_CODE, prod_idx, velocity), the bias last in those of kind "output".
    """

    customer_vectors: DataFrame
    product_vectors: DataFrame
    output_weights: DataFrame
    history: DataFrame
    velocities: DataFrame

    def save(self, path: str) -> None:
        for name, table in vars(self).items():
            write_table(table, f"{path.rstrip('/')}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "VectorModel":
        names = cls.__dataclass_fields__
        return cls(**{name: read_table(spark, f"{path.rstrip('/')}/{name}") for name in names})


def start_vector(dim: int, seed: int, layer: str = "customer", key: str = CUSTOMER, limit: float = INIT_RANGE) -> Column:
    """Start values of a row, even between -limit and limit, from a hash that any SQL engine can recompute.

    A row takes ``dim`` hashes: they are made for an Arrow batch at a time."""

    def start(names):
        return sgd.lists(sgd.start_values(seed, layer, names.to_pylist(), dim, limit))

    name = F.coalesce(F.col(key).cast("string"), F.lit(""))  # anonymous lines may be kept as one customer
    return F.arrow_udf(start, "array<float>")(name)


def output_limit(num_prods: int, dim: int) -> float:
    """The fan-in/fan-out range of output weights."""
    return math.sqrt(6 / (num_prods + dim))


def _start_shared(num_prods: int, dim: int, method: str, seed: int) -> dict:
    """Output weights, zero bias and product vectors with the values of ``start_vector``, on the driver."""

    def layer(name, limit):
        return sgd.start_values(seed, name, range(num_prods), dim, limit)

    shared = {"W": layer("output", output_limit(num_prods, dim)), "b": np.zeros(num_prods)}
    if method == "dm":
        shared["E"] = layer("product", INIT_RANGE)
    return {name: array.astype(np.float32) for name, array in shared.items()}


def _epoch_task(shared, method: str, window: int, rate: float, momentum: float, batch_size: int):
    """The function that trains on one partition: (example, state) rows of customers in, tagged rows out."""

    def rows(kind, n, **columns):
        blank = {
            "kind": pa.array([kind] * n, pa.string()),
            CUSTOMER: pa.nulls(n, pa.string()),
            "n_unknown": pa.nulls(n, pa.int32()),
            "prod_idxs": pa.nulls(n, pa.list_(pa.int32())),
            "prod_idx": pa.nulls(n, pa.int32()),
            "vector": pa.nulls(n, pa.list_(pa.float32())),
            "velocity": pa.nulls(n, pa.list_(pa.float32())),
            "weight": pa.nulls(n, pa.float64()),
            "loss": pa.nulls(n, pa.float64()),
            "hits": pa.nulls(n, pa.float64()),
        }
        return pa.RecordBatch.from_pydict({**blank, **columns})

    def changes(kind, before, after, speed_before, speed_after, weight):
        moved = np.flatnonzero((after != before).any(axis=1) | (speed_after != speed_before).any(axis=1))
        return rows(
            kind,
            len(moved),
            prod_idx=pa.array(moved, pa.int32()),
            vector=sgd.lists((after - before)[moved]),
            velocity=sgd.lists((speed_after - speed_before)[moved]),
            weight=pa.array(np.full(len(moved), float(weight))),
        )

    def run(batches):
        start, start_speed = shared.value
        model = {name: array.copy() for name, array in start.items()}
        speed = {name: array.copy() for name, array in start_speed.items()}
        rule = sgd.Nesterov(np.float32(rate), np.float32(momentum))
        seen, loss, hits = 0, 0.0, 0.0
        for table in sgd.minibatches(batches, batch_size):
            contexts = sgd.matrix(table["contexts"], np.int64).reshape(table.num_rows, -1, window)
            centres = sgd.matrix(table["targets"], np.int64) if method == "dm" else None
            vectors = sgd.matrix(table["vector"], np.float32)
            velocities = sgd.matrix(table["velocity"], np.float32)
            # A step per window of the batch's customers.
            for i in range(contexts.shape[1]):
                context = contexts[:, i]
                inputs, targets = (context, centres[:, i : i + 1]) if method == "dm" else (None, context)
                batch_loss, batch_hits = sgd.train_batch(model, speed, rule, vectors, velocities, inputs, targets)
                seen, loss, hits = seen + len(vectors), loss + float(batch_loss), hits + float(batch_hits)
            yield rows(
                "customer",
                len(vectors),
                **{CUSTOMER: table[CUSTOMER].combine_chunks().cast(pa.string())},
                n_unknown=table["n_unknown"].combine_chunks(),
                prod_idxs=table["prod_idxs"].combine_chunks().cast(pa.list_(pa.int32())),
                vector=sgd.lists(vectors),
                velocity=sgd.lists(velocities),
            )
        if not seen:
            return

        def output(layer):
            return np.column_stack([layer["W"], layer["b"]])

        yield changes("output", output(start), output(model), output(start_speed), output(speed), seen)
        if method == "dm":
            yield changes("product", start["E"], model["E"], start_speed["E"], speed["E"], seen)
        empty = sgd.lists(np.zeros((1, 1)))
        yield rows(
            "metric",
            1,
            vector=empty,
            velocity=empty,
            weight=pa.array([float(seen)]),
            loss=pa.array([loss]),
            hits=pa.array([hits]),
        )

    return run


def _combine(trained: DataFrame, shared: dict, speed: dict, combine: str) -> tuple[float, float, int]:
    """Add the changes of all copies, or their example-weighted mean, to every shared row; return loss, accuracy and examples.

    Velocities become the example-weighted mean of the copies. Where changes are added up, each copy carries an
    equal part of it into the next epoch: what is left of earlier steps acts once, not once per copy.
    One job over the small part of the epoch table; at most two rows per product reach the driver.
    """
    sums = (
        trained.where(F.col("kind").isin("output", "product", "metric"))
        .groupBy("kind", "prod_idx")
        .agg(
            Summarizer.sum(array_to_vector("vector"), F.lit(1.0) if combine == "sum" else F.col("weight")).alias("vector"),
            Summarizer.sum(array_to_vector("velocity"), F.col("weight")).alias("velocity"),
            *[F.sum(c).alias(c) for c in ("weight", "loss", "hits")],
            F.count("*").alias("copies"),
        )
        .withColumns({c: vector_to_array(c) for c in ("vector", "velocity")})
        .toArrow()
    )

    def part(kind):
        return sums.filter(pa.compute.equal(sums["kind"], kind))

    metric = part("metric").to_pylist()[0]
    examples = metric["weight"]
    for kind in ("output", "product"):
        table = part(kind)
        if not table.num_rows:
            continue
        index = table["prod_idx"].to_numpy()
        for values, column, share in ((shared, "vector", 1.0 if combine == "sum" else examples), (speed, "velocity", examples)):
            change = (sgd.matrix(table[column], np.float64) / share).astype(np.float32)
            if kind == "product":
                values["E"][index] += change
            else:
                values["W"][index] += change[:, :-1]
                values["b"][index] += change[:, -1]
    for values in speed.values() if combine == "sum" else ():
        values /= np.float32(metric["copies"])
    return metric["loss"] / examples, metric["hits"] / examples, int(examples)


class _Copies:
    """Side-by-side training of whole copies of the shared layer, which lives on the driver between two epochs."""

    def __init__(self, docs, customers, num_prods, dim, path, method, window, partitions, count, batch_size, rate, momentum, combine, seed, start):
        self.spark, self.path, self.combine, self.partitions = docs.sparkSession, path, combine, partitions
        # The state of a customer is its document, vector and velocity in one row. With the document at hand an
        # epoch needs no join, only the shuffle that restores the layout.
        self.state = rotation.by_customer(docs, customers).withColumnRenamed("state", "velocity")
        self.draw = lambda state, epoch: epoch_windows(state, window, method, epoch, seed, count, keep=["n_unknown", "prod_idxs", "vector", "velocity"])
        self.task = lambda layers: _epoch_task(layers, method, window, rate, momentum, batch_size)
        self.shared = _start_shared(num_prods, dim, method, seed)
        self.speed = {name: np.zeros_like(array) for name, array in self.shared.items()}
        if start:
            _resume(start, self.shared, self.speed)

    def epoch(self, epoch: int) -> tuple[float, float, int]:
        # Two slots take turns, so the disk holds two states however many epochs run, and a lost
        # executor costs the tasks of the current epoch only.
        slot = f"{self.path}/state-{epoch % 2}"
        rows = self.draw(self.state, epoch).withColumn("targets", F.coalesce("targets", F.array().cast("array<int>")))  # see rotation._shaped
        rows = rows.repartition(self.partitions, CUSTOMER).sortWithinPartitions(CUSTOMER)
        layers = self.spark.sparkContext.broadcast((self.shared, self.speed))
        rows.mapInArrow(self.task(layers), _EPOCH_ROW).write.options(**rotation.PLAIN).partitionBy("kind").mode("overwrite").parquet(slot)
        layers.destroy()
        self.trained = self.spark.read.schema(_EPOCH_ROW).parquet(slot)
        self.state = self.trained.where("kind = 'customer'").select(CUSTOMER, "n_unknown", "prod_idxs", "vector", "velocity")
        return _combine(self.trained, self.shared, self.speed, self.combine)

    def model(self, short: DataFrame, history: DataFrame) -> VectorModel:
        moving = self.trained.where("kind = 'customer'").select("kind", CUSTOMER, "prod_idx", "velocity")
        for kind, layer in (("output", np.column_stack([self.speed["W"], self.speed["b"]])), ("product", self.speed.get("E"))):
            rows = _matrix_table(self.spark, layer).withColumnRenamed("vector", "velocity")
            moving = moving.unionByName(rows.withColumns({"kind": F.lit(kind), CUSTOMER: F.lit(None).cast("string")}))
        return VectorModel(
            customer_vectors=self.trained.where("kind = 'customer'").select(CUSTOMER, "vector").unionByName(short),
            product_vectors=_matrix_table(self.spark, self.shared.get("E")),
            output_weights=_matrix_table(self.spark, self.shared["W"], self.shared["b"]),
            history=history,
            velocities=moving,
        )


class _Rounds:
    """Training in rounds (see ``rotation``); no layer comes to the driver or is broadcast."""

    def __init__(self, docs, customers, num_prods, dim, path, method, window, blocks, count, batch_size, rule, negatives, seed, start):
        products = docs.sparkSession.range(num_prods).select(F.col("id").cast("int").alias("prod_idx"))
        counts = products.withColumn("weight", F.lit(0.0))
        if blocks > 1 or negatives:  # how often a product is met: the hot ones, and the chances of a draw
            met = docs.select(F.explode("prod_idxs").alias("prod_idx")).groupBy("prod_idx").count()
            met = met.unionByName(docs.select(F.lit(UNKNOWN).alias("prod_idx"), F.col("n_unknown").cast("long").alias("count")))
            met = met.groupBy("prod_idx").agg(F.sum("count").cast("double").alias("weight"))
            counts = products.join(met, "prod_idx", "left").fillna(0.0, ["weight"])
        hot = rotation.hot_products(counts, blocks)

        def rest(width):
            return F.array_repeat(F.lit(rule.start).cast("float"), width)

        zero = F.array(F.lit(0.0).cast("float"))
        vector = F.concat(start_vector(dim, seed, "output", "prod_idx", output_limit(num_prods, dim)), zero)
        outputs = counts.select("prod_idx", "weight", vector.alias("vector"), rest(dim + 1).alias("state"))
        inputs = products.select("prod_idx", start_vector(dim, seed, "product", "prod_idx").alias("vector"), rest(dim).alias("state"))
        if start:
            outputs = _known(outputs, start.output_weights.select("prod_idx", F.concat("vector", F.array("bias")).alias("vector")), start, "output")
            inputs = _known(inputs, start.product_vectors, start, "product")
        write_table(outputs, f"{path}/outputs")
        outputs = read_table(docs.sparkSession, f"{path}/outputs")
        is_hot = F.col("prod_idx").isin(hot)
        shared = []
        if method == "dm":
            shared.append(inputs.withColumn("layer", F.lit("product")))
        if hot:
            shared.append(outputs.where(is_hot).drop("weight").withColumn("layer", F.lit("output")))
            outputs = outputs.where(~is_hot)
        if shared:
            write_table(reduce(DataFrame.unionByName, shared), f"{path}/shared")
            shared = read_table(docs.sparkSession, f"{path}/shared")
        self.training = rotation.Rotation(
            docs, customers, outputs, shared or None, path, method, window, num_prods, blocks, count, batch_size, rule, negatives, seed, hot
        )
        self.dim, self.epoch = dim, self.training.epoch

    def model(self, short: DataFrame, history: DataFrame) -> VectorModel:
        t, key = self.training, F.lit(None).cast("string").alias(CUSTOMER)
        rows = t.outputs.select(F.lit("output").alias("layer"), "prod_idx", "vector", "state")
        if t.shared:
            rows = rows.unionByName(t.shared.select("layer", "prod_idx", "vector", "state"))
        no_product = F.lit(None).cast("int").alias("prod_idx")
        moving = t.customers.select(F.lit("customer").alias("kind"), CUSTOMER, no_product, F.col("state").alias("velocity"))
        output = rows.where("layer = 'output'").select("prod_idx", F.slice("vector", 1, self.dim).alias("vector"), F.element_at("vector", -1).alias("bias"))
        return VectorModel(
            customer_vectors=t.customers.select(CUSTOMER, "vector").unionByName(short),
            product_vectors=rows.where("layer = 'product'").select("prod_idx", "vector"),
            output_weights=output,
            history=history,
            velocities=moving.unionByName(rows.select(F.col("layer").alias("kind"), key, "prod_idx", F.col("state").alias("velocity"))),
        )


def _known(rows: DataFrame, vectors: DataFrame, model: VectorModel, kind: str) -> DataFrame:
    """``rows`` (prod_idx, vector, state) with the vectors and the state of a model where it has them."""
    moving = model.velocities.where(F.col("kind") == kind).select("prod_idx", F.col("velocity").alias("_state"))
    found = rows.join(vectors.withColumnRenamed("vector", "_vector"), "prod_idx", "left").join(moving, "prod_idx", "left")
    return found.withColumns({c: F.coalesce(f"_{c}", c) for c in ("vector", "state")}).drop("_vector", "_state")


def _gradient_task(num_prods: int, dim: int, method: str, window: int, seed: int, size: int):
    """The function that adds up the gradients of one partition's examples at the start values."""

    start = _start_shared

    def run(batches):
        shared = {name: array.astype(np.float64) for name, array in start(num_prods, dim, method, seed).items()}
        values = np.column_stack([shared["W"], shared["b"]])
        block = sgd.Block(values, np.zeros_like(values), num_prods, num_prods)
        inputs = sgd.Inputs(shared["E"], np.zeros_like(shared["E"]), np.arange(num_prods), num_prods) if method == "dm" else None
        seen, loss = 0, 0.0
        for table in sgd.minibatches(batches, BATCH):
            contexts = sgd.matrix(table["context"], np.int64)
            targets = table["target"].to_numpy().reshape(-1, 1).astype(np.int64) if method == "dm" else contexts
            vectors = sgd.matrix(table["vector"], np.float64)
            change = np.zeros_like(vectors)
            found = block.train(sgd.Gather(), vectors, change, inputs, contexts if inputs else None, targets, size)
            seen, loss = seen + len(vectors), loss + found[0] / targets.shape[1]
            codes = table[CUSTOMER].combine_chunks().cast(pa.string())
            yield rows("customer", codes, pa.nulls(len(codes), pa.int32()), change, 0.0)
        if seen:
            parts = [("output", block.state)] + ([("product", inputs.state)] if inputs else [])
            for name, change in parts:
                moved = np.flatnonzero(change.any(axis=1))
                yield rows(name, pa.nulls(len(moved), pa.string()), pa.array(moved, pa.int32()), change[moved], 0.0)
            yield rows("loss", pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()), np.zeros((1, 1)), loss / size)

    def rows(layer, codes, products, change, loss):
        n, width = change.shape
        offsets = pa.array(np.arange(0, n * width + 1, width), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(change, np.float64).ravel()))
        columns = [pa.array([layer] * n, pa.string()), codes, products, lists, pa.array([loss] * n, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, ["layer", CUSTOMER, "prod_idx", "gradient", "loss"])

    return run


def first_step(docs: DataFrame, num_prods: int, method: str = "dm", window: int = WINDOW, dim: int = DIM, rate: float = RATE, seed: int = 1) -> DataFrame:
    """(layer, CUST_CODE, prod_idx, vector, loss): all rows after one plain gradient step on the examples of epoch 0.

    The step is the mean over the customers that have an example, added up over all tasks, so that it does not depend on
    their number; any SQL engine can recompute it from the start values. ``layer`` is "customer", "output" (the bias
    last), "product" ("dm" only), or "loss", one row with the mean loss before the step.
    """
    check_window(method, window)
    spark = docs.sparkSession
    samples = epoch_sample(docs, window, method, 0, seed).select(CUSTOMER, "context", "target", start_vector(dim, seed).alias("vector"))
    samples = materialize(samples, "samples")
    size = samples.count()
    task = _gradient_task(num_prods, dim, method, window, seed, max(1, size))
    found = samples.mapInArrow(task, f"layer string, {CUSTOMER} string, prod_idx int, gradient array<double>, loss double")
    total = vector_to_array(Summarizer.sum(array_to_vector("gradient"))).alias("gradient")
    found = found.groupBy("layer", CUSTOMER, "prod_idx").agg(total, F.sum("loss").alias("loss"))
    products = spark.range(num_prods).select(F.col("id").cast("int").alias("prod_idx"))
    no_code, no_product = F.lit(None).cast("string").alias(CUSTOMER), F.lit(None).cast("int").alias("prod_idx")
    zero = F.array(F.lit(0.0).cast("float"))
    output = F.concat(start_vector(dim, seed, "output", "prod_idx", output_limit(num_prods, dim)), zero)
    starts = products.select(F.lit("output").alias("layer"), no_code, "prod_idx", output.alias("start"))
    starts = starts.unionByName(samples.select(F.lit("customer").alias("layer"), CUSTOMER, no_product, F.col("vector").alias("start")))
    if method == "dm":
        inputs = start_vector(dim, seed, "product", "prod_idx")
        starts = starts.unionByName(products.select(F.lit("product").alias("layer"), no_code, "prod_idx", inputs.alias("start")))
    starts = starts.unionByName(spark.range(1).select(F.lit("loss").alias("layer"), no_code, no_product, F.lit(None).cast("array<float>").alias("start")))
    # NULL keys are equal here: every row has either a customer or a product.
    key = F.concat_ws("|", "layer", CUSTOMER, "prod_idx")
    joined = starts.withColumn("_key", key).join(found.select(key.alias("_key"), "gradient", "loss"), "_key", "left")
    moved = F.zip_with("start", "gradient", lambda x, g: x.cast("double") - rate * g)
    vector = F.when(F.col("gradient").isNull(), F.col("start").cast("array<double>")).otherwise(moved)
    return joined.select("layer", CUSTOMER, "prod_idx", vector.alias("vector"), F.when(F.col("layer") == "loss", F.col("loss")).alias("loss"))


OPTIMIZERS = ("nesterov", "adagrad")


def train_vectors(
    docs: DataFrame,
    num_prods: int,
    method: str = "dm",
    window: int = WINDOW,
    dim: int = DIM,
    epochs: int = EPOCHS,
    rate: float = RATE,
    momentum: float = MOMENTUM,
    batch_size: int = BATCH,
    patience: int | None = None,
    save_path: str | None = None,
    save_period: int | None = None,
    snapshot_path: str | None = None,
    snapshot_period: int | None = None,
    seed: int = 1,
    partitions: int | None = None,
    steps_per_epoch: int | None = None,
    start: VectorModel | None = None,
    combine: str = "rotate",
    optimizer: str = "nesterov",
    negatives: int | None = None,
) -> VectorModel:
    """Train customer vectors on one window per customer and epoch, or on as many windows of every customer as
    make at least ``steps_per_epoch`` mini-batches.

    ``combine="rotate"`` trains in rounds of ``partitions`` tasks in which no two change one row: the loss depends
    little on their number, and no layer is held whole by a task or the driver. ``"sum"`` and ``"mean"`` train whole copies
    side by side, whose changes are added up or averaged: fewer jobs, for a vocabulary that fits every task; the rate
    must suit that many batches at a time.

    ``negatives`` compares a target with so many drawn products in place of all (in rounds only). ``optimizer`` is
    "nesterov" or "adagrad" (in rounds only; ``momentum`` is for the first).

    ``start`` is a model to train on, with the same optimizer: its vectors, their state and the history go on where they
    ended. Customers it does not know begin anew.

    Stops early after ``patience`` epochs without a lower loss. Every ``save_period`` epochs the
    model, and every ``snapshot_period`` epochs (from the first on) the customer vectors, are written
    to the given path, in which ``{epoch}`` is replaced. Documents too short for a window keep their
    start vector. The result depends on seed and partition count, not on the layout of ``docs``; the
    count is ``PARTITIONS`` unless it is given. A last snapshot is written when training ends.
    """
    check_window(method, window)
    if epochs < 1:
        raise ValueError("epochs must be at least 1")
    if combine not in ("rotate", "sum", "mean"):
        raise ValueError("combine must be 'rotate', 'sum' or 'mean'")
    if optimizer not in OPTIMIZERS:
        raise ValueError(f"optimizer must be one of {OPTIMIZERS}")
    if combine != "rotate" and (negatives or optimizer != "nesterov"):
        raise ValueError("negatives and other optimizers need combine='rotate'")
    spark = docs.sparkSession
    run = scratch_path(spark, "vectors")
    columns = [CUSTOMER, "n_unknown", "prod_idxs"] + ([RUNS] if RUNS in docs.columns else [])
    if RUNS in columns and combine != "rotate":
        raise ValueError("documents in an order of their own need combine='rotate'")
    write_table(docs.select(*columns), f"{run}/documents")
    docs = read_table(spark, f"{run}/documents")
    n_customers = eligible(docs, window).count()
    if not n_customers:
        raise ValueError(f"no document has more than {window} products")
    count = max(1, math.ceil((steps_per_epoch or 0) * batch_size / n_customers))
    partitions = partitions or PARTITIONS

    rule = sgd.Adagrad(np.float32(rate)) if optimizer == "adagrad" else sgd.Nesterov(np.float32(rate), np.float32(momentum))
    rest = F.array_repeat(F.lit(rule.start).cast("float"), dim)
    customers = eligible(docs, window).select(CUSTOMER, start_vector(dim, seed).alias("vector"), rest.alias("state"))
    short = docs.where(length() <= window).select(CUSTOMER, start_vector(dim, seed).alias("vector"))
    history = []
    if start:
        moving = start.velocities.where("kind = 'customer'").select(CUSTOMER, F.col("velocity").alias("_state"))
        known = start.customer_vectors.withColumnRenamed("vector", "_vector")
        customers = rotation.by_customer(rotation.by_customer(customers, known, "left"), moving, "left")
        customers = customers.select(CUSTOMER, *[F.coalesce(f"_{c}", c).alias(c) for c in ("vector", "state")])
        history = [tuple(r) for r in start.history.orderBy("epoch").select("epoch", "loss", "accuracy", "n_examples").collect()]
    known = (docs, customers, num_prods, dim, run, method, window, partitions, count, batch_size)
    training = _Rounds(*known, rule, negatives, seed, start) if combine == "rotate" else _Copies(*known, rate, momentum, combine, seed, start)

    def result():
        return training.model(short, spark.createDataFrame(history, "epoch int, loss double, accuracy double, n_examples bigint"))

    best, waited = min((h[1] for h in history), default=math.inf), 0
    first = history[-1][0] + 1 if history else 0
    for epoch in range(first, first + epochs):
        loss, accuracy, seen = training.epoch(epoch)
        history.append((epoch, loss, accuracy, seen))
        if snapshot_path and snapshot_period and epoch % snapshot_period == 0:
            write_table(result().customer_vectors, snapshot_path.format(epoch=epoch))
        if save_path and save_period and (epoch + 1) % save_period == 0:
            result().save(save_path.format(epoch=epoch))
        best, waited = (loss, 0) if loss < best else (best, waited + 1)
        if patience and waited >= patience:
            break

    model = result()
    if snapshot_path:
        write_table(model.customer_vectors, snapshot_path.format(epoch=len(history)))
    if save_path:
        model.save(save_path.format(epoch=len(history)))
    return model


def _resume(model: VectorModel, shared: dict, speed: dict) -> None:
    """Put the shared layer and its velocities of ``model``, bounded by the vocabulary, into the given arrays."""

    def fill(values, name, df, column):
        table = df.select("prod_idx", column).toArrow()
        if name in values and table.num_rows:
            found = table[column].combine_chunks()
            values[name][table["prod_idx"].to_numpy()] = sgd.matrix(table[column], np.float32) if pa.types.is_list(found.type) else found.to_numpy()

    fill(shared, "W", model.output_weights, "vector")
    fill(shared, "b", model.output_weights, "bias")
    fill(shared, "E", model.product_vectors, "vector")
    fill(speed, "E", model.velocities.where("kind = 'product'"), "velocity")
    table = model.velocities.where("kind = 'output'").select("prod_idx", "velocity").toArrow()
    index, found = table["prod_idx"].to_numpy(), sgd.matrix(table["velocity"], np.float32)
    speed["W"][index], speed["b"][index] = found[:, :-1], found[:, -1]


def _matrix_table(spark: SparkSession, matrix, bias=None) -> DataFrame:
    """(prod_idx, vector[, bias]) from a driver matrix with a row per vocabulary entry."""
    matrix = np.zeros((0, 1), np.float32) if matrix is None else matrix
    columns = {"prod_idx": pa.array(np.arange(len(matrix)), pa.int32()), "vector": sgd.lists(matrix)}
    if bias is not None:
        columns["bias"] = pa.array(bias, pa.float32())
    return spark.createDataFrame(pa.table(columns))
