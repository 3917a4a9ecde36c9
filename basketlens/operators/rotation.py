"""Training in rounds in which no two tasks change one row (stratified SGD).

Customers are dealt to as many blocks as there are tasks, and in every epoch products are dealt anew to as many blocks.
In round s, task c trains customer block c against product block c + s: the output rows of these products are changed
by that task alone, the vectors of its customers too. After as many rounds as blocks every target has been met, in the
order of one sequential run. A customer travels only to the rounds in which one of its targets is due.

A target is compared with the products of its block; each of them stands for as many as are not there, so that the
loss estimates the softmax over all products. With one block it is that softmax. With ``negatives`` only a sample of the
block is compared, drawn from an alias table of the product counts, and only touched rows change.

Two kinds of rows are wanted by several tasks of a round: the input rows of "dm", and the output rows of products that
are the target of more than a block's share of all examples. Tasks get copies of those they need; momentum is dealt to
the copies in equal parts, and the changes are added up after the round.
"""

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.operators import sgd
from basketlens.operators.windows import epoch_windows
from basketlens.schema import CUSTOMER
from basketlens.sources import storage

OUTPUT, INPUT, CUSTOMERS = 0, 1, 2  # kinds of rows, in the order in which a task reads them

# So many mini-batches are held at a time, fewer where their windows have more products than that.
GROUP, GROUP_ITEMS = 64, 1 << 18

# Vectors are written as they are: their numbers hardly repeat, so a dictionary of them is built only to be thrown away.
PLAIN = {f"parquet.enable.dictionary#{name}.list.element": "false" for name in ("vector", "state", "velocity")}

_ROW = (
    f"c int, kind int, layer string, prod_idx int, weight double, {CUSTOMER} string, contexts array<int>, "
    "targets array<int>, firsts array<int>, visits array<int>, vector array<float>, state array<float>"
)
_OUT = (
    f"layer string, prod_idx int, weight double, {CUSTOMER} string, contexts array<int>, targets array<int>, firsts array<int>, "
    "visits array<int>, vector array<float>, state array<float>, seen double, loss double, hits double, kind string, next int"
)


def _parts(ddl: str) -> list[list[str]]:
    return [part.split(" ", 1) for part in ddl.split(", ")]


def by_customer(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """A join by customer, in which the anonymous one is a customer like any other.

    Both sides have a row per customer and are sorted: start vectors are estimated by the small file they are made
    from, and a broadcast of them would bring every vector to the driver."""
    right = right.withColumnRenamed(CUSTOMER, "_code").hint("merge")
    return left.hint("merge").join(right, F.col(CUSTOMER).eqNullSafe(F.col("_code")), how).drop("_code")


def _shaped(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` as rows of the task, from SQL expressions; columns that are not given are NULL, lists empty.

    For every row Spark measures the batch that it fills for Python, and walks over all NULL lists at its end each time:
    a column of them takes time with the square of the batch's rows."""
    made = {"vector": "vector", "state": "state", **columns}
    blank = {name: "array()" if kind.startswith("array") else "null" for name, kind in _parts(_ROW)}
    return df.selectExpr(*[f"cast({made.get(name, blank[name])} as {kind}) as {name}" for name, kind in _parts(_ROW)])


def _task(count: int, method: str, window: int, num_prods: int, stage: int, batch_size: int, rule, negatives: int | None, seed: int):
    """The function that trains one customer block against one product block."""

    def rows(kind, n, **columns):
        out = {}
        for name, sql in _parts(_OUT):
            plain = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}
            arrow = pa.list_(pa.int32() if "int" in sql else pa.float32()) if sql.startswith("array") else plain[sql]
            made = {"kind": [kind] * n, "next": [-1] * n, **columns}.get(name)
            if made is None:
                made = pa.nulls(n, arrow)
            elif isinstance(made, pa.ChunkedArray):
                made = made.combine_chunks().cast(arrow)
            out[name] = made.cast(arrow) if isinstance(made, pa.Array) else pa.array(made, arrow)
        return pa.RecordBatch.from_pydict(out)

    def layer(table, kind, name=None):
        """prod_idx, weight, values and state of the rows of a kind."""
        keep = pa.compute.equal(table["kind"], kind)
        table = table.filter(pa.compute.and_(keep, pa.compute.equal(table["layer"], name)) if name else keep)
        if not table.num_rows:
            return None
        return table["prod_idx"].to_numpy(), table["weight"].to_numpy(), sgd.matrix(table["vector"], np.float32), sgd.matrix(table["state"], np.float32)

    def stacked(own, hot):
        """Rows of the block, then those of hot products."""
        parts = [p for p in (own, hot) if p]
        return [np.concatenate([p[i] for p in parts]) for i in (0, 2, 3)]

    def run(batches):
        head = []

        def tail():
            for batch in batches:
                first = int(np.searchsorted(batch.column("kind").to_numpy(), CUSTOMERS))
                if first:
                    head.append(batch.slice(0, first))
                if first < batch.num_rows:
                    yield batch.slice(first)

        # Many mini-batches are read and written at once, their columns are turned into arrays once.
        held = batch_size * max(1, min(GROUP, GROUP_ITEMS // (batch_size * count * window)))
        stream = sgd.minibatches(tail(), held)
        customers = next(stream, None)  # by now all product rows are here
        if not head:  # more blocks than products
            return
        table = pa.Table.from_batches(head)
        own, hot, inputs = layer(table, OUTPUT), layer(table, INPUT, "output"), layer(table, INPUT, "product")
        n_own = len(own[0]) if own else 0
        if own or hot:
            idx, values, state = stacked(own, hot)
            block = sgd.Block(values, state, n_own, num_prods, negatives, own[1] if own else None, (seed, stage, int(idx[0])))
            place = np.full(num_prods, -1)
            place[idx] = np.arange(len(idx))
        before = [a[n_own:].copy() for a in (values, state)] if hot else None
        share = None
        if inputs:
            was = inputs[2].copy(), inputs[3].copy()
            share = sgd.Inputs(inputs[2], inputs[3], inputs[0], num_prods)
        seen, loss, hits = 0.0, 0.0, 0.0
        while customers is not None:
            n = customers.num_rows
            contexts = sgd.matrix(customers["contexts"], np.int64).reshape(n, count, window)
            targets = sgd.matrix(customers["targets"], np.int64).reshape(n, count, 1) if method == "dm" else contexts
            firsts = sgd.matrix(customers["firsts"], np.int64)
            vectors, moving = (sgd.matrix(customers[c], np.float32) for c in ("vector", "state"))
            wants = place[targets]
            if hot:  # they are in every block, and due in one round of the window
                wants[(wants >= n_own) & (firsts[:, count : 2 * count] != stage)[:, :, None]] = -1
            has = (wants >= 0).any(axis=2)
            for first in range(0, n, batch_size):
                for i in range(count):
                    due = first + np.flatnonzero(has[first : first + batch_size, i])
                    if not len(due):
                        continue
                    a, b = vectors[due], moving[due]
                    found = block.train(rule, a, b, share, contexts[due, i] if share else None, wants[due, i], batch_size, firsts[due, i] == stage)
                    vectors[due], moving[due] = a, b
                    loss, hits, seen = loss + found[0], hits + found[1], seen + found[2]
            visits = customers["visits"].combine_chunks()
            later = pa.compute.list_slice(visits, 1)
            yield rows(
                "customer",
                n,
                **{c: customers[c] for c in (CUSTOMER, "contexts", "targets", "firsts")},
                visits=later,
                next=[v[0] if v else -2 for v in later.to_pylist()],
                vector=sgd.lists(vectors),
                state=sgd.lists(moving),
            )
            customers = next(stream, None)
        if own:
            n = len(own[0])
            yield rows("output", n, prod_idx=pa.array(own[0]), weight=pa.array(own[1]), vector=sgd.lists(values[:n]), state=sgd.lists(state[:n]))
        changes = [("output", hot[0], values[n_own:] - before[0], state[n_own:] - before[1])] if hot else []
        if inputs:
            changes.append(("product", inputs[0], inputs[2] - was[0], inputs[3] - was[1]))
        for name, at, value, speed in changes:
            moved = np.flatnonzero(value.any(axis=1) | speed.any(axis=1))
            if len(moved):
                yield rows("change", len(moved), layer=[name] * len(moved), prod_idx=pa.array(at[moved]), vector=sgd.lists(value[moved]), state=sgd.lists(speed[moved]))
        yield rows("metric", 1, seen=[seen], loss=[loss], hits=[hits])

    return run


class Rotation:
    """The tables of a training run: customers, output rows, shared rows; ``epoch`` moves all of them on."""

    def __init__(self, docs, customers, outputs, shared, path, method, window, num_prods, blocks, count, batch_size, rule, negatives, seed, hot):
        """``docs`` are eligible documents, ``customers`` (CUST_CODE, vector, state), ``outputs`` (prod_idx, weight, vector with
        the bias last, state), ``shared`` (layer, prod_idx, vector, state): "product" rows, and "output" rows of hot products."""
        self.spark, self.docs, self.path = docs.sparkSession, docs, path
        self.customers, self.outputs, self.shared = customers, outputs, shared
        self.method, self.window, self.num_prods, self.blocks, self.count = method, window, num_prods, blocks, count
        self.batch_size, self.rule, self.negatives, self.seed = batch_size, rule, negatives, seed
        self.hot = hot

    def _customer_block(self) -> str:
        return f"cast(pmod(xxhash64({CUSTOMER}, {self.seed}), {self.blocks}) as int)"

    def _product_block(self, epoch: int, product: str) -> str:
        return f"cast(pmod(xxhash64({product}, {self.seed}, {epoch}), {self.blocks}) as int)"

    def _drawn(self, epoch: int) -> DataFrame:
        """The customers with the windows of an epoch and the rounds in which they are due."""
        rows = by_customer(self.docs, self.customers)
        rows = epoch_windows(rows, self.window, self.method, epoch, self.seed, self.count, keep=["vector", "state"])
        width = 1 if self.method == "dm" else self.window
        due = "targets" if self.method == "dm" else "contexts"
        # A hot target is due in a round of the customer's window, any other one where its block is met.
        windows = f"sequence(0, {self.count - 1})"
        spread = f"transform({windows}, i -> cast(pmod(xxhash64({CUSTOMER}, {epoch}, i, {self.seed}), {self.blocks}) as int))"
        usual = f"pmod({self._product_block(epoch, 't')} - _block, {self.blocks})"
        if self.hot:
            usual = f"case when t in ({', '.join(map(str, self.hot))}) then get(_spread, cast(i div {width} as int)) else {usual} end"
        rows = rows.selectExpr("*", f"{self._customer_block()} as _block", f"{spread} as _spread")
        rows = rows.selectExpr("*", f"transform({due}, (t, i) -> {usual}) as _due")
        firsts = f"transform({windows}, i -> array_min(slice(_due, i * {width} + 1, {width})))"
        firsts = f"concat({firsts}, _spread)" if self.hot else firsts
        rows = rows.selectExpr("*", "sort_array(array_distinct(_due)) as visits", f"{firsts} as firsts")
        made = {n: n for n in (CUSTOMER, "contexts", "targets", "firsts", "visits", "vector", "state")}
        made |= {"kind": "'customer'", "next": "get(visits, 0)"}
        return rows.selectExpr(*[f"cast({made.get(name, 'null')} as {kind}) as {name}" for name, kind in _parts(_OUT)])

    def _shared_now(self, slot: str, stage: int) -> DataFrame:
        """Shared rows with the changes of the rounds so far: sums, in no row of which two tasks ever write."""
        rows = self.shared.select("layer", "prod_idx", "vector", "state")
        if stage:
            rows = rows.unionByName(self._read(slot, range(stage), "change").select("layer", "prod_idx", "vector", "state"))
        sums = [Summarizer.sum(array_to_vector(c)).alias(c) for c in ("vector", "state")]
        rows = rows.groupBy("layer", "prod_idx").agg(*sums)
        return rows.select("layer", "prod_idx", *[vector_to_array(c, "float32").alias(c) for c in ("vector", "state")])

    def _write(self, rows: DataFrame, slot: str, stage: int) -> None:
        with storage.shuffles_freed(self.spark):  # a run has hundreds of epochs, each with shuffles of all vectors
            rows.write.options(**PLAIN).partitionBy("kind", "next").mode("overwrite").parquet(f"{slot}/{stage + 1}")

    def _read(self, slot: str, stages, kind: str, due: int = -1) -> DataFrame:
        """Rows of a kind that the rounds have written; the folders are named, so that none but theirs are listed."""
        context = self.spark.sparkContext
        paths = [context._jvm.org.apache.hadoop.fs.Path(f"{slot}/{stage + 1}/kind={kind}/next={due}") for stage in stages]
        there = [str(p) for p in paths if p.getFileSystem(context._jsc.hadoopConfiguration()).exists(p)]
        schema = ", ".join(f"{name} {kind}" for name, kind in _parts(_OUT)[:-2])
        return self.spark.read.schema(schema).parquet(*there) if there else self.spark.createDataFrame([], schema)

    def _copies(self, slot: str, stage: int, customers: DataFrame) -> DataFrame:
        """Shared rows as they stand, for the tasks that need them: hot products go to every task, others at most once to each.

        Momentum is dealt to the copies, what an adaptive rule has gathered is known to all of them."""
        rows, parts = self._shared_now(slot, stage), []
        if self.hot:
            parts.append(rows.where("layer = 'output'").selectExpr("*", f"sequence(0, {self.blocks - 1}) as cs"))
        if self.method == "dm":
            used = customers.selectExpr(f"{self._customer_block()} as c", "explode(contexts) as prod_idx").distinct()
            used = used.groupBy("prod_idx").agg(F.collect_list("c").alias("cs"))
            parts.append(rows.where("layer = 'product'").join(used, "prod_idx").select("layer", "prod_idx", "vector", "state", "cs"))
        state = "transform(state, x -> x / size(cs))" if self.rule.divided else "state"
        made = [part.selectExpr("layer", "prod_idx", "vector", f"{state} as state", "explode(cs) as c") for part in parts]
        rows = made[0] if len(made) == 1 else made[0].unionByName(made[1])
        return _shaped(rows, c="c", layer="layer", kind=f"{INPUT}", prod_idx="prod_idx", weight="0")

    def epoch(self, epoch: int) -> tuple[float, float, int]:
        """Train for one epoch; return loss, accuracy and the number of examples."""
        slot = f"{self.path}/epoch-{epoch % 2}"
        width = 1 if self.method == "dm" else self.window
        self._write(self._drawn(epoch), slot, -1)
        outputs = self.outputs
        for stage in range(self.blocks):
            customers = self._read(slot, range(-1, stage), "customer", stage)
            c = f"pmod({self._product_block(epoch, 'prod_idx')} - {stage}, {self.blocks})"
            rows = _shaped(outputs, c=c, kind=f"{OUTPUT}", prod_idx="prod_idx", weight="weight")
            if self.shared:
                rows = rows.unionByName(self._copies(slot, stage, customers))
            keep = {n: n for n in (CUSTOMER, "contexts", "firsts", "visits")} | ({"targets": "targets"} if self.method == "dm" else {})
            rows = rows.unionByName(_shaped(customers, c=self._customer_block(), kind=f"{CUSTOMERS}", **keep))
            rows = rows.repartitionById(self.blocks, F.col("c")).sortWithinPartitions("kind", CUSTOMER, "layer", "prod_idx")
            task = _task(self.count, self.method, self.window, self.num_prods, stage, self.batch_size, self.rule, self.negatives, self.seed * 1_000_003 + epoch)
            self._write(rows.mapInArrow(task, _OUT), slot, stage)
            outputs = self._read(slot, [stage], "output").select("prod_idx", "weight", "vector", "state")
        self.outputs = outputs
        self.customers = self._read(slot, range(self.blocks), "customer", -2).select(CUSTOMER, "vector", "state")
        if self.shared:
            path = f"{self.path}/shared-{epoch % 2}"
            self._shared_now(slot, self.blocks).write.mode("overwrite").parquet(path)
            self.shared = self.spark.read.parquet(path)
        sums = self._read(slot, range(self.blocks), "metric").agg(*[F.sum(c).alias(c) for c in ("loss", "hits", "seen")]).first()
        examples = sums["seen"] / width  # counted by target
        return sums["loss"] / width / examples, sums["hits"] / width / examples, round(examples)


def hot_products(counts: DataFrame, blocks: int) -> list[int]:
    """Products that are met more often than a block's share; fewer than ``blocks`` of them. ``counts``: (prod_idx, weight)."""
    if blocks == 1:
        return []
    total = counts.agg(F.sum("weight")).first()[0] or 0.0
    return sorted(r["prod_idx"] for r in counts.where(F.col("weight") * blocks > total).select("prod_idx").collect())


