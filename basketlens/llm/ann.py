"""Nearest neighbours by inner product with multiprobe p-stable hashing.

A vector x is extended by sqrt(R^2 - |x|^2), R being the largest length, and a query by 0; then the largest inner
product belongs to the smallest distance. Every table hashes with ``HASHES`` Gaussian projections, shifted and cut
into steps of ``WIDTH``. A query visits, in each table, the ``PROBES`` buckets with the best estimated success: a step to
the next slot of a projection costs the squared distance to its border. The candidates' exact products are ranked.
A query that finds fewer rows than are asked for, and than there are, is compared with all rows.

Buckets with more rows than ``BLOCK`` are worked on in blocks, as are their queries, so a frequent vector is no hot group.

Defined cases: vectors that are NULL, zero, of an odd length, or hold NULL or non-finite components take no part;
ties go to the smaller vec_id; repeated rows count once; a query without candidates has no rows; rows whose id is NULL
take no part; other columns are ignored.
"""

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import cut
from basketlens.llm.vectors import dimension, matrix, products, usable

TABLES = 3
HASHES = 6
# In units of R.
WIDTH = 2.5
PROBES = 50
BLOCK = 4096
SEED = 5


class Tables:
    """The hash functions, drawn from a seed."""

    def __init__(self, dim: int, radius: float, tables=TABLES, hashes=HASHES, width=WIDTH, probes=PROBES, seed=SEED):
        rng = np.random.default_rng(seed)
        self.a = rng.normal(size=(tables, dim + 1, hashes)) / (width * radius)
        self.b = rng.random((tables, hashes))
        self.radius = radius
        self.steps = np.array(list(itertools.product((0, -1, 1), repeat=hashes)))
        self.probes = min(probes, len(self.steps))
        # Slots reach from -64 to 63 in each projection: beyond them they are as good as empty and share the last one.
        self.base = 128 ** np.arange(hashes, dtype=np.int64)

    def slots(self, x: np.ndarray, rest: np.ndarray, table: int) -> np.ndarray:
        return np.hstack([x, rest[:, None]]) @ self.a[table] + self.b[table]

    def key(self, slots: np.ndarray) -> np.ndarray:
        return (np.clip(slots, -64, 63) + 64).astype(np.int64) @ self.base

    def buckets(self, x: np.ndarray, table: int) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.radius**2 - (x * x).sum(axis=1), 0))
        return self.key(np.floor(self.slots(x, rest, table)))

    def visits(self, q: np.ndarray, table: int) -> np.ndarray:
        """(queries, probes) bucket keys in the order of estimated success."""
        at = self.slots(q, np.zeros(len(q)), table)
        low = np.floor(at)
        below = at - low
        cost = np.stack([np.zeros_like(below), (1 - below) ** 2, below**2], axis=2)  # steps 0, 1 and -1
        total = sum(cost[:, i, self.steps[:, i]] for i in range(at.shape[1]))
        best = np.argsort(total, axis=1, kind="stable")[:, : self.probes]
        return self.key(low[:, None, :] + self.steps[best])


def nearest(vectors: DataFrame, queries: DataFrame, k: int, vector: str = "embedding", tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows of ``vectors`` found for each row of ``queries``."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col(vector).cast("array<double>").alias("x")).where(usable(F.col("x")) & F.col("vec_id").isNotNull())
    asked = queries.select(F.col("vec_id").cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("q")).where(usable(F.col("q")) & F.col("query_id").isNotNull())
    dim = dimension(rows, "x")
    rows, asked = (cut(df.where(F.size(c) == dim).dropDuplicates(), "ann") for df, c in ((rows, "x"), (asked, "q")))
    radius = rows.agg(F.max(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))).first()[0]
    hashed = Tables(dim, math.sqrt(radius or 1.0), tables=tables, probes=probes)

    def place(batches):
        for batch in batches:
            x = matrix(batch.column(1), dim)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([t] * len(x), pa.int32()), pa.array(hashed.buckets(x, t))], ["vec_id", "x", "t", "bucket"])

    def visit(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                q = matrix(part.column(1), dim)
                for t in range(tables):
                    keys = hashed.visits(q, t)
                    rows_ = pa.array(np.repeat(np.arange(len(q)), keys.shape[1]))
                    yield pa.RecordBatch.from_arrays([part.column(0).take(rows_), pa.array([t] * len(rows_), pa.int32()), pa.array(keys.ravel())], ["query_id", "t", "bucket"])

    placed = cut(rows.mapInArrow(place, "vec_id long, x array<double>, t int, bucket long"), "ann-placed")
    sizes = cut(placed.groupBy("t", "bucket").agg(F.ceil(F.count("*") / BLOCK).alias("n_c")), "ann-sizes")
    visits = asked.select("query_id", "q").mapInArrow(visit, "query_id long, t int, bucket long").dropDuplicates().join(sizes, ["t", "bucket"])
    visits = cut(visits, "ann-visits")
    asks = cut(visits.groupBy("t", "bucket").agg(F.ceil(F.count("*") / BLOCK).alias("n_q")), "ann-asks")
    whole = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    left = placed.join(sizes, ["t", "bucket"]).join(asks, ["t", "bucket"])
    left = left.withColumn("c", F.pmod(F.xxhash64("vec_id"), F.col("n_c"))).select("t", "bucket", "c", F.explode(whole("n_q")).alias("p"), "vec_id", "x")
    right = visits.join(asks, ["t", "bucket"]).join(asked, "query_id")
    right = right.withColumn("p", F.pmod(F.xxhash64("query_id"), F.col("n_q"))).select("t", "bucket", F.explode(whole("n_c")).alias("c"), "p", "query_id", "q")

    def rank(cand, ask):
        out = []
        if len(cand) and len(ask):
            ids, asked_ids = cand["vec_id"].to_numpy(), ask["query_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, x, q = ids[order], matrix(cand["x"], dim)[order], matrix(ask["q"], dim)
            for start in range(0, len(q), 512):
                found = products(q[start : start + 512], x)
                found[ids[None, :] == asked_ids[start : start + 512, None]] = -np.inf
                m = min(k, len(ids))
                # The candidates are in the order of their ids, so a stable sort settles ties.
                best = np.argsort(-found, axis=1, kind="stable")[:, :m]
                score = np.take_along_axis(found, best, axis=1)
                ok = np.isfinite(score)
                out.append(pd.DataFrame({"query_id": np.repeat(asked_ids[start : start + 512], m)[ok.ravel()], "vec_id": ids[best][ok], "score": score[ok]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["t", "bucket", "c", "p"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(rank, "query_id long, vec_id long, score double")
    found = cut(found.dropDuplicates(["query_id", "vec_id"]), "ann-found")
    n = rows.select("vec_id").distinct().count()
    enough = found.groupBy("query_id").count().where(F.col("count") >= min(k, n))
    short = cut(asked.join(enough, "query_id", "left_anti"), "ann-short")
    n_short = short.count()
    if n and n_short:
        # Block meets block, as in a large bucket.
        blocks = lambda c, m: F.pmod(F.xxhash64(c), F.lit(math.ceil(m / BLOCK)).cast("long"))
        every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(math.ceil(m / BLOCK) - 1).cast("long")))
        left = rows.select(blocks("vec_id", n).alias("c"), every(n_short).alias("p"), "vec_id", "x")
        right = short.select(every(n).alias("c"), blocks("query_id", n_short).alias("p"), "query_id", "q")
        rest = left.groupBy("c", "p").cogroup(right.groupBy("c", "p")).applyInPandas(rank, "query_id long, vec_id long, score double")
        found = found.unionByName(rest)
    # At most k rows a query and block visited; the window drops all but k.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
