"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products, one representative per group.

The centroids are fitted on a bounded sample; every vector belongs to its nearest cell, and cells are cut into blocks,
which are files of the shared folder with the largest angle between their vectors and their centroid. By the triangle
inequality a vector has links in a block only if its angle to the block's centroid is at most that angle plus the one of
the threshold. Block meets block where that may hold and only the vectors that may have links are compared, so no link is
lost, and neither a large cell nor a large group is one task. Where vectors are spread evenly the angles exclude little, and
about half of all products are computed. Copies of a vector are one row with a count.
From each meeting come the number of links per vector and the edges of its groups, never the pairs.

Defined cases: vectors that are NULL, zero, of an odd length, or hold NULL or non-finite components link with
nothing and are kept; repeated rows (same vec_id and vector) count once and have equal results; rows whose vec_id is
NULL link with nothing; an empty table gives no rows; other columns, labels included, are ignored.
"""

import io
import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import cut, discard, publish, shared_folder, store
from basketlens.llm.components import components, smallest_labels
from basketlens.llm.vectors import dimension, matrix, usable

THRESHOLD = 0.9
# k grows with the root of the number of vectors, up to this many: the centroids are sent to every task.
MAX_CENTROIDS = 4096
SAMPLE_PER_CENTROID = 16
ROUNDS = 8
BLOCK = 2048
# A unit of work is a block with so many others.
MEETINGS = 64
# Angles are rounded; this much more of them is compared.
SLACK = 1e-6


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 1) -> np.ndarray:
    """Unit centroids of unit rows. A cell that loses all rows keeps its centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = np.concatenate([np.argmax(x[i : i + 4096] @ c.T, axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(length > 0, sums / np.maximum(length, 1e-300), c)
    return c


def _unit(x):
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _angles(x, centroid):
    return np.arccos(np.clip(x @ centroid, -1, 1))


def _load(uri):
    fs, path = store(uri)
    with fs.open_input_file(path) as f:
        data = io.BytesIO(f.read())
    return [np.load(data) for _ in range(3)]


def meet(mine, other, threshold: float):
    """Ids, links and labels of the linked vectors of two blocks, each (ids, copies, unit rows); ``other`` may be None
    for a block that meets itself. Id and label are an edge."""
    ids, copies, x = mine
    ids_, copies_, y = other or mine
    shift, every = (len(ids), np.concatenate([ids, ids_])) if other else (0, ids)
    links, edges = np.zeros(len(every), np.int64), []
    for start in range(0, len(ids), 256):
        i, j = np.nonzero(x[start : start + 256] @ y.T >= threshold)
        i += start
        if not other:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        np.add.at(links, i, copies_[j])
        np.add.at(links, j + shift, copies[i])
        # Of a slice's pairs go on as many as connect the same places.
        low = smallest_labels(np.arange(len(every)), i, j + shift)
        edges.append(np.stack([np.flatnonzero(low != np.arange(len(low))), low[low != np.arange(len(low))]]))
    at = np.flatnonzero(links)
    label = smallest_labels(every, *np.hstack(edges)) if edges else every
    return every[at], links[at], label[at]


def near_groups(vectors: DataFrame, vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), F.col(vector).cast("array<double>").alias("x"))
    dim = dimension(rows.where(usable(F.col("x"))), "x")
    good = usable(F.col("x")) & (F.size("x") == dim) & F.col("vec_id").isNotNull()
    keyed = rows.withColumns({"k1": F.when(good, F.xxhash64("x")), "k2": F.when(good, F.xxhash64("x", F.lit(1)))})
    members = keyed.where("k1 is not null")
    # Equal vectors are counted before they move.
    counted = members.select("k1", "k2", "vec_id").distinct().groupBy("k1", "k2").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    counted = cut(counted, "emb-counts")
    classes = members.withColumnRenamed("vec_id", "id").join(counted, ["k1", "k2", "id"]).dropDuplicates(["k1", "k2"]).select("id", "copies", "x")
    classes = cut(classes, "emb-classes")
    n = classes.count()
    k = min(MAX_CENTROIDS, max(1, math.ceil(math.sqrt(n))))
    sample = classes.orderBy(F.xxhash64("id")).limit(SAMPLE_PER_CENTROID * k).select("x").toArrow()
    centroids = spherical_kmeans(_unit(matrix(sample.column(0).combine_chunks(), dim)), k) if n else np.zeros((1, max(dim, 1)))
    centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-300)
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches):
        c = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(matrix(batch.column(2), dim))
            near = np.concatenate([np.argmax(x[i : i + 1024] @ c.T, axis=1) for i in range(0, len(x), 1024)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], ["id", "copies", "x", "cell"])

    placed = cut(classes.mapInArrow(assign, "id long, copies long, x array<double>, cell int"), "emb-cells")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("n_blocks"))  # one row per centroid
    laid = placed.join(F.broadcast(sizes), "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")))
    folder = shared_folder(spark, "emb-blocks")

    def write(pdf):
        x, cell = _unit(matrix(pdf["x"], dim)), int(pdf["cell"].iloc[0])
        data = io.BytesIO()
        for values in (pdf["id"].to_numpy(), pdf["copies"].to_numpy(), x):
            np.save(data, values)
        path = publish(folder, f"{uuid.uuid4().hex}.npy", data.getvalue())
        return pd.DataFrame({"path": [path], "cell": [cell], "radius": [_angles(x, shared.value[cell]).max()]})

    # One row per block.
    blocks = cut(laid.groupBy("cell", "block").applyInPandas(write, "path string, cell int, radius double"), "emb-index").orderBy("path").collect()
    listed = spark.sparkContext.broadcast([tuple(b) for b in blocks])
    m, reach = len(blocks), math.acos(threshold) + SLACK
    # Block a meets the blocks that come after it in a ring, half of the ring and itself: every pair of blocks once.
    parts = max(1, math.ceil((m // 2 + 1) / MEETINGS))

    def compare(batches):
        c, known = shared.value, listed.value

        def within(one, cell, radius):
            return tuple(v[_angles(one[2], c[cell]) <= radius + reach] for v in one)

        for batch in batches:
            for unit in batch.column(0).to_pylist():
                a, part = divmod(unit, parts)
                path, cell, radius = known[a]
                mine = _load(path)
                for step in range(part * MEETINGS, min((part + 1) * MEETINGS, m // 2 + 1)):
                    if step and 2 * step == m and a >= step:
                        continue
                    path_, cell_, radius_ = known[(a + step) % m]
                    if not step:
                        pair = mine, None
                    elif math.acos(max(-1.0, min(1.0, float(c[cell] @ c[cell_])))) > radius + radius_ + reach:
                        continue
                    else:
                        pair = within(mine, cell_, radius_), within(_load(path_), cell, radius)
                        if not len(pair[0][0]) or not len(pair[1][0]):
                            continue
                    found = meet(*pair, threshold)
                    if len(found[0]):
                        yield pa.RecordBatch.from_arrays([pa.array(v) for v in found], ["id", "n", "label"])

    units = spark.range(0, m * parts, 1, max(1, min(m * parts, 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))))
    found = units.mapInArrow(compare, "id long, n long, label long")
    # Rows of a vector from several meetings: links are added up, each different label is an edge.
    found = cut(found.groupBy("id", "label").agg(F.sum("n").alias("n")), "emb-links")
    discard(spark, folder)
    groups = components(found.select(F.col("id").alias("a"), F.col("label").alias("b")))
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    named = counted.join(links, "id", "left").join(groups, "id", "left")
    named = named.select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component_id", "id").alias("c"))
    out = keyed.select("vec_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    return out.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"),
        F.coalesce("c", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"),
    )


def deduplicated(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vectors`` with one row per group: that of its smallest vec_id."""
    gone = near_groups(vectors, vector).where("not kept").select("vec_id").distinct()
    return vectors.join(gone, "vec_id", "left_anti")
