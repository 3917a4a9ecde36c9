"""Customer segments: k-means over customer vectors, choice of k, scoring."""

import json

from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.operators import sweep
from basketlens.operators.customers import in_sample
from basketlens.schema import CUSTOMER, SEGMENT
from basketlens.sources import storage

cloudpickle.register_pickle_by_value(sweep)  # its tasks need no installed copy of the package

FEATURES = "features"

# Tasks of a fit. The random starts depend on it, so it is a parameter and does not follow the number of rows: give
# as many as the cluster has cores for a large table.
PARTITIONS = 16


def assemble(vectors: DataFrame, column: str = "vector", key: str = CUSTOMER, keep=()) -> DataFrame:
    """(key, features, kept columns): array column to ML vector, without a column per dimension."""
    return vectors.select(key, array_to_vector(F.col(column)).alias(FEATURES), *keep)


def canonical(df: DataFrame, key: str = CUSTOMER, partitions: int | None = None) -> DataFrame:
    """The same rows in a layout that depends on the keys and the partition count only.

    A seed alone does not make k-means repeatable: its random starts depend on which rows share a
    partition and in what order. The count is ``PARTITIONS`` unless it is given, so the result depends
    neither on the session nor on thresholds of the number of rows.
    """
    return df.repartition(partitions or PARTITIONS, key).sortWithinPartitions(key)


def fit_segments(
    df: DataFrame,
    k: int = 7,
    seed: int = 1,
    features: str = FEATURES,
    key: str = CUSTOMER,
    partitions: int | None = None,
    save_path: str | None = None,
) -> KMeansModel:
    """Fit k-means, and save the model if asked."""
    model = KMeans(k=k, seed=seed, featuresCol=features).fit(canonical(df, key, partitions))
    if save_path:
        model.write().overwrite().save(save_path)
    return model


def load_segments(path: str) -> KMeansModel:
    return KMeansModel.load(path)


def score_segments(
    df: DataFrame, model: KMeansModel, key: str = CUSTOMER, seg: str = SEGMENT, save_path: str | None = None
) -> DataFrame:
    """(key, CLUSTER_NUM): the nearest centre of every vector; a map over the rows, nothing moves."""
    scored = model.transform(df).select(key, F.col(model.getPredictionCol()).alias(seg))
    if save_path:
        scored.write.mode("overwrite").parquet(save_path)
        scored = df.sparkSession.read.parquet(save_path)
    return scored


def silhouette(scored: DataFrame, features: str = FEATURES, seg: str = SEGMENT) -> float:
    """Mean silhouette with squared Euclidean distance; cost is linear in the rows."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=seg).evaluate(scored)


def kmeans_sweep(
    df: DataFrame,
    k_max: int = 25,
    fraction: float = 0.5,
    seed: int = 1,
    features: str = FEATURES,
    key: str = CUSTOMER,
    partitions: int | None = None,
    max_iter: int = sweep.MAX_ITER,
) -> DataFrame:
    """(k, silhouette, training_cost) for k = 2..k_max: fitted on a sample of customers, judged on all.

    All k share every pass over the vectors, which are written once (see ``sweep``)."""
    keyed = df.withColumn("_key", F.col(key).cast("string"))
    rows = sweep.as_rows(keyed, key, features, F.coalesce(in_sample(fraction, seed, "_key"), F.lit(False)))
    rows = storage.materialize(canonical(rows, key, partitions), "sweep")
    # The tasks' sums meet in the order in which they end, which shows in the last digits only.
    results = [(k, round(s, 9), round(c, 9)) for k, s, c in sweep.sweep(rows, key, range(2, k_max + 1), seed, max_iter)]
    return df.sparkSession.createDataFrame(results, "k int, silhouette double, training_cost double")


# ---- column expressions, without a model ----


def _table_literal(rows: DataFrame, schema: str):
    """A table of a row per cluster as one constant, an array of structs; its size is clusters times dimensions."""
    lines = [json.dumps(r.asDict(recursive=True)) for r in rows.collect()]
    return F.from_json(F.lit(f"[{','.join(lines)}]"), f"array<struct<{schema}>>")


def _dot(x, y):
    return F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, v: s + v)


def _cluster_sums(df: DataFrame, seg: str, vector: str) -> DataFrame:
    """(seg, n, squares, total) of every cluster: all that distances to its members, or its mean, depend on."""
    squares = F.sum(_dot(F.col(vector), F.col(vector))).alias("squares")
    total = vector_to_array(Summarizer.sum(array_to_vector(F.col(vector)))).alias("total")
    return df.groupBy(F.col(seg).alias("seg")).agg(F.count("*").cast("double").alias("n"), squares, total)


def centroids(df: DataFrame, seg: str = SEGMENT, vector: str = "vector") -> DataFrame:
    """(CLUSTER_NUM, vector): the mean vector of every segment."""
    sums = _cluster_sums(df, seg, vector)
    return sums.select(F.col("seg").alias(SEGMENT), F.transform("total", lambda x: x / F.col("n")).alias("vector"))


def nearest_centroid(df: DataFrame, means: DataFrame, vector: str = "vector", key: str = CUSTOMER) -> DataFrame:
    """(key, CLUSTER_NUM): the segment with the nearest of the given centroids (CLUSTER_NUM, vector), the smaller of equally near ones.

    A map over the rows with column expressions only; nothing moves. A vector that is NULL has no segment."""
    table = _table_literal(means.select(F.col(SEGMENT).cast("long").alias("seg"), "vector"), "seg: bigint, vector: array<double>")
    half = F.transform(table, lambda c: F.struct((_dot(c.vector, c.vector) / 2 - _dot(F.col(vector), c.vector)).alias("d"), c.seg.alias("seg")))
    nearest = F.array_min(half).getField("seg").cast("int")
    return df.select(key, F.when(F.col(vector).isNotNull(), nearest).alias(SEGMENT))


def silhouettes(df: DataFrame, seg: str = SEGMENT, vector: str = "vector") -> DataFrame:
    """``df`` with ``silhouette`` (squared distances) per row, in closed form from one row of sums per cluster.

    The only member of a cluster has 0, and so has everyone where there is one cluster."""
    sums = _cluster_sums(df, seg, vector).withColumn("seg", F.col("seg").cast("long"))
    table = _table_literal(sums, "seg: bigint, n: double, squares: double, total: array<double>")
    x, own = F.col(vector), F.col(seg).cast("long")
    square = _dot(x, x)
    far = F.transform(table, lambda c: F.struct(c.seg.alias("seg"), c.n.alias("n"), (c.n * square - 2 * _dot(x, c.total) + c.squares).alias("d")))
    df = df.withColumn("_far", far)
    mine = F.get(F.filter("_far", lambda c: c.seg == own), F.lit(0))
    inside = F.when(mine.getField("n") > 1, mine.getField("d") / (mine.getField("n") - 1))
    near = F.array_min(F.transform(F.filter("_far", lambda c: c.seg != own), lambda c: c.d / c.n))
    df = df.withColumns({"_inside": inside, "_near": near})
    top = F.greatest("_inside", "_near")
    value = F.when(F.col("_near").isNotNull() & F.col("_inside").isNotNull() & (top > 0), (F.col("_near") - F.col("_inside")) / top)
    return df.withColumn("silhouette", F.coalesce(value, F.lit(0.0))).drop("_far", "_inside", "_near")


def silhouette_by_segment(df: DataFrame, seg: str = SEGMENT, vector: str = "vector") -> DataFrame:
    """(CLUSTER_NUM, n_rows, silhouette): the mean silhouette of every segment."""
    rows = silhouettes(df, seg, vector).groupBy(F.col(seg).alias(SEGMENT))
    return rows.agg(F.count("*").alias("n_rows"), F.avg("silhouette").alias("silhouette"))
