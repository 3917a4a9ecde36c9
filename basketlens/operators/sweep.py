"""The choice of k: k-means for many k in the same passes over the vectors.

The starts of all k are the first k of one sequence of well spread vectors. A pass assigns every vector of the sample
to the nearest centre of each k that still moves, adds up per task by (k, centre) and then over all tasks; the centres, fewer than
``k_max`` squared, are all that the driver sees. Two more passes over all vectors give the silhouette in closed form: the mean
squared distance of a vector to the members of a cluster follows from their number, sum and sum of squares.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions import hash32

# Vectors among which the starts are chosen: those with the smallest hashes of their keys.
START_ROWS = 2048
MAX_ITER, TOLERANCE = 20, 1e-4

_SUMS = "k int, centre int, n double, cost double, squares double, total array<double>"
_SCORE = "k int, n double, score double"


def spread_starts(rows: np.ndarray, k_max: int, seed: int) -> np.ndarray:
    """``k_max`` rows, each drawn with chances that grow with the squared distance to those before it (k-means++)."""
    random = np.random.default_rng(seed)
    chosen = [int(random.integers(len(rows)))]
    distance = ((rows - rows[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k_max:
        total = distance.sum()
        place = np.searchsorted(np.cumsum(distance), random.random() * total, "right") if total else random.integers(len(rows))
        chosen.append(min(int(place), len(rows) - 1))
        distance = np.minimum(distance, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return rows[chosen]


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("_vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _nearest(rows: np.ndarray, centres: np.ndarray):
    """(nearest centre, its squared distance) of every row; the first of equally near ones."""
    distance = (centres**2).sum(axis=1) - 2 * rows @ centres.T
    at = distance.argmin(axis=1)
    return at, np.maximum(distance[np.arange(len(rows)), at] + (rows**2).sum(axis=1), 0)


def _sums(centres: dict, batches):
    """Per k and centre: number, cost in the sample, sum of squares and sum of the rows; one line each per task."""
    found = {k: [np.zeros((k, 3)), np.zeros(c.shape)] for k, c in centres.items()}
    for batch in batches:
        if not batch.num_rows:
            continue
        rows, sampled = _vectors(batch), batch.column("_sampled").to_numpy(zero_copy_only=False)
        squares = (rows**2).sum(axis=1)
        for k, c in centres.items():
            at, cost = _nearest(rows, c)
            for i, values in enumerate((None, cost * sampled, squares)):
                found[k][0][:, i] += np.bincount(at, values, minlength=k)
            members = np.zeros((k, len(rows)))
            members[at, np.arange(len(rows))] = 1
            found[k][1] += members @ rows
    for k, (numbers, total) in found.items():
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, total.shape[1]), pa.int32()), pa.array(total.ravel()))
        columns = [pa.array([k] * k, pa.int32()), pa.array(np.arange(k), pa.int32()), *[pa.array(numbers[:, i]) for i in range(3)], lists]
        yield pa.RecordBatch.from_arrays(columns, ["k", "centre", "n", "cost", "squares", "total"])


def _scores(centres: dict, stats: dict, batches):
    """Per k: number of rows and sum of their silhouettes, one line each per task."""
    found = {k: np.zeros(2) for k in centres}
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _vectors(batch)
        for k, c in centres.items():
            at, _ = _nearest(rows, c)
            found[k] += [len(rows), _silhouettes(rows, at, *stats[k]).sum()]
    columns = [pa.array(list(found), pa.int32()), *[pa.array([v[i] for v in found.values()], pa.float64()) for i in range(2)]]
    yield pa.RecordBatch.from_arrays(columns, ["k", "n", "score"])


def _silhouettes(rows, at, n, squares, total):
    """Silhouette with squared distances; 0 for the only member of a cluster. Empty clusters are nobody's neighbour."""
    own = np.arange(len(rows))
    safe = np.maximum(n, 1)
    mean = (rows**2).sum(axis=1)[:, None] + squares / safe - 2 * rows @ (total / safe[:, None]).T
    mean[:, n == 0] = np.inf
    inside = mean[own, at] * n[at] / np.maximum(n[at] - 1, 1)
    mean[own, at] = np.inf
    near = mean.min(axis=1)
    top = np.maximum(inside, near)
    usable = (n[at] > 1) & (top > 0) & np.isfinite(near)
    return np.where(usable, (near - inside) / np.where(usable, top, 1), 0.0)


def _added(rows: DataFrame, centres: dict) -> dict:
    """{k: (n, cost, squares, total)} over all rows; below ``k_max`` squared lines reach the driver."""
    sums = rows.mapInArrow(partial(_sums, centres), _SUMS).groupBy("k", "centre")
    total = vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total")
    sums = sums.agg(*[F.sum(c).alias(c) for c in ("n", "cost", "squares")], total)
    out = {k: (np.zeros(k), np.zeros(k), np.zeros(k), np.zeros(c.shape)) for k, c in centres.items()}
    for r in sums.collect():
        for array, name in zip(out[r["k"]], ("n", "cost", "squares", "total")):
            array[r["centre"]] = r[name]
    return out


def lloyd(rows: DataFrame, starts: dict, max_iter: int = MAX_ITER, tolerance: float = TOLERANCE) -> dict:
    """{k: centres} after Lloyd steps on ``rows`` (_vector, _sampled) from ``starts``, all k in one pass each.

    A k ends when no centre moves further than ``tolerance``. A centre without members stays where it is."""
    centres, moving = dict(starts), set(starts)
    for _ in range(max_iter):
        for k, (n, _, _, total) in _added(rows, {k: centres[k] for k in sorted(moving)}).items():
            new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres[k])
            if ((new - centres[k]) ** 2).sum(axis=1).max() <= tolerance**2:
                moving.discard(k)
            centres[k] = new
        if not moving:
            break
    return centres


def sweep(rows: DataFrame, key: str, ks, seed: int, max_iter: int = MAX_ITER, tolerance: float = TOLERANCE) -> list[tuple]:
    """(k, silhouette of all rows, cost of the sample) for every k; ``rows``: (key, _vector, _sampled)."""
    sample = rows.where("_sampled")
    order = [hash32(seed, F.col(key).cast("string")), F.col(key)]
    first = sample.orderBy(*order).limit(START_ROWS).select("_vector").toArrow()
    if not first.num_rows:
        return []
    first = first["_vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(first.num_rows, -1)
    starts = spread_starts(first, max(ks), seed)
    centres = lloyd(sample, {k: starts[:k] for k in ks}, max_iter, tolerance)
    added = _added(rows, centres)
    stats = {k: (n, squares, total) for k, (n, _, squares, total) in added.items()}
    scores = rows.mapInArrow(partial(_scores, centres, stats), _SCORE).groupBy("k").agg(F.sum("n").alias("n"), F.sum("score").alias("score"))
    return sorted((r["k"], r["score"] / r["n"], float(added[r["k"]][1].sum())) for r in scores.collect())


def as_rows(df: DataFrame, key: str, features: str, sampled) -> DataFrame:
    """(key, _vector, _sampled) of ML vectors; ``sampled`` marks the rows that are fitted on."""
    return df.select(key, vector_to_array(F.col(features)).alias("_vector"), sampled.alias("_sampled"))
