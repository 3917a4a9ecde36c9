"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features, those of the lines before and after it, and the labels
next to it. A document's score is the mean of the lines' forward-backward marginals, weighted by line length.

The field is fitted on the driver from a bounded sample of labelled documents: at most ``SAMPLE_DOCS``, those with the
smallest hashes; of a longer document, ``SAMPLE_LINES`` lines in a row teach the field. Scoring covers every line of every text.

Defined cases: NULL and empty text is one empty line; labels that are NULL or of unknown documents are ignored,
repeated labels of a document are averaged; with no labels, or no documents for them, every score is 0.5; repeated
rows score alike; other columns pass through.
"""

import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import extended

SAMPLE_DOCS = 3000
SAMPLE_LINES = 200
THRESHOLD = 0.7
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
# Steps of a measure become 0/1 features, since quality does not change evenly with any of them.
STEPS = {
    "punctuation": (0.03, 0.06, 0.1, 0.2, 0.35), "digits": (0.05, 0.2, 0.5), "upper": (0.1, 0.3, 0.6),
    "distinct": (0.25, 0.5, 0.7, 0.9), "twice": (0.05, 0.2, 0.5), "top": (0.15, 0.3, 0.6),
    "words": (1.5, 3.5, 8.5, 20.5, 60.5), "word_length": (2.5, 4, 7, 10), "closed": (0.5,),
}
_EDGES = [(i, e) for i, edges in enumerate(STEPS.values()) for e in edges]
_COLUMN, _EDGE = np.array([i for i, _ in _EDGES]), np.array([e for _, e in _EDGES])


def _measures(line: str) -> tuple:
    data, words = line.encode(), line.split()
    size, n = max(1, len(data)), max(1, len(words))
    return (
        (len(data) - len(data.translate(None, _PUNCTUATION))) / size,
        (len(data) - len(data.translate(None, _DIGITS))) / size,
        (len(data) - len(data.translate(None, _UPPER))) / size,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        max(Counter(words).values(), default=0) / n if n > 3 else 0.0,
        len(words),
        sum(map(len, words)) / n,
        float(line.rstrip().endswith((".", "!", "?", ":", '"', "»"))),
    )


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) of the lines: own steps, the neighbours' mean steps, first and last line, constant."""
    lines = (text or "").split("\n")
    own = (np.array([_measures(x) for x in lines])[:, _COLUMN] > _EDGE).astype(np.float32)
    near = np.zeros_like(own)
    near[1:] += own[:-1] / 2
    near[:-1] += own[1:] / 2
    ends = np.zeros((len(lines), 3), np.float32)
    ends[0, 0] = ends[-1, 1] = 1
    ends[:, 2] = 1
    return np.hstack([own, near, ends]), np.array([len(x) + 1 for x in lines], np.float64)


def marginals(scores: np.ndarray, stay: float) -> np.ndarray:
    """P(good) per line. ``scores``: log-odds of good from the features; ``stay``: reward for equal neighbours."""
    n = len(scores)
    gain = float(np.exp(min(max(stay, -30), 30)))
    odds = np.exp(np.clip(scores, -30, 30)).tolist()
    ahead, r = [0.0] * n, 1.0  # r: odds that reach a line from the left, before its own score
    for i in range(n):
        ahead[i] = r
        f = r * odds[i]
        r = (gain * f + 1) / (f + gain)
    out, r = [0.0] * n, 1.0
    for i in range(n - 1, -1, -1):
        o = ahead[i] * odds[i] * r
        out[i] = o / (1 + o)
        f = r * odds[i]
        r = (gain * f + 1) / (f + gain)
    return np.array(out)


def fit_field(features: list[np.ndarray], labels: list[int], rounds: int = 120, rate: float = 0.15, decay: float = 1e-3):
    """(weights, stay) by Adam on the exact gradient of the conditional log-likelihood; lines carry their document's label."""
    order = sorted(range(len(features)), key=lambda i: -len(features[i]))
    lengths = np.array([len(features[i]) for i in order])
    # Time-major layout: line t of all documents that have one, longest documents first.
    alive = [int((lengths > t).sum()) for t in range(lengths[0])]
    x = np.concatenate([np.stack([features[i][t] for i in order[:k]]) for t, k in enumerate(alive)]).astype(np.float64)
    y = np.concatenate([np.array([labels[i] for i in order[:k]], float) for k in alive])
    at = np.cumsum([0, *alive])
    theta, m, v = np.zeros(x.shape[1] + 1), 0.0, 0.0
    share = min(max(float(np.mean(labels)), 0.01), 0.99)
    theta[-2] = np.log(share / (1 - share))
    n_docs = len(order)
    for step in range(1, rounds + 1):
        odds, gain = np.exp(np.clip(x @ theta[:-1], -30, 30)), np.exp(np.clip(theta[-1], -30, 30))
        left, right = np.ones(len(x)), np.ones(len(x))
        for t in range(1, len(alive)):
            f = (left * odds)[at[t - 1] : at[t - 1] + alive[t]]
            left[at[t] : at[t + 1]] = (gain * f + 1) / (f + gain)
        for t in range(len(alive) - 2, -1, -1):
            k = alive[t + 1]
            f = (right * odds)[at[t + 1] : at[t + 1] + k]
            right[at[t] : at[t] + k] = (gain * f + 1) / (f + gain)
        o = left * odds * right
        p = o / (1 + o)
        # Expected number of equal neighbours, from the pair marginals; observed are all of them.
        equal = 0.0
        for t in range(1, len(alive)):
            a = (left * odds)[at[t - 1] : at[t - 1] + alive[t]]
            b = (right * odds)[at[t] : at[t + 1]]
            equal += float((gain * (a * b + 1) / (gain * (a * b + 1) + a + b)).sum())
        grad = np.append(x.T @ (y - p), (len(x) - n_docs) - equal) / n_docs - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def sampled_lines(text: str | None) -> np.ndarray:
    """Features of the lines that teach the field: all of a document, or of a long one ``SAMPLE_LINES`` in a row."""
    x, _ = line_features(text)
    start = zlib.crc32((text or "").encode()) % max(1, len(x) - SAMPLE_LINES + 1)
    return x[start : start + SAMPLE_LINES]


def held_out(doc_id: Column) -> Column:
    """Whether labels of the document are kept from the fit."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS):
    """(weights, stay) from a bounded sample of the labelled documents that are not held out; None without any."""
    known = labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)

    def run(batches):
        for batch in batches:
            rows = [(zlib.compress(sampled_lines(t).tobytes(), 1), g) for t, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32())], ["x", "good"])

    # The sample is bounded, and so is what is broadcast and collected.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "good").mapInArrow(run, "x binary, good int").collect()
    if not rows:
        return None
    width = 2 * len(_EDGES) + 3
    rows.sort(key=lambda r: bytes(r["x"]))  # the fit does not depend on the order of tasks
    return fit_field([np.frombuffer(zlib.decompress(r["x"]), np.float32).reshape(-1, width) for r in rows], [r["good"] for r in rows])


def document_score(text: str | None, model) -> float:
    if model is None:
        return 0.5
    x, weight = line_features(text)
    return float(np.clip((marginals(x @ model[0], model[1]) * weight).sum() / weight.sum(), 0.0, 1.0))


def score(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.7)."""
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    at = keep.index(text)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                scores = [document_score(t.as_py(), model) for t in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], [*keep, "score"])

    plain = docs.select(*keep)
    scored = plain.mapInArrow(run, extended(plain, score="double"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are predicted good."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return score(rows, fit(docs, labels)).where("predicted = 1").select("row.*")
