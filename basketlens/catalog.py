"""The registered queries: every operator over the whole tables, with an SQL counterpart where SQL can say it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.catalog_sql import oracle_sql
from basketlens.operators import customers, documents, habits, kpis, profiles, quality, segments, vectors, windows
from basketlens.operators import vocabulary as vocab_ops
from basketlens.plans.stages import Settings
from basketlens.schema import CALENDAR, HABIT_PREFIX, REPORT_VARIABLES, TRANSACTIONS
from basketlens.sources import adapter, staging, storage

__all__ = ["oracle_sql", "queries"]

QUERIES = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def queries():
    return dict(QUERIES)


def _lines(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Some columns of the transactions, staged once: the join behind them is not repeated by every pass."""
    return storage.materialize(adapter.transactions(spark, path).select(*columns), "lines")


def _trans_and_segments(spark: SparkSession, path: str, *columns: str):
    trans = _lines(spark, path, "CUST_CODE", "BASKET_ID", *columns)
    return trans, adapter.number_segments(trans)


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- sources and sinks ----


@_query
def staged_transactions(spark, path):
    """The transactions after the whole way: CSV files, typed scan, staged parquet, typed scan."""
    root = storage.scratch_path(spark, "staging")
    trans = adapter.transactions(spark, path).select(*TRANSACTIONS.fieldNames())
    staging.write_raw(trans, f"{root}/raw/transactions", "BASKET_ID")
    staging.write_staged(staging.read_transactions(spark, f"{root}/raw"), f"{root}/trans-data", by_file=True)
    staged = staging.read_staged(spark, f"{root}/trans-data", TRANSACTIONS)
    return staged.withColumn("SPEND", F.round(F.col("SPEND").cast("double"), 2))


@_query
def staged_calendar(spark, path):
    root = storage.scratch_path(spark, "staging")
    adapter.calendar(adapter.transactions(spark, path)).write.option("header", True).csv(f"{root}/raw/time.csv")
    staging.write_staged(staging.read_calendar(spark, f"{root}/raw"), f"{root}/time-data", partition_by=None)
    return staging.read_staged(spark, f"{root}/time-data", CALENDAR)


@_query
def kpi_report(spark, path):
    """The KPI report as it comes back from its CSV files."""
    report = kpis.segment_kpis(*_trans_and_segments(spark, path, "QUANTITY", "SPEND"))
    target = storage.scratch_path(spark, "report")
    storage.write_report(report, target, ["CLUSTER_NUM"])
    return storage.read_report(spark, target, report.schema)


# ---- data quality ----


@_query
def dataset_summary(spark, path):
    return quality.dataset_summary(adapter.transactions(spark, path))


@_query
def table_shape(spark, path):
    return quality.shape(adapter.transactions(spark, path))


@_query
def schema_report(spark, path):
    trans = adapter.transactions(spark, path)
    return quality.schema_report(trans).join(quality.missing_rates(trans), "column")


@_query
def head_records(spark, path):
    order = ["SHOP_DATE", "BASKET_ID", "PROD_CODE", "QUANTITY", "SPEND"]
    return quality.head(adapter.transactions(spark, path), 10, order)


@_query
def duplicate_check(spark, path):
    return quality.duplicate_check(adapter.transactions(spark, path))


@_query
def missing_rates(spark, path):
    return quality.missing_rates(adapter.transactions(spark, path))


@_query
def top20_values(spark, path):
    return quality.top_values(adapter.transactions(spark, path), 20)


@_query
def numeric_profile(spark, path):
    return _rounded(quality.numeric_profile(adapter.transactions(spark, path)), 6, "mean", "std")


# ---- customers, vocabulary, documents, windows ----

NUM_PRODS = 500
WINDOW = 8


def _documents(spark: SparkSession, path: str, num_prods: int = NUM_PRODS) -> DataFrame:
    trans = _lines(spark, path, "CUST_CODE", "PROD_CODE")
    return documents.customer_documents(trans, vocab_ops.vocabulary(trans, num_prods), num_prods)


def _as_text(column: str):
    return F.array_join(column, ",").alias(column)


@_query
def sampled_customers(spark, path):
    return customers.sample_customers(adapter.transactions(spark, path), 0.5)


@_query
def customer_index(spark, path):
    return customers.customer_index(adapter.transactions(spark, path))


@_query
def vocabulary(spark, path):
    return vocab_ops.vocabulary(adapter.transactions(spark, path), NUM_PRODS)


@_query
def oov_summary(spark, path):
    trans = adapter.transactions(spark, path)
    return vocab_ops.oov_summary(trans, vocab_ops.vocabulary(trans, NUM_PRODS), NUM_PRODS)


@_query
def customer_documents(spark, path):
    docs = _documents(spark, path)
    return docs.select("CUST_CODE", "n_unknown", F.array_join(documents.sequence(), ",").alias("document"))


def _dated_documents(spark: SparkSession, path: str) -> DataFrame:
    trans = _lines(spark, path, "CUST_CODE", "PROD_CODE", "SHOP_DATE")
    return documents.customer_documents(trans, vocab_ops.vocabulary(trans, NUM_PRODS), NUM_PRODS, order_by="SHOP_DATE")


@_query
def dated_documents(spark, path):
    """Documents in the order of first purchases."""
    docs = _dated_documents(spark, path)
    return docs.select("CUST_CODE", "n_unknown", F.array_join(documents.sequence(ordered=True), ",").alias("document"))


@_query
def dated_dm_pairs(spark, path):
    pairs = windows.dm_pairs(_dated_documents(spark, path), WINDOW)
    return pairs.select("CUST_CODE", "target_pos", _as_text("context"), "target")


@_query
def dated_epoch_sample_dbow(spark, path):
    sample = windows.epoch_sample(_dated_documents(spark, path), WINDOW, "dbow", epoch=3, seed=1)
    return sample.select("CUST_CODE", "pos", _as_text("context"))


@_query
def indexed_documents(spark, path):
    index = customers.customer_index(adapter.transactions(spark, path))
    return customers.to_index(_documents(spark, path), index).select("cust_idx", "n_unknown", _as_text("prod_idxs"))


@_query
def dm_pairs(spark, path):
    pairs = windows.dm_pairs(_documents(spark, path), WINDOW)
    return pairs.select("CUST_CODE", "target_pos", _as_text("context"), "target")


@_query
def dbow_pairs(spark, path):
    pairs = windows.dbow_pairs(_documents(spark, path), WINDOW)
    return pairs.select("CUST_CODE", "start_pos", _as_text("context"))


@_query
def epoch_sample_dm(spark, path):
    sample = windows.epoch_sample(_documents(spark, path), WINDOW, "dm", epoch=3, seed=1)
    return sample.select("CUST_CODE", "pos", _as_text("context"), "target")


@_query
def epoch_sample_dbow(spark, path):
    sample = windows.epoch_sample(_documents(spark, path), WINDOW, "dbow", epoch=3, seed=1)
    return sample.select("CUST_CODE", "pos", _as_text("context"))


# ---- segments and profiles ----


@_query
def segment_kpis(spark, path):
    return kpis.segment_kpis(*_trans_and_segments(spark, path, "QUANTITY", "SPEND"))


@_query
def habit_counts(spark, path):
    return habits.habit_counts(adapter.transactions(spark, path))


@_query
def dominant_attributes(spark, path):
    return habits.dominant_attributes(adapter.transactions(spark, path))


@_query
def dominant_attributes_first(spark, path):
    return habits.dominant_attributes(adapter.transactions(spark, path), ties="first")


@_query
def customer_attributes(spark, path):
    wide = habits.customer_attributes(adapter.transactions(spark, path))
    return wide.select("CUST_CODE", *[F.array_join(c, "|").alias(c) for c in wide.columns[1:]])


def _members(spark: SparkSession, path: str) -> DataFrame:
    """Two narrow passes over the lines, which cost less than a written copy."""
    trans = adapter.transactions(spark, path).select("CUST_CODE", "BASKET_ID")
    return profiles.profile_members(trans, adapter.number_segments(trans))


@_query
def segment_sizes(spark, path):
    return profiles.segment_sizes(_members(spark, path))


@_query
def customer_total(spark, path):
    return profiles.customer_total(_members(spark, path))


@_query
def segment_profile(spark, path):
    trans, scored = _trans_and_segments(spark, path, "CUST_LIFESTAGE")
    joined = trans.select("CUST_CODE", "CUST_LIFESTAGE").join(scored, "CUST_CODE")
    return profiles.segment_profile(joined, "CUST_LIFESTAGE")


def _profiles(spark, path, variables):
    columns = [v.removeprefix(HABIT_PREFIX) for v in variables]
    return profiles.segment_profiles(*_trans_and_segments(spark, path, *columns), variables=variables)


@_query
def segment_profiles_all(spark, path):
    return _profiles(spark, path, REPORT_VARIABLES)


@_query
def segment_profiles_extra(spark, path):
    variables = [
        "DOM_CUST_STORE_CODE",
        "DOM_CUST_STORE_REGION",
        "CUST_LIFESTAGE",
        "PROD_CODE",
        "PROD_CODE_10",
        "PROD_CODE_20",
    ]
    return _profiles(spark, path, variables)


# ---- vectors and clustering ----

TRAINING = {"window": WINDOW, "dim": 32, "epochs": 4}


def _trained(spark: SparkSession, path: str, method: str) -> vectors.VectorModel:
    return vectors.train_vectors(_documents(spark, path), NUM_PRODS, method, **TRAINING)


def _embeddings(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.parquet(f"{path}/embeddings.parquet")
    return table.select(F.col("vec_id").cast("string").alias("CUST_CODE"), F.col("embedding").alias("vector"), "label")


STEP = {"window": WINDOW, "dim": 8, "rate": 10.0}


def _first_step(spark: SparkSession, path: str, method: str) -> DataFrame:
    rows = vectors.first_step(_documents(spark, path), NUM_PRODS, method, **STEP)
    # A row per number: a number at the edge of two rounded ones would otherwise spoil its row's text.
    numbers = rows.where("layer <> 'loss'").select("layer", "CUST_CODE", "prod_idx", F.posexplode("vector").alias("place", "value"))
    loss = rows.where("layer = 'loss'").select("layer", "CUST_CODE", "prod_idx", F.lit(0).alias("place"), F.col("loss").alias("value"))
    return _rounded(numbers.unionByName(loss), 5, "value")


@_query
def training_step_dm(spark, path):
    return _first_step(spark, path, "dm")


@_query
def training_step_dbow(spark, path):
    return _first_step(spark, path, "dbow")


@_query
def customer_vectors_dbow(spark, path):
    return _trained(spark, path, "dbow").customer_vectors


@_query
def customer_vectors_dm(spark, path):
    return _trained(spark, path, "dm").customer_vectors


@_query
def customer_vectors_full_size(spark, path):
    """The standard run's model: 4,000 products, dimension 256, a patience of 5; three epochs of its 250."""
    model = vectors.train_vectors(_documents(spark, path, 4000), 4000, "dm", WINDOW, 256, epochs=3, patience=5)
    return model.customer_vectors


@_query
def product_vectors_dm(spark, path):
    return _trained(spark, path, "dm").product_vectors


@_query
def training_history(spark, path):
    return _trained(spark, path, "dbow").history


@_query
def silhouette_given_labels(spark, path):
    value = segments.silhouette(segments.assemble(_embeddings(spark, path), keep=["label"]), seg="label")
    return spark.createDataFrame([(round(value, 8),)], "silhouette double")


@_query
def silhouette_by_segment(spark, path):
    scores = segments.silhouette_by_segment(_embeddings(spark, path), "label")
    return _rounded(scores.withColumnRenamed("CLUSTER_NUM", "label"), 8, "silhouette")


@_query
def nearest_centroid_score(spark, path):
    rows = _embeddings(spark, path)
    return segments.nearest_centroid(rows, segments.centroids(rows, "label"))


@_query
def kmeans_segments(spark, path):
    features = segments.assemble(_embeddings(spark, path))
    return segments.score_segments(features, segments.fit_segments(features, k=7))


@_query
def kmeans_sweep(spark, path):
    return segments.kmeans_sweep(segments.assemble(_embeddings(spark, path)), k_max=25)


@_query
def learned_segment_kpis(spark, path):
    """Transactions to documents, vectors, segments and the KPIs of these segments, with the sizes of the standard run."""
    run = Settings()
    docs = _documents(spark, path, run.num_prods)
    model = vectors.train_vectors(docs, run.num_prods, "dbow", run.window, run.dim, run.epochs, patience=run.patience)
    features = segments.assemble(model.customer_vectors)
    scored = segments.score_segments(features, segments.fit_segments(features, k=run.k))
    return kpis.segment_kpis(adapter.transactions(spark, path), scored)
