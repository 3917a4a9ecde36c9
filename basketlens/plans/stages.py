"""The five stages from raw files to segment reports, each reading and writing shared tables.

A stage can be rerun on its own: it reads what the stage before it wrote and overwrites its output.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from basketlens.operators import documents, profiles, quality, segments, vectors, vocabulary
from basketlens.operators.customers import customer_index, identified, sample_customers, to_code, to_index
from basketlens.operators.kpis import segment_kpis
from basketlens.schema import CALENDAR, CUSTOMER, REPORT_VARIABLES, SEGMENT, TRANSACTIONS
from basketlens.sources import staging, storage

INDEX = "cust_idx"


@dataclass(frozen=True)
class Settings:
    """Data parameters of a run. The values are those of the standard run, not tuned ones."""

    sample: bool = False
    sample_rate: float = 0.5
    keep_anonymous: bool = False
    num_prods: int = 4000
    method: str = "dm"
    window: int = 8
    dim: int = 256
    epochs: int = 250
    patience: int | None = 5
    save_period: int | None = 20
    snapshot_period: int | None = 20
    sweep: bool = True
    sweep_k_max: int = 25
    k: int = 7
    seed: int = 1
    partitions: int | None = None


class Layout:
    """Folder names of the tables of a run under one root."""

    def __init__(self, root: str):
        root = root.rstrip("/")
        self.transactions = f"{root}/trans-data"
        self.calendar = f"{root}/time-data"
        self.vocabulary = f"{root}/vocabulary"
        self.customers = f"{root}/customers"
        self.documents = f"{root}/documents"
        self.model = f"{root}/vector-model"
        self.snapshots = f"{root}/vector-snapshots"
        self.vectors = f"{root}/customer-vectors"
        self.sweep = f"{root}/kmeans-sweep"
        self.kmeans = f"{root}/kmeans-model"
        self.scored = f"{root}/scored-kmeans"
        self.kpis = f"{root}/seg-kpis"
        self.profiles = f"{root}/model-profiles"


def stage(spark: SparkSession, raw_path: str, layout: Layout) -> dict[str, dict[str, DataFrame]]:
    """Raw CSV to staged parquet; returns the quality reports of both tables, read from the staged files."""
    staging.write_staged(staging.read_transactions(spark, raw_path), layout.transactions, by_file=True)
    staging.write_staged(staging.read_calendar(spark, raw_path), layout.calendar, partition_by=None)
    trans = staging.read_staged(spark, layout.transactions, TRANSACTIONS)
    calendar = staging.read_staged(spark, layout.calendar, CALENDAR)
    reports = {"transactions": quality.all_reports(trans), "calendar": quality.all_reports(calendar)}
    reports["transactions"]["summary"] = quality.dataset_summary(trans)
    return reports


def prepare(spark: SparkSession, layout: Layout, settings: Settings) -> None:
    """Staged transactions to vocabulary, customer index and documents."""
    keep = settings.keep_anonymous
    trans = identified(staging.read_staged(spark, layout.transactions, TRANSACTIONS), keep)
    if settings.sample:
        trans = sample_customers(trans, settings.sample_rate)
    storage.write_table(vocabulary.vocabulary(trans, settings.num_prods, keep), layout.vocabulary)
    vocab = storage.read_table(spark, layout.vocabulary)
    storage.write_table(customer_index(trans, keep_anonymous=keep), layout.customers)
    storage.write_table(documents.customer_documents(trans, vocab, settings.num_prods, keep), layout.documents)


def train(spark: SparkSession, layout: Layout, settings: Settings) -> vectors.VectorModel:
    """Documents to customer vectors, which are also written by customer index: a number in place of a code for what follows."""
    model = vectors.train_vectors(
        storage.read_table(spark, layout.documents),
        settings.num_prods,
        method=settings.method,
        window=settings.window,
        dim=settings.dim,
        epochs=settings.epochs,
        patience=settings.patience,
        save_path=f"{layout.model}-epoch-{{epoch}}" if settings.save_period else None,
        save_period=settings.save_period,
        snapshot_path=f"{layout.snapshots}-{{epoch}}" if settings.snapshot_period else None,
        snapshot_period=settings.snapshot_period,
        seed=settings.seed,
        partitions=settings.partitions,
    )
    model.save(layout.model)
    model = vectors.VectorModel.load(spark, layout.model)
    storage.write_table(to_index(model.customer_vectors, storage.read_table(spark, layout.customers)), layout.vectors)
    return model


def segment(spark: SparkSession, layout: Layout, settings: Settings) -> DataFrame:
    """Customer vectors to one segment per customer; the sweep over k is written if asked for.

    All of it runs on customer indexes; codes come back with the scores, by key."""
    features = segments.assemble(storage.read_table(spark, layout.vectors), key=INDEX)
    if settings.sweep:
        sweep = segments.kmeans_sweep(
            features, settings.sweep_k_max, seed=settings.seed, key=INDEX, partitions=settings.partitions
        )
        storage.write_table(sweep, layout.sweep)
    fitted = segments.fit_segments(
        features, settings.k, settings.seed, key=INDEX, partitions=settings.partitions, save_path=layout.kmeans
    )
    scored = to_code(segments.score_segments(features, fitted, key=INDEX), storage.read_table(spark, layout.customers))
    storage.write_table(scored.select(CUSTOMER, SEGMENT), layout.scored)
    return storage.read_table(spark, layout.scored)


def profile(spark: SparkSession, layout: Layout, variables=REPORT_VARIABLES) -> None:
    """Staged transactions and segments to the KPI and index-profile reports."""
    trans = staging.read_staged(spark, layout.transactions, TRANSACTIONS)
    scored = storage.read_table(spark, layout.scored)
    storage.write_report(segment_kpis(trans, scored), layout.kpis, [SEGMENT])
    report = profiles.segment_profiles(trans, scored, variables)
    storage.write_report(report, layout.profiles, ["var", SEGMENT, "var_detail"])


def run_all(spark: SparkSession, raw_path: str, root: str, settings: Settings = Settings()) -> Layout:
    """All five stages in order."""
    layout = Layout(root)
    stage(spark, raw_path, layout)
    prepare(spark, layout, settings)
    train(spark, layout, settings)
    segment(spark, layout, settings)
    profile(spark, layout)
    return layout
