"""All five stages from CSV files to reports."""

import pytest

from basketlens.operators import kpis, profiles
from basketlens.plans import stages
from basketlens.schema import CALENDAR, TRANSACTIONS
from basketlens.sources import adapter, staging, storage
from tests.conftest import TESTDATA
from tests.helpers import rows


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    trans = adapter.transactions(spark, str(TESTDATA / "sf0.001")).select(*TRANSACTIONS.fieldNames())
    trans.toPandas().to_csv(root / "transactions_1.csv", index=False)
    adapter.calendar(trans).toPandas().to_csv(root / "time.csv", index=False)
    return str(root)


def test_run_all(spark, raw, tmp_path):
    settings = stages.Settings(
        num_prods=100, method="dbow", dim=8, epochs=2, save_period=None, snapshot_period=1, sweep_k_max=3, k=3
    )
    layout = stages.run_all(spark, raw, str(tmp_path), settings)

    trans = staging.read_staged(spark, layout.transactions, TRANSACTIONS)
    assert trans.count() == 6000
    assert staging.read_staged(spark, layout.calendar, CALENDAR).count() == trans.select("SHOP_WEEK").distinct().count()
    customers = {r[0] for r in rows(storage.read_table(spark, layout.customers))}
    scored = storage.read_table(spark, layout.scored)
    vectors_ = storage.read_table(spark, layout.vectors)
    assert sorted(r["cust_idx"] for r in vectors_.collect()) == list(range(len(customers)))
    assert {r[0] for r in rows(scored)} == customers
    assert [r["k"] for r in storage.read_table(spark, layout.sweep).orderBy("k").collect()] == [2, 3]
    assert storage.read_table(spark, f"{layout.snapshots}-1").count() == len(customers)

    report = kpis.segment_kpis(trans, scored)
    assert rows(storage.read_report(spark, layout.kpis, report.schema)) == rows(report)
    report = profiles.segment_profiles(trans, scored)
    back = storage.read_report(spark, layout.profiles, report.schema)
    assert rows(back) == rows(report) and back.select("var").distinct().count() == 9


def test_reports_and_sample(spark, raw, tmp_path):
    layout = stages.Layout(str(tmp_path))
    reports = stages.stage(spark, raw, layout)
    assert reports["transactions"]["shape"].first()["n_rows"] == 6000
    assert reports["transactions"]["summary"].first()["n_basket_id"] > 100
    assert reports["calendar"]["shape"].first()["n_columns"] == 3
    everyone = staging.read_staged(spark, layout.transactions).select("CUST_CODE").distinct().count() - 1
    stages.prepare(spark, layout, stages.Settings(sample=True, sample_rate=0.5, num_prods=50))
    assert 0 < storage.read_table(spark, layout.documents).count() < everyone
    assert storage.read_table(spark, layout.vocabulary).count() == 49
