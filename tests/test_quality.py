import datetime
import math

import pytest
from pyspark.sql import functions as F

from basketlens.operators import quality
from tests.helpers import rows, scattered


@pytest.fixture
def mixed(spark):
    data = [
        ("a", 1, 1.0, datetime.date(2020, 1, 1)),
        ("a", 1, 1.0, datetime.date(2020, 1, 1)),
        ("b", None, float("nan"), None),
        (None, 3, None, datetime.date(2020, 1, 2)),
    ]
    return spark.createDataFrame(data, "s string, i int, f float, d date")


def test_shape_and_schema(mixed):
    assert rows(quality.shape(mixed)) == [(4, 4)]
    report = [tuple(r) for r in quality.schema_report(mixed).orderBy("position").collect()]
    assert report == [(0, "s", "string", True), (1, "i", "int", True), (2, "f", "float", True), (3, "d", "date", True)]


def test_missing_counts_null_and_nan(mixed):
    assert rows(quality.missing_rates(mixed)) == [("d", 0.25), ("f", 0.5), ("i", 0.25), ("s", 0.25)]


def test_duplicates(spark, mixed):
    assert rows(quality.duplicate_check(mixed)) == [(4, 3)]
    assert rows(quality.duplicate_check(mixed.where("false"))) == [(0, 0)]


def test_duplicates_where_digests_meet(spark, monkeypatch):
    """Also where digests of different rows are equal, and beyond the bound of the broadcast."""
    data = [(None, "a"), ("a", None), ("a", None), ("b", "c")] + [(f"k{i % 40}", f"v{i % 3}") for i in range(300)]
    df = spark.createDataFrame(data, "x string, y string")
    want = [(len(data), len(set(data)))]
    assert rows(quality.duplicate_check(df)) == want
    monkeypatch.setattr(quality, "BROADCAST_DIGESTS", 0)
    assert rows(quality.duplicate_check(df)) == want
    monkeypatch.setattr(quality, "row_digest", lambda df: [F.pmod(F.hash("x"), F.lit(7)).alias(f"_digest{i}") for i in (0, 1)])
    assert rows(quality.duplicate_check(df)) == want


def test_digests_are_all_that_is_shuffled(spark):
    df = spark.range(1000).selectExpr("id", *[f"concat('some long text of column {i} ', id) as c{i}" for i in range(20)])
    digests = df.select(*quality.row_digest(df)).groupBy("_digest0", "_digest1").count()
    plan = digests._jdf.queryExecution().executedPlan().toString()
    assert "c19" not in plan.split("Exchange")[0]
    assert digests.count() == 1000 and digests.where("count > 1").count() == 0


def test_summary_without_multiplied_rows(spark):
    df = spark.range(5000).selectExpr("id % 700 as a", "if(id % 5 = 0, null, id % 90) as b", "id % 12 as SHOP_WEEK")
    columns = ["a", "b"]
    exact = quality.dataset_summary(df, columns)
    assert "Expand" not in exact._jdf.queryExecution().executedPlan().toString()
    assert rows(exact) == [(700, 73)]
    (a, b), = rows(quality.dataset_summary(df, columns, approx=True))
    assert abs(a - 700) <= 14 and abs(b - 73) <= 2
    weeks = quality.value_sketches(df, columns)
    assert weeks.count() == 12
    ((x, y),) = rows(quality.merged_summary(weeks, columns))
    assert abs(x - 700) <= 14 and y == b
    assert rows(quality.dataset_summary(df.limit(0), columns)) == [(0, 0)] == rows(quality.dataset_summary(df.limit(0), columns, approx=True))


def test_summary_counts_null_as_a_value(mixed):
    assert rows(quality.dataset_summary(mixed, ["s", "i"])) == [(3, 3)]


def test_numeric_profile_skips_dates(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (3, 2.0, "y"), (None, None, "z")], "i int, f double, s string")
    got = {r["column"]: r for r in quality.numeric_profile(df).collect()}
    assert set(got) == {"i", "f"}
    assert (got["i"]["mean"], got["i"]["max"], got["i"]["min"]) == (2.0, 3.0, 1.0)
    assert math.isclose(got["i"]["std"], math.sqrt(2)) and got["f"]["std"] == 0.0


def test_top_values_ties_and_null(spark):
    values = ["b", "a", "c", "c", None, None, None] + [f"z{i:02}" for i in range(30)]
    df = spark.createDataFrame([(v, 1) for v in values], "s string, n int")
    for table in (df, scattered(df)):
        got = [(r["value"], r["n_rows"]) for r in quality.top_values(table).orderBy("position").collect()]
        assert got == [(None, 3), ("c", 2), ("a", 1), ("b", 1)] + [(f"z{i:02}", 1) for i in range(16)]
    with pytest.raises(ValueError):
        quality.top_values(df, 0)


@pytest.mark.parametrize("limit", ["1000", "-1"])
def test_top_values_of_any_number_and_setting(spark, limit):
    df = spark.range(6000).selectExpr("cast(id as string) s")
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        got = [r["value"] for r in quality.top_values(df, 5000).orderBy("position").collect()]
    finally:
        spark.conf.set(key, before)
    assert got == sorted(str(i) for i in range(6000))[:5000]


def test_top_values_are_limited_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("cast(id as string) s")
    plan = quality.top_values(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_tables_without_strings_or_numbers(spark):
    numbers, strings = spark.range(3), spark.createDataFrame([("a",)], "s string")
    assert quality.top_values(numbers).count() == 0
    assert quality.top_values(numbers).dtypes == quality.top_values(strings).dtypes
    assert quality.numeric_profile(strings).count() == 0
    assert quality.numeric_profile(strings).dtypes == quality.numeric_profile(numbers).dtypes


def test_head(spark):
    df = spark.range(50)
    assert [r["id"] for r in quality.head(df, order_by=[df.id.desc()]).collect()] == list(range(49, 39, -1))
    assert quality.head(df).count() == 10


def test_all_reports(mixed):
    reports = quality.all_reports(mixed)
    assert all(t.count() >= 1 for t in reports.values()) and len(reports) == 7
