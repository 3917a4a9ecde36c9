import datetime

import pytest
from pyspark.errors import AnalysisException

from basketlens.schema import CALENDAR, TRANSACTIONS
from basketlens.sources import staging, storage
from tests.helpers import left_over, lines, rows, shuffle_files

HEADER = ",".join(TRANSACTIONS.fieldNames())


def line(week, product, spend="1.5", quantity="2"):
    cells = [str(week), "20060410", "1", "9", quantity, spend, product] + ["x"] * 15
    return ",".join(cells)


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "transactions_200607.csv").write_text("\n".join([HEADER, line(200607, "P1"), line(200607, "P2")]))
    (tmp_path / "deep" / "er" / "my_transactions.csv").write_text(
        "\n".join([HEADER, line(200608, "P3", spend="bad", quantity="many")])
    )
    (tmp_path / "other.csv").write_text("\n".join([HEADER, line(1, "NO")]))
    (tmp_path / "time.csv").write_text("shop_week,date_from,date_to\n200607,20060410,20060416\n")
    return str(tmp_path)


def test_reads_all_matching_files_by_position(spark, raw):
    df = staging.read_transactions(spark, raw)
    assert df.schema == TRANSACTIONS
    assert rows(df, "SHOP_WEEK", "PROD_CODE", "SPEND", "QUANTITY") == [
        (200607, "P1", 1.5, 2),
        (200607, "P2", 1.5, 2),
        (200608, "P3", None, None),
    ]


def test_a_folder_may_carry_the_name(spark, tmp_path):
    root = tmp_path / "transactions of a year"
    (root / "transactions").mkdir(parents=True)
    (root / "transactions" / "part-0.csv").write_text("\n".join([HEADER, line(200607, "P1")]))
    (root / "part-0.csv").write_text("\n".join([HEADER, line(1, "NO")]))
    assert rows(staging.read_transactions(spark, str(root)), "PROD_CODE") == [("P1",)]
    assert rows(staging.read_transactions(spark, str(root), "*.csv"), "PROD_CODE") == [("NO",), ("P1",)]


def test_reads_calendar(spark, raw):
    df = staging.read_calendar(spark, raw)
    assert df.schema == CALENDAR
    assert rows(df) == [(200607, 20060410, 20060416)]


def test_nothing_to_read_gives_typed_empty_tables(spark, tmp_path):
    (tmp_path / "other.csv").write_text("a\n1\n")
    assert staging.read_transactions(spark, str(tmp_path)).schema == TRANSACTIONS
    assert staging.read_transactions(spark, str(tmp_path)).count() == 0
    assert staging.read_transactions(spark, str(tmp_path / "missing")).count() == 0
    assert staging.read_calendar(spark, str(tmp_path)).schema == CALENDAR
    assert staging.read_calendar(spark, str(tmp_path)).count() == 0


def test_union_is_by_position_and_keeps_copies(spark, raw):
    df = staging.read_calendar(spark, raw)
    assert rows(staging.union_tables(df, df, df)) == [(200607, 20060410, 20060416)] * 3


def test_staged_round_trip_one_folder_per_week(spark, raw, tmp_path):
    target = str(tmp_path / "staged")
    df = staging.read_transactions(spark, raw)
    for _ in range(2):
        staging.write_staged(df, target)
    back = staging.read_staged(spark, target, TRANSACTIONS)
    assert back.columns == TRANSACTIONS.fieldNames()
    assert rows(back) == rows(df)
    folders = {p.name for p in (tmp_path / "staged").iterdir() if p.is_dir()}
    assert folders == {"SHOP_WEEK=200607", "SHOP_WEEK=200608"}
    pruned = back.where("SHOP_WEEK = 200608")
    assert "PartitionFilters: [isnotnull(SHOP_WEEK" in pruned._jdf.queryExecution().executedPlan().toString()


def test_staged_null_week_and_dominant_week(spark, tmp_path):
    data = [{"SHOP_WEEK": None, "PROD_CODE": "P"}] + [{"SHOP_WEEK": 1 + (i % 10 == 0), "PROD_CODE": f"P{i}"} for i in range(500)]
    df = lines(spark, data)
    staging.write_staged(df, str(tmp_path / "s"))
    assert rows(staging.read_staged(spark, str(tmp_path / "s"), TRANSACTIONS)) == rows(df)


def test_report_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1), (None, 3)], "name string, n int")
    storage.write_report(df, str(tmp_path / "r"), ["n"])
    assert rows(storage.read_report(spark, str(tmp_path / "r"), df.schema)) == rows(df)


def test_scratch_is_under_the_shared_folder_of_the_session(spark, tmp_path):
    spark.conf.set("spark.checkpoint.dir", str(tmp_path)) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    first, second = storage.scratch_path(spark, "x"), storage.scratch_path(spark, "x")
    assert first != second
    table = storage.materialize(spark.range(5), "numbers")
    assert table.count() == 5 and "FileScan" in table._jdf.queryExecution().executedPlan().toString()


def test_missing_partition_column_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([(datetime.date(2020, 1, 1),)], "d date")
    with pytest.raises(AnalysisException):
        staging.write_staged(df, str(tmp_path / "s"))


def test_no_line_is_asked_for_its_file_where_all_files_match(spark, tmp_path):
    (tmp_path / "transactions").mkdir()
    (tmp_path / "transactions" / "part-0.csv").write_text("\n".join([HEADER, line(200607, "P1")]))
    df = staging.read_transactions(spark, str(tmp_path))
    assert "file_path" not in df._jdf.queryExecution().optimizedPlan().toString()
    (tmp_path / "other.csv").write_text("\n".join([HEADER, line(200607, "NO")]))
    df = staging.read_transactions(spark, str(tmp_path))
    assert "file_path" in df._jdf.queryExecution().optimizedPlan().toString()
    assert rows(df, "PROD_CODE") == [("P1",)]


def many(spark, n=600):
    """Some lines come twice, some have no basket and no week."""
    data = [{"SHOP_WEEK": i % 7 or None, "PROD_CODE": f"P{i // 2}", "BASKET_ID": f"B{i % 50}" if i % 9 else None} for i in range(n)]
    return lines(spark, data)


def test_written_tables_leave_no_shuffle_behind(spark, tmp_path):
    df, before = many(spark).repartition(3), shuffle_files(spark)
    staging.write_raw(df, str(tmp_path / "transactions"), "BASKET_ID")
    staging.write_staged(df, str(tmp_path / "staged"))
    assert left_over(spark, before) == set()


def test_passes_take_every_line_once(spark, tmp_path, monkeypatch):
    source, raw, target = (str(tmp_path / name) for name in ("source", "transactions", "staged"))
    many(spark).repartition(6).write.parquet(source)
    df = spark.read.parquet(source)
    monkeypatch.setattr(storage, "PASS_BYTES", 1)
    assert storage.passes(df) == storage.PASSES
    for _ in range(2):  # a table that is there is written over
        staging.write_raw(df, raw, "BASKET_ID")
        staging.write_staged(staging.read_transactions(spark, raw, "*.csv.gz"), target, by_file=True)
    assert rows(staging.read_staged(spark, target, TRANSACTIONS)) == rows(df) == rows(many(spark))


def test_a_pass_reads_its_own_files_only(spark, raw, tmp_path, monkeypatch):
    scan = staging.read_transactions(spark, raw)
    monkeypatch.setattr(storage, "PASS_BYTES", 1)
    read, where = [], type(scan).where

    def seen(df, condition):
        part = where(df, condition)
        read.append(sorted(name.rsplit("/", 1)[-1] for name in {r[0] for r in part.select("_metadata.file_path").collect()}))
        return part

    monkeypatch.setattr(type(scan), "where", seen)
    staging.write_staged(scan, str(tmp_path / "staged"), by_file=True)
    monkeypatch.undo()
    assert sorted(sum(read, [])) == ["my_transactions.csv", "transactions_200607.csv"]


def test_raw_files_are_compressed_and_bounded(spark, tmp_path):
    staging.write_raw(many(spark).coalesce(1), str(tmp_path / "transactions"), "BASKET_ID")
    names = [p.name for p in (tmp_path / "transactions").iterdir() if p.name.startswith("part-")]
    assert names and all(name.endswith(".csv.gz") for name in names)
    assert rows(staging.read_transactions(spark, str(tmp_path))) == rows(many(spark))


def test_one_pass_over_little_or_nothing(spark, raw, tmp_path):
    assert storage.passes(staging.read_transactions(spark, raw)) == 1
    assert storage.passes(staging.read_transactions(spark, str(tmp_path / "missing"))) == 1
