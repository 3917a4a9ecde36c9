"""KPIs, dominant habits and index profiles against plain Python on small tables with ties, NULLs and skew."""

import random
from collections import defaultdict

import pytest

from basketlens.operators import habits, kpis, profiles
from basketlens.schema import HABITS
from basketlens.sources import storage
from tests.helpers import lines, rows, scattered


@pytest.fixture(scope="module")
def shop(spark):
    random.seed(11)
    data = []
    for i in range(900):
        hot = i % 3 == 0
        data.append(
            {
                "CUST_CODE": "HOT" if hot else random.choice([None, *(f"C{j}" for j in range(25))]),
                "BASKET_ID": random.choice([None, *(f"B{j}" for j in range(120))]),
                "BASKET_TYPE": random.choice(["Full", "Small", "TopUp", None]),
                "BASKET_SIZE": random.choice("SML"),
                "STORE_CODE": f"S{random.randrange(9)}",
                "SHOP_WEEKDAY": random.randrange(1, 8),
                "CUST_PRICE_SENSITIVITY": random.choice(["LA", "MM", None]),
                "PROD_CODE_40": f"D{random.randrange(4)}",
                "QUANTITY": random.randrange(0, 3),
                "SPEND": random.randrange(1000) / 100,
            }
        )
    data.append({"CUST_CODE": "NOBASKET", "BASKET_ID": None, "PROD_CODE_40": "D0", "QUANTITY": 1, "SPEND": 1.0})
    names = sorted({d["CUST_CODE"] for d in data if d["CUST_CODE"]})
    # The first customer has no segment, the last is alone in its segment, an unknown one has no lines.
    scored = [(c, 9 if c == names[-1] else n % 3) for n, c in enumerate(names) if n] + [("GHOST", 1)]
    return lines(spark, data), data, spark.createDataFrame(scored, "CUST_CODE string, CLUSTER_NUM int"), dict(scored)


def python_dominants(data, var):
    baskets = defaultdict(set)
    for d in data:
        if d["CUST_CODE"] and d["BASKET_ID"]:
            baskets[d["CUST_CODE"], d.get(var)].add(d["BASKET_ID"])
    top = defaultdict(int)
    for (c, _), b in baskets.items():
        top[c] = max(top[c], len(b))
    return {(c, v) for (c, v), b in baskets.items() if len(b) == top[c]}


@pytest.mark.parametrize("var", ["BASKET_TYPE", "STORE_CODE", "SHOP_WEEKDAY"])
def test_dominant_attribute_keeps_ties_and_null(shop, var):
    df, data, _, _ = shop
    want = python_dominants(data, var)
    for table in (df, scattered(df)):
        got = [tuple(r) for r in habits.dominant_attribute(table, var).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert habits.dominant_attribute(df, var).columns == ["CUST_CODE", f"DOM_CUST_{var}"]


def test_all_habits_in_one_pass(shop):
    df, data, _, _ = shop
    got = {tuple(r) for r in habits.dominant_attributes(df).collect()}
    want = {
        (c, var, None if v is None else str(v)) for var in HABITS for c, v in python_dominants(data, var)
    }
    assert got == want


def test_first_tie_and_wide_form(shop):
    df, data, _, _ = shop
    want = defaultdict(list)
    for c, v in python_dominants(data, "STORE_CODE"):
        want[c].append(v)
    first = habits.dominant_attribute(df, "STORE_CODE", ties="first")
    assert {tuple(r) for r in first.collect()} == {(c, min(v)) for c, v in want.items()}
    wide = habits.customer_attributes(df, ["STORE_CODE", "BASKET_SIZE"]).collect()
    assert {r["CUST_CODE"]: r["DOM_CUST_STORE_CODE"] for r in wide} == {c: sorted(v) for c, v in want.items()}
    with pytest.raises(ValueError):
        habits.dominant_attributes(df, ties="none")


def test_kpis(shop):
    df, data, scored, seg = shop
    groups = defaultdict(list)
    for d in data:
        if d["CUST_CODE"] in seg:
            groups[seg[d["CUST_CODE"]]].append(d)
    for table in (df, scattered(df)):
        got = {r["CLUSTER_NUM"]: r for r in kpis.segment_kpis(table, scored).collect()}
        assert set(got) == set(groups)
        for s, g in groups.items():
            sales, units = sum(round(d["SPEND"] * 100) for d in g) / 100, sum(d["QUANTITY"] for d in g)
            basks = len({d["BASKET_ID"] for d in g if d["BASKET_ID"]})
            custs = len({d["CUST_CODE"] for d in g})
            row = got[s]
            assert (row["TOT_SALES"], row["TOT_UNITS"], row["TOT_BASKS"], row["TOT_CUSTS"]) == (sales, units, basks, custs)
            assert row["SPEND_PER_BASK"] == (sales / basks if basks else None)
            assert row["UNITS_PER_CUST"] == units / custs
            assert row["PPU"] == (sales / units if units else None)


def test_kpis_with_zero_divisors_and_null_spend(spark):
    df = lines(
        spark,
        [
            {"CUST_CODE": "A", "BASKET_ID": None, "QUANTITY": 0, "SPEND": None},
            {"CUST_CODE": "B", "BASKET_ID": "B1", "QUANTITY": 0, "SPEND": 2.5},
        ],
    )
    scored = spark.createDataFrame([("A", 0), ("B", 1)], "CUST_CODE string, CLUSTER_NUM int")
    got = {r["CLUSTER_NUM"]: tuple(r)[1:] for r in kpis.segment_kpis(df, scored).collect()}
    assert got == {
        0: (None, 0, 0, 1, None, None, None, 0.0, None),
        1: (2.5, 0, 1, 1, 2.5, 0.0, 2.5, 0.0, None),
    }


def test_approximate_kpis_are_close(shop):
    df, _, scored, _ = shop
    exact = {r["CLUSTER_NUM"]: r for r in kpis.segment_kpis(df, scored).collect()}
    for r in kpis.segment_kpis(df, scored, approx=True).collect():
        assert abs(r["TOT_BASKS"] - exact[r["CLUSTER_NUM"]]["TOT_BASKS"]) <= 0.15 * exact[r["CLUSTER_NUM"]]["TOT_BASKS"]


def test_customer_in_two_segments(spark, shop):
    """KPIs count the customer in both segments; shares of a customer base can not, so profiles refuse."""
    df, _, scored, seg = shop
    more = scored.union(spark.createDataFrame([("HOT", 77)], scored.schema))
    got = {r["CLUSTER_NUM"]: tuple(r)[1:] for r in kpis.segment_kpis(df, more).collect()}
    alone = spark.createDataFrame([("HOT", 77)], scored.schema)
    assert got[77] == tuple(kpis.segment_kpis(df, alone).first())[1:]
    assert got[seg["HOT"]] == {r["CLUSTER_NUM"]: tuple(r)[1:] for r in kpis.segment_kpis(df, scored).collect()}[seg["HOT"]]
    with pytest.raises(Exception, match="customer in two segments: HOT"):
        profiles.segment_profiles(df, more, ["PROD_CODE_40"]).collect()
    twice = profiles.segment_profiles(df, scored.union(scored), ["PROD_CODE_40"])
    assert rows(twice) == rows(profiles.segment_profiles(df, scored, ["PROD_CODE_40"]))


def test_kpis_multiply_no_rows(spark):
    trans = spark.createDataFrame([("C", "B", 1.0, 1)], "CUST_CODE string, BASKET_ID string, SPEND double, QUANTITY int")
    scored = spark.createDataFrame([("C", 1)], "CUST_CODE string, CLUSTER_NUM int")
    plan = kpis.segment_kpis(trans, scored)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Aggregate" in plan


def test_join_of_a_hot_customer_is_split(spark):
    """Without broadcast, the runtime splits the partition of a customer with most of the baskets."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    data = spark.range(20000).selectExpr(
        "case when id % 3 = 0 then 'HOT' else concat('C', id % 500) end as CUST_CODE",
        "concat('B', id div 2) as BASKET_ID",
        "1 as QUANTITY",
        "cast(1 as float) as SPEND",
    )
    scored = data.select("CUST_CODE").distinct().selectExpr("CUST_CODE", "cast(0 as int) as CLUSTER_NUM")
    scored = storage.materialize(scored, "scored")
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        table = kpis.segment_kpis(data, scored)
        row = table.first()
        assert (row["TOT_SALES"], row["TOT_BASKS"], row["TOT_CUSTS"]) == (20000.0, 10000, 501)
        table.collect()
        assert "skew=true" in table._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def python_profile(cells, members):
    """cells: {(customer, value)}; members: {customer: segment}."""
    size, total = defaultdict(int), len(members)
    for s in members.values():
        size[s] += 1
    seg, overall = defaultdict(set), defaultdict(set)
    for c, v in cells:
        if c in members and v is not None:
            seg[members[c], v].add(c)
            overall[v].add(c)
    return {
        (str(v), s): (len(cs) / size[s], len(cs) / size[s] / (len(overall[v]) / total) * 100)
        for (s, v), cs in seg.items()
    }


def as_profile(df):
    return {(r["var_detail"], r["CLUSTER_NUM"]): (r["PERC_SEG"], r["INDEX"]) for r in df.collect()}


def test_segment_profiles(shop):
    df, data, scored, seg = shop
    with_basket = {d["CUST_CODE"] for d in data if d["CUST_CODE"] and d["BASKET_ID"]}
    members = {c: s for c, s in seg.items() if c in with_basket}
    assert "NOBASKET" in seg and "NOBASKET" not in members
    got = profiles.segment_profiles(
        df, scored, ["DOM_CUST_BASKET_TYPE", "DOM_CUST_SHOP_WEEKDAY", "CUST_PRICE_SENSITIVITY", "PROD_CODE_40"]
    ).cache()
    for var in ("BASKET_TYPE", "SHOP_WEEKDAY"):
        assert as_profile(got.where(f"var = 'DOM_CUST_{var}'")) == python_profile(python_dominants(data, var), members)
    for var in ("CUST_PRICE_SENSITIVITY", "PROD_CODE_40"):
        cells = {(d["CUST_CODE"], d.get(var)) for d in data}
        assert as_profile(got.where(f"var = '{var}'")) == python_profile(cells, members)
    assert got.columns == ["var_detail", "CLUSTER_NUM", "PERC_SEG", "INDEX", "var"]
    assert got.count() == len({tuple(r)[:2] + (r["var"],) for r in got.collect()})
    sizes = {r[0]: r[1] for r in profiles.segment_sizes(profiles.profile_members(df, scored)).collect()}
    assert sum(sizes.values()) == len(members) == profiles.customer_total(profiles.profile_members(df, scored)).first()[0]
    with pytest.raises(ValueError):
        profiles.segment_profiles(df, scored, [])


def test_profile_of_any_table(shop):
    df, data, scored, seg = shop
    joined = df.select("CUST_CODE", "PROD_CODE_40").join(scored, "CUST_CODE")
    members = {d["CUST_CODE"]: seg[d["CUST_CODE"]] for d in data if d["CUST_CODE"] in seg}
    cells = {(d["CUST_CODE"], d.get("PROD_CODE_40")) for d in data}
    assert as_profile(profiles.segment_profile(joined, "PROD_CODE_40")) == python_profile(cells, members)


def test_plans_have_no_cross_joins_and_no_single_task_over_lines(shop):
    df, _, scored, _ = shop
    for table in (profiles.segment_profiles(df, scored), kpis.segment_kpis(df, scored), habits.dominant_attributes(df)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        # The only rows that meet in one task are the sizes of the segments.
        assert plan.count("SinglePartition") == (1 if "PERC_SEG" in table.columns else 0)


def test_amounts_that_are_no_numbers_count_as_missing(spark):
    spend = [1.5, float("nan"), float("inf"), 1e30, None, 2.25]
    trans = lines(spark, [{"CUST_CODE": "C", "BASKET_ID": "B", "QUANTITY": 1, "SPEND": s} for s in spend])
    scored = spark.createDataFrame([("C", 0)], "CUST_CODE string, CLUSTER_NUM int")
    row = kpis.segment_kpis(trans, scored).first()
    assert (row["TOT_SALES"], row["TOT_UNITS"]) == (3.75, 6)


@pytest.mark.parametrize("make, exchanges", [(habits.habit_counts, 2), (habits.dominant_attributes, 3)])
def test_exchanges_of_habits(shop, make, exchanges):
    df = shop[0]
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = make(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == exchanges, plan


def _plan(df):
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def test_baskets_whose_lines_differ(spark):
    """Every value of a basket counts once, whether its lines agree or not; no set is gathered for it."""
    found = [("C", "A", "S", 1), ("C", "A", "S", 2), ("C", "A", None, 1), ("C", "B", "S", 1), ("C", "B", "S", 1), ("D", "A", "S", 1), ("C", None, "S", 1)]
    trans = lines(spark, [{"CUST_CODE": c, "BASKET_ID": b, "BASKET_TYPE": t, "SHOP_HOUR": h} for c, b, t, h in found])
    counts = habits.habit_counts(trans, ["BASKET_TYPE", "SHOP_HOUR"])
    assert {tuple(r) for r in counts.collect()} == {
        ("C", "BASKET_TYPE", "S", 2), ("C", "BASKET_TYPE", None, 1), ("C", "SHOP_HOUR", "1", 2), ("C", "SHOP_HOUR", "2", 1),
        ("D", "BASKET_TYPE", "S", 1), ("D", "SHOP_HOUR", "1", 1),
    }
    assert "ObjectHashAggregate" not in _plan(habits.habit_counts(trans)) and "SortAggregate" not in _plan(habits.habit_counts(trans))


def test_unfolded_traits_are_not_shuffled(shop):
    df, _, scored, _ = shop
    plan = _plan(profiles.segment_profiles(df, scored, ["PROD_CODE_30", "PROD_CODE_40"]))
    assert not [row for row in plan.splitlines() if "Exchange hashpartitioning" in row and "CUST_CODE" in row and "value" in row], plan
