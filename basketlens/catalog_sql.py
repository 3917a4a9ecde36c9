"""SQL counterparts of the registered queries, written for DuckDB and independent of the operators."""

import math

from basketlens.schema import HABITS, REPORT_VARIABLES

TRANS = """
trans as (
  select cast(year(o_orderdate)*100 + floor((dayofyear(o_orderdate)-1)/7) + 1 as int) as SHOP_WEEK,
    cast(year(o_orderdate)*10000 + month(o_orderdate)*100 + day(o_orderdate) as int) as SHOP_DATE,
    cast(isodow(o_orderdate) as int) as SHOP_WEEKDAY,
    cast(8 + o_orderkey % 14 as int) as SHOP_HOUR,
    cast(l_quantity as int) as QUANTITY,
    cast(l_extendedprice*(1-l_discount) as decimal(18,4)) as SPEND,
    concat('P', cast(l_partkey as varchar)) as PROD_CODE,
    concat(p_type, '|', p_brand, '|', cast(p_size as varchar)) as PROD_CODE_10,
    concat(p_type, '|', p_brand, '|', case when p_size <= 25 then 'LO' else 'HI' end) as PROD_CODE_20,
    concat(p_type, '|', p_brand) as PROD_CODE_30,
    p_type as PROD_CODE_40,
    case when o_orderkey % 13 = 0 then null else concat('C', cast(o_custkey as varchar)) end as CUST_CODE,
    case when o_orderkey % 13 = 0 then null when c_acctbal < 2500 then 'LA'
         when c_acctbal < 6500 then 'MM' else 'UM' end as CUST_PRICE_SENSITIVITY,
    case when o_orderkey % 13 = 0 or c_custkey % 11 = 0 then null else c_mktsegment end as CUST_LIFESTAGE,
    concat('B', cast(o_orderkey as varchar)) as BASKET_ID,
    case when o_totalprice < 100000 then 'S' when o_totalprice < 300000 then 'M' else 'L' end as BASKET_SIZE,
    case o_orderkey % 3 when 0 then 'LA' when 1 then 'MM' else 'UM' end as BASKET_PRICE_SENSITIVITY,
    o_orderpriority as BASKET_TYPE,
    o_orderstatus as BASKET_DOMINANT_MISSION,
    concat('S', cast(o_orderkey % 50 as varchar)) as STORE_CODE,
    case o_orderkey % 50 % 4 when 0 then 'SS' when 1 then 'MS' when 2 then 'LS' else 'XLS' end as STORE_FORMAT,
    n_name as STORE_REGION
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join part on l_partkey = p_partkey join nation on c_nationkey = n_nationkey
)"""

KNOWN = "known as (select * from trans where CUST_CODE is not null)"

SCORED = """
scored as (
  select distinct CUST_CODE, cast(cast(substr(CUST_CODE, 2) as bigint) % 7 as int) as CLUSTER_NUM from known
)"""

# Documents over the 500 most frequent products, index 0 for all others.
DOCS = """
vocab as (
  select PROD_CODE, cast(row_number() over (order by n_rows desc, PROD_CODE) as int) as prod_idx, n_rows
  from (select PROD_CODE, count(*) as n_rows from known group by PROD_CODE order by n_rows desc, PROD_CODE limit 499)
),
pairs as (
  select CUST_CODE, PROD_CODE, coalesce(prod_idx, 0) as prod_idx
  from (select distinct CUST_CODE, PROD_CODE from known) left join vocab using (PROD_CODE)
),
docs as (
  select CUST_CODE, cast(count(*) filter (where prod_idx = 0) as int) as n_unknown,
    list(prod_idx order by prod_idx) as document, count(*) as n
  from pairs group by CUST_CODE
),
long_docs as (select * from docs where n > 8)"""

CUSTOMER_INDEX = """
customer_index as (
  select CUST_CODE, row_number() over (order by substr(md5(CUST_CODE), 1, 3), CUST_CODE) - 1 as cust_idx
  from (select distinct CUST_CODE from known)
)"""

# Column name -> type name in the schema report.
TYPES = {
    **dict.fromkeys(["SHOP_WEEK", "SHOP_DATE", "SHOP_WEEKDAY", "SHOP_HOUR", "QUANTITY"], "int"),
    "SPEND": "decimal(18,4)",
    **dict.fromkeys(
        """PROD_CODE PROD_CODE_10 PROD_CODE_20 PROD_CODE_30 PROD_CODE_40 CUST_CODE CUST_PRICE_SENSITIVITY
        CUST_LIFESTAGE BASKET_ID BASKET_SIZE BASKET_PRICE_SENSITIVITY BASKET_TYPE BASKET_DOMINANT_MISSION
        STORE_CODE STORE_FORMAT STORE_REGION""".split(),
        "string",
    ),
}
STRINGS = [c for c, t in TYPES.items() if t == "string"]
NUMBERS = [c for c, t in TYPES.items() if t != "string"]


def _with(*parts: str) -> str:
    return "with " + ",".join(parts) + "\n"


def _union(selects) -> str:
    return "\nunion all\n".join(selects)


def _dominants(variables=HABITS, name="dominants") -> str:
    """(CUST_CODE, var, value) one variable at a time, all ties."""
    one = """select CUST_CODE, '{v}' as var, value from (
      select CUST_CODE, cast({v} as varchar) as value, count(distinct BASKET_ID) as n,
        max(count(distinct BASKET_ID)) over (partition by CUST_CODE) as top
      from known group by CUST_CODE, {v}) where n = top"""
    return f"{name} as (" + _union(one.format(v=v) for v in variables) + ")"


def _profile(variables) -> str:
    habits = [v for v in variables if v.startswith("DOM_CUST_")]
    traits = [v for v in variables if not v.startswith("DOM_CUST_")]
    rows = [f"select distinct CUST_CODE, '{v}' as var, {v} as value from known" for v in traits]
    if habits:
        rows.append("select CUST_CODE, 'DOM_CUST_' || var as var, value from dominants")
    parts = [TRANS, KNOWN, SCORED]
    if habits:
        parts.append(_dominants([v.removeprefix("DOM_CUST_") for v in habits]))
    parts += [
        "cells as (" + _union(rows) + ")",
        """seg as (select CLUSTER_NUM, var, value, count(distinct CUST_CODE) as n
           from cells join scored using (CUST_CODE) group by CLUSTER_NUM, var, value)""",
        """overall as (select var, value, count(distinct CUST_CODE) as n
           from cells join scored using (CUST_CODE) group by var, value)""",
        "size as (select CLUSTER_NUM, count(*) as n from scored group by CLUSTER_NUM)",
    ]
    return (
        _with(*parts)
        + """select seg.value as var_detail, seg.CLUSTER_NUM as CLUSTER_NUM,
        seg.n / size.n as PERC_SEG,
        (seg.n / size.n) / (overall.n / (select count(*) from scored)) * 100 as INDEX,
        seg.var as var
        from seg join size on seg.CLUSTER_NUM = size.CLUSTER_NUM
          join overall on seg.var = overall.var and seg.value = overall.value"""
    )


# The first training step: hashed start values, the softmax of one window per customer, one step against its mean gradient.
STEP_DIM, STEP_RATE, INIT_LIMIT, OUTPUT_LIMIT = 8, 10, 0.05, math.sqrt(6 / (500 + 8))


def _first_step(method: str) -> str:
    def start(layer, key, limit):
        text = f"'1:{layer}:' || cast({key} as varchar) || ':' || cast(d as varchar)"
        unit = f"cast(('0x' || substr(md5({text}), 1, 8))::bigint as double) / cast('4294967296' as double)"
        return f"cast(cast(({unit} * 2 - 1) * cast('{limit!r}' as double) as float) as double)"

    draw = "('0x' || substr(md5('1:0:' || CUST_CODE), 1, 8))::bigint % (n - 8)"
    if method == "dm":
        drawn = f"""select CUST_CODE, document[p-3:p] || document[p+2:p+5] as context, [document[p+1]] as targets
          from (select *, {draw} + 4 as p from long_docs)"""
        used = "select CUST_CODE, unnest(context) as prod_idx from drawn"
        hidden = """select CUST_CODE, d, (v + s) / 9 as h from customer join (
          select CUST_CODE, d, sum(v) as s from used join product using (prod_idx) group by CUST_CODE, d) using (CUST_CODE, d)"""
        extra = """union all select 'product', null, prod_idx, d, v - {rate} * coalesce(g, 0) from product left join (
          select prod_idx, d, sum(back) as g from used join backs using (CUST_CODE) group by prod_idx, d) using (prod_idx, d)"""
    else:
        drawn = f"""select CUST_CODE, document[p+1:p+8] as context, document[p+1:p+8] as targets
          from (select *, {draw} as p from long_docs)"""
        used = "select null as CUST_CODE, null as prod_idx"
        hidden = "select CUST_CODE, d, v as h from customer"
        extra = ""
    share = 9 if method == "dm" else 1
    parts = [
        TRANS, KNOWN, DOCS, f"drawn as ({drawn})", "size as (select cast(count(*) as double) as m from drawn)",
        f"dims as (select unnest(range({STEP_DIM})) as d)", "products as (select cast(unnest(range(500)) as int) as prod_idx)",
        f"customer as (select CUST_CODE, d, {start('customer', 'CUST_CODE', INIT_LIMIT)} as v from drawn cross join dims)",
        f"output as (select prod_idx, d, {start('output', 'prod_idx', OUTPUT_LIMIT)} as v from products cross join dims)",
        f"product as (select prod_idx, d, {start('product', 'prod_idx', INIT_LIMIT)} as v from products cross join dims)",
        f"used as ({used})", f"hidden as ({hidden})",
        "hs as (select CUST_CODE, list(h order by d) as h from hidden group by CUST_CODE)",
        "ws as (select prod_idx, list(v order by d) as w from output group by prod_idx)",
        "logits as (select CUST_CODE, prod_idx, h, w, exp(list_inner_product(h, w)) as e from hs cross join ws)",
        "totals as (select CUST_CODE, sum(e) as z from logits group by CUST_CODE)",
        """hit as (select CUST_CODE, prod_idx, count(*) / any_value(width) as y
          from (select CUST_CODE, unnest(targets) as prod_idx, len(targets) as width from drawn) group by CUST_CODE, prod_idx)""",
        """error as (select CUST_CODE, prod_idx, h, w, (e / z - coalesce(y, 0)) / m as g, coalesce(y, 0) * ln(z / e) / m as loss
          from logits join totals using (CUST_CODE) left join hit using (CUST_CODE, prod_idx) cross join size)""",
        f"backs as (select CUST_CODE, d, sum(g * w[d + 1]) / {share} as back from error cross join dims group by CUST_CODE, d)",
        "steps as (select prod_idx, d, sum(g * h[d + 1]) as g from error cross join dims group by prod_idx, d)",
        f"""moved(layer, CUST_CODE, prod_idx, place, value) as (
          select 'customer', CUST_CODE, cast(null as int), d, v - {STEP_RATE} * back from customer join backs using (CUST_CODE, d)
          union all select 'output', null, prod_idx, d, v - {STEP_RATE} * g from output join steps using (prod_idx, d)
          union all select 'output', null, prod_idx, {STEP_DIM}, - {STEP_RATE} * sum(g) from error group by prod_idx
          union all select 'loss', null, null, 0, sum(loss) from error
          {extra.format(rate=STEP_RATE)})""",
    ]
    return _with(*parts) + "select layer, CUST_CODE, prod_idx, cast(place as int) as place, round(value, 5) as value from moved"


CELLS = """
cell as (select vec_id, label, cast(unnest(embedding) as double) as v, unnest(range(len(embedding))) as d from embeddings)"""


def oracle_sql() -> dict[str, str]:
    sql = {}

    staged = ", ".join(f"round(cast(cast({c} as float) as double), 2) as {c}" if c == "SPEND" else c for c in TYPES)
    sql["staged_transactions"] = _with(TRANS) + f"select {staged} from trans"
    sql["staged_calendar"] = (
        _with(TRANS)
        + "select SHOP_WEEK, min(SHOP_DATE) as DATE_FROM, max(SHOP_DATE) as DATE_TO from trans group by SHOP_WEEK"
    )

    sql["dataset_summary"] = (
        _with(TRANS)
        + """select count(distinct BASKET_ID) + max(cast(BASKET_ID is null as bigint)) as n_basket_id,
        count(distinct PROD_CODE) + max(cast(PROD_CODE is null as bigint)) as n_prod_code,
        count(distinct SHOP_WEEK) + max(cast(SHOP_WEEK is null as bigint)) as n_shop_week from trans"""
    )
    sql["table_shape"] = _with(TRANS) + "select count(*) as n_rows, cast(22 as int) as n_columns from trans"
    # Parquet columns may be NULL, and so may what is made of them, but for joined texts and cases that name all values.
    never = ("PROD_CODE_10", "PROD_CODE_20", "PROD_CODE_30", "BASKET_SIZE", "BASKET_PRICE_SENSITIVITY", "STORE_FORMAT")
    sql["schema_report"] = _with(TRANS) + _union(
        f"""select cast({i} as int) as position, '{c}' as "column", '{t}' as type, {str(c not in never).lower()} as nullable,
        sum(case when {c} is null then 1 else 0 end) / count(*) as missing_rate from trans"""
        for i, (c, t) in enumerate(TYPES.items())
    )
    sql["head_records"] = (
        _with(TRANS)
        + """select * from trans
        order by SHOP_DATE, BASKET_ID, PROD_CODE, QUANTITY, SPEND limit 10"""
    )
    sql["duplicate_check"] = (
        _with(TRANS)
        + """select (select count(*) from trans) as n_rows,
        (select count(*) from (select distinct * from trans)) as n_distinct_rows"""
    )
    sql["missing_rates"] = _with(TRANS) + _union(
        f"select '{c}' as \"column\", sum(case when {c} is null then 1 else 0 end) / count(*) as missing_rate from trans"
        for c in TYPES
    )
    sql["top20_values"] = _with(TRANS) + _union(
        f"""select * from (select '{c}' as "column", {c} as value, count(*) as n_rows,
        cast(row_number() over (order by count(*) desc, {c} asc nulls last) as int) as position
        from trans group by {c}) where position <= 20"""
        for c in STRINGS
    )
    sql["numeric_profile"] = _with(TRANS) + _union(
        f"""select '{c}' as "column", round(avg(cast({c} as double)), 6) as mean, cast(max({c}) as double) as max,
        cast(min({c}) as double) as min, round(stddev_samp(cast({c} as double)), 6) as std from trans"""
        for c in NUMBERS
    )

    sql["sampled_customers"] = (
        _with(TRANS)
        + """select * from trans
        where ('0x' || substr(md5('42:' || CUST_CODE), 1, 8))::bigint < 2147483648"""
    )
    sql["customer_index"] = _with(TRANS, KNOWN, CUSTOMER_INDEX) + "select CUST_CODE, cust_idx from customer_index"
    sql["vocabulary"] = _with(TRANS, KNOWN, DOCS) + "select PROD_CODE, prod_idx, n_rows from vocab"
    sql["oov_summary"] = (
        _with(TRANS, KNOWN, DOCS)
        + "select count(*) as n_pairs, count(*) filter (where prod_idx = 0) as n_unknown from pairs"
    )
    sql["customer_documents"] = (
        _with(TRANS, KNOWN, DOCS) + "select CUST_CODE, n_unknown, array_to_string(document, ',') as document from docs"
    )
    sql["indexed_documents"] = (
        _with(TRANS, KNOWN, DOCS, CUSTOMER_INDEX)
        + """select cust_idx, n_unknown, array_to_string(document[n_unknown + 1:], ',') as prod_idxs
        from docs join customer_index using (CUST_CODE)"""
    )
    around = "array_to_string(document[{p}-3:{p}] || document[{p}+2:{p}+5], ',') as context"
    ahead = "array_to_string(document[{p}+1:{p}+8], ',') as context"
    sql["dm_pairs"] = (
        _with(TRANS, KNOWN, DOCS)
        + f"""select CUST_CODE, cast(p as int) as target_pos, {around.format(p="p")}, document[p + 1] as target
        from (select *, unnest(range(4, n - 4)) as p from long_docs)"""
    )
    sql["dbow_pairs"] = (
        _with(TRANS, KNOWN, DOCS)
        + f"""select CUST_CODE, cast(p as int) as start_pos, {ahead.format(p="p")}
        from (select *, unnest(range(0, n - 8)) as p from long_docs)"""
    )
    draw = "('0x' || substr(md5('1:3:' || CUST_CODE), 1, 8))::bigint % (n - 8)"
    sql["epoch_sample_dm"] = (
        _with(TRANS, KNOWN, DOCS)
        + f"""select CUST_CODE, cast(p as int) as pos, {around.format(p="p")}, document[p + 1] as target
        from (select *, {draw} + 4 as p from long_docs)"""
    )
    sql["epoch_sample_dbow"] = (
        _with(TRANS, KNOWN, DOCS)
        + f"""select CUST_CODE, cast(p as int) as pos, {ahead.format(p="p")}
        from (select *, {draw} as p from long_docs)"""
    )

    # The same over products in the order of their first purchase.
    dated = DOCS.replace("select CUST_CODE, PROD_CODE, coalesce(prod_idx, 0) as prod_idx", "select CUST_CODE, PROD_CODE, first, coalesce(prod_idx, 0) as prod_idx")
    dated = dated.replace("(select distinct CUST_CODE, PROD_CODE from known)", "(select CUST_CODE, PROD_CODE, min(SHOP_DATE) as first from known group by all)")
    dated = dated.replace("list(prod_idx order by prod_idx)", "list(prod_idx order by first, PROD_CODE)")
    for name in ("customer_documents", "dm_pairs", "epoch_sample_dbow"):
        sql["dated_" + name.removeprefix("customer_")] = sql[name].replace(DOCS, dated)

    sql["segment_kpis"] = (
        _with(TRANS, KNOWN, SCORED)
        + """select *, TOT_SALES / nullif(TOT_BASKS, 0) as SPEND_PER_BASK, TOT_UNITS / nullif(TOT_BASKS, 0) as UNITS_PER_BASK,
        TOT_SALES / nullif(TOT_CUSTS, 0) as SPEND_PER_CUST, TOT_UNITS / nullif(TOT_CUSTS, 0) as UNITS_PER_CUST,
        TOT_SALES / nullif(TOT_UNITS, 0) as PPU
        from (select CLUSTER_NUM, cast(sum(SPEND) as double) as TOT_SALES, cast(sum(QUANTITY) as bigint) as TOT_UNITS,
          count(distinct BASKET_ID) as TOT_BASKS, count(distinct CUST_CODE) as TOT_CUSTS
          from known join scored using (CUST_CODE) group by CLUSTER_NUM)"""
    )
    sql["kpi_report"] = sql["segment_kpis"]
    sql["habit_counts"] = _with(TRANS, KNOWN) + _union(
        f"""select CUST_CODE, '{v}' as var, cast({v} as varchar) as value, count(distinct BASKET_ID) as n_baskets
        from known group by CUST_CODE, {v}"""
        for v in HABITS
    )
    sql["dominant_attributes"] = _with(TRANS, KNOWN, _dominants()) + "select CUST_CODE, var, value from dominants"
    sql["dominant_attributes_first"] = (
        _with(TRANS, KNOWN, _dominants()) + "select CUST_CODE, var, min(value) as value from dominants group by CUST_CODE, var"
    )
    arrays = ", ".join(
        f"string_agg(value, '|' order by value) filter (where var = '{v}') as DOM_CUST_{v}" for v in HABITS
    )
    sql["customer_attributes"] = (
        _with(TRANS, KNOWN, _dominants()) + f"select CUST_CODE, {arrays} from dominants group by CUST_CODE"
    )
    sql["segment_sizes"] = (
        _with(TRANS, KNOWN, SCORED)
        + "select CLUSTER_NUM, count(distinct CUST_CODE) as TOT_CUSTS_SEG from scored group by CLUSTER_NUM"
    )
    sql["customer_total"] = _with(TRANS, KNOWN, SCORED) + "select count(distinct CUST_CODE) as TOT_CUSTS from scored"
    sql["segment_profile"] = _profile(["CUST_LIFESTAGE"])
    sql["segment_profiles_all"] = _profile(REPORT_VARIABLES)
    sql["segment_profiles_extra"] = _profile(
        ["DOM_CUST_STORE_CODE", "DOM_CUST_STORE_REGION", "CUST_LIFESTAGE", "PROD_CODE", "PROD_CODE_10", "PROD_CODE_20"]
    )

    # Silhouette with squared Euclidean distance in closed form: with n, sum and squared norm of a
    # cluster, the total distance of x to it is n*|x|^2 - 2*x.sum + norm.
    sql["silhouette_given_labels"] = """
    with cell as (
      select vec_id, label, cast(unnest(embedding) as double) as v, unnest(range(len(embedding))) as d from embeddings
    ),
    point as (select vec_id, label, sum(v*v) as norm from cell group by vec_id, label),
    axis as (select label, d, sum(v) as s from cell group by label, d),
    cluster as (select label, count(*) as n, sum(norm) as norm from point group by label),
    dot as (
      select cell.vec_id, axis.label as other, sum(cell.v * axis.s) as xs
      from cell join axis on cell.d = axis.d group by cell.vec_id, axis.label
    ),
    total as (
      select point.vec_id, point.label, other, cluster.n, cluster.n*point.norm - 2*xs + cluster.norm as dist
      from point join dot on point.vec_id = dot.vec_id join cluster on cluster.label = dot.other
    ),
    ab as (
      select vec_id, max(case when other = label then case when n > 1 then dist/(n-1) end end) as a,
        min(case when other <> label then dist/n end) as b,
        max(case when other = label then n end) as n
      from total group by vec_id
    )
    select round(avg(case when n = 1 then 0 when a < b then 1 - a/b when a > b then b/a - 1 else 0 end), 8) as silhouette
    from ab"""
    body = sql["silhouette_given_labels"]
    sql["silhouette_by_segment"] = (
        body.replace("select vec_id, max(case", "select vec_id, any_value(label) as label, max(case")
        .replace("select round(avg(", "select label, count(*) as n_rows, round(avg(")
        .replace("from ab", "from ab group by label")
    )
    sql["nearest_centroid_score"] = (
        _with(
            CELLS,
            "means as (select label, d, avg(v) as m from cell group by label, d)",
            """far as (select vec_id, means.label as seg, sum((v - m) * (v - m)) as far
              from cell join means on cell.d = means.d group by vec_id, means.label)""",
        )
        + "select cast(vec_id as varchar) as CUST_CODE, cast(arg_min(seg, far) as int) as CLUSTER_NUM from far group by vec_id"
    )
    for method in ("dm", "dbow"):
        sql[f"training_step_{method}"] = _first_step(method)
    return sql
