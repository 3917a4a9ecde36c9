"""Exact comparison of a Spark result with DuckDB on the same parquet files."""

import pathlib

import duckdb

TYPE_GROUPS = {
    "tinyint": "int", "smallint": "int", "integer": "int", "int": "int",
    "bigint": "bigint", "varchar": "string", "string": "string", "double": "double", "float": "float",
    "boolean": "boolean",
}


def connect(sf_dir):
    con = duckdb.connect()
    for file in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _sort_key(row):
    return tuple((v is None, str(v)) for v in row)


def compare(df, con, sql):
    """Raise AssertionError unless names, types and all values agree; return the row count."""
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    types = {d[0]: TYPE_GROUPS.get(str(d[1]).lower(), str(d[1]).lower()) for d in want.description}
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    order = sorted(names)
    got_types = {f.name: TYPE_GROUPS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    assert got_types == types, {c: (got_types[c], types[c]) for c in order if got_types[c] != types[c]}
    want_rows = [dict(zip(names, r)) for r in want.fetchall()]
    want_rows = sorted((tuple(r[c] for c in order) for r in want_rows), key=_sort_key)
    got_rows = sorted((tuple(r) for r in df.select(*order).collect()), key=_sort_key)
    assert len(got_rows) == len(want_rows), (len(got_rows), len(want_rows))
    different = [(g, w) for g, w in zip(got_rows, want_rows) if g != w]
    assert not different, (len(different), different[:3])
    return len(got_rows)
