"""Run registered queries against their SQL in DuckDB and report differences.

    python tests/compare.py /root/testdata/sf0.01 [name prefix ...]
"""

from __future__ import annotations

import glob
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lagline.queries import load_all  # noqa: E402
from lagline.session import local_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def difference(spark, con, name, query, sf_dir) -> str | None:
    """What differs between the query and its SQL, or None."""
    df = query.run(spark, sf_dir)
    got_columns, got = _sorted_rows(df.columns, df.collect())
    if query.sql is None:
        return None if got else "no rows"
    result = con.execute(query.sql)
    want_columns, want = _sorted_rows([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    types = [(g, w) for g, w in zip(got[0], want[0]) if g is not None and w is not None and type(g) is not type(w)] if got else []
    if types:
        return f"types differ: {types}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str, prefixes: list[str]) -> int:
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, query in load_all().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            found = difference(spark, con, name, query, sf_dir)
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:600]}"
        bad += found is not None
        kind = "sql " if query.sql else "rows"
        print(f"{'ok  ' if found is None else 'BAD '} {kind} {time.time() - start:6.1f}s {name} {found or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
