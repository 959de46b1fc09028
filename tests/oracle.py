"""Compare a registered query with its SQL in DuckDB.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

KINDS = {
    "bigint": "int", "int": "int", "integer": "int", "smallint": "int", "tinyint": "int", "hugeint": "hugeint",
    "double": "float", "float": "float", "string": "text", "varchar": "text", "boolean": "bool",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_cell(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(type(v)), v) for v in row),
    )


def compare(spark, con, name, query, sql, sf_dir) -> list[str]:
    """Differences between the two results; none means equal."""
    df = query(spark, sf_dir)
    got = df.collect()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = [str(d[1]).lower() for d in result.description]
    expected = result.fetchall()
    problems = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    spark_kinds = {c: KINDS.get(t, t) for c, t in df.dtypes}
    sql_kinds = {c: KINDS.get(t, t) for c, t in zip(columns, types)}
    if spark_kinds != sql_kinds:
        problems.append(f"types {spark_kinds} != {sql_kinds}")
    a, b = _sorted_rows(df.columns, got), _sorted_rows(columns, expected)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        shown = "; ".join(f"{str(x)[:300]} != {str(y)[:300]}" for x, y in bad[:2])
        problems.append(f"{len(bad)} rows differ: {shown}")
    if not a:
        problems.append("no rows")
    return problems


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from quillmill.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            if name in oracles:
                problems = compare(spark, con, name, queries[name], oracles[name], sf_dir)
            else:
                problems = [] if queries[name](spark, sf_dir).count() else ["no rows"]
        except Exception as error:  # noqa: BLE001  (report and go on)
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s {' | '.join(problems)}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
