"""Run registered queries beside their DuckDB oracles and report differences.

    python check_oracles.py [name part ...]     (SF_DIR selects the tables)
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardfold.session import build_session  # noqa: E402
from workload import oracles, registry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple((row[i] is None, str(row[i])) for i in order) for row in rows
    )


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, int]:
    """'' when result and schema agree, else what differs; and the row count."""
    df = registry.queries()[name](spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(oracles.oracle_sql()[name])
    rows = cursor.fetchall()
    columns = [d[0] for d in cursor.description]
    want = normal(columns, rows)
    types = {d[0]: str(d[1]) for d in cursor.description}
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}", len(got[1])
    wrong = {c: (t, types[c]) for c, t in df.dtypes if TYPES.get(t) != types[c]}
    if wrong:
        return f"types {wrong}", len(got[1])
    if got[1] != want[1]:
        only_spark, only_duck = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
        return f"rows {len(got[1])} / {len(want[1])}: {sorted(only_spark)[:2]} / {sorted(only_duck)[:2]}", len(got[1])
    return "", len(got[1])


def main() -> int:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "check",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in registry.queries():
        if len(sys.argv) > 1 and not any(part in name for part in sys.argv[1:]):
            continue
        start = time.perf_counter()
        difference, rows = compare(spark, con, name, sf_dir)
        bad += bool(difference)
        print(f"{'FAIL' if difference else 'ok  '} {name} {rows} rows {time.perf_counter() - start:.1f}s {difference}", flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
