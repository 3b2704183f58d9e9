"""Run registered queries next to their SQL: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return [(v is None, str(v)) for v in row]


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    """What differs between a query and its SQL: columns, types, or rows."""
    df = entry.queries()[name](spark, sf_dir)
    found = {c: TYPES.get(t, t) for c, t in df.dtypes}
    cursor = con.execute(entry.oracle_sql()[name])
    wanted = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    if found != wanted:
        return [f"columns: {found} != {wanted}"]
    order = sorted(found)
    at = [list(wanted).index(c) for c in order]
    left = sorted((tuple(r[c] for c in order) for r in df.collect()), key=_key)
    right = sorted((tuple(r[i] for i in at) for r in expected), key=_key)
    if len(left) != len(right):
        only = list(set(left) ^ set(right))[:4]
        return [f"rows: {len(left)} != {len(right)}; for example {only}"]
    bad = [
        f"{a} != {b}"
        for a, b in zip(left, right)
        if not all(_same(x, y) for x, y in zip(a, b))
    ]
    return bad[:5]


def main() -> None:
    from footfall import build_session
    from footfall.session import remove_work_dirs

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(entry.oracle_sql())
    spark = build_session(
        master="local[8]",
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            out = differences(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            out = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(out)
        print(f"{'ok ' if not out else 'BAD'} {name} {time.time() - start:.1f}s", flush=True)
        for line in out:
            print("    ", line, flush=True)
    remove_work_dirs(spark)
    print(f"{len(names) - bad} of {len(names)} match")


if __name__ == "__main__":
    main()
