"""Run registered queries next to their checking SQL.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "bigint", "hugeint": "hugeint",
    "string": "text", "varchar": "text", "date": "date", "double": "double", "boolean": "bool", "timestamp": "timestamp",
}


def kind(name: str) -> str:
    name = name.lower()
    return name.replace(" ", "") if name.startswith("decimal") else KINDS.get(name, name)


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize() + 0)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return str(value)


def table_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("NULL" if row[i] is None else plain(row[i]) for i in order) for row in rows)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    engine = duckdb.connect()
    for table in TABLES:
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return engine


def differences(spark, folder: str, name: str, make, check: str, engine) -> list[str]:
    """What differs between a query and its check; empty if nothing does."""
    rows = make(spark, folder)
    expected = engine.execute(check)
    names = [column[0] for column in expected.description]
    found = []
    if sorted(names) != sorted(rows.columns):
        return [f"columns {sorted(rows.columns)} instead of {sorted(names)}"]
    want_types = {column[0]: kind(str(column[1])) for column in expected.description}
    for column, type_name in rows.dtypes:
        if kind(type_name) != want_types[column]:
            found.append(f"{column}: {type_name} instead of {want_types[column]}")
    want = table_rows(names, expected.fetchall())
    got = table_rows(rows.columns, rows.collect())
    if len(want) != len(got):
        found.append(f"{len(got)} rows instead of {len(want)}")
    if want != got:
        extra = sorted((Counter(got) - Counter(want)).elements())[:2]
        lacking = sorted((Counter(want) - Counter(got)).elements())[:2]
        found.append(f"values differ: extra {extra}, lacking {lacking}")
    if not want:
        found.append("check gives no rows")
    return found


def main() -> int:
    import __spark_entry__ as registry
    from sentinela.session import local_session

    folder, *chosen = sys.argv[1:] or ["/root/testdata/sf0.01"]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    engine = connect(folder)
    bad = 0
    for name, make in registry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            check = registry.oracle_sql().get(name)
            if check is None:
                result = f"{len(make(spark, folder).collect())} rows, no check"
            else:
                problems = differences(spark, folder, name, make, check, engine)
                bad += bool(problems)
                result = "; ".join(problems) or "equal"
        except Exception as error:  # report and go on with the next query
            bad += 1
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s  {result}", flush=True)
    print(f"{bad} queries differ or failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
