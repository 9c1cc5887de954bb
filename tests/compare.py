"""Run registered queries next to their DuckDB statements and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TESTDATA = Path("/root/testdata")


def views(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted((TESTDATA / sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("n", str(value.normalize()))
    if isinstance(value, bool):
        return ("b", str(value))
    if isinstance(value, (int, float)):
        return ("n", repr(float(value)))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("t", value.isoformat())
    return ("s", str(value)) if value is not None else ("", "")


def rows(records, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in records)


def differences(spark, con, name, query, statement, sf):
    df = query(spark, str(TESTDATA / sf))
    result = con.execute(statement)
    expected_columns = [c[0] for c in result.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    got, expected = rows(df.collect(), df.columns), rows(result.fetchall(), expected_columns)
    if got != expected:
        sample = [(g, e) for g, e in zip(got, expected) if g != e][:2]
        return f"{len(got)} rows, {len(expected)} expected, first differences {sample}"
    types = {c[0]: str(c[1]) for c in result.description}
    print(name, len(got), [(f.name, f.dataType.simpleString(), types[f.name]) for f in df.schema.fields])
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from starloom.session import session

    sf, *names = sys.argv[1:]
    spark = session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = views(sf), entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names or name not in oracles:
            continue
        start = time.time()
        try:
            problem = differences(spark, con, name, query, oracles[name], sf)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{'ok' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    spark.stop()
