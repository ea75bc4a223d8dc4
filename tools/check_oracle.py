"""Run registered queries beside their oracle SQL and report differences.

usage: python tools/check_oracle.py SF_DIR [key-part ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_connection(base: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{base}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def compare(frame, connection, sql: str) -> str:
    """Reason of a difference, empty when columns and all rows agree."""
    relation = connection.sql(sql)
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} vs {sorted(relation.columns)}"
    names = sorted(frame.columns)
    ours = Counter(tuple(plain(r[n]) for n in names) for r in frame.collect())
    places = [relation.columns.index(n) for n in names]
    theirs = Counter(tuple(plain(r[i]) for i in places) for r in relation.fetchall())
    if ours == theirs:
        return "" if ours else "no rows on either side"
    lost, extra = list((theirs - ours).elements()), list((ours - theirs).elements())
    key = lambda row: tuple(str(v) for v in row)
    return (f"rows {sum(ours.values())} vs {sum(theirs.values())}; {len(extra)} only in Spark, {len(lost)} only in oracle\n"
            f"   {names}\n   spark  {sorted(extra, key=key)[:2]}\n   oracle {sorted(lost, key=key)[:2]}")


def main() -> int:
    from martloom.catalog import ORACLES, QUERIES
    from martloom.session import build_session
    base, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("oracle check", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    connection = oracle_connection(base)
    failed = []
    for key in QUERIES:
        if wanted and not any(part in key for part in wanted):
            continue
        begun = time.time()
        try:
            frame = QUERIES[key](spark, base)
            reason = compare(frame, connection, ORACLES[key]) if key in ORACLES else ""
            rows = "" if key in ORACLES else f"  {frame.count()} rows, no oracle"
        except Exception as error:  # noqa: BLE001 - report and go on with the next key
            reason, rows = f"{type(error).__name__}: {str(error)[:700]}", ""
        if reason:
            failed.append(key)
        print(f"{'DIFF' if reason else 'ok  '} {key} {time.time() - begun:.1f}s{rows}{'  ' + reason if reason else ''}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
