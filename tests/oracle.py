"""Compare named queries with their SQL on DuckDB.

    python tests/oracle.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, sf_dir: str, build, sql: str) -> str | None:
    """None when columns and the bag of rows agree, else what differs."""
    df = build(spark, sf_dir)
    columns = sorted(df.columns)
    ours = Counter(tuple(row[c] for c in columns) for row in df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    if ours != theirs:
        only_ours, only_theirs = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        return (
            f"{sum(ours.values())} rows != {sum(theirs.values())}; columns {columns}\n"
            f"  only here: {only_ours}\n  only in SQL: {only_theirs}"
        )
    return None if ours else "EMPTY"


def main() -> int:
    import __spark_entry__ as entry
    from wattlake.session import build_session

    sf_dir, *only = sys.argv[1:]
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, sf_dir, build, sqls[name])
            else:
                problem = f"no SQL; {build(spark, sf_dir).count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem) and problem != "EMPTY"
        print(f"{name:28} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
