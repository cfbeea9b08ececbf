"""Compare a query's rows with its SQL counterpart in DuckDB, in any row order.

    python -m workload.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def as_rows(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


SAME_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


def difference(spark, con, sf_dir: str, run, sql: str) -> str | None:
    """None if both sides agree on names, types and values; else what differs."""
    df = run(spark, sf_dir)
    names, got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    wanted_names, wanted = as_rows([d[0] for d in result.description], result.fetchall())
    if names != wanted_names:
        return f"columns {names} / {wanted_names}"
    kinds = dict(df.dtypes)
    wrong = {n: (kinds[n], t) for n, t in types.items() if SAME_TYPE.get(t, t) != kinds[n]}
    if wrong:
        return f"types {wrong}"
    if len(got) != len(wanted):
        return f"{len(got)} rows / {len(wanted)}"
    bad = [(g, w) for g, w in zip(got, wanted, strict=True) if g != w]
    if bad:
        first = [(n, a, b) for n, a, b in zip(names, *bad[0], strict=True) if a != b]
        return f"{len(bad)} of {len(got)} rows differ, first {first[:4]}"
    return None


def main(sf_dir: str, *only: str) -> int:
    from almanac.session import build_session
    from workload.oracles import ORACLES
    from workload.queries import QUERIES

    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = 0
    for name in only or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                problem = difference(spark, con, sf_dir, QUERIES[name], ORACLES[name])
            else:
                problem = None if QUERIES[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{time.time() - start:7.2f}s  {problem or ''}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
