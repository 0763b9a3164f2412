"""Run registered queries beside their SQL and compare: ``python tests/oracle.py [names...]`` (SF_DIR picks the data)."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    """One form for both engines; floats to 9 significant digits."""
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else float(f"{number:.9g}")
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value if isinstance(value, str) else str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, folder: str) -> str | None:
    """None when both sides agree, else what differs."""
    from taxaloom.plans import registered

    queries, sql = registered()
    df = queries[name](spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql[name])
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    theirs = rows_of(names, result.fetchall())
    if len(mine) != len(theirs):
        extra = [r for r in mine if r not in theirs][:3] if len(mine) < 5000 else []
        lack = [r for r in theirs if r not in mine][:3] if len(mine) < 5000 else []
        return f"{len(mine)} rows against {len(theirs)}; only here {extra}; only there {lack}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{sorted(names)}: {a} against {b}"
    return None if mine else "no rows on either side"


def main() -> int:
    from taxaloom.plans import registered
    from taxaloom.session import local_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    queries, sql = registered()
    names = sys.argv[1:] or list(queries)
    spark, con, bad = local_session(8, 8), connect(folder), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder) if name in sql else f"(rows only: {queries[name](spark, folder).count()})"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        ok = problem is None or problem.startswith("(rows only")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
