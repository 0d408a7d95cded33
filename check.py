"""Run registered queries and compare each with its SQL on DuckDB.

    python check.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import signal
import sys
import time
import traceback

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def kind(name: str) -> str:
    name = name.lower()
    return {"long": "bigint", "integer": "int", "text": "string", "varchar": "string", "float": "float"}.get(name, name)


def compare(spark, con, name, fn, sql, sf_dir):
    start = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    names = df.columns
    if sql is None:
        return "rows", f"{len(rows)} rows", took
    start = time.time()
    result = con.execute(sql)
    their_names = [d[0] for d in result.description]
    their_types = {d[0]: str(d[1]).lower() for d in result.description}
    theirs = result.fetchall()
    sql_took = time.time() - start
    if sorted(names) != sorted(their_names):
        return "FAIL", f"columns {sorted(names)} != {sorted(their_names)}", took
    my_types = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    duck = {"bigint": "bigint", "integer": "int", "varchar": "string", "double": "double", "boolean": "boolean",
            "timestamp": "timestamp_ntz", "date": "date", "float": "float"}
    odd = {c: (my_types[c], their_types[c]) for c in names if duck.get(their_types[c], their_types[c]) != my_types[c]}
    a, b = canonical(rows, names), canonical(theirs, their_names)
    if a != b:
        mine, other = set(a), set(b)
        extra = [r for r in a if r not in other][:3]
        missing = [r for r in b if r not in mine][:3]
        return "FAIL", f"{len(a)} rows vs {len(b)}; only spark {extra}; only sql {missing}", took
    if odd:
        return "TYPES", f"{len(a)} rows, types {odd}", took
    return "ok", f"{len(a)} rows (sql {sql_took:.1f}s)", took


def _late(*_):
    raise TimeoutError("query took too long")


def main(argv):
    import duckdb

    from tamra.plans import QUERIES
    from tamra.session import local_session

    sf, limit = "0.01", 60
    signal.signal(signal.SIGALRM, _late)
    if argv and argv[0] == "--sf":
        sf, argv = argv[1], argv[2:]
    if argv and argv[0] == "--limit":
        limit, argv = int(argv[1]), argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    picked = [n for n in QUERIES if not argv or any(n == a or (a.endswith('*') and n.startswith(a[:-1])) for a in argv)]
    for name in picked:
        q = QUERIES[name]
        signal.alarm(limit)
        try:
            status, note, took = compare(spark, con, name, q.run, q.sql, sf_dir)
        except Exception as error:  # noqa: BLE001 - one broken query must not hide the others
            status, took = "ERROR", 0.0
            note = f"{type(error).__name__}: {str(error)[:900]}"
            if "-v" in argv:
                traceback.print_exc()
        finally:
            signal.alarm(0)
        if status == "ERROR":
            spark.sparkContext.cancelAllJobs()
        bad += status not in ("ok", "rows")
        print(f"{status:6} {name:28} {took:6.1f}s  {note}", flush=True)
    print(f"{len(picked)} queries, {bad} bad")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
