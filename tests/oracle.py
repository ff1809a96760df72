"""Compare registered queries with their SQL: names, row count and values, in any order."""

import datetime
import decimal
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


def database(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(int(value)) if value == int(value) else str(value)
    if isinstance(value, datetime.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S")
    # Sums of floats depend on their order in the last digits.
    if isinstance(value, float):
        return f"{value:.9g}"
    return None if value is None else str(value)


def difference(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a short text saying how they differ."""
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(([plain(v) for v in row] for row in df.select(*cols).collect()), key=repr)
    rel = con.execute(f"select * from ({sql}) q")
    names = [d[0] for d in rel.description]
    if sorted(names) != cols:
        return f"columns {cols} != {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in rel.description}
    wrong = [f"{c}: {t} vs {kinds[c]}" for c, t in df.dtypes if TYPES.get(t) != kinds[c]]
    if wrong:
        return f"types {wrong}"
    order = [names.index(c) for c in cols]
    want = sorted(([plain(row[i]) for i in order] for row in rel.fetchall()), key=repr)
    if got != want:
        only = [r for r in got if r not in want][:2] if len(got) < 5000 else [a for a, b in zip(got, want) if a != b][:2]
        miss = [r for r in want if r not in got][:2] if len(got) < 5000 else [b for a, b in zip(got, want) if a != b][:2]
        return f"rows {len(got)} vs {len(want)}; spark {str(only)[:700]} sql {str(miss)[:700]}"
    return None if got else "no rows"


def main(sf_dir, *names):
    import os
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from hirelake.session import session

    spark = session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = database(sf_dir), e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            result = difference(spark, con, name, fn, oracles[name], sf_dir) if name in oracles else "no SQL"
        except Exception as ex:  # noqa: BLE001
            result = f"{type(ex).__name__}: {str(ex)[:900]}"
        bad += result is not None
        print(f"{name:28s} {time.time() - t:6.2f}s {result or 'ok'}", flush=True)
    print("differences:", bad, "of", len(names) or len(e.queries()))


if __name__ == "__main__":
    main(*sys.argv[1:])
