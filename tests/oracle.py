"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import datetime
import decimal

import duckdb

from sampleledger.catalog import oracle_sql, queries
from sampleledger.catalog.inputs import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value) if value % 1 else int(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


_FAMILIES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def compare(spark, con, sf_dir: str, key: str) -> str | None:
    """None when equal, else what differs."""
    df = queries()[key](spark, sf_dir)
    cur = con.execute(oracle_sql()[key])
    theirs_types = {d[0]: str(d[1]) for d in cur.description}
    for name, kind in df.dtypes:
        if theirs_types.get(name) != _FAMILIES.get(kind):
            return f"type of {name}: {kind} / {theirs_types.get(name)}"
    ours = _sorted(df.columns, [tuple(r) for r in df.collect()])
    theirs = _sorted([d[0] for d in cur.description], cur.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"values {a} / {b}"
    return None if ours[1] else "no rows"


def main() -> None:
    import sys
    import time

    from sampleledger.session import local_session

    sf_dir, *only = sys.argv[1:]
    spark, con = local_session(8, 8), connect(sf_dir)
    bad = 0
    for key in oracle_sql():
        if only and not any(key.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            found = compare(spark, con, sf_dir, key)
        except Exception as e:  # report and go on with the others
            found = f"{type(e).__name__}: {str(e)[:600]}"
        bad += found is not None
        print(f"{'FAIL' if found else 'ok  '} {key} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{bad} failing", flush=True)


if __name__ == "__main__":
    main()
