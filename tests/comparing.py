"""Side-by-side run of a registered query and its SQL."""
import datetime
import decimal
import glob
import math
import os
from collections import Counter

import duckdb

NUMERIC = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
           "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark, con, query, sql, sf_dir):
    """List of texts; empty if names, types and values agree."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = rows_of(names, result.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if NUMERIC.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} != {types[name]}")
    if got != want:
        problems.append(f"rows {sum(got.values())} != {sum(want.values())}; "
                        f"only here {list((got - want).items())[:3]}; "
                        f"only there {list((want - got).items())[:3]}")
    return problems
