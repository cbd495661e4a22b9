"""Run named queries and their SQL side by side."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and (math.isnan(value) or value == 0):
        return "nan" if math.isnan(value) else 0.0
    return value


def _key(row):
    return [(value is None, str(type(value)), str(value)) for value in row]


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=_key)


def differences(df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: str(d[1]) for d in expected.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = rows_of(names, expected.fetchall())
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if len(want) != len(got):
        return f"{len(got)} rows != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(want)} rows differ, first: {str(wrong[0])[:600]}"
    types = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    }
    for field in df.schema.fields:
        kind = types.get(field.dataType.simpleString())
        if kind != kinds[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} != {kinds[field.name]}"
    return None


def main(folder: str, chosen: list[str]) -> None:
    sys.path.insert(0, str(Path(__file__).parent.parent))
    import __spark_entry__ as entry
    from topiclens.session import build_session

    spark = build_session(
        master=f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        shuffle_partitions=8,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in sqls:
                wrong = differences(df, con, sqls[name])
                result = "ok" if wrong is None else "DIFFERS " + wrong
            else:
                result = f"rows {len(df.collect())}"
        except Exception as error:  # noqa: BLE001
            result = "ERROR " + str(error)[:700]
        print(f"{name:28s} {time.time() - start:6.2f}s {result}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
