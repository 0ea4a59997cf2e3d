"""Compare registered queries with their SQL text in DuckDB: ``python tests/compare.py [sf_dir] [name ..]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when the DataFrame and the SQL give the same names and rows."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    expected, actual = bag(names, result.fetchall()), bag(df.columns, df.collect())
    kinds = {tuple(type(v).__name__ for v in row) for row in list(expected)[:50] if None not in row}
    seen = {tuple(type(v).__name__ for v in row) for row in list(actual)[:50] if None not in row}
    if expected != actual:
        return (f"{expected.total()} and {actual.total()} rows; only in SQL {list((expected - actual).items())[:2]}; "
                f"only in Spark {list((actual - expected).items())[:2]}")
    if kinds and seen and kinds != seen:
        return f"types {kinds} and {seen}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    from skyledger import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (session.builder("compare", "local[8]").config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE_PARTITIONS", "8"))
             .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), []
    for name, fn in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                count = con.execute(f"SELECT count(*) FROM ({sqls[name]})").fetchone()[0]
                outcome = difference(df, con, sqls[name]) or f"same, {count} rows"
            else:
                outcome = f"rows only: {df.count()}"
        except Exception as error:  # report and go on
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        if not outcome.startswith(("same", "rows only")) or outcome.endswith((" 0 rows", ": 0")):
            bad.append(name)
        print(f"{name:28} {time.time() - start:6.1f}s  {outcome}", flush=True)
    print("to look at:", bad)


if __name__ == "__main__":
    main()
