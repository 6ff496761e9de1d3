"""Run queries and their SQL side by side: python tests/compare.py [sf] [name ...]"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([columns[i] for i in order]), sorted((tuple(row[i] for i in order) for row in data), key=repr)


def compare(spark, con, name, sf_dir):
    """None if both agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    have = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(entry.oracle_sql()[name])
    want = rows([d[0] for d in cursor.description], cursor.fetchall())
    if have == want:
        return None
    if have[0] != want[0]:
        return f"columns {have[0]} / {want[0]}"
    only_have, only_want = set(have[1]) - set(want[1]), set(want[1]) - set(have[1])
    return f"{len(have[1])} / {len(want[1])} rows\n  spark {sorted(only_have, key=repr)[:3]}\n  sql   {sorted(only_want, key=repr)[:3]}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    session = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config(
        "spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in sys.argv[2:] or entry.oracle_sql():
        start = time.time()
        try:
            result = compare(session, con, name, sf_dir)
        except Exception as error:  # report and go on
            result = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{name}: {'ok' if result is None else result} ({time.time() - start:.1f}s)", flush=True)
