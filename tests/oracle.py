"""Runs a query and its SQL on the same tables and compares the results as multisets of rows."""

import sys
import time
from collections import Counter
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    if isinstance(v, float):
        return repr(v)
    return str(v) if v is not None else None


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, query, sql):
    df = query(spark, sf_dir)
    ours = bag(df.columns, df.collect())
    relation = con.sql(sql)
    theirs = bag(relation.columns, relation.fetchall())
    assert ours[0] == theirs[0], (name, ours[0], theirs[0])
    only_ours, only_theirs = ours[1] - theirs[1], theirs[1] - ours[1]
    assert not only_ours and not only_theirs, (
        name, sum(ours[1].values()), sum(theirs[1].values()), list(only_ours)[:3], list(only_theirs)[:3]
    )
    assert sum(ours[1].values()) > 0, name


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1]
    names = sys.argv[2:] or sorted(e.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(f"/root/testdata/{sf}")
    for n in names:
        start = time.time()
        try:
            compare(spark, con, f"/root/testdata/{sf}", n, e.queries()[n], e.oracle_sql()[n])
            print(f"ok   {time.time() - start:6.2f}s {n}", flush=True)
        except Exception as x:
            print(f"FAIL {time.time() - start:6.2f}s {n}: {str(x)[:600]}", flush=True)
