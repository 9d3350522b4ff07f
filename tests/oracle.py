"""Runs a query and its SQL on the same tables and compares the rows."""

import os
import time

import duckdb

import __spark_entry__ as contract

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    cleaned = [tuple(None if v is None or v != v else v for v in row)
               for row in pdf.astype(object).itertuples(index=False, name=None)]
    return sorted(cleaned, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None
                                               else (True, "", "") for v in r))


def compare(spark, db, sf_dir, name):
    """None if the query equals its SQL, else what differs."""
    got = contract.queries()[name](spark, sf_dir).toPandas()
    want = db.execute(contract.oracle_sql()[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    got, want = rows(got), rows(want)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not want:
        return "no rows"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(want)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    import sys

    from pyspark.sql import SparkSession

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    for name in only or contract.queries():
        start = time.time()
        try:
            result = compare(spark, db, sf_dir, name)
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24s} {time.time() - start:6.1f}s {result or 'ok'}", flush=True)
