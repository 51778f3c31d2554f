"""Compare every registered query with its DuckDB twin."""

from __future__ import annotations

import math
import sys
import time

from pyspark.sql import SparkSession

from inkfold.plans import oracles, queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return round(float(value), 6) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str:
    """Empty when both engines agree, else what differs."""
    found = queries.REGISTRY[name](spark, sf_dir)
    left = rows_of(found.columns, [tuple(r) for r in found.collect()])
    result = con.execute(oracles.sql()[name])
    right = rows_of([d[0] for d in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"row counts {len(left[1])} / {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{len(wrong)} of {len(left[1])} rows differ, first {wrong[0]}" if wrong else ""


def main(sf_dir: str, names: list[str]) -> None:
    spark = (SparkSession.builder.master("local[8]").config("spark.driver.memory", "12g")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, known = connect(sf_dir), oracles.sql()
    for name in names or list(queries.REGISTRY):
        began = time.time()
        try:
            if name in known:
                verdict = compare(spark, con, sf_dir, name) or "ok"
            else:
                verdict = f"rows only: {queries.REGISTRY[name](spark, sf_dir).count()}"
        except Exception as error:  # report and go on with the next query
            verdict = f"failed: {str(error)[:600]}"
        print(f"{name}: {verdict} ({time.time() - began:.1f} s)", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
