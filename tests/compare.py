"""Runs registered queries and their SQL twins side by side. Also a script: ``python -m tests.compare [sf] [name …]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TESTDATA = "/root/testdata"


def make_session(cores: str = "8") -> SparkSession:
    return (SparkSession.builder.master(f"local[{cores}]").appName("wardscope")
            .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
            .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
            .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.extraJavaOptions", "-Dlog4j2.level=ERROR").getOrCreate())


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value: object) -> object:
    """Comparable form of a value of either engine."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.9g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def table(names: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    body = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(body, key=lambda r: tuple((v is not None, str(type(v)), v) if not isinstance(
        v, (int, float)) else (True, "n", v) for v in r))


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, build, statement: str) -> str | None:
    """None when both results hold the same rows, else what differs."""
    df = build(spark, folder)
    ours = table(df.columns, df.collect())
    result = con.execute(statement)
    theirs = table([c[0] for c in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}; first {ours[1][:2]} against {theirs[1][:2]}"
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(wrong)} of {len(ours[1])} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    import __spark_entry__ as entry

    arguments = sys.argv[1:]
    scale = arguments.pop(0) if arguments and arguments[0][0].isdigit() else "0.001"
    folder = f"{TESTDATA}/sf{scale}"
    spark, con = make_session(), database(folder)
    spark.sparkContext.setLogLevel("ERROR")
    oracles, failed = entry.oracle_sql(), []
    for name, build in entry.queries().items():
        if arguments and not any(name.startswith(a) for a in arguments):
            continue
        start = time.time()
        try:
            if name in oracles:
                found = difference(spark, con, folder, build, oracles[name])
                verdict = "ok" if found is None else "DIFFERS " + found
            else:
                verdict = f"rows {len(build(spark, folder).collect())}"
        except Exception as error:  # the run goes on to the next query
            verdict = "ERROR " + " ".join(str(error).split())[:600]
        if verdict.startswith(("DIFFERS", "ERROR")):
            failed.append(name)
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
