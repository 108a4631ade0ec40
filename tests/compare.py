"""Runs registered queries against their SQL in DuckDB."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def spark_rows(frame) -> tuple[list[str], list[tuple]]:
    names = sorted(frame.columns)
    return names, sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def difference(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    names, got = spark_rows(query(spark, sf_dir))
    want_names, want = sql_rows(con, sql)
    if names != want_names:
        return f"{name}: columns {names} != {want_names}"
    for i, column in enumerate(names):
        kinds = [{type(r[i]) for r in rows if r[i] is not None} for rows in (got, want)]
        if kinds[0] != kinds[1] and got and want:
            return f"{name}: {column} is {kinds[0]}, wanted {kinds[1]}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2] if len(got) < 200_000 else []
        missing = [r for r in want if r not in set(got)][:2] if len(got) < 200_000 else []
        return f"{name}: {len(got)} rows, wanted {len(want)}; only here {extra}; only there {missing}"
    return None if got else f"{name}: no rows"


def main() -> None:
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from tidemart.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracle:
                wrong = difference(spark, con, name, query, oracle[name], sf_dir)
            else:
                wrong = None if query(spark, sf_dir).count() else f"{name}: no rows"
        except Exception as error:  # report and go on with the other queries
            wrong = f"{name}: {type(error).__name__} {str(error)[:600]}"
        print("ok  " if wrong is None else "BAD ", name, round(time.time() - start, 1),
              (wrong or "")[:900], flush=True)


if __name__ == "__main__":
    main()
