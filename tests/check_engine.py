"""Runs registered queries on both engines and compares rows. ``python tests/check_engine.py SF [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return int(v)
    return v


def oracle_rows(con, sql: str):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    kinds = {names[i]: str(cur.description[i][1]) for i in order}
    return [names[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in cur.fetchall()), kinds


def spark_rows(df):
    names = df.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return [names[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in df.collect()), kinds


SAME_KIND = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    sn, sr, sk = spark_rows(df)
    on, orows, ok = oracle_rows(con, sql)
    if sn != on:
        return f"columns {sn} != {on}"
    kinds = [(c, sk[c], ok[c]) for c in sn if SAME_KIND.get(sk[c]) != ok[c].upper()]
    if kinds:
        return f"types {kinds}"
    if sr != orows:
        a, b = list((sr - orows).items())[:3], list((orows - sr).items())[:3]
        return (f"rows {sum(sr.values())} / {sum(orows.values())}, only spark {sum((sr - orows).values())}, only sql "
                f"{sum((orows - sr).values())}\n   {sn}\n   S {a}\n   O {b}")
    return None


def main(sf: str, names: list[str]) -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    from subrev.session import BUILD_CONF

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config(map=BUILD_CONF).config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sf}"
    con = connect(sf_dir)
    qs, sql = entry.queries(), entry.oracle_sql()
    print("without sql:", sorted(set(qs) - set(sql)), "sql only:", sorted(set(sql) - set(qs)))
    bad = 0
    for n in names or qs:
        t = time.time()
        try:
            problem = compare(qs[n](spark, sf_dir), con, sql[n]) if n in sql else f"rows {qs[n](spark, sf_dir).count()}"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{n}: {'ok' if problem is None else problem} [{time.time() - t:.1f}s]", flush=True)
    print("failed", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
