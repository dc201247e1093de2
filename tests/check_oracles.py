"""Run registered queries against their SQL forms: python tests/check_oracles.py SF_DIR [name part ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "<null>"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "<nan>"
        return repr(v + 0.0) if v != int(v) else repr(int(v))
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def compare(df, con, sql) -> str | None:
    """None when equal, otherwise what differs first."""
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    want_names, want = [c[0] for c in rel.description], rel.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    a, b = _rows(got_names, got), _rows(want_names, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return None if not bad else f"{len(bad)} rows differ, e.g. {str(bad[0])[:600]}"


def main(folder: str, parts: list[str]) -> int:
    from tabmill.catalog import ORACLES, QUERIES
    from tabmill.runtime import build_session

    spark = build_session(
        "oracles", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name, fn in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.monotonic()
        try:
            df = fn(spark, folder)
            if name in ORACLES:
                problem = compare(df, con, ORACLES[name])
            else:
                problem = None if df.count() >= 0 else "?"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        took = time.monotonic() - start
        print(f"{'ok  ' if problem is None else 'FAIL'} {took:6.2f}s {name}{'' if name in ORACLES else ' (rows only)'} {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
