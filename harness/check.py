"""Compare registered queries with their SQL on the same tables. Usage: python -m harness.check [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb

from covenant.session import local_session
from harness.queries import ORACLES, QUERIES

DEFAULT_DIR = "/root/testdata/sf0.01"


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = con.sql(sql)
    names = sorted(found.columns)
    order = [found.columns.index(n) for n in names]
    return names, Counter(tuple(row[i] for i in order) for row in found.fetchall())


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else DEFAULT_DIR
    wanted = argv[1:] or list(QUERIES)
    spark = local_session("check", 8)
    failures = 0
    for name in wanted:
        began = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            names = sorted(df.columns)
            actual = Counter(tuple(row[n] for n in names) for row in df.collect())
            seconds = time.time() - began
            if name not in ORACLES:
                print(f"rows  {name}: {sum(actual.values())} ({seconds:.1f}s)", flush=True)
                continue
            expected_names, expected = oracle_rows(sf_dir, ORACLES[name])
            same = names == expected_names and actual == expected
            failures += not same
            print(f"{'ok   ' if same else 'DIFF '} {name}: {sum(actual.values())} rows ({seconds:.1f}s)", flush=True)
            if not same:
                print("   columns", names, expected_names)
                print("   ours only  ", list((actual - expected).items())[:3])
                print("   theirs only", list((expected - actual).items())[:3])
        except Exception:
            failures += 1
            print(f"ERROR {name}", flush=True)
            print("\n".join(traceback.format_exc().splitlines()[-12:])[:1800])
    print(f"{len(wanted)} queries, {failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
