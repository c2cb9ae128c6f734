"""Command-line form of the comparison: run_compare.py SF_DIR [names...]."""

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import __spark_entry__ as entry  # noqa: E402
from compare import compare, duckdb_connection  # noqa: E402
from tidewrack.session import build_session  # noqa: E402


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb_connection(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        started = time.time()
        try:
            if name in oracle:
                rows, problem = compare(spark, connection, queries[name], oracle[name], sf_dir)
            else:
                rows, problem = queries[name](spark, sf_dir).count(), ""
        except Exception as error:  # report and go on to the next query
            rows, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '}{name:32s} {rows:8d} {time.time() - started:6.2f}s {problem}", flush=True)
    print(f"{bad} bad of {len(names or queries)}; without SQL: {sorted(set(queries) - set(oracle))}")


if __name__ == "__main__":
    main()
