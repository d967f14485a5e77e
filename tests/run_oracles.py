"""``python -m tests.run_oracles [folder] [name …]``: every query against its oracle, with times."""

import sys
import time

from queries import all_queries
from tests.oracle import compare, connect


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    from tests.sessions import local_session
    spark = local_session()
    queries, oracles = all_queries()
    con = connect(folder)
    bad = 0
    for name, fn in queries.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start, spent = time.time(), -1.0
        try:
            df = fn(spark, folder)
            if name in oracles:
                df.write.format("noop").mode("overwrite").save()
            spent = time.time() - start
            if name in oracles:
                outcome = compare(name, df, con, oracles[name])
            else:
                outcome = "" if df.count() >= 0 else "no rows"
        except Exception as error:  # report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(outcome)
        print(f"{'FAIL' if outcome else 'ok  '} {name:28s} {spent:6.2f}s "
              f"{'' if name in oracles else '(rows only) '}{outcome}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
