"""Run registered queries against their SQL: ``python -m tests.check <folder> [name ...]``."""

import sys
import time

from tests.support import connect, difference
from tradewind.session import local_session


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry

    spark, con, sql = local_session("check"), connect(folder), entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        begin = time.time()
        try:
            frame = build(spark, folder)
            found = difference(frame, con, sql[name]) if name in sql else f"no SQL, {frame.count()} rows"
        except Exception as error:  # report and go on with the next query
            found = f"ERROR {str(error)[:1500]}"
        bad += bool(found) and name in sql
        print(f"{time.time() - begin:6.2f}s {name}: {found or 'same'}", flush=True)
    print("differing:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
